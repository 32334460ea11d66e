"""The queries of this subpackage and the SQL to compare them with."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from heddle.functions.tables import materialize, table
from heddle.llm import leakage, lines, names, packing, similar, subjects, truncation


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return lines.excessive_occurrences(table(spark, d, "items"))


def p1_clean(spark: SparkSession, d: str) -> DataFrame:
    return lines.without_excessive_lines(table(spark, d, "items"))


def _item_text() -> F.Column:
    return F.concat_ws("\n", "title", "abstract", "content")


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    links, member = similar.similar_pairs(table(spark, d, "items"), "id", _item_text(), threshold=0.5, shingle=3)
    return similar.all_pairs(links, member).select(F.col("a").alias("item_id_a"), F.col("b").alias("item_id_b"))


def p3_groups(spark: SparkSession, d: str) -> DataFrame:
    return similar.groups(*similar.similar_pairs(table(spark, d, "items"), "id", _item_text(), threshold=0.5, shingle=3))


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return truncation.truncated(table(spark, d, "items")).where("is_cut").select("item_id", "field")


def p4_rates(spark: SparkSession, d: str) -> DataFrame:
    return truncation.truncation_rates(table(spark, d, "items"))


def p4_limits(spark: SparkSession, d: str) -> DataFrame:
    return truncation.hidden_limits(table(spark, d, "items"))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return names.variants(table(spark, d, "items"), "id", "authors")


def p5_entities(spark: SparkSession, d: str) -> DataFrame:
    return names.entities(table(spark, d, "items"), "id", "authors")


def p6_pack(spark: SparkSession, d: str) -> DataFrame:
    sizes = materialize(packing.token_sizes(table(spark, d, "documents"), "doc_id", "text"))
    return packing.packed(sizes, table(spark, d, "pack_targets"))


def p6_filling(spark: SparkSession, d: str) -> DataFrame:
    return packing.filling(p6_pack(spark, d), table(spark, d, "pack_targets"))


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    return leakage.leaked(table(spark, d, "documents"), table(spark, d, "benchmark")).select("doc_id", "item_id")


def p7_report(spark: SparkSession, d: str) -> DataFrame:
    items = table(spark, d, "benchmark")
    return leakage.leak_report(leakage.leaked(table(spark, d, "documents"), items), items)


def p8_posteriors(spark: SparkSession, d: str) -> DataFrame:
    return subjects.subject_posteriors(table(spark, d, "documents"), table(spark, d, "subject_labels"), table(spark, d, "subjects"))


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    return p8_posteriors(spark, d).where("assigned").select("doc_id", "subject").distinct()


def p8_composition(spark: SparkSession, d: str) -> DataFrame:
    return subjects.composition(p8_posteriors(spark, d))


def queries() -> dict:
    return {k: v for k, v in globals().items() if k[0] == "p" and k[1:2].isdigit() and callable(v)}


_NORM = r"trim(regexp_replace(regexp_replace(lower(line), '\p{Nd}+', '', 'g'), '[\s\x{00A0}\x{2000}-\x{200A}\x{202F}\x{205F}\x{3000}\x{0085}\x{2028}\x{2029}]+', ' ', 'g'))"

_EXCESS = rf"""
WITH l AS (SELECT id, source, generate_subscripts(string_split(content, chr(10)), 1) AS line_no, unnest(string_split(content, chr(10))) AS line
           FROM items WHERE length(content) > 0),
k AS (SELECT id, source, line_no, line, {_NORM} AS norm FROM l),
n AS (SELECT source, count(*) AS n_source FROM items WHERE length(content) > 0 GROUP BY source),
c AS (SELECT source, norm, count(DISTINCT id) AS n_items FROM k WHERE norm <> '' GROUP BY source, norm),
x AS (SELECT c.source, c.norm FROM c JOIN n ON c.source IS NOT DISTINCT FROM n.source WHERE n_items >= 5 AND n_items >= 0.1 * n_source)
"""


_WORDS = r"regexp_extract_all(lower({0}), '[\p{{L}}\p{{N}}]+')"


def _runs(words: str, k: int) -> str:
    """The distinct runs of k words of a list, each as one string."""
    return f"list_distinct(list_transform(generate_series(1, len({words}) - {k - 1}), lambda i: array_to_string({words}[i:i + {k - 1}], ' ')))"


_PAIRS = f"""
WITH w AS (SELECT id, {_WORDS.format("coalesce(title, '') || ' ' || coalesce(abstract, '') || ' ' || coalesce(content, '')")} AS w FROM items),
r AS (SELECT id, {_runs('w', 3)} AS r FROM w), e AS (SELECT id, unnest(r) AS s FROM r), n AS (SELECT id, len(r) AS n FROM r),
p AS (SELECT a.id AS a, b.id AS b, count(*) AS c FROM e a JOIN e b ON a.s = b.s AND a.id < b.id GROUP BY ALL)
SELECT p.a AS item_id_a, p.b AS item_id_b FROM p JOIN n x ON x.id = p.a JOIN n y ON y.id = p.b WHERE c >= 0.5 * (x.n + y.n - c)"""

_LEAKS = f"""
WITH d AS (SELECT doc_id, {_WORDS.format('text')} AS w FROM documents WHERE length(text) > 0), i AS (SELECT item_id, {_WORDS.format('text')} AS w FROM benchmark WHERE length(text) > 0),
d3 AS (SELECT doc_id, unnest({_runs('w', 3)}) AS s FROM d), i3 AS (SELECT item_id, unnest({_runs('w', 3)}) AS s FROM i), n AS (SELECT item_id, count(*) AS n FROM i3 GROUP BY item_id),
d12 AS (SELECT doc_id, unnest({_runs('w', 12)}) AS s FROM d), i12 AS (SELECT item_id, unnest({_runs('w', 12)}) AS s FROM i)
SELECT doc_id, item_id FROM d12 JOIN i12 USING (s) UNION
SELECT doc_id, item_id FROM (SELECT doc_id, item_id, count(*) AS c FROM d3 JOIN i3 USING (s) GROUP BY ALL) JOIN n USING (item_id) WHERE c >= 0.6 * n"""


def oracle_sql() -> dict[str, str]:
    return {
        "p3_found": _PAIRS,
        "p7_found": _LEAKS,
        "p1_found": _EXCESS + "SELECT k.id AS item_id, k.line_no::BIGINT AS line_no FROM k JOIN x ON k.source IS NOT DISTINCT FROM x.source AND k.norm = x.norm",
        "p1_clean": _EXCESS
        + """, m AS (SELECT k.id, string_agg(k.line, chr(10) ORDER BY k.line_no) FILTER (x.norm IS NULL) AS text, count(x.norm) AS n_removed
           FROM k LEFT JOIN x ON k.source IS NOT DISTINCT FROM x.source AND k.norm = x.norm GROUP BY k.id)
        SELECT i.id AS item_id, CASE WHEN m.id IS NULL THEN i.content ELSE coalesce(m.text, '') END AS text, coalesce(m.n_removed, 0)::BIGINT AS n_removed
        FROM items i LEFT JOIN m ON i.id = m.id""",
    }
