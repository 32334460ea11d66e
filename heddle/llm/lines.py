"""Lines repeated across one source's documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from heddle.functions.tables import broadcast_if_small, has_text, materialize

MIN_ITEMS, MIN_SHARE, FALSE_DISCOVERY = 5, 0.10, 0.05
MAX_SOURCES = 5_000  # sources whose sets may go to all tasks: each holds at most (mean lines of an item) / MIN_SHARE hashes of 8 bytes


def line_key(line: F.Column) -> F.Column:
    """What makes two lines the same: without digits, in lower case, white space collapsed, ends trimmed."""
    return F.trim(F.regexp_replace(F.regexp_replace(F.lower(line), r"\p{Nd}+", ""), r"(?U)\s+", " "))


def line_hashes(text: F.Column) -> F.Column:
    """One 64-bit hash per line of ``text`` (lines parted by \\n, blank ones too); null for a line that is empty once normalised."""
    return F.transform(F.split(text, "\n", -1), lambda x: F.when(F.length(line_key(x)) > 0, F.xxhash64(line_key(x))))


def excessive_lines(items: DataFrame, id_col: str = "id", text: str = "content", source: str = "source", min_items: int = MIN_ITEMS, min_share: float = MIN_SHARE, q: float = FALSE_DISCOVERY) -> DataFrame:
    """The lines that stand excessively often in one source: ``source, line_hash, n_items, n_source, llr``.

    Document frequencies are counted per (source, line) over all items with text, with partial sums before the shuffle, so
    that one source or line holding a third of the rows is no hot spot, and written once. Every pair with ``min_items`` items is tested by the
    log-likelihood ratio of its rate within the source against its rate outside. Outside are the other sources, but for those in which the
    line reaches ``min_share`` too, so that a notice which many sites use isn't excused by them; a pseudo-count at the mean rate of all lines
    stands for a line that is nowhere else. Benjamini and Hochberg's step-up over all these pairs, read off a histogram of the ratios, keeps the
    share of false discoveries below ``q``: these are the lines in excess. Of them those count that reach ``min_share`` of their source's items.

    A line at ``min_share`` that is nearly as frequent outside, just below the share everywhere, isn't in excess. A null source counts as a
    source of its own. Items without text count for nothing. An empty table gives no lines.
    """
    rows = items.select(F.col(source).alias("source"), F.col(text).alias("text")).where(has_text(F.col("text")))
    per_source = rows.groupBy("source").agg(F.count("*").alias("n_source"))
    hashes = rows.select("source", F.explode(F.array_distinct(F.filter(line_hashes(F.col("text")), lambda h: h.isNotNull()))).alias("line_hash"))
    pairs = materialize(hashes.groupBy("line_hash", "source").agg(F.count("*").alias("n_items")))

    # one row: the number of hypotheses, of items, and the mean rate of a line; a pair below min_items can't be found and is no hypothesis (Tarone 1990)
    whole = pairs.agg(F.count("*").alias("n_pairs"), F.count_if(F.col("n_items") >= min_items).alias("m"), F.sum("n_items").alias("occurrences"))
    total = per_source.agg(F.sum("n_source").alias("n_all")).withColumn("one", F.lit(1)).join(whole.withColumn("one", F.lit(1)), "one")

    held = pairs.where(F.col("n_items") >= min_items).join(per_source, pairs["source"].eqNullSafe(per_source["source"])).select("line_hash", pairs["source"], "n_items", "n_source")
    held = materialize(held.withColumn("reaches", F.col("n_items") >= F.col("n_source") * F.lit(min_share)))
    # a line's counts outside: its count everywhere, less those of the sources in which it reaches the share, and of the source itself
    inside = held.where("reaches").groupBy("line_hash").agg(F.sum("n_items").alias("in_items"), F.sum("n_source").alias("in_source"))
    everywhere = pairs.join(held.select("line_hash").distinct(), "line_hash", "left_semi").groupBy("line_hash").agg(F.sum("n_items").alias("all_items"))
    tested = held.join(everywhere, "line_hash").join(inside, "line_hash", "left").withColumn("one", F.lit(1)).join(F.broadcast(total), "one")
    others = lambda c, within: F.coalesce(within, F.lit(0)) + F.when(F.col("reaches"), 0).otherwise(F.col(c))
    rate = F.col("occurrences") / F.col("n_pairs") / F.col("n_all")
    tested = tested.withColumn("b", F.col("all_items") - others("n_items", F.col("in_items")) + 1.0).withColumn("outside", F.col("n_all") - others("n_source", F.col("in_source")) + F.greatest(1.0 / rate, F.lit(1.0)))

    def part(k, n, p):
        other = n - k
        return F.when(k > 0, k * F.log(k / (n * p))).otherwise(0.0) + F.when(other > 0, other * F.log(other / (n * F.greatest(1 - p, F.lit(1e-12))))).otherwise(0.0)

    pooled = (F.col("n_items") + F.col("b")) / (F.col("n_source") + F.col("outside"))
    ratio = 2 * (part(F.col("n_items").cast("double"), F.col("n_source"), pooled) + part(F.col("b"), F.col("outside"), pooled))
    excess = F.col("n_items") / F.col("n_source") > F.col("b") / F.col("outside")
    tested = tested.withColumn("llr", F.when(excess, ratio).otherwise(0.0))

    # step-up: the least ratio at which m * p(ratio) <= q * (pairs with at least that ratio); at most 2,000 bins of width 0.1
    binned = tested.withColumn("bin", F.least(F.floor(F.col("llr") * 10), F.lit(2000)))
    bins = binned.groupBy("bin").agg(F.count("*").alias("n"), F.first("m").alias("m"))
    above = Window.orderBy(F.col("bin").desc())
    tail = F.exp(-F.col("bin") / 20.0)  # P(chi-square with one degree of freedom > x) <= exp(-x / 2)
    passed = bins.withColumn("at_least", F.sum("n").over(above)).where(F.col("m") * tail <= q * F.col("at_least")).agg(F.min("bin").alias("least"))
    return binned.join(F.broadcast(passed.withColumn("one", F.lit(1))), "one").where((F.col("bin") >= F.col("least")) & F.col("reaches")).select("source", "line_hash", "n_items", "n_source", "llr")


def _sets(excess: DataFrame) -> DataFrame:
    """Per source its excessive lines. A set holds at most (mean lines of an item) / min_share of them, whatever the number of items."""
    return excess.groupBy("source").agg(F.collect_set("line_hash").alias("_excess")).withColumnRenamed("source", "_source")


def _marked(items: DataFrame, excess: DataFrame, source: str) -> DataFrame:
    """``items`` with ``_excess``, the set of its source. The sets go to the texts while there are few sources; beyond that Spark sorts, and splits hot sources."""
    sets = broadcast_if_small(_sets(excess), MAX_SOURCES)
    return items.join(sets, items[source].eqNullSafe(sets["_source"]), "left").drop("_source")


def excessive_occurrences(items: DataFrame, id_col: str = "id", text: str = "content", source: str = "source", **options) -> DataFrame:
    """One row per occurrence of an excessive line: ``item_id, line_no`` (from 1, blank lines counted). Repeated ids repeat rows."""
    rows = items.select(F.col(id_col).alias("item_id"), F.col(source).alias("source"), F.col(text).alias("text")).where(has_text(F.col("text")))
    marked = _marked(rows, excessive_lines(items, id_col, text, source, **options), "source").where(F.col("_excess").isNotNull())
    return marked.select("item_id", "_excess", F.posexplode(line_hashes(F.col("text"))).alias("p", "h")).where(F.array_contains("_excess", F.col("h"))).select("item_id", (F.col("p") + 1).cast("bigint").alias("line_no"))


def without_excessive_lines(items: DataFrame, id_col: str = "id", text: str = "content", source: str = "source", **options) -> DataFrame:
    """``item_id, text, n_removed``: every item's text without its source's excessive lines, the others in their order.

    The anti-join runs inside each row, against the set of its source, so lines are neither exploded nor shuffled to be put
    together by position again. A null or "" text stays as it is with 0 removed; a text of nothing but excessive lines becomes "".
    """
    rows = items.select(F.col(id_col).alias("item_id"), F.col(source).alias("source"), F.col(text).alias("text"))
    marked = _marked(rows, excessive_lines(items, id_col, text, source, **options), "source")
    lines = F.arrays_zip(F.split("text", "\n", -1).alias("line"), line_hashes(F.col("text")).alias("h"))
    kept = F.transform(F.filter(lines, lambda x: x["h"].isNull() | ~F.array_contains("_excess", x["h"])), lambda x: x["line"])
    clean = marked.withColumn("kept", F.when(F.col("_excess").isNotNull() & has_text(F.col("text")), kept))
    removed = F.size(F.split("text", "\n", -1)) - F.size("kept")
    return clean.select("item_id", F.coalesce(F.array_join("kept", "\n"), F.col("text")).alias("text"), F.coalesce(F.when(F.col("kept").isNotNull(), removed), F.lit(0)).cast("bigint").alias("n_removed"))
