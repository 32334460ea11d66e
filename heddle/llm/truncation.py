"""Text cut off by field limits or mid-transfer."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from heddle.functions.tables import broadcast_if_small, has_text, materialize
from heddle.llm.words import chunks, words_of

# What a system leaves where it cut: an ellipsis and a "more" link, or the beginning of markup, of an entity or of a character.
MARK = r"(?i)[\s ]*(?:(?:\.\.\.|…|\[\s*(?:\.\.\.|…)\s*\])[\s ]*(?:[\[(]?(?:continue reading|read more|more)(?:\s*→)?[\])]?)?|\[(?:continue reading|read more)(?:\s*→)?\])[\s ]*$"
ENTITY = r"&#?\w{0,8}$"
# what follows the last < of a text if it is a tag that was begun: a name, and attributes if any
TAG = r"(?s)^(?:|[/!]?[A-Za-z][\w:-]*(?:\s+[\w:-]+\s*=.*|\s+[\w:-]*|\s*/?))$"
CLOSED = r"[.?!][\"'”’»)\]]*$"
LABEL = r"^\p{Lu}[\p{L}]*(?: \p{L}+){0,3}: "
LINK = r"(?:https?://|www\.)\S+$"
MAX_SOURCES = 20_000  # (source, field) pairs whose limits may go to all tasks: a few numbers each
MIN_PILE, DEVIATIONS = 5, 6
# A line or word is known from so many places, or from this share of all texts and words where that is more; of a known line's places so many differ
KNOWN_LINE, LINE_SHARE, UNLIKE, KNOWN_WORD, WORD_SHARE = 5, 2e-6, 0.3, 3, 2e-8


def _count(text: F.Column, chars: str) -> F.Column:
    """How many of ``chars`` (ASCII) stand in ``text``."""
    return sum((F.octet_length(text) - F.octet_length(F.replace(text, F.lit(c))) for c in chars), F.lit(0))


def lengths(text: F.Column) -> dict[str, F.Column]:
    """The length of ``text`` in each form in which a limit may have counted it."""
    chars, size, newlines = F.length(text), F.octet_length(text), _count(text, "\n")
    entities = 4 * _count(text, "&") + 3 * _count(text, "<>") + 5 * _count(text, "\"'")
    escapes = _count(text, '"\\\n\r\t')
    return {
        "characters": chars,
        "utf8_bytes": size,
        "utf16_units": (F.octet_length(F.encode(text, "UTF-16LE")) / 2).cast("int"),
        "entity_escaped": chars + entities,
        "entity_escaped_bytes": size + entities,
        "json_escaped": chars + escapes,
        "json_escaped_bytes": size + escapes,
        "crlf_characters": chars + newlines,
        "crlf_bytes": size + newlines,
    }


def _rtrim(col: str) -> F.Column:
    """``col`` without white space at its end, no-break spaces and line ends included."""
    return F.rtrim(F.col(col), F.lit(" \n\r\t\u00a0\u2002\u2003\u2009\u202f\u3000"))


def _values(df: DataFrame, id_col: str, source: str, fields: tuple[str, ...]) -> DataFrame:
    """One row per field with text: ``item_id, source, field, text`` and ``whole``, the text without what was left where it was cut."""
    each = F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).alias("text")) for f in fields])).alias("v")
    rows = df.select(F.col(id_col).alias("item_id"), F.col(source).alias("source"), each).select("item_id", "source", "v.field", "v.text")
    # a mark stands at the end, after which only white space is left: the few texts whose end could be one are searched whole
    end = F.lower(F.right(_rtrim("text"), F.lit(60)))
    hint = F.exists(F.array(*map(F.lit, ("...", "…", "more", "reading"))), lambda m: end.contains(m))
    rows = rows.where(has_text(F.col("text"))).withColumn("whole", F.when(hint, F.regexp_replace("text", MARK, "")).otherwise(F.col("text")))
    rows = rows.withColumn("whole", F.rtrim("whole", F.lit("\ufffd")))
    begun = F.substring_index("whole", "<", -1)
    tag = F.col("whole").contains("<") & ~begun.contains(">") & begun.rlike(TAG)
    rows = rows.withColumn("whole", F.when(tag, F.left("whole", F.length("whole") - F.length(begun) - 1)).otherwise(F.col("whole")))
    entity = F.regexp_extract(F.right("whole", F.lit(10)), ENTITY, 0)
    rows = rows.withColumn("whole", F.left("whole", F.length("whole") - F.length(entity)))
    return rows.withColumn("marked", F.length("whole") < F.length("text"))


def _ends(line) -> F.Column:
    """Whether a sentence closes at the end of a line, before quotes, brackets and white space."""
    return F.right(F.rtrim(F.rtrim(line, F.lit(" \t\r\n\x0b\f")), F.lit("\"'”’»)]")), F.lit(1)).isin(".", "?", "!")


def _read(df: DataFrame, id_col: str, source: str, fields: tuple[str, ...]) -> DataFrame:
    """One row per field with text, written once, as the rest needs no more of it: ``item_id, source, field, marked, closed``, its lengths in all forms in order,
    and of values that don't close ``last``, the last line, ``rest``, what follows the last closed sentence on it, ``last_word`` and the line's ``key``."""
    rows = _values(df, id_col, source, fields)
    rows = rows.select("item_id", "source", "field", "marked", F.right(_rtrim("text"), F.lit(100)).rlike(CLOSED).alias("closed"), F.array(*[x.cast("int") for x in lengths(F.col("whole")).values()]).alias("lengths"), "whole")
    last = F.regexp_replace(F.substring_index(F.replace(_rtrim("whole"), F.lit("\r"), F.lit("\n")), "\n", -1), r"(?U)^\s+", "")
    rows = rows.select("item_id", "source", "field", "marked", "closed", "lengths", F.when(~F.col("closed") | F.col("marked"), last).alias("last"))
    rest = F.regexp_replace("last", r"^.*[.?!][\"'”’»)]*(?U)\s+", "")
    word = F.regexp_extract("last", r"([\p{L}\p{N}]+)[\"'”’»)\]]*$", 1)
    return materialize(rows.select("*", rest.alias("rest"), word.alias("last_word"), F.when(~F.col("closed"), F.xxhash64(_norm("last"))).alias("key")))


def _norm(line) -> F.Column:
    """A line without digits, in lower case, white space collapsed, ends trimmed."""
    return F.trim(F.regexp_replace(F.regexp_replace(F.lower(line), r"\p{Nd}+", ""), r"(?U)\s+", " "))


FORMS = ["characters", "utf8_bytes", "utf16_units", "entity_escaped", "entity_escaped_bytes", "json_escaped", "json_escaped_bytes", "crlf_characters", "crlf_bytes"]  # those of lengths(), in order


def hidden_limits(df: DataFrame, id_col: str = "id", source: str = "source", fields: tuple[str, ...] = ("abstract", "content")) -> DataFrame:
    """``source, field, encoding, limit, n_at, n_above, n_values``: lengths, in some form, at which a source's values pile up.

    A length is a limit if more values have exactly that length than the mean over the twenty lengths around it explains: MIN_PILE
    and DEVIATIONS standard deviations (of a Poisson count) above it. A limit needn't hold for all values of a source, so longer ones may
    exist. Counts are partial sums before the shuffle; a group is (source, field, form, length), so a large source is spread by its lengths.
    """
    return _limits(_read(df, id_col, source, fields))


def _limits(rows: DataFrame) -> DataFrame:
    form = F.posexplode("lengths").alias("form", "length")
    counts = rows.select("source", "field", form).groupBy("source", "field", "form", "length").agg(F.count("*").alias("n_at"))
    group = Window.partitionBy("source", "field", "form")
    up = group.orderBy("length")
    near = F.coalesce(F.sum("n_at").over(up.rangeBetween(-10, -1)), F.lit(0)) + F.coalesce(F.sum("n_at").over(up.rangeBetween(1, 10)), F.lit(0))
    seen = counts.withColumn("n_above", F.coalesce(F.sum("n_at").over(up.rangeBetween(1, Window.unboundedFollowing)), F.lit(0))).withColumn("near", near / 20).withColumn("n_values", F.sum("n_at").over(group))
    pile = F.col("n_at") > F.col("near") + DEVIATIONS * F.sqrt("near") + MIN_PILE
    encoding = F.element_at(F.array(*map(F.lit, FORMS)), F.col("form") + 1)
    return seen.where(pile).select("source", "field", encoding.alias("encoding"), F.col("length").cast("bigint").alias("limit"), "n_at", "n_above", "n_values")


def _at_limit(rows: DataFrame, limits: DataFrame) -> DataFrame:
    """``rows`` with ``at_limit``. Per (source, field) the limits are one array: a few numbers per form."""
    per = limits.groupBy(F.col("source").alias("_source"), F.col("field").alias("_field")).agg(F.collect_set(F.concat_ws(":", "encoding", "limit")).alias("_limits"))
    per = broadcast_if_small(per, MAX_SOURCES)
    mine = F.array(*[F.concat(F.lit(f"{k}:"), F.get("lengths", F.lit(i)).cast("string")) for i, k in enumerate(FORMS)])
    joined = rows.join(per, rows["source"].eqNullSafe(per["_source"]) & (rows["field"] == per["_field"]), "left")
    return joined.withColumn("at_limit", F.when(F.col("_limits").isNull(), False).otherwise(F.arrays_overlap("_limits", mine))).drop("_source", "_field", "_limits")


def _counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Word counts of each batch, the last word of each text left out."""
    for b in batches:
        for _, part in chunks(b["text"]):
            hashes, doc, *_ = words_of(part)
            inner = np.zeros(len(hashes), dtype=bool)
            inner[:-1] = doc[:-1] == doc[1:]
            word, n = np.unique(hashes[inner], return_counts=True)
            yield pd.DataFrame({"word": word.view(np.int64), "n": n})


def _hashed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The hash of each last word."""
    for b in batches:
        b = b[b["last_word"] != ""].drop_duplicates()
        words = b["last_word"].tolist()
        hashes, doc, *_ = words_of(words)
        keep = np.bincount(doc, minlength=len(words))[doc] == 1
        yield pd.DataFrame({"last_word": [words[i] for i in doc[keep]], "word": hashes[keep].view(np.int64)})


def truncated(df: DataFrame, id_col: str = "id", source: str = "source", fields: tuple[str, ...] = ("abstract", "content")) -> DataFrame:
    """One row per field with text: ``item_id, source, field, at_limit, marked, is_cut``.

    A value that ends where a sentence closes is whole. Otherwise it is cut if a mark of a cut follows, or the beginning of
    markup, an entity or a character; if its length in some form is a hidden limit of its source; or if its end is that
    of no finished line. Finished are lines that texts hold in KNOWN_LINE places or more that differ otherwise (notices,
    headings), links, signatures, and lists, bullets and labels whose last word is a word that the texts hold elsewhere too. What counts as known
    grows with the corpus, and revisions of one text are one place: a group of near-copies cut in the same line doesn't make it known.
    Running prose isn't finished without its full stop. Null and "" are no values. A null source is a source of its own.
    """
    rows = _read(df, id_col, source, fields)
    rows = _at_limit(rows, _limits(rows))
    texts = df.select(F.explode(F.array(*fields)).alias("text")).where(has_text(F.col("text")))
    n_texts = texts.count()
    # a line's place is told by the least hash of the text's closed lines: revisions of one text are one place, not many
    parts = texts.select(F.xxhash64("text").alias("t"), F.transform(F.split("text", "\n"), lambda x: F.struct(x.alias("x"), _ends(x).alias("closed"))).alias("parts"))
    place = F.array_min(F.transform(F.filter("parts", lambda p: p["closed"]), lambda p: F.xxhash64(p["x"])))
    line = F.explode(F.filter("parts", lambda p: ~p["closed"] & p["x"].rlike(r"\S"))).alias("p")
    lines = parts.select("t", place.alias("place"), line).select(F.xxhash64(_norm("p.x")).alias("key"), "t", "place").distinct()
    places = lines.groupBy("key", "place").agg(F.count("*").alias("n")).groupBy("key").agg(F.sum("n").alias("n"), F.count("place").alias("n_places"))
    known_lines = places.where((F.col("n_places") >= max(KNOWN_LINE, LINE_SHARE * n_texts)) & (F.col("n_places") >= UNLIKE * F.col("n"))).select("key", F.lit(True).alias("known_line"))
    counted = materialize(texts.mapInPandas(_counted, "word bigint, n bigint").groupBy("word").agg(F.sum("n").alias("n")))
    n_words = counted.agg(F.sum("n")).first()[0] or 0
    words = counted.where(F.col("n") >= max(KNOWN_WORD, WORD_SHARE * n_words))
    ends = rows.where("not closed").select("last_word").distinct().mapInPandas(_hashed, "last_word string, word bigint").distinct()
    known_words = ends.join(words, "word").select("last_word", F.lit(True).alias("known_word"))

    unclosed = rows.where("not closed or marked").join(known_lines, "key", "left").join(known_words, "last_word", "left")
    word = F.coalesce("known_word", F.lit(False)) | F.col("last_word").rlike(r"^\p{N}+$")
    listed = F.col("last").rlike(r"^(?:[•*\-–—·]|\d{1,3}[.)])(?U)\s") | F.col("rest").rlike(LABEL) | (F.size(F.split("last", " ")) <= 4) & ~F.col("last").rlike(r"^[\"'“‘]?\p{Lu}")
    stops = F.col("rest").rlike(r"[\p{L}\p{N})\]\"”’/]$")
    finished = F.coalesce("known_line", F.lit(False)) | F.col("rest").rlike(LINK) | (listed & stops & word)
    judged = unclosed.select("item_id", "source", "field", "at_limit", "marked", (F.col("marked") | F.col("at_limit") | ~finished).alias("is_cut"))
    return judged.union(rows.where("closed and not marked").select("item_id", "source", "field", "at_limit", "marked", F.lit(False).alias("is_cut")))


def truncation_rates(df: DataFrame, id_col: str = "id", source: str = "source", fields: tuple[str, ...] = ("abstract", "content")) -> DataFrame:
    """``source, field, n_values, n_cut, share_cut``: how often each source truncates each field."""
    t = truncated(df, id_col, source, fields).groupBy("source", "field").agg(F.count("*").alias("n_values"), F.count_if("is_cut").alias("n_cut"))
    return t.withColumn("share_cut", F.round(F.col("n_cut") / F.col("n_values"), 6))
