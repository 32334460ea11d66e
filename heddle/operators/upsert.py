"""Snapshots with upsert, replace and cascade: a new state from the old one and the changes, as joins.

Parquet tables take no MERGE; a new snapshot is written beside the old one and the pointer moved (heddle.sources.store).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Rule = Callable[[Column, Column], Column]  # (new, old) -> value, for a row that is in both

overwrite: Rule = lambda new, old: new
keep: Rule = lambda new, old: old
fill: Rule = lambda new, old: F.coalesce(new, old)
if_not_empty: Rule = lambda new, old: F.when(new.isNotNull() & ~new.isin("", "{}", "[]"), new).otherwise(old)


def upsert(old: DataFrame, new: DataFrame, key: list[str], rules: dict[str, Rule] | None = None, last: str | None = None) -> DataFrame:
    """The old rows with the new ones laid over them by ``key``, null keys never equal.

    ``rules`` says per column what a row in both takes (overwrite by default, also with "" or null). Of several new rows of one key the last
    by the column ``last`` counts; without it keys of ``new`` must be distinct. Columns are those of ``old``.
    """
    if last:
        rest = [c for c in new.columns if c not in key]
        new = new.groupBy(*key).agg(F.max_by(F.struct(*rest), F.struct(last)).alias("_v")).select(*key, "_v.*")
    rules = rules or {}
    o, n = old.withColumn("_old", F.lit(True)).alias("o"), new.withColumn("_new", F.lit(True)).alias("n")
    joined = o.join(n, [F.col(f"o.{k}") == F.col(f"n.{k}") for k in key], "full")
    out = []
    for c in old.columns:
        if c in key:
            out.append(F.coalesce(F.col(f"n.{c}"), F.col(f"o.{c}")).alias(c))
        elif c not in new.columns:
            out.append(F.col(f"o.{c}").alias(c))
        else:
            both = rules.get(c, overwrite)(F.col(f"n.{c}"), F.col(f"o.{c}"))
            out.append(F.when(F.col("_new").isNull(), F.col(f"o.{c}")).when(F.col("_old").isNull(), F.col(f"n.{c}")).otherwise(both).alias(c))
    return joined.select(*out)


def replace_groups(old: DataFrame, new: DataFrame, touched: DataFrame, key: list[str]) -> DataFrame:
    """The old rows whose key isn't touched, and the distinct new ones: delete and insert of whole groups, also of groups that become empty."""
    return old.join(touched.select(*key).distinct(), key, "left_anti").unionByName(new.select(*old.columns).distinct())


def cascade(child: DataFrame, parents: DataFrame, child_key: str, parent_key: str = "id") -> DataFrame:
    """The child rows whose parent is still there."""
    return child.join(parents.select(F.col(parent_key).alias(child_key)), child_key, "left_semi")


def failures_in_a_row(events: DataFrame, source: str, failed: Column, order: list[str]) -> DataFrame:
    """``source, consecutive_failures, last_ok``: the failures of each source after its last success, all of them if it never had one.

    Two aggregates with partial sums, so that a source with a third of the events is spread over tasks.
    """
    at = F.struct(*order)
    rows = events.select(F.col(source).alias("source"), failed.alias("failed"), at.alias("at"))
    ok = rows.groupBy("source").agg(F.max(F.when(~F.col("failed"), F.col("at"))).alias("last_ok"))
    joined = rows.join(ok, "source")
    return joined.groupBy("source").agg(F.count_if(F.col("failed") & (F.col("last_ok").isNull() | (F.col("at") > F.col("last_ok")))).alias("consecutive_failures"))


def crawl_status(error: Column, n_items: Column) -> Column:
    """error, else empty for no items, else ok."""
    return F.when(error.isNotNull() & (error != ""), "error").when(F.coalesce(n_items, F.lit(0)) == 0, "empty").otherwise("ok")


def crawls_written(sources: DataFrame, crawls: DataFrame) -> DataFrame:
    """``sources`` after ``crawls`` (``source, at, n_items, error``; no two of a source at one time): status, error and time of the last one, an error
    cleared if it had none, and failures in a row, which go on from those before if no crawl went well. Sources that weren't crawled stay as they are.
    """
    rows = crawls.select("source", "at", crawl_status(F.col("error"), F.col("n_items")).alias("status"), "error")
    bad = F.col("status") == "error"
    last = rows.groupBy("source").agg(F.max_by(F.struct("status", F.when(bad, F.col("error")).alias("error"), "at"), "at").alias("_last"))
    runs = failures_in_a_row(rows, "source", bad, ["at"])
    well = rows.groupBy("source").agg(F.bool_or(~bad).alias("_well"))
    done = last.join(runs, "source").join(well, "source").select(F.col("source").alias("key"), "_last", F.col("consecutive_failures").alias("_n"), "_well")
    before = F.when(~F.col("_well"), F.coalesce("consecutive_failures", F.lit(0))).otherwise(0)
    new = {"crawl_status": F.col("_last.status"), "crawl_error": F.col("_last.error"), "consecutive_failures": (before + F.col("_n")).cast("int"), "last_crawled_at": F.col("_last.at")}
    out = sources.join(done, "key", "left")
    return out.select(*[F.when(F.col("_last").isNull(), F.col(c)).otherwise(new[c]).alias(c) if c in new else c for c in sources.columns])


def storage_rows(items: DataFrame) -> DataFrame:
    """Items as they are stored: null texts as "", source_id else the paper's number, authors else author, source_name else the newsletter's,
    published_date else date, where such columns are there; of the metadata only images and keyword scores, as JSON."""
    have = set(items.columns)

    def text(c: str, *more: str) -> Column:
        given = [F.when(F.length(F.col(x).cast("string")) > 0, F.col(x).cast("string")) for x in (c, *more) if x in have]
        return F.coalesce(*given, F.lit("")).alias(c)

    day = F.coalesce(*[F.col(c).cast("date") for c in ("published_date", "date") if c in have], F.lit(None).cast("date")).alias("published_date")
    meta = F.from_json("raw_metadata", "images array<string>, keyword_scores string") if "raw_metadata" in have else None
    member = lambda name, value: F.when(value.isNotNull(), F.concat(F.lit(f'"{name}":'), value))
    scores = None if meta is None else F.when(meta["keyword_scores"].rlike(r"^[\[{]"), meta["keyword_scores"])
    kept = F.lit("{}") if meta is None else F.concat(F.lit("{"), F.concat_ws(",", member("images", F.to_json(meta["images"])), member("keyword_scores", scores)), F.lit("}"))
    made = [text("abstract"), text("content"), text("authors", "author"), text("source_id", "paper_number"), text("source_name", "substack_name"), day, kept.alias("raw_metadata")]
    names = {"abstract", "content", "authors", "source_id", "source_name", "published_date", "raw_metadata"}
    return items.select(*[c for c in items.columns if c not in names], *made)


def usage(calls: DataFrame, service: str, tokens: str, cost: str) -> DataFrame:
    """``service, n_calls, tokens, cost`` of calls, the dearest first."""
    return calls.groupBy(F.col(service).alias("service")).agg(F.count("*").alias("n_calls"), F.sum(tokens).alias("tokens"), F.round(F.sum(cost), 2).alias("cost")).orderBy(F.col("cost").desc(), "service")
