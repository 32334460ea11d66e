"""The filtered feed: items by subtopic, topic, confidence, connection and date, and what is attached to them."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CONFIDENCE = ["high", "medium", "low", "uncertain"]  # fixed values, in falling order


@dataclass(frozen=True)
class FeedFilter:
    subtopics: tuple[str, ...] = ()
    topics: tuple[str, ...] = ()
    min_confidence: str | None = None
    connected_only: bool = False
    start: date | None = None
    end: date | None = None

    def __post_init__(self) -> None:
        if not self.subtopics and not self.connected_only:
            raise ValueError("a feed needs subtopics, or connected_only")


def feed(items: DataFrame, classifications: DataFrame, item_topics: DataFrame, connections: DataFrame | None, f: FeedFilter) -> DataFrame:
    """The items of a feed, newest first, undated ones before all others, by falling id among equals.

    Filters are semi-joins, so a verdict or topic that comes twice gives no row twice, and only those a feed names are joined. The topic
    filter isn't tied to the verdict's subtopic: an item relevant under one subtopic with a topic under another passes. An unknown
    confidence level is no filter. With a date bound, undated items don't pass.
    """
    out = items
    if f.start:
        out = out.where(F.col("published_date") >= F.lit(f.start))
    if f.end:
        out = out.where(F.col("published_date") <= F.lit(f.end))
    if f.subtopics:
        verdicts = classifications.where(F.col("subtopic").isin(*f.subtopics) & F.col("relevant"))
        if f.min_confidence in CONFIDENCE:
            verdicts = verdicts.where(F.col("confidence").isin(*CONFIDENCE[: CONFIDENCE.index(f.min_confidence) + 1]))
        out = out.join(verdicts.select(F.col("item_id").alias("id")), "id", "left_semi")
    if f.topics:
        tagged = item_topics.where(F.col("topic_key").isin(*f.topics))
        if f.subtopics:
            tagged = tagged.where(F.col("subtopic").isin(*f.subtopics))
        out = out.join(tagged.select(F.col("item_id").alias("id")), "id", "left_semi")
    if f.connected_only:
        out = out.join(connections.select(F.col("item_id").alias("id")), "id", "left_semi")
    return out.orderBy(F.col("published_date").desc_nulls_first(), F.col("id").desc())


def latest_verdicts(classifications: DataFrame) -> DataFrame:
    """One row per item and subtopic: the verdict given last, the greatest id among equals. What is stored after upserts in order."""
    last = F.max_by(F.struct("relevant", "confidence", "reasoning", "classified_at"), F.struct("classified_at", "id")).alias("v")
    return classifications.groupBy("item_id", "subtopic").agg(last).select("item_id", "subtopic", "v.*")


def with_attachments(items: DataFrame, classifications: DataFrame, item_topics: DataFrame, connections: DataFrame) -> DataFrame:
    """``items`` with ``classifications``, map<subtopic, struct<relevant, confidence, reasoning, topics>> of all verdicts, and ``connection``.

    Topics are attached where their verdict exists. Null texts become "", an item without verdicts gets an empty map, one without
    a connection a struct that says so. Of each side only what belongs to ``items`` is aggregated, before it is joined: write a filtered
    feed once before it comes here, as it is read for each side.
    """
    mine = items.select(F.col("id").alias("item_id"))
    classifications, item_topics, connections = (x.join(mine, "item_id", "left_semi") for x in (classifications, item_topics, connections))
    topics = item_topics.groupBy("item_id", "subtopic").agg(F.sort_array(F.collect_set("topic_key")).alias("topics"))
    verdicts = latest_verdicts(classifications).join(topics, ["item_id", "subtopic"], "left")
    value = F.struct("relevant", F.coalesce("confidence", F.lit("")).alias("confidence"), F.coalesce("reasoning", F.lit("")).alias("reasoning"), F.coalesce("topics", F.array().cast("array<string>")).alias("topics"))
    nested = verdicts.groupBy(F.col("item_id").alias("id")).agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("subtopic", value.alias("v"))))).alias("classifications"))
    linked = connections.groupBy(F.col("item_id").alias("id")).agg(F.min(F.struct(F.lit(True).alias("has_connection"), "connection_name", "connection_description")).alias("connection"))
    none = F.struct(F.lit(False).alias("has_connection"), F.lit("").alias("connection_name"), F.lit("").alias("connection_description"))
    texts = [c for c, kind in items.dtypes if kind == "string" and c not in ("url", "title", "source")]
    out = items.join(nested, "id", "left").join(linked, "id", "left")
    out = out.withColumns({c: F.coalesce(c, F.lit("")) for c in texts})
    return out.withColumns({"classifications": F.coalesce("classifications", F.create_map().cast(dict(nested.dtypes)["classifications"])), "connection": F.coalesce("connection", none)})


def unclassified(items: DataFrame, classifications: DataFrame, now, days: int, limit: int = 0) -> DataFrame:
    """The items without any verdict whose date (else the day they were crawled) lies from ``days`` before ``now`` to a day after it, newest first.

    A date is its midnight. ``limit`` 0 takes all. Equal dates go by id.
    """
    day = F.coalesce(F.col("published_date"), F.to_date("crawled_at"))
    at = day.cast("timestamp")
    open_ = items.where((at >= F.lit(now) - F.expr(f"interval {days} days")) & (at <= F.lit(now) + F.expr("interval 1 day")))
    out = open_.join(classifications.select(F.col("item_id").alias("id")), "id", "left_anti").withColumn("day", day)
    out = out.orderBy(F.col("day").desc_nulls_first(), "id")
    return out.limit(limit) if limit else out


def item_set_hash(df: DataFrame, group: list[str], id_col: str, width: int = 100_000) -> DataFrame:
    """``group..., item_hash, n_items``: 16 hex digits of a group's ids in numeric order, duplicates kept.

    Ids are hashed in stretches of ``width`` numbers, so no task holds a group. A group within one stretch has the hash of its ids joined
    by commas; one of several stretches has the hash of the stretches' whole hashes, joined in order.
    """
    ids = F.transform(F.sort_array(F.collect_list(id_col)), lambda x: x.cast("string"))
    stretch = F.floor(F.col(id_col) / width).alias("_stretch")
    each = df.groupBy(*group, stretch).agg(F.sha2(F.array_join(ids, ","), 256).alias("_h"), F.count("*").alias("_n"))
    parts = F.sort_array(F.collect_list(F.struct("_stretch", "_h")))
    whole = F.when(F.count("*") == 1, F.max("_h")).otherwise(F.sha2(F.array_join(F.transform(parts, lambda x: x["_h"]), ","), 256))
    return each.groupBy(*group).agg(F.substring(whole, 1, 16).alias("item_hash"), F.sum("_n").alias("n_items"))


def cache_status(current: DataFrame, cached: DataFrame, key: list[str]) -> DataFrame:
    """``current`` with ``status``: hit (the same hash is cached), stale (another one), or miss."""
    have = cached.select(*key, F.col("item_hash").alias("_had"))
    state = F.when(F.col("_had").isNull(), "miss").when(F.col("_had") == F.col("item_hash"), "hit").otherwise("stale")
    return current.join(have, key, "left").withColumn("status", state).drop("_had")


def weekly_snapshots(items: DataFrame, ends) -> DataFrame:
    """``source, week_ending, item_ids, n_items``: the ids of each source's dated items by week, sorted."""
    weeks = items.where(F.col("published_date").isNotNull()).withColumn("week_ending", ends)
    return weeks.groupBy("source", "week_ending").agg(F.sort_array(F.collect_list("id")).alias("item_ids"), F.count("*").alias("n_items"))
