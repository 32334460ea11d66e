"""The two phases over stored tables: ingest commits what was crawled, classify_pending picks up what has no verdict. Either can be run again."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from heddle.functions import dates
from heddle.functions.tables import materialize
from heddle.operators import classify, dedup, feed, scoring, summaries, upsert
from heddle.operators.taxonomy import Taxonomy
from heddle.sources.store import TABLES, Store
from heddle.streaming.streams import look_back

COLUMNS = [c.split()[0] for c in TABLES["items"].split(", ")]


def numbered(new: DataFrame, old: DataFrame, key: str) -> DataFrame:
    """``new`` with ids after the greatest of ``old``, in the order of ``key``: partitions by range, numbered within, offset by those before."""
    start = old.agg(F.coalesce(F.max("id"), F.lit(0))).first()[0]
    ranged = materialize(new.drop("id").repartitionByRange(key).withColumn("_p", F.spark_partition_id()))
    sizes = ranged.groupBy("_p").agg(F.count("*").alias("n")).withColumn("_before", F.coalesce(F.sum("n").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("n")
    within = F.row_number().over(Window.partitionBy("_p").orderBy(key))
    return ranged.join(F.broadcast(sizes), "_p").withColumn("id", F.lit(start) + F.col("_before") + within).drop("_p", "_before")


def ingest(store: Store, crawled: DataFrame, now: dt.datetime, days: int = 7, pages: DataFrame | None = None, writer: summaries.Writer | None = None) -> dict[str, int]:
    """Known addresses dropped, copies by content hash dropped, thin items enriched, abstracts written, rows upserted by address.

    crawled: rows with at least url, title and source. Rows without an address are refused, dates over a week ahead become null. Items and the state
    of the sources crawled (up to when they are done) are one commit, so a source's state only moves with its items. Only the buckets of addresses that
    came are read for the upsert and rewritten. Gives the counts of rows crawled, refused, known and stored.
    """
    old = store.read("items")
    have = set(crawled.columns)
    kinds = dict(old.dtypes)
    rows = crawled.select(*[(F.col(c) if c in have else F.lit(None)).cast(kinds[c]).alias(c) for c in COLUMNS])
    rows = rows.withColumns({"crawled_at": F.lit(now), "published_date": dates.without_future(F.col("published_date"), F.lit(now)), "id": F.xxhash64("url", "title")})
    rows = materialize(rows)
    ok = F.coalesce(F.length("url") > 0, F.lit(False))
    n_crawled, n_refused = rows.agg(F.count_if(ok), F.count_if(~ok)).first()
    asked = rows.select("source").where("source is not null").distinct()
    rows = rows.where(ok)
    fresh = dedup.unknown(rows, old.where(F.col("crawled_at") >= F.lit(now) - F.expr(f"interval {look_back(days)} days")))
    fresh = materialize(fresh)
    n_known = n_crawled - fresh.count()
    fresh = dedup.first_by(dedup.best_of_copies(fresh, ["url"]), "url", ["title"])
    if pages is not None:
        fresh = summaries.enriched(fresh, pages).drop("enriched")
    if writer is not None:
        replies = materialize(summaries.written(summaries.candidates(fresh), writer))
        fresh = summaries.summarized(fresh, replies, now).drop("outcome")
    fresh = materialize(numbered(fresh.withColumns({c: F.coalesce(c, F.lit("")) for c in ("abstract", "content", "authors", "source_id", "source_name")}), old, "url"))
    rules = {"id": upsert.keep, "published_date": upsert.fill, "api_refused_at": upsert.fill, "api_refusal_type": upsert.fill, "raw_metadata": upsert.if_not_empty}
    touched = sorted(r[0] for r in fresh.select(store.bucket("items", F.col("url"))).distinct().collect())  # at most as many as there are buckets
    items = upsert.upsert(store.read("items", touched), fresh.select(*COLUMNS), ["url"], rules)
    done = asked.withColumns({"saved": dates.last_boundary(F.lit(now)), "last_run": F.lit(now)})
    store.commit({"items": items, "crawl_state": upsert.upsert(store.read("crawl_state"), done, ["source"])}, {"items": touched})
    return {"crawled": n_crawled, "refused": n_refused, "known": n_known, "stored": fresh.count()}


def ingest_each(store: Store, crawls: dict[str, Callable[[], DataFrame]], now: dt.datetime, **more) -> dict[str, str]:
    """Sources crawled and ingested one after the other, each a commit of its own: a stop loses one source at most, and one that fails leaves its state and
    the others as they are. At the end the sources' status, error and failures in a row are written. Gives each source's status."""
    rows = []
    for source, crawl in crawls.items():
        n, error = 0, None
        try:
            n = ingest(store, crawl(), now, **more)["crawled"]
        except Exception as e:
            error = f"{type(e).__name__}: {e}".splitlines()[0][:500]
        rows.append((source, now, n, error))
    done = materialize(store.spark.createDataFrame(rows, "source string, at timestamp, n_items int, error string"))
    store.commit({"sources": upsert.crawls_written(store.read("sources"), done)})
    status = done.select("source", upsert.crawl_status(F.col("error"), F.col("n_items")).alias("status"))
    return {r.source: r.status for r in status.collect()}  # as many as the caller gave


def classify_pending(store: Store, taxonomy: Taxonomy, classifier: classify.Classifier, now: dt.datetime, days: int = 30, limit: int = 0, audit: bool = True) -> dict[str, int]:
    """Items without a verdict are prefiltered, classified, tagged and audited; verdicts, topics and connections are one commit. Gives counts.

    The classifier's replies are written once before the three tables are made of them, so that none is asked for twice.
    """
    items, verdicts, topics, links = (store.read(t) for t in ("items", "classifications", "item_topics", "network_connections"))
    queue = materialize(feed.unclassified(items, verdicts, now, days, limit).drop("day"))
    new = materialize(classify.auto_tagged(classify.classify(queue, taxonomy, classifier, threshold=scoring.THRESHOLD), queue, taxonomy))
    if audit:
        claimed = materialize(classify.category_audit(scoring.audit_hits(queue, taxonomy), new, taxonomy)).select("item_id", "subtopic", F.col("topic").alias("_topic"))
        got = F.col("_topic").isNotNull()
        new = new.join(F.broadcast(claimed), ["item_id", "subtopic"], "left").withColumns({"relevant": got | F.col("relevant"), "confidence": F.when(got, "uncertain").otherwise(F.col("confidence")), "topics": F.when(got, F.array("_topic")).otherwise(F.col("topics"))}).drop("_topic")
    new = materialize(new)
    touched = new.select("item_id", "subtopic")
    stamped = new.select(F.xxhash64("item_id", "subtopic").alias("id"), "item_id", "subtopic", "relevant", "confidence", "reasoning", F.lit(now).alias("classified_at"))
    tagged = new.select("item_id", "subtopic", F.explode(F.transform("topics", lambda t: F.translate(F.lower(t), " -", "__"))).alias("topic_key")).withColumn("id", F.xxhash64("item_id", "subtopic", "topic_key"))
    found = scoring.network_matches(queue, taxonomy).select(F.col("item_id").alias("id"), "item_id", "connection_name", "connection_description")
    store.commit({
        "item_topics": upsert.replace_groups(topics, tagged, touched, ["item_id", "subtopic"]),
        "network_connections": upsert.replace_groups(links, found, touched, ["item_id"]),
        "classifications": upsert.upsert(verdicts, stamped, ["item_id", "subtopic"], {"id": upsert.keep}),
    })
    return {"items": queue.count(), "verdicts": new.count(), "relevant": new.where("relevant").count()}
