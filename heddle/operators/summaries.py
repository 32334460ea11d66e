"""Enrichment with fetched pages and abstracts: what replaces what, and the state an item is left in."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from heddle.functions import text as T
from heddle.operators.feed import cache_status, item_set_hash
from heddle.operators.upsert import keep, upsert

Writer = Callable[[str, str, str], str]  # (title, content, source) -> abstract
LEAST = 20


def enriched(items: DataFrame, pages: DataFrame) -> DataFrame:
    """``items`` whose thin content is replaced by their page's text (``url, text``) where that is longer than content and abstract, with ``enriched``.

    Of several pages of one url the longest counts.
    """
    best = pages.where(F.col("text").isNotNull()).groupBy("url").agg(F.max_by("text", F.length("text")).alias("_text"))
    have = F.greatest(F.length(F.coalesce("content", F.lit(""))), F.when(F.length(F.coalesce("content", F.lit(""))) == 0, F.length(F.coalesce("abstract", F.lit("")))).otherwise(0))
    out = items.join(best, "url", "left")
    take = T.thin(F.col("content")) & (F.length("_text") > have)
    return out.withColumn("enriched", F.coalesce(take, F.lit(False))).withColumn("content", F.when(F.col("enriched"), F.col("_text")).otherwise(F.col("content"))).drop("_text")


def candidates(items: DataFrame) -> DataFrame:
    """The items that lack an abstract, have a content, and weren't refused before."""
    return items.where(T.needs_abstract(F.col("abstract")) & (F.length("content") > 0) & F.col("api_refused_at").isNull())


def refused(items: DataFrame) -> DataFrame:
    """The items that a writer refused and that have a content, so that another may be asked."""
    return items.where(F.col("api_refused_at").isNotNull() & (F.length("content") > 0))


def written(items: DataFrame, writer: Writer, most: int | None = None) -> DataFrame:
    """``item_id, reply, refused`` of a writer, for every item. Too short a reply or an error is no reply; one that declines is refused.

    The writer sees the whole content, or its first ``most`` characters, for a prompt that holds no more.
    """
    content = F.col("content") if most is None else F.substring("content", 1, most)
    rows = items.select(F.col("id").alias("item_id"), "title", content.alias("content"), F.coalesce("source_name", "source").alias("source"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for r in b.itertuples(index=False):
                try:
                    reply = (writer(r.title or "Untitled", r.content or "", r.source or "Unknown") or "").strip()
                except Exception:
                    reply = ""
                refused = reply.lower().startswith(("i cannot", "i'm sorry"))
                out.append((r.item_id, None if refused or len(reply) < LEAST else reply, refused))
            yield pd.DataFrame(out, columns=["item_id", "reply", "refused"])

    return rows.mapInPandas(run, "item_id bigint, reply string, refused boolean")


def summarized(items: DataFrame, replies: DataFrame, now) -> DataFrame:
    """``items`` after a round of abstracts, with ``outcome``: kept, written, extracted (refused, so taken from the content) or failed.

    Whatever gave no reply is marked as refused at ``now``, so that another writer may be asked for it.
    """
    out = items.join(replies.withColumnRenamed("item_id", "id"), "id", "left")
    extract = T.extractive_abstract(F.col("content"))
    outcome = F.when(F.col("refused").isNull(), "kept").when(F.col("reply").isNotNull(), "written").when(F.col("refused") & extract.isNotNull(), "extracted").otherwise("failed")
    out = out.withColumn("outcome", outcome)
    abstract = F.when(F.col("outcome") == "written", F.col("reply")).when(F.col("outcome") == "extracted", extract).otherwise(F.col("abstract"))
    marked = F.col("outcome").isin("extracted", "failed")
    return out.withColumns({"abstract": abstract, "api_refused_at": F.when(marked, F.lit(now)).otherwise(F.col("api_refused_at")), "api_refusal_type": F.when(marked, "abstract").otherwise(F.col("api_refusal_type"))}).drop("reply", "refused")


def retried(items: DataFrame, replies: DataFrame) -> DataFrame:
    """``items`` after a second writer was asked for the refused ones: an abstract it wrote takes the mark off."""
    out = items.join(replies.where("reply is not null").select(F.col("item_id").alias("id"), "reply"), "id", "left")
    got = F.col("reply").isNotNull()
    return out.withColumns({"abstract": F.coalesce("reply", "abstract"), "api_refused_at": F.when(~got, F.col("api_refused_at")), "api_refusal_type": F.when(~got, F.col("api_refusal_type"))}).drop("reply")


def topic_prompts(items: DataFrame, topics: DataFrame, most: int = 300, week: Column | None = None, link: Column | None = None) -> DataFrame:
    """``topic_key, item_hash, n_items, prompt``: each topic's items by id, a line each with title, source and the first ``most`` characters of the abstract.

    topics: ``item_id, topic_key``. Repeated rows count once. week: the end of an item's week, by which topics are parted too, as ``week_ending``; items
    without one are left out. link: an item's address, as a line under it. The lines of a topic, or of its week, are gathered, as one prompt needs
    them all: give a week where topics grow with the corpus.
    """
    keys = ["topic_key"] if week is None else ["topic_key", "week_ending"]
    line = F.concat(F.lit("- "), F.coalesce("title", F.lit("Untitled")), F.lit(" ("), F.coalesce(F.when(F.length("source_name") > 0, F.col("source_name")), F.col("source"), F.lit("")), F.lit("): "), F.substring(F.coalesce("abstract", F.lit("")), 1, most))
    line = line if link is None else F.concat(line, F.lit("\n  "), link)
    lines = items.select(F.col("id").alias("item_id"), line.alias("line"), *([] if week is None else [week.alias("week_ending")]))
    lines = lines if week is None else lines.where("week_ending is not null")
    joined = topics.select("item_id", "topic_key").distinct().join(lines, "item_id")
    listed = F.sort_array(F.collect_list(F.struct("item_id", "line")))
    prompts = joined.groupBy(*keys).agg(F.array_join(F.transform(listed, lambda x: x["line"]), "\n").alias("prompt"))
    return item_set_hash(joined, keys, "item_id").join(prompts, keys)


def stored(cache: DataFrame, summaries: DataFrame, feed_id: int, now) -> DataFrame:
    """The stored summaries with new ones (``topic_key, week_ending, item_hash, summary, status``) laid over them by feed, topic and week.

    Hits change nothing, failed ones aren't stored, whatever stands in for them. Ids are kept; a new row's is made of its key.
    """
    new = summaries.where(~F.col("status").isin("hit", "failed")).select(F.lit(feed_id).cast("bigint").alias("feed_id"), "topic_key", "week_ending", "summary", "item_hash", F.lit(now).alias("created_at"))
    new = new.withColumn("id", F.xxhash64("feed_id", "topic_key", "week_ending"))
    return upsert(cache, new, ["feed_id", "topic_key", "week_ending"], {"id": keep})


def topic_summaries(prompts: DataFrame, cached: DataFrame, names: dict[str, str], writer: Writer) -> DataFrame:
    """``topic_key, item_hash, summary, status``: of each topic, from the cache where the set of items is the same (hit), else written anew (miss, stale).

    cached: ``topic_key, item_hash, summary``. Only topics without a hit reach the writer. Where it fails the summary says how many items there
    are, and the status is failed: such a row isn't to be cached. names: display names; a key without one is its words with capitals.
    """
    state = cache_status(prompts, cached, ["topic_key"]).join(cached.select("topic_key", F.col("summary").alias("_kept")), "topic_key", "left")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for r in b.itertuples(index=False):
                name = names.get(r.topic_key) or r.topic_key.replace("_", " ").title().replace("Ai ", "AI ")
                try:
                    text = (writer(name, r.prompt, "") or "").strip()
                except Exception:
                    text = ""
                out.append((r.topic_key, r.item_hash, text or f"{r.n_items} recent items on {name}.", r.status if text else "failed"))
            yield pd.DataFrame(out, columns=["topic_key", "item_hash", "summary", "status"])

    new = state.where("status <> 'hit'").select("topic_key", "item_hash", "n_items", "prompt", "status").mapInPandas(run, "topic_key string, item_hash string, summary string, status string")
    return state.where("status = 'hit'").select("topic_key", "item_hash", F.col("_kept").alias("summary"), "status").union(new)
