"""Keyword scores against a taxonomy, and matches with a network of names.

The taxonomy is one literal, an array of topics, walked by higher-order functions over a text made once: the generated code doesn't grow
with the topics, there is no join, and a long text is never multiplied by them.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from heddle.operators.taxonomy import Taxonomy

TOPICS = "array<struct<subtopic string, topic string, ordinal int, weight double, keywords array<string>, audit array<string>>>"
NAMES = "array<struct<type string, name string, shown string, description string, pattern string>>"
THRESHOLD = 0.02


def scoring_text(df: DataFrame) -> Column:
    """Source name or source, title, content or abstract, in lower case."""
    part = lambda *names: F.coalesce(*[F.when(F.length(df[n]) > 0, df[n]) for n in names], F.lit(""))
    return F.lower(F.concat_ws(" ", part("source_name", "source"), part("title"), part("content", "abstract")))


def with_value(value: Column, fn) -> Column:
    """``fn`` of a value that is made once, however often ``fn`` uses it."""
    return F.get(F.transform(F.array(value), fn), F.lit(0))


def _topics(taxonomy: Taxonomy) -> Column:
    low = lambda words: [k.lower() for k in words]
    rows = [{"subtopic": t.subtopic, "topic": t.topic, "ordinal": t.ordinal, "weight": float(t.weight), "keywords": low(t.keywords), "audit": low(taxonomy.audit_keywords(t))} for t in taxonomy.topics]
    return F.from_json(F.lit(json.dumps(rows)), TOPICS)


def _names(taxonomy: Taxonomy) -> Column:
    """Names of fewer than five characters stand on word boundaries, longer ones anywhere."""
    rows = [{"type": kind, "name": n, "shown": n.title(), "description": d, "pattern": rf"(?U)\b\Q{n}\E\b" if len(n) < 5 and "\\E" not in n else None} for kind in ("author", "organization", "publication") for n, d in taxonomy.network.get(kind, {}).items()]
    return F.from_json(F.lit(json.dumps(rows)), NAMES)


def topic_score(lower_text: Column, topic: Column) -> Column:
    """The share of a topic's keywords that stand in the text, times its weight, at most 1; 0 without keywords."""
    n = F.size(topic["keywords"])
    hits = F.size(F.filter(topic["keywords"], lambda k: lower_text.contains(k)))
    return F.when(n > 0, F.least(hits / n * topic["weight"], F.lit(1.0))).otherwise(0.0)


def keyword_scores(items: DataFrame, taxonomy: Taxonomy, id_col: str = "id") -> DataFrame:
    """``item_id, subtopic, topic, ordinal, score`` for every item and topic. A null text scores 0."""
    scored = lambda t: F.transform(_topics(taxonomy), lambda p: F.struct(p["subtopic"].alias("subtopic"), p["topic"].alias("topic"), p["ordinal"].alias("ordinal"), topic_score(t, p).alias("score")))
    return items.select(F.col(id_col).alias("item_id"), F.inline(with_value(scoring_text(items), scored)))


def subtopic_scores(scores: DataFrame) -> DataFrame:
    """``item_id, subtopic, score``: the best of a subtopic's topics."""
    return scores.groupBy("item_id", "subtopic").agg(F.max("score").alias("score"))


def keyword_candidates(scores: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``item_id, subtopic, topics``: topics scoring at least ``threshold``, best first, equal ones in the taxonomy's order."""
    kept = scores.where(F.col("score") >= threshold)
    best = F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("s"), "ordinal", "topic")))
    return kept.groupBy("item_id", "subtopic").agg(F.transform(best, lambda x: x["topic"]).alias("topics"))


def potentially_relevant(items: DataFrame, taxonomy: Taxonomy, threshold: float = THRESHOLD) -> DataFrame:
    """``items`` with ``passes``: whether the text clears the threshold for some topic; the first that does is the last looked at."""
    some = lambda t: F.exists(_topics(taxonomy), lambda p: topic_score(t, p) >= threshold)
    return items.withColumn("passes", F.lit(True) if threshold <= 0 else with_value(scoring_text(items), some))


def network_matches(items: DataFrame, taxonomy: Taxonomy, id_col: str = "id") -> DataFrame:
    """``item_id, connection_type, connection_name, connection_description`` of the items that name somebody of the network.

    Authors come before organisations before publications, each in the taxonomy's order; the first that matches counts.
    """
    text = F.lower(F.concat_ws(" ", scoring_text(items), F.coalesce(items["authors"], F.lit(""))))
    stands = lambda t: F.filter(_names(taxonomy), lambda n: F.when(n["pattern"].isNull(), t.contains(n["name"])).otherwise(F.rlike(t, n["pattern"])))
    found = items.select(F.col(id_col).alias("item_id"), F.get(with_value(text, stands), F.lit(0)).alias("m")).where("m is not null")
    return found.select("item_id", F.col("m.type").alias("connection_type"), F.col("m.shown").alias("connection_name"), F.col("m.description").alias("connection_description"))


def audit_hits(items: DataFrame, taxonomy: Taxonomy, id_col: str = "id") -> DataFrame:
    """``item_id, subtopic, topic, ordinal``: the topics any of whose audit keywords stand in the item's text."""
    hits = lambda t: F.transform(F.filter(_topics(taxonomy), lambda p: F.exists(p["audit"], lambda k: t.contains(k))), lambda p: F.struct(p["subtopic"].alias("subtopic"), p["topic"].alias("topic"), p["ordinal"].alias("ordinal")))
    return items.select(F.col(id_col).alias("item_id"), F.inline(with_value(scoring_text(items), hits)))
