"""Duplicates by content hash and by address, and rows that are known already."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from heddle.functions.tables import ranked
from heddle.functions.text import content_hash


def with_hash(items: DataFrame) -> DataFrame:
    """``items`` with ``content_hash``; null for an item without a title."""
    return items.withColumn("content_hash", F.when(F.length("title") > 0, content_hash(F.col("title"), F.col("authors"))))


def best_of_copies(items: DataFrame, order: list[Column | str], id_col: str = "id") -> DataFrame:
    """One row per content hash: the one with the longest abstract, the first by ``order`` among equals. Items without a title all stay. Ids are unique.

    The best row is found by an aggregate of (length, order) keys with partial sums, and the rows are joined to it by id: a hash that
    holds a third of the rows is one row per task after the partial step.
    """
    titled = F.coalesce(F.length("title") > 0, F.lit(False))
    key = F.struct((-F.length(F.coalesce("abstract", F.lit("")))).alias("l"), *[F.expr(o) if isinstance(o, str) else o for o in order], F.col(id_col).alias("_id"))
    # the hash is made once, below the aggregate, and comes back with the best row's id
    best = with_hash(items.where(titled)).groupBy("content_hash").agg(F.min(key).alias("k")).select(F.col("k._id").alias(id_col), "content_hash")
    kept = items.where(titled).drop("content_hash").join(best, id_col)
    return kept.unionByName(items.where(~titled).withColumn("content_hash", F.lit(None).cast("string")))


def first_by(items: DataFrame, key: str, order: list[str], id_col: str = "id") -> DataFrame:
    """One row per ``key``: the first by ``order`` and id. Rows of a null key are one group."""
    rank = F.struct(*[F.col(o) for o in order], F.col(id_col).alias("_id"))
    best = items.groupBy(key).agg(F.min(rank).alias("k")).select(F.col("k._id").alias(id_col))
    return items.join(best, id_col, "left_semi")


def unknown(items: DataFrame, known: DataFrame, key: str = "url") -> DataFrame:
    """The items whose key isn't among the known rows; a null key is never known."""
    return items.join(known.select(key).where(F.col(key).isNotNull()).distinct(), key, "left_anti")


def numbered_batches(items: DataFrame, size: int, by: str, order: str) -> DataFrame:
    """``items`` with ``batch``: the first ``size`` rows of each ``by`` in order are 0, the next 1, and so on. A group that holds most rows is numbered by many tasks."""
    return ranked(items, [by], [order], "_place").withColumn("batch", F.floor((F.col("_place") - 1) / size)).drop("_place")


def best_by_source(items: DataFrame, order: list[str], source: str = "source", id_col: str = "id") -> DataFrame:
    """``source, content_hash, id``: the best copy within each source only. Items without a title have no hash and aren't listed."""
    key = F.struct((-F.length(F.coalesce("abstract", F.lit("")))).alias("l"), *order, F.col(id_col).alias("_id"))
    best = with_hash(items).where("content_hash is not null").groupBy(source, "content_hash").agg(F.min(key).alias("k"))
    return best.select(source, "content_hash", F.col("k._id").alias(id_col))
