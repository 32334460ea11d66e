"""Reading the given tables and cutting lineage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The table ``name`` below ``sf_dir``."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def has_text(col) -> F.Column:
    """Null and "" count as no text."""
    return F.coalesce(F.length(col) > 0, F.lit(False))


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir. Where it is unset, a folder of its own for a session on one machine, as in tests; on a
    cluster that is an error, as a folder of one machine is lost with it and unseen by others."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir isn't set: name a folder that all executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="spark-", dir="/tmp")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder below the shared one for files between steps, gone when the session's driver ends."""
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(p)
    fs.deleteOnExit(p)
    return path


def materialize(df: DataFrame) -> DataFrame:
    """``df`` written once to the shared folder and read again: lineage ends at files that outlive executors."""
    spark = df.sparkSession
    path = f"{scratch(spark, 'heddle')}/rows"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def broadcast_if_small(df: DataFrame, most: int) -> DataFrame:
    """``df``, written once, marked for broadcast if it has at most ``most`` rows; a larger one is left to Spark's choice of join."""
    held = materialize(df)
    return F.broadcast(held) if held.count() <= most else held


def ranked(df: DataFrame, by: list[str], order: list[str], name: str) -> DataFrame:
    """``df`` with its place (from 1) within each group ``by`` in ``order``, nulls first, equal rows in any order.

    No task holds a group: rows are parted by range over all tasks, numbered within each part, and moved on by what the group has in
    the parts before. A group that lies in several parts has an offset for each: at most one a part, so the offsets are few whatever the rows.
    """
    held = materialize(df.repartitionByRange(*by, *order).withColumn("_part", F.spark_partition_id()))
    own = [F.col(c) for c in by]
    sizes = held.groupBy(*by, "_part").agg(F.count("*").alias("_n"))
    before = Window.partitionBy(*own).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.withColumn("_before", F.sum("_n").over(before)).where("_before is not null").drop("_n")
    offsets = offsets.toDF(*[f"_g{i}" for i in range(len(by))], "_p", "_before")
    same = [F.col("_part") == F.col("_p"), *[F.col(c).eqNullSafe(F.col(f"_g{i}")) for i, c in enumerate(by)]]
    place = F.row_number().over(Window.partitionBy("_part", *own).orderBy(*order))
    out = held.withColumn("_place", place).join(F.broadcast(offsets), same, "left")
    return out.withColumn(name, (F.col("_place") + F.coalesce("_before", F.lit(0))).cast("bigint")).select(*df.columns, name)
