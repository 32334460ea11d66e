"""Source definitions: reading, validation, selection."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# The kinds of crawler, and the fields no definition may lack.
CRAWLERS = ["nber", "rss", "crossref", "openalex", "arxiv_atom", "html_scraper", "osf_preprint"]
REQUIRED = ["key", "name", "source_type", "crawler_type"]
SCHEMA = "key string, name string, source_type string, crawler_type string, subtopics array<string>, url string, feed_url string, issn string, openalex_source_id string, crawl_config string, is_enabled boolean"


def read_definitions(spark: SparkSession, path: str) -> DataFrame:
    """Definitions in a JSON file that is an array of objects; nested configurations stay JSON text."""
    return spark.read.schema(SCHEMA).json(path, multiLine=True)


def problems(sources: DataFrame, order: str = "id") -> DataFrame:
    """``position, key, problem`` of all definitions that break a rule, each rule on its own: missing fields, unknown crawlers, keys that stood before."""
    numbered = sources.withColumn("position", F.row_number().over(Window.orderBy(order)) - 1) if "position" not in sources.columns else sources
    missing = F.filter(F.array(*[F.when(F.coalesce(F.trim(F.col(c)), F.lit("")) == "", F.lit(f"{c} is missing")) for c in REQUIRED]), lambda x: x.isNotNull())
    unknown = F.when((F.coalesce("crawler_type", F.lit("")) != "") & ~F.col("crawler_type").isin(*CRAWLERS), F.concat(F.lit("unknown crawler_type "), "crawler_type"))
    before = F.min("position").over(Window.partitionBy("key").orderBy("position").rowsBetween(Window.unboundedPreceding, -1))
    twice = F.when(F.coalesce("key", F.lit("")) != "", F.concat(F.lit("key stands at "), before.cast("string")))
    every = F.concat(missing, F.filter(F.array(unknown, twice), lambda x: x.isNotNull()))
    return numbered.withColumn("e", every).select(F.col("position").cast("bigint").alias("position"), "key", F.explode("e").alias("problem"))


def enabled(sources: DataFrame, crawler_type: str | None = None, subtopic: str | None = None) -> DataFrame:
    """The enabled sources by name, of one kind of crawler and one subtopic if given."""
    out = sources.where("is_enabled")
    if crawler_type:
        out = out.where(F.col("crawler_type") == crawler_type)
    if subtopic:
        out = out.where(F.array_contains("subtopics", subtopic))
    return out.orderBy("name")


def failing(sources: DataFrame, least: int = 3) -> DataFrame:
    """The enabled sources that failed at least so often in a row, most failures first."""
    return sources.where(F.col("is_enabled") & (F.col("consecutive_failures") >= least)).orderBy(F.col("consecutive_failures").desc(), "key")


def by_crawler(sources: DataFrame, items: DataFrame) -> DataFrame:
    """``crawler_type, n_sources, n_items``, sources without items too."""
    per = items.groupBy(F.col("source").alias("key")).agg(F.count("*").alias("_n"))
    return sources.select("key", "crawler_type").join(per, "key", "left").groupBy("crawler_type").agg(F.count("*").alias("n_sources"), F.sum(F.coalesce("_n", F.lit(0))).alias("n_items"))
