"""Works from scholarly JSON interfaces to the item shape, with explicit schemas: no inference, only the fields that are used are read."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from heddle.functions import dates
from heddle.functions import text as T

REGISTRY = "message struct<items array<struct<title array<string>, DOI string, link array<struct<URL string>>, abstract string, author array<struct<given string, family string>>, published struct<`date-parts` array<array<int>>>, created struct<`date-parts` array<array<int>>>>>>"
OPEN = "results array<struct<id string, doi string, title string, display_name string, publication_date string, authorships array<struct<author struct<display_name string>>>, abstract_inverted_index map<string, array<int>>>>"
PREPRINTS = "data array<struct<id string, attributes struct<title string, description string, date_created string, date_published string, doi string, subjects array<array<struct<text string>>>>, links struct<preprint_doi string, html string>, embeds struct<contributors struct<data array<struct<embeds struct<users struct<data struct<attributes struct<full_name string>>>>>>>>>>"


def _parsed(replies: DataFrame, schema: str, path: str) -> DataFrame:
    """One row per work ``w`` of JSON replies (``source, reply``); a broken reply has none."""
    parsed = replies.select("source", F.from_json("reply", schema).alias("j"))
    return parsed.select("source", F.explode(f"j.{path}").alias("w"))


def _joined(names: Column) -> Column:
    return F.coalesce(F.array_join(F.filter(names, lambda n: F.length(F.trim(n)) > 0), ", "), F.lit(""))


def _address(doi: Column) -> Column:
    bare = F.regexp_replace(doi, r"(?i)^https?://(dx\.)?doi\.org/", "")
    return F.when(F.length(bare) > 0, F.concat(F.lit("https://doi.org/"), bare))


def registry_works(replies: DataFrame, today: Column) -> DataFrame:
    """Works of a DOI registry: the first title, the DOI's address else the first link's; published else created. Works without title or address are none."""
    w = _parsed(replies, REGISTRY, "message.items")
    given = lambda a: F.trim(F.concat_ws(" ", a["given"], a["family"]))
    parts = F.coalesce(F.get(F.col("w.published.date-parts"), F.lit(0)), F.get(F.col("w.created.date-parts"), F.lit(0)))
    url = F.coalesce(_address(F.col("w.DOI")), F.get(F.col("w.link"), F.lit(0))["URL"])
    out = w.select("source", url.alias("url"), T.collapse(F.get(F.col("w.title"), F.lit(0))).alias("title"), F.trim(T.strip_tags(F.coalesce("w.abstract", F.lit("")), "")).alias("abstract"), _joined(F.transform("w.author", given)).alias("authors"), dates.from_parts(parts, today).alias("published_date"), F.coalesce("w.DOI", F.lit("")).alias("source_id"))
    return out.where((F.length("url") > 0) & (F.length("title") > 0))


def open_works(replies: DataFrame, today: Column) -> DataFrame:
    """Works of an open catalogue: the DOI's address else the id, the abstract from its inverted index; a date over a week ahead is ``today``, a missing one null."""
    w = _parsed(replies, OPEN, "results")
    day = F.try_to_date("w.publication_date", "yyyy-MM-dd")
    url = F.coalesce(_address(F.col("w.doi")), F.col("w.id"))
    out = w.select("source", url.alias("url"), F.coalesce("w.title", "w.display_name").alias("title"), F.coalesce(T.from_inverted_index(F.col("w.abstract_inverted_index")), F.lit("")).alias("abstract"), _joined(F.transform("w.authorships", lambda a: a["author"]["display_name"])).alias("authors"), F.when(day > F.date_add(today, 7), today).otherwise(day).alias("published_date"), F.coalesce("w.id", F.lit("")).alias("source_id"))
    return out.where((F.length("url") > 0) & (F.length("title") > 0))


def preprint_works(replies: DataFrame, cutoff: Column | None = None) -> DataFrame:
    """Preprints with their contributors: created else published, dropped before ``cutoff``; address by DOI, preprint DOI, page, id; subjects flattened; one per address."""
    w = _parsed(replies, PREPRINTS, "data")
    at = F.coalesce(F.try_to_timestamp("w.attributes.date_created"), F.try_to_timestamp("w.attributes.date_published"))
    url = F.coalesce(_address(F.col("w.attributes.doi")), F.when(F.length("w.links.preprint_doi") > 0, F.col("w.links.preprint_doi")), F.when(F.length("w.links.html") > 0, F.col("w.links.html")), F.concat(F.lit("https://osf.io/"), F.col("w.id")))
    names = F.transform("w.embeds.contributors.data", lambda c: c["embeds"]["users"]["data"]["attributes"]["full_name"])
    subjects = F.array_distinct(F.transform(F.flatten("w.attributes.subjects"), lambda s: s["text"]))
    out = w.select("source", url.alias("url"), T.collapse(F.col("w.attributes.title")).alias("title"), F.trim(T.strip_tags(F.coalesce("w.attributes.description", F.lit("")), "")).alias("abstract"), _joined(names).alias("authors"), at.alias("at"), F.col("w.id").alias("source_id"), subjects.alias("subjects"))
    out = out.where((F.length("url") > 0) & (F.length("title") > 0))
    if cutoff is not None:
        out = out.where(F.col("at").isNull() | (F.col("at") >= cutoff))
    first = out.groupBy("url").agg(F.min_by(F.struct(*[c for c in out.columns if c != "url"]), F.struct("at", "source_id")).alias("v"))
    return first.select("url", "v.*").withColumn("published_date", F.to_date("at")).drop("at")


def backfilled(items: DataFrame, works: DataFrame, most: int | None = None) -> DataFrame:
    """``items`` whose missing abstracts are taken from the works of the same address: of all of them, or of the first ``most`` of each source by id,
    for an interface that may be asked for no more. Of several works of an address the greatest abstract counts."""
    lacking = items.where(T.needs_abstract(F.col("abstract"), 1)).select("id", "url", "source")
    if most is not None:
        lacking = lacking.withColumn("r", F.row_number().over(Window.partitionBy("source").orderBy("id"))).where(F.col("r") <= most)
    found = lacking.join(works.groupBy("url").agg(F.max("abstract").alias("_abstract")).where(F.length("_abstract") > 0), "url").select("id", "_abstract")
    return items.join(found, "id", "left").withColumn("abstract", F.coalesce("_abstract", "abstract")).drop("_abstract")
