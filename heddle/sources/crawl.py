"""Crawls by source definition: what is asked of each source and since when, which reader its replies go to, and what became of it."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from heddle.functions.tables import materialize
from heddle.operators.upsert import crawl_status
from heddle.sources import feeds, listings, works

# The public interfaces asked.
REGISTRY = "https://api.crossref.org/works"
CATALOGUE = "https://api.openalex.org/works"
PREPRINT_FEED = "https://export.arxiv.org/api/query"
PREPRINTS = "https://api.osf.io/v2/preprints/"

CONFIG = "categories array<string>, provider string, subjects array<string>, listing_url string"
REQUEST = "struct<layer int, route string, request string>"


def cutoffs(sources: DataFrame, state: DataFrame, now: Column, days: int | None) -> DataFrame:
    """``source, cutoff``: the boundary saved for a source (state: ``source, saved``), else ``days`` before ``now``; null, so everything, without either."""
    back = F.lit(None).cast("timestamp") if days is None else now - F.expr(f"interval {days} days")
    saved = state.groupBy("source").agg(F.max("saved").alias("saved"))
    return sources.select(F.col("key").alias("source")).join(saved, "source", "left").select("source", F.coalesce("saved", back).alias("cutoff"))


def _given(c: str) -> Column:
    return F.when(F.length(F.trim(c)) > 0, F.trim(c))


def _query(base: str, *parts: Column) -> Column:
    """An address with its parameters; those that are null are left out."""
    return F.concat(F.lit(base + "?"), F.array_join(F.array(*parts), "&"))


def requests(sources: DataFrame, since: DataFrame, contact: str) -> DataFrame:
    """``source, layer, route, request``: what is asked of each enabled source, with the cutoff (``source, cutoff``) and the order pushed to interfaces that take them.

    A journal has layers: its feed, then the registry by ISSN, or the catalogue by its id there; the next layer counts where the one before gave
    no items (see crawled). A preprint server is asked once a category. An unknown crawler, and one that lacks its address or number, is asked nothing.
    """
    s = sources.where("is_enabled").join(since.withColumnRenamed("source", "key"), "key", "left").withColumn("c", F.from_json("crawl_config", CONFIG))
    kind, day = F.col("crawler_type"), F.date_format("cutoff", "yyyy-MM-dd")
    mail = F.lit(f"mailto={contact}")
    registry = _query(REGISTRY, F.concat_ws(",", F.concat(F.lit("filter=issn:"), _given("issn")), F.concat(F.lit("from-created-date:"), day)), F.lit("rows=200"), F.lit("sort=published"), F.lit("order=desc"), mail)
    catalogue = _query(CATALOGUE, F.concat_ws(",", F.concat(F.lit("filter=primary_location.source.id:"), _given("openalex_source_id")), F.concat(F.lit("from_publication_date:"), day)), F.lit("per_page=200"), F.lit("sort=publication_date:desc"), mail)
    provider = F.coalesce(F.col("c.provider"), F.lit("socarxiv"))
    at = F.concat(F.lit("filter[date_created][gte]="), F.date_format("cutoff", "yyyy-MM-dd'T'HH:mm:ss"))
    subjects = F.when(F.size("c.subjects") > 0, F.concat(F.lit("filter[subjects]="), F.array_join("c.subjects", ",")))
    preprints = _query(PREPRINTS, F.concat(F.lit("filter[provider]="), provider), at, F.lit("sort=-date_created"), F.lit("page[size]=50"), subjects)
    ask = lambda layer, route, request: F.struct(F.lit(layer).alias("layer"), F.lit(route).alias("route"), request.alias("request"))
    of = lambda layer, route, when, request: F.when(when & request.isNotNull(), F.array(ask(layer, route, request)))
    none = F.array().cast(f"array<{REQUEST}>")
    by_category = F.transform("c.categories", lambda c: ask(1, "preprint_feed", F.concat(F.lit(PREPRINT_FEED + "?search_query=cat:"), c, F.lit("&sortBy=submittedDate&sortOrder=descending&start=0&max_results=50"))))
    asked = [
        of(1, "feed", kind == "rss", _given("feed_url")),
        of(2, "registry", kind.isin("crossref", "rss") & _given("issn").isNotNull(), registry),
        of(3, "catalogue", (kind == "openalex") & _given("openalex_source_id").isNotNull(), catalogue),
        of(1, "papers", kind == "nber", _given("feed_url")),
        F.when((kind == "arxiv_atom") & (F.size("c.categories") > 0), by_category).otherwise(of(1, "preprint_feed", kind == "arxiv_atom", _given("feed_url"))),
        of(1, "preprints", kind == "osf_preprint", preprints),
        of(1, "listing", kind == "html_scraper", F.coalesce(F.when(F.length("c.listing_url") > 0, F.col("c.listing_url")), _given("url"))),
    ]
    every = F.flatten(F.array(*[F.coalesce(a.cast(f"array<{REQUEST}>"), none) for a in asked]))
    return s.select(F.col("key").alias("source"), F.explode(every).alias("r")).select("source", "r.layer", "r.route", "r.request")


def crawled(sources: DataFrame, replies: DataFrame, since: DataFrame, today: dt.date) -> DataFrame:
    """Items of one shape from replies of every kind (``source, layer, route, address, body``), each given to the reader of its route, with ``route``.

    Of a source's layers the first that has items counts. Cutoffs (``source, cutoff``) are by day where an item has a date; works of registry and
    catalogue are cut by the request. Sources that aren't enabled, routes without a reader, and null or broken bodies give nothing. The replies
    are read once for each route, and only that route's.
    """
    on = sources.where("is_enabled").select(F.col("key").alias("source"), "crawl_config")
    known = replies.join(on, "source")

    def of(route: str) -> DataFrame:
        return known.where(F.col("route") == route)

    documents = lambda route: of(route).select(F.col("address").alias("feed_url"), "source", F.col("body").alias("document"))
    answers = lambda route: of(route).select("source", F.col("body").alias("reply"))
    parts = [
        (1, "feed", feeds.feed_items(documents("feed"))),
        (2, "registry", works.registry_works(answers("registry"), F.lit(today))),
        (3, "catalogue", works.open_works(answers("catalogue"), F.lit(today))),
        (1, "papers", feeds.paper_feed_items(documents("papers"), F.lit(today))),
        (1, "preprint_feed", feeds.preprint_feed_items(documents("preprint_feed"))),
        (1, "preprints", works.preprint_works(answers("preprints"))),
        (1, "listing", listings.listing_items(of("listing").select("source", "crawl_config", F.col("body").alias("html")), today.year)),
    ]
    tagged = [d.withColumns({"layer": F.lit(n), "route": F.lit(r)}) for n, r, d in parts]
    items = materialize(reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged))
    first = items.groupBy("source").agg(F.min("layer").alias("_first"))
    at = since.groupBy("source").agg(F.min("cutoff").alias("_cutoff"))
    out = items.join(first, "source").where("layer = _first").join(at, "source", "left")
    by_request = F.col("route").isin("registry", "catalogue")
    return out.where(by_request | F.col("_cutoff").isNull() | F.col("published_date").isNull() | (F.col("published_date") >= F.to_date("_cutoff"))).drop("_first", "_cutoff", "layer")


def outcomes(sources: DataFrame, asked: DataFrame, items: DataFrame) -> DataFrame:
    """``source, n_items, error, status`` of every enabled source: error where nothing could be asked of it (an unknown crawler, no address), else ok, or empty."""
    n = items.groupBy("source").agg(F.count("*").alias("n_items"))
    known = asked.select("source").distinct().withColumn("_asked", F.lit(True))
    out = sources.where("is_enabled").select(F.col("key").alias("source"), "crawler_type").join(known, "source", "left").join(n, "source", "left")
    error = F.when(F.col("_asked").isNull(), F.concat(F.lit("nothing to ask of crawler_type "), F.coalesce("crawler_type", F.lit("null"))))
    return out.select("source", F.coalesce("n_items", F.lit(0)).cast("bigint").alias("n_items"), error.alias("error")).withColumn("status", crawl_status(F.col("error"), F.col("n_items")))
