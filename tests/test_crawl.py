import datetime as dt
import json

from pyspark.sql import functions as F

from heddle.sources import crawl, listings

SOURCES = "key string, crawler_type string, feed_url string, issn string, openalex_source_id string, url string, crawl_config string, is_enabled boolean"
ROWS = [
    ("blog", "rss", "https://blog.example/feed", "1111-2222", None, None, None, True),
    ("dry", "rss", "https://dry.example/feed", "3333-4444", None, None, "{}", True),
    ("journal", "crossref", None, "5555-6666", None, None, "broken", True),
    ("open", "openalex", None, None, "S7", None, None, True),
    ("server", "arxiv_atom", None, None, None, None, '{"categories": ["q.A", "q.B"]}', True),
    ("provider", "osf_preprint", None, None, None, None, None, True),
    ("paper", "nber", "https://paper.example/rss", None, None, None, None, True),
    ("site", "html_scraper", None, None, None, "https://site.example", None, True),
    ("odd", "telegraph", "https://odd.example", None, None, None, None, True),
    ("mute", None, None, None, None, None, None, True),
    ("off", "rss", "https://off.example/feed", None, None, None, None, False),
    ("blank", "crossref", None, "  ", None, None, None, True),
]
CUT = dt.datetime(2026, 2, 3, 4, 5, 6)


def tables(spark, rows=ROWS):
    s = spark.createDataFrame(rows, SOURCES)
    return s, s.select(F.col("key").alias("source"), F.lit(CUT).alias("cutoff"))


def test_cutoffs(spark):
    s, _ = tables(spark)
    state = spark.createDataFrame([("blog", CUT), ("blog", dt.datetime(2026, 1, 1)), ("dry", None), ("gone", CUT)], "source string, saved timestamp")
    now = F.lit(dt.datetime(2026, 3, 1))
    got = {r.source: r.cutoff for r in crawl.cutoffs(s, state, now, 7).collect()}
    assert got["blog"] == CUT and got["dry"] == dt.datetime(2026, 2, 22) and len(got) == len(ROWS)
    got = {r.source: r.cutoff for r in crawl.cutoffs(s, state, now, None).collect()}
    assert got["blog"] == CUT and got["dry"] is None


def test_requests(spark):
    s, since = tables(spark)
    got = sorted((r.source, r.layer, r.route, r.request) for r in crawl.requests(s, since, "m@x.example").collect())
    assert [(a, b, c) for a, b, c, _ in got] == sorted([("blog", 1, "feed"), ("blog", 2, "registry"), ("dry", 1, "feed"), ("dry", 2, "registry"), ("journal", 2, "registry"), ("open", 3, "catalogue"), ("paper", 1, "papers"), ("provider", 1, "preprints"), ("server", 1, "preprint_feed"), ("server", 1, "preprint_feed"), ("site", 1, "listing")])
    by = {(a, c): r for a, _, c, r in got}
    assert by["journal", "registry"].endswith("filter=issn:5555-6666,from-created-date:2026-02-03&rows=200&sort=published&order=desc&mailto=m@x.example")
    assert "from_publication_date:2026-02-03" in by["open", "catalogue"] and "[gte]=2026-02-03T04:05:06" in by["provider", "preprints"]
    never = crawl.requests(s, since.withColumn("cutoff", F.lit(None).cast("timestamp")), "m@x.example")
    by = {(r.source, r.route): r.request for r in never.collect()}
    assert "from-created-date" not in by["journal", "registry"] and "gte" not in by["provider", "preprints"] and len(by) == 10
    assert crawl.requests(*tables(spark, []), "m").count() == 0


RSS = "<rss><channel><item><title>{0}</title><link>https://x.example/{0}</link><pubDate>{1}</pubDate></item></channel></rss>"


def work(title, doi):
    return json.dumps({"message": {"items": [{"title": [title], "DOI": doi, "published": {"date-parts": [[2020, 1, 2]]}}]}})


def test_crawled(spark):
    s, since = tables(spark)
    replies = [
        ("blog", "feed", RSS.format("New", "Wed, 04 Feb 2026 00:00:00 GMT")), ("blog", "feed", RSS.format("Old", "Wed, 05 Feb 2025 00:00:00 GMT")), ("blog", "registry", work("Unused", "10.1/u")),
        ("dry", "feed", None), ("dry", "feed", "<rss"), ("dry", "registry", work("Second layer", "10.1/s")), ("journal", "registry", work("Journal", "10.1/j")), ("journal", "registry", "{"),
        ("open", "catalogue", json.dumps({"results": [{"id": "W1", "title": "Open"}]})), ("paper", "papers", RSS.format("P -- by Q", "")), ("off", "feed", RSS.format("Off", "")), ("odd", "telegraph", RSS.format("Odd", "")), ("unknown", "feed", RSS.format("Who", "")), (None, "feed", RSS.format("Null", "")),
    ]
    df = spark.createDataFrame([(a, b, "https://a.example", c) for a, b, c in replies], "source string, route string, address string, body string")
    items = crawl.crawled(s, df.withColumns({"layer": F.lit(9), "crawl_config": F.lit("clash"), "title": F.lit("clash")}).drop("crawl_config"), since, dt.date(2026, 3, 1))
    assert sorted((r.source, r.route, r.title) for r in items.collect()) == [("blog", "feed", "New"), ("dry", "registry", "Second layer"), ("journal", "registry", "Journal"), ("open", "catalogue", "Open"), ("paper", "papers", "P")]
    done = {r.source: (r.n_items, r.status) for r in crawl.outcomes(s, crawl.requests(s, since, "m"), items).collect()}
    assert done["blog"] == (1, "ok") and done["site"] == (0, "empty") and "off" not in done
    assert {k for k, v in done.items() if v[1] == "error"} == {"odd", "mute", "blank"}
    assert crawl.crawled(s, df.limit(0), since, dt.date(2026, 3, 1)).count() == 0


def test_page_date(spark):
    pages = {"<time datetime='2026-02-07T09:00'>x</time>": dt.date(2026, 2, 7), "<time class=a>May 2024</time>": dt.date(2024, 5, 1), "<b>Issue Date</b> <i>July 2023</i>": dt.date(2023, 7, 1), "Issue Date: March 9, 2021": dt.date(2021, 3, 9), "<time>soon</time>": None, "": None, None: None}
    df = spark.createDataFrame([(k,) for k in pages], "html string")
    assert {r.html: r.day for r in df.select("html", listings.page_date(F.col("html")).alias("day")).collect()} == pages
