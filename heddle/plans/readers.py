"""The registered queries of the readers: the items, written as the documents and replies of each kind of source, fifty to a page, and read again."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from heddle.functions import text as T
from heddle.functions.tables import table
from heddle.sources import crawl, feeds, listings, works

DAY = dt.date(2026, 3, 1)
CUTOFF = dt.datetime(2025, 2, 1, 12, tzinfo=dt.timezone.utc)
PAGE = 50
RSS = ("<rss version='2.0' xmlns:dc='http://purl.org/dc/elements/1.1/'><channel>", "</channel></rss>")
RDF = ("<rdf:RDF xmlns:rdf='http://www.w3.org/1999/02/22-rdf-syntax-ns#' xmlns='http://purl.org/rss/1.0/' xmlns:dc='http://purl.org/dc/elements/1.1/'>", "</rdf:RDF>")
ATOM = ("<feed xmlns='http://www.w3.org/2005/Atom'>", "</feed>")
SELECTORS = '{"listing_url": "https://site.example/all", "article_selector": "ul li.post", "title_selector": "a.to", "url_selector": "a[href*=\'/p/\']", "date_selector": "time"}'


def escaped(c: Column) -> Column:
    x = F.coalesce(c.cast("string"), F.lit(""))
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        x = F.replace(x, F.lit(a), F.lit(b))
    return x


def _tag(name: str, value: Column, attributes: str = "") -> Column:
    return F.concat(F.lit(f"<{name}{attributes}>"), escaped(value), F.lit(f"</{name}>"))


def _iso(c: str) -> Column:
    return F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")


def _pages(items: DataFrame, entry: Column, ends: tuple[str, str]) -> DataFrame:
    """``source, address, body``: the entries of at most PAGE items of a source to a document."""
    page = F.floor(F.col("id") / PAGE).alias("page")
    gathered = items.groupBy("source", page).agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("id", entry.alias("e")))), lambda x: x["e"]), "").alias("b"))
    return gathered.select("source", F.concat(F.lit("https://"), F.col("source"), F.lit(".example/feed/"), F.col("page")).alias("address"), F.concat(F.lit(ends[0]), F.col("b"), F.lit(ends[1])).alias("body"))


def _replies(items: DataFrame, work: Column, name: str, within: str | None = None) -> DataFrame:
    """``source, address, body``: the works of at most PAGE items of a source to a JSON reply."""
    page = F.floor(F.col("id") / PAGE).alias("page")
    held = F.struct(F.collect_list(work).alias(name))
    body = F.to_json(held if within is None else F.struct(held.alias(within)))
    return items.groupBy("source", page).agg(body.alias("body")).select("source", F.lit(None).cast("string").alias("address"), "body")


def _documents(pages: DataFrame) -> DataFrame:
    return pages.select(F.col("address").alias("feed_url"), "source", F.col("body").alias("document"))


def _answers(pages: DataFrame) -> DataFrame:
    return pages.select("source", F.col("body").alias("reply"))


def _rss(items: DataFrame) -> DataFrame:
    return _pages(items, F.concat(F.lit("<item>"), _tag("title", F.col("title")), _tag("link", F.col("url")), _tag("pubDate", F.date_format("crawled_at", "EEE, dd MMM yyyy HH:mm:ss 'GMT'")), F.lit("</item>")), RSS)


def _rdf(items: DataFrame) -> DataFrame:
    return _pages(items, F.concat(F.lit("<item>"), _tag("title", F.col("title")), _tag("link", F.col("url")), _tag("dc:creator", F.col("authors")), _tag("dc:date", F.col("published_date")), _tag("description", F.col("abstract")), F.lit("</item>")), RDF)


def _atom(items: DataFrame) -> DataFrame:
    images = F.coalesce(F.from_json("raw_metadata", "images array<string>")["images"], F.array().cast("array<string>"))
    html = F.concat(F.coalesce("content", F.lit("")), F.array_join(F.transform(images, lambda u: F.concat(F.lit('<img src="'), u, F.lit('">'))), ""))
    return _pages(items, F.concat(F.lit("<entry>"), _tag("id", F.col("url")), _tag("title", F.col("title")), _tag("updated", _iso("crawled_at")), _tag("summary", F.col("abstract")), _tag("content", html, " type='html'"), F.lit("<author>"), _tag("name", F.col("authors")), F.lit("</author></entry>")), ATOM)


def _preprint_feed(items: DataFrame) -> DataFrame:
    at = F.concat(F.lit("http://pre.example/abs/"), F.col("id").cast("string"))
    link = F.concat(F.lit("<link type='text/html' href='"), at, F.lit("'/><category term='"), F.col("source"), F.lit("'/>"))
    return _pages(items, F.concat(F.lit("<entry>"), _tag("id", at), link, _tag("title", F.col("title")), _tag("published", _iso("crawled_at")), _tag("summary", F.col("abstract")), F.lit("<author>"), _tag("name", F.col("authors")), F.lit("</author></entry>")), ATOM)


def _papers(items: DataFrame) -> DataFrame:
    by = F.when(F.length(T.collapse(F.col("authors"))) > 0, F.concat(F.lit(" -- by "), F.col("authors")))
    link = F.concat(F.lit("https://papers.example/papers/w"), F.col("id").cast("string"), F.lit("#fromrss"))
    return _pages(items, F.concat(F.lit("<item>"), _tag("title", F.concat("title", F.coalesce(by, F.lit("")))), _tag("link", link), _tag("description", F.col("abstract")), F.lit("</item>")), RSS)


def _registry(items: DataFrame) -> DataFrame:
    work = F.struct(F.array("title").alias("title"), F.concat(F.lit("10.1000/"), F.col("id")).alias("DOI"), F.array(F.array(F.year("published_date"), F.month("published_date"), F.dayofmonth("published_date"))).alias("p"))
    return _replies(items, F.struct(work["title"].alias("title"), work["DOI"].alias("DOI"), F.struct(work["p"].alias("date-parts")).alias("published")), "items", "message")


def _catalogue(items: DataFrame) -> DataFrame:
    words = F.split(F.col("abstract"), " ")
    index = F.map_from_entries(F.transform(F.array_distinct(words), lambda w: F.struct(w, F.filter(F.transform(words, lambda x, i: F.when(x == w, i)), lambda i: i.isNotNull()))))
    work = F.struct(F.concat(F.lit("W"), F.col("id")).alias("id"), F.concat(F.lit("https://doi.org/10.1000/"), F.col("id")).alias("doi"), F.col("title").alias("display_name"), F.col("published_date").cast("string").alias("publication_date"), F.array(F.struct(F.struct(F.col("authors").alias("display_name")).alias("author"))).alias("authorships"), index.alias("abstract_inverted_index"))
    return _replies(items, work, "results")


def _preprints(items: DataFrame) -> DataFrame:
    person = F.struct(F.struct(F.struct(F.struct(F.struct(F.col("authors").alias("full_name")).alias("attributes")).alias("data")).alias("users")).alias("embeds"))
    about = F.struct(F.col("title").alias("title"), F.concat(F.lit("<p>"), F.coalesce("abstract", F.lit("")), F.lit("</p>")).alias("description"), _iso("crawled_at").alias("date_created"), F.array(F.array(F.struct(F.col("source").alias("text")), F.struct(F.col("source").alias("text")))).alias("subjects"))
    work = F.struct(F.concat(F.lit("p"), F.col("id")).alias("id"), about.alias("attributes"), F.struct(F.concat(F.lit("https://pre.example/"), F.col("id")).alias("html")).alias("links"), F.struct(F.struct(F.array(person).alias("data")).alias("contributors")).alias("embeds"))
    return _replies(items, work, "data")


def _listing(items: DataFrame) -> DataFrame:
    entry = F.concat(F.lit("<li class='post card'><a class='to' href='/p/"), F.col("id").cast("string"), F.lit("'>"), escaped(F.col("title")), F.lit("</a><time datetime='"), F.coalesce(F.col("published_date").cast("string"), F.lit("")), F.lit("'>x</time></li>"))
    return _pages(items, entry, ("<ul>", "</ul>"))


def atom_items(spark: SparkSession, d: str) -> DataFrame:
    """Items out of Atom feeds with their images, of which two count, and whole contents."""
    got = feeds.feed_items(_documents(_atom(table(spark, d, "items"))))
    return got.select("source", "url", "title", "authors", "published_date", F.length("abstract").cast("bigint").alias("n_abstract"), F.length("content").cast("bigint").alias("n_content"), F.size("images").cast("bigint").alias("n_images"), F.coalesce(F.get("images", F.lit(0)), F.lit("")).alias("image"))


def rdf_items(spark, d):
    return feeds.feed_items(_documents(_rdf(table(spark, d, "items")))).select("source", "url", "title", "abstract", "authors", "published_date")


def newest_posts(spark, d):
    """The posts of all feeds, RSS and RDF, since a day as one list, the newest first."""
    items = table(spark, d, "items")
    both = _rss(items).union(_rdf(items))
    return feeds.newest_first(_documents(both), F.lit(CUTOFF)).select("source", "url", "published_date")


def preprint_feed_items(spark, d):
    """Preprints that stand in two categories each, once by address, after a time."""
    pages = _preprint_feed(table(spark, d, "items"))
    both = pages.union(pages.withColumn("address", F.concat("address", F.lit("/other"))))
    got = feeds.preprint_feed_items(_documents(both), F.lit(CUTOFF))
    return got.select("source", "url", "title", "abstract", "authors", "published_date", "source_id", F.array_join("subjects", ",").alias("subjects"))


def paper_feed_items(spark, d):
    return feeds.paper_feed_items(_documents(_papers(table(spark, d, "items"))), F.lit(DAY)).select("source", "url", "title", "authors", "abstract", "source_id", "published_date")


def page_dates(spark, d):
    """Dates on papers' pages: as an element, else as a month named in the text."""
    day, items = F.col("published_date"), table(spark, d, "items")
    html = F.when(F.length("abstract") > 0, F.concat(F.lit("<p>x</p><time class='d' datetime='"), day.cast("string"), F.lit("'>soon</time>"))).otherwise(F.concat(F.lit("<div>Issue Date</div> <div>"), F.date_format(day, "MMMM yyyy"), F.lit("</div>")))
    return items.select("id", listings.page_date(html).alias("day"))


def catalogue_items(spark, d):
    """Works of a catalogue, whose abstracts are inverted indexes."""
    return works.open_works(_answers(_catalogue(table(spark, d, "items"))), F.lit(DAY)).select("source", "source_id", "url", "title", "abstract", "authors", "published_date")


def preprint_items(spark, d):
    """Preprints of a provider, each in two replies, created since a time."""
    pages = _preprints(table(spark, d, "items"))
    got = works.preprint_works(_answers(pages.union(pages)), F.lit(CUTOFF))
    return got.select("source", "source_id", "url", "title", "abstract", "authors", "published_date", F.array_join("subjects", ",").alias("subjects"))


def backfilled_items(spark, d):
    """Items whose missing abstracts come from the registry, which has the document of the same number as the abstract of the item's address."""
    items = table(spark, d, "items")
    known = items.select("id", "source", "url", "title").join(table(spark, d, "documents").select(F.col("doc_id").alias("id"), "text"), "id")
    work = F.struct(F.array("title").alias("title"), F.array(F.struct(F.col("url").alias("URL"))).alias("link"), F.concat(F.lit("<jats:p>"), F.coalesce("text", F.lit("")), F.lit("</jats:p>")).alias("abstract"))
    found = works.registry_works(_answers(_replies(known, work, "items", "message")), F.lit(DAY))
    return works.backfilled(items, found).select("id", F.length("abstract").cast("bigint").alias("n_chars"), F.md5("abstract").alias("digest"))


# crawls by source definition


def _since(spark, d):
    """A state saved for the sources of which an item came before 2026: the last such day's start; the others go back 30 days."""
    state = table(spark, d, "items").where(F.col("crawled_at") < dt.datetime(2026, 1, 1, tzinfo=dt.timezone.utc)).groupBy("source").agg(F.date_trunc("day", F.max("crawled_at")).alias("saved"))
    return crawl.cutoffs(table(spark, d, "sources"), state.where(F.col("source") != "harbor_ledger"), F.lit(dt.datetime(2026, 3, 1, tzinfo=dt.timezone.utc)), 30)


def source_cutoffs(spark, d):
    return _since(spark, d)


def source_requests(spark, d):
    """What is asked of every source since it was crawled last; journals whose feed failed before have a registry number here."""
    s = table(spark, d, "sources").withColumn("issn", F.when(F.col("crawl_status") == "error", F.lit("1234-5678")).otherwise(F.col("issn")))
    s = s.withColumn("crawl_config", F.when(F.col("crawler_type") == "arxiv_atom", F.lit('{"categories": ["cs.A", "cs.B"]}')).when(F.col("key") == "preprint_arcade", F.lit('{"provider": "arcade", "subjects": ["Law", "Art"]}')).otherwise(F.col("crawl_config")))
    return crawl.requests(s, _since(spark, d), "mail@reader.example")


def _crawl(spark, d):
    items, s = table(spark, d, "items"), table(spark, d, "sources")
    s = s.withColumn("crawl_config", F.when(F.col("crawler_type") == "html_scraper", F.lit(SELECTORS)).otherwise(F.col("crawl_config")))
    kinds = items.join(s.select(F.col("key").alias("source"), "crawler_type", "crawl_status"), "source")
    routes = [("feed", _rss, "crawler_type = 'rss' and crawl_status <> 'error'"), ("registry", _registry, "crawler_type in ('rss', 'crossref')"), ("catalogue", _catalogue, "crawler_type = 'openalex'"), ("preprint_feed", _preprint_feed, "crawler_type = 'arxiv_atom'"), ("preprints", _preprints, "crawler_type = 'osf_preprint'"), ("listing", _listing, "crawler_type = 'html_scraper'")]
    replies = None
    for route, write, where in routes:
        some = write(kinds.where(where)).withColumn("route", F.lit(route))
        replies = some if replies is None else replies.unionByName(some)
    since = crawl.cutoffs(s, items.select("source", F.lit(CUTOFF).alias("saved")).distinct(), F.lit(CUTOFF), 30)
    return s, crawl.crawled(s, replies, since, DAY)


def crawled_items(spark, d):
    """Every source's replies read by its kind; blogs whose feed is in error have no feed here and fall to the registry."""
    return _crawl(spark, d)[1].select("source", "route", "url", "title", "published_date")


def crawl_outcomes(spark, d):
    """What became of each source, where every scraped site's definition is misspelled."""
    s, items = _crawl(spark, d)
    typed = s.withColumn("crawler_type", F.when(F.col("crawler_type") == "html_scraper", "scraper").otherwise(F.col("crawler_type"))).withColumn("feed_url", F.coalesce("feed_url", "url"))
    asked = crawl.requests(typed, crawl.cutoffs(s, items.select("source", F.lit(None).cast("timestamp").alias("saved")), F.lit(CUTOFF), None), "mail@reader.example")
    return crawl.outcomes(typed, asked, items.where("route <> 'listing'"))


WS = r"[\s\p{Z}]+"


def _norm(c: str) -> str:
    return f"trim(regexp_replace(coalesce({c}, ''), '{WS}', ' ', 'g'))"


def _plain(c: str) -> str:
    return f"trim(regexp_replace(regexp_replace({c}, '<[^>]+>', ' ', 'g'), '{WS}', ' ', 'g'))"


# XML reads every end of line as \n
AUTHORS = "trim(regexp_replace(coalesce(authors, ''), '\\r\\n?', chr(10), 'g'))"
CRAWLED = "(crawled_at AT TIME ZONE 'UTC')"
AT = "TIMESTAMPTZ '2025-02-01 12:00:00+00'"
TEXT = "strftime({0}, '%Y-%m-%d')"
AHEAD = "CASE WHEN published_date > DATE '2026-03-08' THEN DATE '2026-03-01' ELSE published_date END"
PARTS = "CASE WHEN published_date IS NULL OR published_date > DATE '2026-03-08' THEN DATE '2026-03-01' ELSE published_date END"
SINCE = """SELECT key AS source, coalesce((SELECT date_trunc('day', max(crawled_at AT TIME ZONE 'UTC')) FROM items i WHERE i.source = s.key AND s.key <> 'harbor_ledger' AND crawled_at < TIMESTAMPTZ '2026-01-01 00:00:00+00'),
  TIMESTAMP '2026-01-30 00:00:00') AS cutoff FROM sources s"""
CRAWL = f"""SELECT i.source, CASE WHEN crawler_type = 'rss' AND crawl_status <> 'error' THEN 'feed' WHEN crawler_type IN ('rss', 'crossref') THEN 'registry' WHEN crawler_type = 'openalex' THEN 'catalogue'
   WHEN crawler_type = 'arxiv_atom' THEN 'preprint_feed' WHEN crawler_type = 'osf_preprint' THEN 'preprints' ELSE 'listing' END AS route, i.url AS item_url, i.id, {_norm('title')} AS title, published_date, {CRAWLED}::DATE AS crawled
  FROM items i JOIN sources s ON s.key = i.source WHERE s.is_enabled AND length(title) > 0 AND length(i.url) > 0"""
ROUTED = f"""SELECT source, route, CASE route WHEN 'feed' THEN item_url WHEN 'preprint_feed' THEN 'http://pre.example/abs/' || id WHEN 'preprints' THEN 'https://pre.example/' || id WHEN 'listing' THEN 'https://site.example/p/' || id ELSE 'https://doi.org/10.1000/' || id END AS url, title,
  CASE WHEN route IN ('feed', 'preprint_feed', 'preprints') THEN crawled WHEN route = 'registry' THEN {PARTS} WHEN route = 'catalogue' THEN {AHEAD} ELSE published_date END AS day FROM ({CRAWL})"""
ROUTED = f"SELECT source, route, url, title, day FROM ({ROUTED}) WHERE route IN ('registry', 'catalogue') OR day IS NULL OR day >= DATE '2025-02-01'"
IMAGES = "coalesce(json_extract_string(raw_metadata, '$.images[*]'), [])"
HTML = "coalesce(content, '') || array_to_string(list_transform(im, lambda u: '<img src=\"' || u || '\">'), '')"

SQL = {
    "atom_items": f"""WITH x AS (SELECT *, {IMAGES} AS im FROM items WHERE length(title) > 0 AND length(url) > 0), y AS (SELECT *, {HTML} AS html FROM x)
 SELECT source, url, {_norm('title')} AS title, {AUTHORS} AS authors, {TEXT.format(CRAWLED)} AS published_date, length({_plain("coalesce(nullif(trim(abstract), ''), html)")}) AS n_abstract,
  length({_plain("coalesce(nullif(trim(html), ''), abstract, '')")}) AS n_content, least(2, len(list_distinct(im)))::BIGINT AS n_images, coalesce(im[1], '') AS image FROM y""",
    "rdf_items": f"SELECT source, url, {_norm('title')} AS title, {_plain("coalesce(abstract, '')")} AS abstract, {AUTHORS} AS authors, {TEXT.format('published_date')} AS published_date FROM items WHERE length(title) > 0",
    "newest_posts": f"""WITH p AS (SELECT source, url, {CRAWLED}::DATE AS day FROM items WHERE length(title) > 0 UNION ALL SELECT source, url, published_date FROM items WHERE length(title) > 0)
 SELECT source, url, {TEXT.format('day')} AS published_date FROM p WHERE day IS NULL OR day >= DATE '2025-02-01' ORDER BY day DESC NULLS LAST, url""",
    "preprint_feed_items": f"""SELECT source, 'http://pre.example/abs/' || id AS url, {_norm('title')} AS title, {_norm('abstract')} AS abstract, {AUTHORS} AS authors, {TEXT.format(CRAWLED)} AS published_date, id::VARCHAR AS source_id, source AS subjects
 FROM items WHERE length(title) > 0 AND {CRAWLED}::DATE > DATE '2025-02-01'""",
    "paper_feed_items": f"SELECT source, 'https://papers.example/papers/w' || id AS url, {_norm('title')} AS title, {_norm('authors')} AS authors, {_plain("coalesce(abstract, '')")} AS abstract, 'w' || id AS source_id, '2026-03-01' AS published_date FROM items WHERE length(title) > 0",
    "page_dates": f"SELECT id, {TEXT.format("CASE WHEN length(abstract) > 0 THEN published_date ELSE date_trunc('month', published_date) END")} AS day FROM items",
    "catalogue_items": f"SELECT source, 'W' || id AS source_id, 'https://doi.org/10.1000/' || id AS url, title, coalesce(abstract, '') AS abstract, CASE WHEN length(trim(authors)) > 0 THEN authors ELSE '' END AS authors, {TEXT.format(AHEAD)} AS published_date FROM items WHERE length(title) > 0",
    "preprint_items": f"""SELECT source, 'p' || id AS source_id, 'https://pre.example/' || id AS url, {_norm('title')} AS title, trim(regexp_replace(coalesce(abstract, ''), '<[^>]+>', '', 'g')) AS abstract, CASE WHEN length(trim(authors)) > 0 THEN authors ELSE '' END AS authors,
 {TEXT.format(CRAWLED)} AS published_date, source AS subjects FROM items WHERE length(title) > 0 AND crawled_at >= {AT}""",
    "backfilled_items": """WITH w AS (SELECT url, max(a) AS a FROM (SELECT items.url, trim(regexp_replace(text, '<[^>]+>', '', 'g')) AS a FROM documents JOIN items ON id = doc_id WHERE length(items.title) > 0) WHERE length(a) > 0 GROUP BY url),
 f AS (SELECT id, CASE WHEN length(trim(coalesce(abstract, ''))) = 0 THEN coalesce(w.a, abstract) ELSE abstract END AS a FROM items LEFT JOIN w USING (url)) SELECT id, length(a) AS n_chars, md5(a) AS digest FROM f""",
    "source_cutoffs": f"SELECT source, strftime(cutoff, '%Y-%m-%d %H:%M:%S') AS cutoff FROM ({SINCE})",
    "source_requests": f"""WITH c AS ({SINCE}), s AS (SELECT s.* REPLACE (CASE WHEN crawl_status = 'error' THEN '1234-5678' ELSE issn END AS issn), cutoff FROM sources s JOIN c ON c.source = s.key WHERE is_enabled)
 SELECT key AS source, 1 AS layer, 'feed' AS route, feed_url AS request FROM s WHERE crawler_type = 'rss' AND length(trim(feed_url)) > 0
 UNION ALL SELECT key, 2, 'registry', '{crawl.REGISTRY}?filter=issn:' || issn || ',from-created-date:' || strftime(cutoff, '%Y-%m-%d') || '&rows=200&sort=published&order=desc&mailto=mail@reader.example' FROM s WHERE crawler_type IN ('crossref', 'rss') AND length(trim(issn)) > 0
 UNION ALL SELECT key, 3, 'catalogue', '{crawl.CATALOGUE}?filter=primary_location.source.id:' || openalex_source_id || ',from_publication_date:' || strftime(cutoff, '%Y-%m-%d') || '&per_page=200&sort=publication_date:desc&mailto=mail@reader.example' FROM s WHERE crawler_type = 'openalex' AND length(trim(openalex_source_id)) > 0
 UNION ALL SELECT key, 1, 'preprint_feed', '{crawl.PREPRINT_FEED}?search_query=cat:' || c || '&sortBy=submittedDate&sortOrder=descending&start=0&max_results=50' FROM s, (VALUES ('cs.A'), ('cs.B')) v(c) WHERE crawler_type = 'arxiv_atom'
 UNION ALL SELECT key, 1, 'preprints', '{crawl.PREPRINTS}?filter[provider]=' || CASE WHEN key = 'preprint_arcade' THEN 'arcade' ELSE 'socarxiv' END || '&filter[date_created][gte]=' || strftime(cutoff, '%Y-%m-%dT%H:%M:%S') || '&sort=-date_created&page[size]=50' || CASE WHEN key = 'preprint_arcade' THEN '&filter[subjects]=Law,Art' ELSE '' END FROM s WHERE crawler_type = 'osf_preprint'
 UNION ALL SELECT key, 1, 'listing', url FROM s WHERE crawler_type = 'html_scraper' AND length(trim(url)) > 0""",
    "crawled_items": f"SELECT source, route, url, title, {TEXT.format('day')} AS published_date FROM ({ROUTED})",
    "crawl_outcomes": f"""WITH n AS (SELECT source, count(*) AS n FROM ({ROUTED}) WHERE route <> 'listing' GROUP BY source), s AS (SELECT key AS source, coalesce(n, 0) AS n_items,
  CASE WHEN crawler_type = 'html_scraper' THEN 'nothing to ask of crawler_type scraper' WHEN (crawler_type = 'crossref' AND issn IS NULL) OR (crawler_type = 'openalex' AND openalex_source_id IS NULL) OR (crawler_type = 'rss' AND feed_url IS NULL AND s.url IS NULL AND issn IS NULL) THEN 'nothing to ask of crawler_type ' || crawler_type END AS error
  FROM sources s LEFT JOIN n ON n.source = s.key WHERE is_enabled) SELECT source, n_items, error, CASE WHEN error IS NOT NULL THEN 'error' WHEN n_items = 0 THEN 'empty' ELSE 'ok' END AS status FROM s""",
}
