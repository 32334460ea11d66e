"""The registered queries of the core. Each takes the session and the folder of the tables, and runs over whole tables."""

from __future__ import annotations

import datetime as dt
import functools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from heddle.functions import dates
from heddle.functions import text as T
from heddle.functions.tables import materialize, scratch, table
from heddle.operators import classify, dedup, feed, packed, scoring, summaries, upsert
from heddle.operators.feed import FeedFilter
from heddle.operators.taxonomy import Taxonomy
from heddle.plans import readers
from heddle.plans.oracles import oracle_sql
from heddle.sources import definitions, feeds, listings, works
from heddle.sources.store import Store
from heddle.streaming import streams

NOW = dt.datetime(2026, 3, 1, tzinfo=dt.timezone.utc)
DAY = dt.date(2026, 3, 1)
FEED = FeedFilter(subtopics=("built_world", "power_systems", "fair_rules"), topics=("homes_supply", "wires_and_storage", "pay_and_prices", "general_fair_rules"), min_confidence="medium", start=dt.date(2025, 1, 1), end=dt.date(2026, 12, 31))
NETWORK = {"author": {"edward lumnisige": "an author", "fatima gralmelleri": "an author"}, "organization": {"sarbomeni council": "a council", "wto": "a body"}, "publication": {"lantern review": "a review"}}
TAGS = {"docket_notes": [("built_world", "general_built_world")], "merge_window": [("machine_conduct", "general_machine_conduct")], "tidewater_policy": [("fair_rules", "general_fair_rules")]}


def _now():
    return F.lit(NOW)


def _taxonomy(spark: SparkSession, d: str) -> Taxonomy:
    rows = table(spark, d, "taxonomy")
    secondary = frozenset(r[0] for r in rows.where("topic like 'general%'").select("topic").distinct().collect())
    return Taxonomy.read(rows, network=NETWORK, source_tags=TAGS, secondary=secondary)


def _t(spark: SparkSession, d: str, *names: str) -> list[DataFrame]:
    return [table(spark, d, n) for n in names]


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return packed.unpacked(table(spark, d, "items"), "id", "authors").where("n_values > 1").select("item_id", "pos", F.col("value").alias("author"))


def p2_dialects(spark: SparkSession, d: str) -> DataFrame:
    """How many fields and values each dialect parsed."""
    first = packed.unpacked(table(spark, d, "items"), "id", "authors").where("pos = 1")
    return first.groupBy("dialect").agg(F.count("*").alias("n_fields"), F.sum("n_values").alias("n_values"))


# the feed


def _slim(df: DataFrame) -> DataFrame:
    return df.select("id", "url", "title", "source", "published_date")


def feed_items(spark, d):
    items, c, t = _t(spark, d, "items", "classifications", "item_topics")
    return _slim(feed.feed(items, c, t, None, FEED))


def feed_any_topic(spark, d):
    items, c, t = _t(spark, d, "items", "classifications", "item_topics")
    return _slim(feed.feed(items, c, t, None, FeedFilter(subtopics=("health_security",))))


def feed_min_confidence(spark, d):
    items, c, t = _t(spark, d, "items", "classifications", "item_topics")
    return _slim(feed.feed(items, c, t, None, FeedFilter(subtopics=("machine_conduct", "fair_rules"), min_confidence="high")))


def feed_topic_uncorrelated(spark, d):
    items, c, t = _t(spark, d, "items", "classifications", "item_topics")
    return _slim(feed.feed(items, c, t, None, FeedFilter(subtopics=("health_security", "fair_rules"), topics=("early_years", "courts_and_claims"))))


def _connections(spark, d):
    return scoring.network_matches(table(spark, d, "items"), _taxonomy(spark, d))


def feed_connected_only(spark, d):
    items, c, t = _t(spark, d, "items", "classifications", "item_topics")
    return _slim(feed.feed(items, c, t, _connections(spark, d), FeedFilter(connected_only=True, start=dt.date(2025, 3, 1))))


def feed_nested(spark, d):
    items, c, t = _t(spark, d, "items", "classifications", "item_topics")
    chosen = materialize(feed.feed(items, c, t, None, FEED))
    full = feed.with_attachments(chosen, c, t, scoring.network_matches(chosen, _taxonomy(spark, d)))
    verdict = lambda e: F.concat_ws(":", e["key"], e["value"]["relevant"].cast("string"), e["value"]["confidence"], F.array_join(e["value"]["topics"], "+"))
    return full.select("id", "abstract", F.array_join(F.transform(F.array_sort(F.map_entries("classifications")), verdict), ";").alias("verdicts"), F.col("connection.connection_name").alias("connection_name"))


def unclassified_queue(spark, d):
    items, c = _t(spark, d, "items", "classifications")
    return feed.unclassified(items, c, NOW, 365).select("id", "day")


def unclassified_topn(spark, d):
    items, c = _t(spark, d, "items", "classifications")
    return feed.unclassified(items, c, NOW, 730, 50).select("id", "day")


# duplicates and known rows


def content_hash(spark, d):
    return dedup.with_hash(table(spark, d, "items")).select("id", "content_hash")


def dedup_best_wins(spark, d):
    return dedup.best_of_copies(table(spark, d, "items"), ["crawled_at"]).select("id", "content_hash")


def dedup_best_per_source(spark, d):
    """The best copy within each source only."""
    return dedup.best_by_source(table(spark, d, "items"), ["crawled_at"])


def dedup_first_wins(spark, d):
    return dedup.first_by(table(spark, d, "items"), "url", ["crawled_at"]).select("id", "url")


def known_url_antijoin(spark, d):
    items = table(spark, d, "items")
    cut = F.lit(NOW) - F.expr("interval 60 days")
    return dedup.unknown(items.where(F.col("crawled_at") >= cut), items.where((F.col("crawled_at") < cut) & (F.col("crawled_at") >= cut - F.expr("interval 400 days")))).select("id", "url")


def item_batches(spark, d):
    return dedup.numbered_batches(table(spark, d, "items").select("id", "source"), 5, "source", "id")


# scores


def keyword_scores(spark, d):
    return scoring.keyword_scores(table(spark, d, "items"), _taxonomy(spark, d)).where("score > 0").select("item_id", "subtopic", "topic", F.round("score", 6).alias("score"))


def subtopic_scores(spark, d):
    return scoring.subtopic_scores(scoring.keyword_scores(table(spark, d, "items"), _taxonomy(spark, d))).select("item_id", "subtopic", F.round("score", 6).alias("score"))


def keyword_candidates(spark, d):
    s = scoring.keyword_scores(table(spark, d, "items"), _taxonomy(spark, d))
    return scoring.keyword_candidates(s, 0.1).select("item_id", "subtopic", F.array_join("topics", ",").alias("topics"))


def prefilter_split(spark, d):
    return scoring.potentially_relevant(table(spark, d, "items"), _taxonomy(spark, d)).select("id", "passes")


def network_match(spark, d):
    return _connections(spark, d)


def audit_keyword_hits(spark, d):
    return scoring.audit_hits(table(spark, d, "items"), _taxonomy(spark, d)).select("item_id", "subtopic", "topic")


# classification


def _verdicts(spark, d):
    c, t = _t(spark, d, "classifications", "item_topics")
    topics = t.groupBy("item_id", "subtopic").agg(F.sort_array(F.collect_set("topic_key")).alias("topics"))
    return feed.latest_verdicts(c).join(topics, ["item_id", "subtopic"], "left").withColumn("topics", F.coalesce("topics", F.array().cast("array<string>")))


def autotag(spark, d):
    v = classify.auto_tagged(_verdicts(spark, d), table(spark, d, "items"), _taxonomy(spark, d))
    return v.select("item_id", "subtopic", F.array_join("topics", ",").alias("topics"))


def relevance_counts(spark, d):
    return classify.relevance_counts(_verdicts(spark, d))


def populated_topics(spark, d):
    return classify.populated(_verdicts(spark, d))


def filter_relevant(spark, d):
    return classify.relevant_in(_verdicts(spark, d), "fair_rules").select("item_id", "confidence")


def category_audit(spark, d):
    """The audit over the verdicts of sources that name no general topic: those count as unfilled."""
    v = _verdicts(spark, d).withColumn("topics", F.filter("topics", lambda t: t.startswith("general")))
    return classify.category_audit(scoring.audit_hits(table(spark, d, "items"), _taxonomy(spark, d)), v, _taxonomy(spark, d))


def classified(spark, d):
    """Verdicts on the whole queue: rejected by the prefilter, or by a classifier in batches, with every subtopic filled."""
    items, c = _t(spark, d, "items", "classifications")
    tax = _taxonomy(spark, d)
    queue = feed.unclassified(items, c, NOW, 3650).drop("day")
    v = classify.classify(queue, tax, classify.keyword_classifier(tax), threshold=scoring.THRESHOLD)
    return v.select("item_id", "subtopic", "relevant", "confidence", F.array_join(F.array_sort("topics"), ",").alias("topics"))


def item_types(spark, d):
    items, s = _t(spark, d, "items", "sources")
    return items.join(s.select("key", "source_type"), items["source"] == s["key"], "left").groupBy(classify.item_type(F.col("source_type")).alias("item_type")).agg(F.count("*").alias("n"))


# functions


def topic_key_norm(spark, d):
    return table(spark, d, "taxonomy").select("topic", T.topic_key(F.col("name")).alias("topic_key"))


def strip_html(spark, d):
    return table(spark, d, "documents").select("doc_id", T.strip_html(F.col("text")).alias("text"))


def url_hosts(spark, d):
    return table(spark, d, "items").groupBy(T.host(F.col("url")).alias("host")).agg(F.count("*").alias("n"))


def rss_dates(spark, d):
    """Dates written as feeds write them and read again."""
    typed = F.date_format("crawled_at", "EEE, dd MMM yyyy HH:mm:ss 'GMT'")
    return table(spark, d, "items").select("id", dates.rss_date(typed).alias("day"))


def flexible_dates(spark, d):
    """Dates typed in four ways, by id, and read again; the 31st of February among them."""
    i = F.col("id") % 5
    p = F.col("published_date")
    typed = F.when(i == 0, p.cast("string")).when(i == 1, F.date_format(p, "MMM d, yyyy")).when(i == 2, F.date_format(p, "d MMMM yyyy")).when(i == 3, F.date_format(p, "MMMM d yyyy")).otherwise(F.lit("Feb 31, 2025"))
    return table(spark, d, "items").select("id", dates.flexible_date(typed, 2026).alias("day"))


def last_boundary(spark, d):
    return table(spark, d, "items").select("id", dates.last_boundary(F.col("crawled_at")).alias("last_at"))


def future_dates(spark, d):
    return table(spark, d, "items").select("id", dates.without_future(F.col("published_date"), F.col("crawled_at")).alias("day"))


def storage_rows(spark, d):
    rows = upsert.storage_rows(table(spark, d, "items"))
    meta = F.from_json("raw_metadata", "images array<string>, keyword_scores string")
    return rows.select("id", "abstract", "authors", "source_id", "source_name", F.coalesce(F.size(meta["images"]), F.lit(0)).alias("n_images"), meta["keyword_scores"].isNotNull().alias("has_scores"))


def needs_abstract(spark, d):
    return table(spark, d, "items").select("id", T.needs_abstract(F.col("abstract")).alias("needs"), T.thin(F.col("content")).alias("thin"))


def extractive_abstract(spark, d):
    return table(spark, d, "items").select("id", T.extractive_abstract(F.col("content")).alias("bullets"))


def summary_candidates(spark, d):
    return summaries.candidates(table(spark, d, "items")).select("id")


def refused_candidates(spark, d):
    return summaries.refused(table(spark, d, "items")).select("id", "api_refusal_type")


def summarized(spark, d):
    """A round of abstracts by a writer that declines long contents: what each item is left with."""
    items = table(spark, d, "items")

    def writer(title: str, content: str, source: str) -> str:
        return "I cannot summarise this." if len(content) > 2000 else f"{title}, as told by {source} in {len(content)} characters."

    replies = summaries.written(summaries.candidates(items), writer)
    return summaries.summarized(items, replies, NOW).groupBy("outcome").agg(F.count("*").alias("n"), F.count_if(F.col("api_refused_at").isNotNull()).alias("n_refused"))


# snapshots


def _older_newer(spark, d):
    items = table(spark, d, "items")
    return items.where(F.col("crawled_at") < NOW), items.where(F.col("crawled_at") >= NOW)


def item_upsert(spark, d):
    """Crawls up to a day, one row per address, under later ones: texts overwritten, dates and refusals filled, metadata kept where the new is empty."""
    old, new = _older_newer(spark, d)
    old = dedup.first_by(old, "url", ["crawled_at"])
    rules = {"id": upsert.keep, "published_date": upsert.fill, "api_refused_at": upsert.fill, "api_refusal_type": upsert.fill, "raw_metadata": upsert.if_not_empty}
    return upsert.upsert(old, dedup.first_by(new, "url", ["crawled_at"]), ["url"], rules).select("url", "id", "title", "abstract", "published_date", "crawled_at", "raw_metadata")


def store_upsert(spark, d):
    """The same through stored tables kept in buckets of addresses: the first crawls committed whole, of the later ones only the buckets they touch."""
    old, new = (dedup.first_by(x, "url", ["crawled_at"]) for x in _older_newer(spark, d))
    store = Store(spark, scratch(spark, "store"), buckets=32)
    store.write("items", old)
    new = materialize(new)
    touched = sorted(r[0] for r in new.select(store.bucket("items", F.col("url"))).distinct().collect())
    rules = {"id": upsert.keep, "published_date": upsert.fill, "api_refused_at": upsert.fill, "api_refusal_type": upsert.fill, "raw_metadata": upsert.if_not_empty}
    store.commit({"items": upsert.upsert(store.read("items", touched), new, ["url"], rules)}, {"items": touched})
    return store.read("items").select("url", "id", "title", "abstract", "published_date", "crawled_at", "raw_metadata")


def classification_upsert(spark, d):
    c = table(spark, d, "classifications")
    cut = dt.datetime(2025, 9, 1, tzinfo=dt.timezone.utc)
    cols = ["item_id", "subtopic", "relevant", "confidence", "classified_at"]
    old, new = (feed.latest_verdicts(x).select(*cols) for x in (c.where(F.col("classified_at") < cut), c.where(F.col("classified_at") >= cut)))
    return upsert.upsert(old, new, ["item_id", "subtopic"])


def topics_replace(spark, d):
    """Topics replaced for the verdicts given after a day by those verdicts' keyword candidates."""
    c, t, items = _t(spark, d, "classifications", "item_topics", "items")
    touched = c.where(F.col("classified_at") >= dt.datetime(2025, 9, 1, tzinfo=dt.timezone.utc)).select("item_id", "subtopic")
    cand = scoring.keyword_scores(items, _taxonomy(spark, d)).where("score >= 0.2").select("item_id", "subtopic", F.col("topic").alias("topic_key"))
    new = cand.join(touched.distinct(), ["item_id", "subtopic"], "left_semi")
    return upsert.replace_groups(t.select("item_id", "subtopic", "topic_key").distinct(), new, touched, ["item_id", "subtopic"])


def connection_replace(spark, d):
    """Connections found in older items, replaced for the items that were judged since."""
    c = table(spark, d, "classifications")
    found = _connections(spark, d).select("item_id", "connection_name", "connection_description")
    touched = c.where(F.col("classified_at") >= dt.datetime(2025, 9, 1, tzinfo=dt.timezone.utc)).select("item_id")
    relevant = c.where("relevant").select("item_id")
    return upsert.replace_groups(found, found.join(touched, "item_id", "left_semi").join(relevant, "item_id", "left_semi"), touched, ["item_id"])


def source_upsert(spark, d):
    s = table(spark, d, "sources")
    new = s.where("id % 2 = 0").select("key", F.upper("name").alias("name"), "url", F.lit(False).alias("is_enabled"))
    return upsert.upsert(s.select("key", "name", "url", "is_enabled", "crawl_status"), new, ["key"], {"is_enabled": upsert.keep})


def cascade_topics(spark, d):
    items, t = _t(spark, d, "items", "item_topics")
    return upsert.cascade(t, items.where(F.col("published_date") >= dt.date(2025, 6, 1)), "item_id").select("id", "item_id").distinct()


def item_set_hash(spark, d):
    c = table(spark, d, "classifications").where("relevant").select("subtopic", "item_id").distinct()
    return feed.item_set_hash(c, ["subtopic"], "item_id")


def summary_cache_status(spark, d):
    """Which topics' summaries are still good: the sets of a week's items by topic, against those cached before late verdicts came."""
    c, t = _t(spark, d, "classifications", "item_topics")
    early = c.where(F.col("classified_at") < dt.datetime(2025, 12, 1, tzinfo=dt.timezone.utc)).select("item_id", "subtopic")
    topics = t.select("item_id", "subtopic", "topic_key").distinct()
    now_ = feed.item_set_hash(topics, ["topic_key"], "item_id")
    was = feed.item_set_hash(topics.join(early, ["item_id", "subtopic"], "left_semi"), ["topic_key"], "item_id")
    return feed.cache_status(now_, was, ["topic_key"]).select("topic_key", "status", "n_items")


def topic_prompts(spark, d):
    items, t = _t(spark, d, "items", "item_topics")
    return summaries.topic_prompts(items, t).select("topic_key", "item_hash", "n_items", F.length("prompt").cast("bigint").alias("n_chars"))


def _weekly(items, t):
    return summaries.topic_prompts(items, t, week=dates.week_ending(F.col("published_date")), link=T.deep_link("https://reader.example/", F.lit("daily"), F.col("id")))


def topic_week_prompts(spark, d):
    """A prompt a topic and week, with a link to each item."""
    items, t = _t(spark, d, "items", "item_topics")
    return _weekly(items, t).select("topic_key", "week_ending", "item_hash", "n_items", F.length("prompt").cast("bigint").alias("n_chars"))


def topic_summary_upsert(spark, d):
    """Summaries of items crawled before a day, stored by feed, topic and week, and those of all items laid over them where the set of items is another."""
    items, t = _t(spark, d, "items", "item_topics")
    told = lambda p: p.withColumn("summary", F.concat("topic_key", F.lit(": "), F.col("n_items").cast("string")))
    early = told(_weekly(items.where(F.col("crawled_at") < dt.datetime(2025, 6, 1, tzinfo=dt.timezone.utc)), t)).withColumn("status", F.lit("miss"))
    none = spark.createDataFrame([], "id bigint, feed_id bigint, topic_key string, week_ending date, summary string, item_hash string, created_at timestamp")
    cache = materialize(summaries.stored(none, early, 7, dt.datetime(2025, 6, 1, tzinfo=dt.timezone.utc)))
    now_ = feed.cache_status(told(_weekly(items, t)), cache, ["topic_key", "week_ending"])
    return summaries.stored(cache, now_, 7, NOW).select("feed_id", "topic_key", "week_ending", "summary", "item_hash", "created_at")


def topic_summaries(spark, d):
    """Summaries of all topics, by a writer that tells their length, beside a cache made before late topics came."""
    items, t = _t(spark, d, "items", "item_topics")
    now_ = summaries.topic_prompts(items, t)
    old = summaries.topic_prompts(items, t.where(~F.col("topic_key").startswith("general") | (F.col("item_id") < 1000))).select("topic_key", "item_hash", F.lit("kept").alias("summary"))
    return summaries.topic_summaries(now_, old, {}, lambda name, prompt, _: f"{name}: {len(prompt)} characters")


def weekly_snapshots(spark, d):
    w = feed.weekly_snapshots(table(spark, d, "items"), dates.week_ending(F.col("published_date")))
    return w.select("source", "week_ending", F.array_join(F.transform("item_ids", lambda x: x.cast("string")), ",").alias("item_ids"), "n_items")


# sources and events


def source_failures(spark, d):
    return upsert.failures_in_a_row(table(spark, d, "events"), "user_id", F.col("event_type") == "error", ["ts", "event_id"])


def crawl_counters(spark, d):
    e = table(spark, d, "events")
    status = upsert.crawl_status(F.when(F.col("event_type") == "error", "failed"), F.get_json_object("props", "$.k").cast("int") % 10)
    return e.groupBy("user_id", status.alias("status")).agg(F.count("*").alias("n"))


def usage_rollup(spark, d):
    e = table(spark, d, "events").select(F.col("event_type").alias("service"), F.get_json_object("props", "$.k").cast("bigint").alias("tokens"), "value")
    return upsert.usage(e, "service", "tokens", "value")


def source_validation(spark, d):
    """Rules broken by the definitions, with every third kind of crawler misspelled and every fifth name lost."""
    s = table(spark, d, "sources").select("id", F.when(F.col("id") % 7 == 0, "quiet_grid").otherwise(F.col("key")).alias("key"), F.when(F.col("id") % 5 != 0, F.col("name")).alias("name"), "source_type", F.when(F.col("id") % 3 == 0, F.concat("crawler_type", F.lit("s"))).otherwise(F.col("crawler_type")).alias("crawler_type"))
    return definitions.problems(s)


def enabled_sources(spark, d):
    return definitions.enabled(table(spark, d, "sources"), subtopic="fair_rules").select("key", "name", "crawler_type")


def failing_sources(spark, d):
    return definitions.failing(table(spark, d, "sources")).select("key", F.col("consecutive_failures").cast("bigint").alias("consecutive_failures"))


def sources_by_crawler(spark, d):
    items, s = _t(spark, d, "items", "sources")
    return definitions.by_crawler(s, items)


def source_crawls(spark, d):
    """The sources after crawls, one a source and day crawled, which failed where an item was refused on it."""
    items, s = _t(spark, d, "items", "sources")
    crawls = items.groupBy("source", F.to_date("crawled_at").alias("day")).agg(F.max("crawled_at").alias("at"), F.count("*").alias("n_items"), F.max(F.when(F.col("api_refused_at").isNotNull(), "refused")).alias("error"))
    return upsert.crawls_written(s, crawls).select("key", "crawl_status", "crawl_error", F.col("consecutive_failures").cast("bigint").alias("consecutive_failures"), "last_crawled_at")


# documents derived from the items, read again


def _xml(c: str) -> F.Column:
    return readers.escaped(F.col(c))


def rss_items(spark, d):
    """Every item written as an RSS document of its own, and read."""
    items = table(spark, d, "items")
    doc = F.concat(F.lit("<rss version='2.0' xmlns:dc='http://purl.org/dc/elements/1.1/'><channel><item><title>"), _xml("title"), F.lit("</title><link>"), _xml("url"), F.lit("</link><dc:creator>"), _xml("authors"), F.lit("</dc:creator><pubDate>"), F.date_format("crawled_at", "EEE, dd MMM yyyy HH:mm:ss 'GMT'"), F.lit("</pubDate><description>"), _xml("abstract"), F.lit("</description></item></channel></rss>"))
    got = feeds.feed_items(items.select(F.col("id").cast("string").alias("feed_url"), "source", doc.alias("document")), F.lit(dt.datetime(2025, 2, 1, 12, tzinfo=dt.timezone.utc)))
    return got.groupBy("source", "published_date").agg(F.count("*").alias("n"), F.sum(F.length("abstract")).cast("bigint").alias("n_chars"))


def registry_items(spark, d):
    """Items written as replies of a DOI registry, fifty of a source to a reply, and read."""
    items = table(spark, d, "items")
    day = F.col("published_date")
    work = F.struct(F.array("title").alias("title"), F.concat(F.lit("10.1000/"), F.col("id")).alias("DOI"), F.concat(F.lit("<jats:p>"), F.coalesce("abstract", F.lit("")), F.lit("</jats:p>")).alias("abstract"), F.array(F.struct(F.lit("Ann").alias("given"), F.col("source").alias("family"))).alias("author"), F.struct(F.array(F.array(F.year(day), F.month(day), F.dayofmonth(day))).alias("date-parts")).alias("published"))
    replies = items.groupBy("source", F.floor(F.col("id") / readers.PAGE).alias("page")).agg(F.to_json(F.struct(F.struct(F.collect_list(work).alias("items")).alias("message"))).alias("reply"))
    return works.registry_works(replies, F.lit(DAY)).select("source_id", "url", "title", "authors", "published_date")


def page_texts(spark, d):
    """Every document as an article page, its text taken out again."""
    docs = table(spark, d, "documents").where("length(text) > 0")
    para = F.replace(_xml("text"), F.lit("\n"), F.lit("</p><p>"))
    html = F.concat(F.lit("<html><header>top</header><nav>menu</nav><article><script>var t='</p>';</script><p>"), para, F.lit("</p></article><footer>end</footer></html>"))
    got = listings.page_texts(docs.select(F.concat(F.lit("https://pages.example/"), F.col("doc_id")).alias("url"), html.alias("html")))
    return got.select(F.substring_index("url", "/", -1).cast("bigint").alias("doc_id"), F.length("text").cast("bigint").alias("n_chars"), F.md5(F.regexp_replace("text", r"(?U)\s+", "")).alias("digest"))


def enriched_items(spark, d):
    """Thin items that get the text of the document of the same number where it is longer."""
    items, docs = _t(spark, d, "items", "documents")
    pages = items.select("id", "url").join(docs.select(F.col("doc_id").alias("id"), "text"), "id").select("url", "text")
    return summaries.enriched(items, pages).select("id", "enriched", F.length("content").cast("bigint").alias("n_chars"))


def listing_items(spark, d):
    """Listing pages of a source, fifty items to a page, that name each article twice, scraped by selectors and deduplicated by address."""
    items = table(spark, d, "items").where("published_date is not null")
    entry = F.concat(F.lit("<li class='post card'><a class='to' href='/p/"), F.col("id").cast("string"), F.lit("'>"), _xml("title"), F.lit("</a><time datetime='"), F.col("published_date").cast("string"), F.lit("'>x</time></li>"))
    pages = items.groupBy("source", F.floor(F.col("id") / readers.PAGE).alias("page")).agg(F.concat(F.lit("<ul>"), F.repeat(F.array_join(F.sort_array(F.collect_list(entry)), ""), F.lit(2)), F.lit("</ul>")).alias("html"))
    conf = F.lit('{"listing_url": "https://site.example/all", "article_selector": "ul li.post", "title_selector": "a.to", "url_selector": "a[href*=\'/p/\']", "date_selector": "time"}')
    return listings.listing_items(pages.select("source", conf.alias("crawl_config"), "html"), 2026, F.lit(dt.datetime(2025, 2, 1, tzinfo=dt.timezone.utc))).groupBy("source").agg(F.count("*").alias("n"), F.min("published_date").alias("first_day"))


# streams over the events


def _streamed(spark, d, made, mode, key):
    """What a stream over the events leaves in ``out``, which came as four parts, a run of the stream over the files of each, from one checkpoint."""
    e = table(spark, d, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    folder = scratch(spark, "events")
    come, out = f"{folder}/in", f"{folder}/out"
    low, high = e.agg(F.min("ts"), F.max("ts")).first()
    for i in range(4):
        part = e if low is None else e.where(F.floor((F.col("ts").cast("double") - low.timestamp()) / max(1e-6, high.timestamp() - low.timestamp() + 1e-3) * 4) == i)
        part.write.mode("append").parquet(come)
        streams.run_available(made(spark.readStream.schema(e.schema).parquet(come)), lambda b, n: b.write.mode("overwrite").parquet(f"{out}/b={n}"), f"{folder}/check", mode)
    return spark.read.schema(f"{key}, b bigint").parquet(out)


def stream_first_seen(spark, d):
    """The first event of each user and type as a stream sees them, in four parts one after the other."""
    keyed = lambda s: s.withColumn("key", F.concat_ws("/", F.col("user_id").cast("string"), "event_type"))
    got = _streamed(spark, d, lambda s: streams.first_seen(keyed(s), "key", "ts", 30).select("key"), "append", "key string")
    return got.groupBy("key").agg(F.count("*").alias("n"))


def stream_failures(spark, d):
    """Failures in a row by user, as a stream leaves them after its last batch."""
    got = _streamed(spark, d, lambda s: streams.failure_runs(s, "user_id", F.col("event_type") == "error", "ts", "event_id"), "update", "source string, consecutive_failures bigint")
    return got.groupBy(F.col("source").cast("bigint").alias("source")).agg(F.max_by("consecutive_failures", "b").alias("consecutive_failures"))


def _as_text(query):
    """A query with its dates and times as text, as the SQL gives them."""

    @functools.wraps(query)
    def run(spark: SparkSession, d: str) -> DataFrame:
        df = query(spark, d)
        form = {"date": "yyyy-MM-dd", "timestamp": "yyyy-MM-dd HH:mm:ss"}
        return df.select(*[F.date_format(c, form[kind]).alias(c) if kind in form else c for c, kind in df.dtypes])

    return run


def queries() -> dict:
    own = {k: v for k, v in globals().items() if callable(v) and getattr(v, "__module__", "") == __name__ and k[0] != "_" and k != "queries"}
    return {k: _as_text(v) for k, v in (own | {k: getattr(readers, k) for k in readers.SQL}).items()}


__all__ = ["oracle_sql", "queries"]
