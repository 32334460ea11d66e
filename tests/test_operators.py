import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from heddle.functions import text
from heddle.operators import classify, dedup, feed, scoring, summaries, upsert
from heddle.operators.feed import FeedFilter
from heddle.operators.taxonomy import Taxonomy, Topic
from heddle.plans import queries

TAX = Taxonomy(
    (
        Topic("abundance", "housing", 0, "Housing", "", 1.0, ("zoning reform", "housing supply", "affordable housing", "starter homes", "rent")),
        Topic("abundance", "energy", 1, "Energy", "", 2.0, ("nuclear energy", "permitting reform")),
        Topic("abundance", "general", 2, "General", "", 1.0, ("abundance agenda",)),
        Topic("ai", "alignment", 3, "Alignment", "", 1.0, ("alignment", "reward model")),
        Topic("ai", "bare", 4),
    ),
    network={"author": {"jane quimby": "writes"}, "organization": {"ifw": "an institute"}, "publication": {"the widget review": "a review"}},
    source_tags={"movement": [("abundance", "general")]},
    secondary=frozenset({"general"}),
)
ITEM = "id bigint, url string, title string, abstract string, content string, authors string, source string, source_name string, published_date date, crawled_at timestamp, api_refused_at timestamp, api_refusal_type string"


def items(spark, *rows):
    base = {"url": None, "title": None, "abstract": None, "content": None, "authors": None, "source": "s", "source_name": None, "published_date": None, "crawled_at": None, "api_refused_at": None, "api_refusal_type": None}
    names = [c.split()[0] for c in ITEM.split(", ")]
    return spark.createDataFrame([tuple({"id": i, **base, **r}[n] for n in names) for i, r in enumerate(rows)], ITEM)


def test_taxonomy_problems_and_prompt():
    with pytest.raises(ValueError, match="2 problem"):
        Taxonomy((Topic("a", "x", 0), Topic("a", "x", 1)), network={"place": {}})
    assert TAX.prompt(["ai", "abundance"]) == TAX.prompt(["abundance", "ai", "ai"])
    assert TAX.subtopics == ["abundance", "ai"]


def test_scores(spark):
    t = items(spark, {"title": "Zoning Reform and housing supply"}, {"title": "nothing"}, {"content": "nuclear energy; permitting reform; ALIGNMENT"}, {}, {"source_name": "", "source": "alignment"})
    s = scoring.keyword_scores(t, TAX)
    got = {(r.item_id, r.topic): round(r.score, 6) for r in s.collect()}
    assert got[(0, "housing")] == 0.4 and got[(1, "housing")] == 0.0 and got[(2, "energy")] == 1.0 and got[(2, "bare")] == 0.0 and got[(4, "alignment")] == 0.5
    assert {(r.item_id, r.subtopic): r.score for r in scoring.subtopic_scores(s).collect()}[(2, "abundance")] == 1.0
    assert {(r.item_id, r.subtopic): r.topics for r in scoring.keyword_candidates(s).collect()} == {(0, "abundance"): ["housing"], (2, "abundance"): ["energy"], (2, "ai"): ["alignment"], (4, "ai"): ["alignment"]}
    assert [r.passes for r in scoring.potentially_relevant(t, TAX).orderBy("id").collect()] == [True, False, True, False, True]
    assert scoring.keyword_scores(t.limit(0), TAX).count() == 0


def test_network(spark):
    t = items(spark, {"title": "x", "authors": "Jane Quimby"}, {"content": "the IFW says"}, {"content": "gifws"}, {"content": "The Widget Review, by Jane Quimby"}, {})
    got = {r.item_id: (r.connection_type, r.connection_name) for r in scoring.network_matches(t, TAX).collect()}
    assert got == {0: ("author", "Jane Quimby"), 1: ("organization", "Ifw"), 3: ("author", "Jane Quimby")}


def test_dedup(spark):
    t = items(spark, {"title": "A  Tale", "abstract": "x"}, {"title": "a tale!", "abstract": "longer"}, {"title": "A tale", "abstract": "equals"}, {"title": ""}, {"title": None}, {"title": "Other", "authors": "B"}, {"title": "Other", "authors": "C"})
    assert sorted(r.id for r in dedup.best_of_copies(t, ["id"]).collect()) == [1, 3, 4, 5, 6]
    u = items(spark, {"url": "a"}, {"url": "a"}, {"url": None}, {"url": "b"})
    assert sorted(r.id for r in dedup.first_by(u, "url", ["id"]).collect()) == [0, 2, 3]
    assert sorted(r.id for r in dedup.unknown(u, u.where("id = 0")).collect()) == [2, 3]
    assert [r.batch for r in dedup.numbered_batches(u, 3, "source", "id").orderBy("id").collect()] == [0, 0, 0, 1]


def test_feed(spark):
    d = dt.date
    t = items(spark, {"published_date": d(2025, 1, 2)}, {"published_date": None}, {"published_date": d(2025, 1, 3)}, {"published_date": d(2025, 1, 3)})
    c = spark.createDataFrame([(1, 0, "a", True, "high"), (1, 0, "a", True, "high"), (2, 1, "a", True, "low"), (3, 2, "b", True, "high"), (4, 3, "a", False, "high"), (5, 2, "a", True, "medium")], "id bigint, item_id bigint, subtopic string, relevant boolean, confidence string").withColumns({"reasoning": F.lit(None).cast("string"), "classified_at": F.lit(dt.datetime(2025, 1, 1))})
    k = spark.createDataFrame([(1, 0, "b", "x"), (2, 2, "a", "y"), (2, 2, "a", "y")], "id bigint, item_id bigint, subtopic string, topic_key string")
    n = spark.createDataFrame([(1, "Jane", "who")], "item_id bigint, connection_name string, connection_description string")
    ids = lambda f: [r.id for r in feed.feed(t, c, k, n, f).collect()]
    assert ids(FeedFilter(("a",))) == [1, 2, 0] and ids(FeedFilter(("a",), min_confidence="medium")) == [2, 0] and ids(FeedFilter(("a",), min_confidence="odd")) == [1, 2, 0]
    assert ids(FeedFilter(("a", "b"), topics=("x",))) == [0]  # relevant under a, the topic under b
    assert ids(FeedFilter(("a",), start=d(2025, 1, 3))) == [2] and ids(FeedFilter(connected_only=True)) == [1]
    with pytest.raises(ValueError, match="subtopics"):
        FeedFilter()
    full = {r.id: r for r in feed.with_attachments(t, c, k, n).collect()}
    assert full[2].classifications["a"].topics == ["y"] and full[2].classifications["b"].topics == [] and full[3].abstract == ""
    assert full[1].connection.has_connection and not full[0].connection.has_connection and full[0].classifications["a"].confidence == "high"
    assert [r.id for r in feed.unclassified(t.withColumn("crawled_at", F.lit(dt.datetime(2025, 1, 4))), c.where("item_id = 2"), dt.datetime(2025, 1, 4), 2).collect()] == [1, 3, 0]


def test_hashes_and_cache(spark):
    import hashlib

    df = spark.createDataFrame([("a", 10), ("a", 9), ("a", 9), ("b", 1)], "g string, i bigint")
    got = {r.g: r.item_hash for r in feed.item_set_hash(df, ["g"], "i").collect()}
    assert got["a"] == hashlib.sha256(b"9,9,10").hexdigest()[:16]
    cached = spark.createDataFrame([("a", got["a"]), ("b", "old")], "g string, item_hash string")
    now = feed.item_set_hash(df.union(spark.createDataFrame([("c", 2)], "g string, i bigint")), ["g"], "i")
    assert {r.g: r.status for r in feed.cache_status(now, cached, ["g"]).collect()} == {"a": "hit", "b": "stale", "c": "miss"}


def test_upsert(spark):
    old = spark.createDataFrame([(1, "u", "t", "2025", "{}"), (2, "v", "t2", None, "m")], "id int, url string, title string, day string, meta string")
    new = spark.createDataFrame([(7, "u", "", None, "m2"), (8, "w", "t3", "2026", ""), (9, None, "x", None, None)], "id int, url string, title string, day string, meta string")
    got = {r.url: tuple(r) for r in upsert.upsert(old, new, ["url"], {"id": upsert.keep, "day": upsert.fill, "meta": upsert.if_not_empty}).collect()}
    assert got == {"u": (1, "u", "", "2025", "m2"), "v": (2, "v", "t2", None, "m"), "w": (8, "w", "t3", "2026", ""), None: (9, None, "x", None, None)}
    twice = spark.createDataFrame([("u", "a", 1), ("u", "b", 2)], "url string, title string, n int")
    assert upsert.upsert(old.select("url", "title"), twice, ["url"], last="n").where("url = 'u'").first().title == "b"
    t = spark.createDataFrame([(1, "a", "x"), (2, "a", "y")], "item_id int, subtopic string, topic_key string")
    touched = spark.createDataFrame([(1, "a"), (3, "a")], "item_id int, subtopic string")
    put = spark.createDataFrame([(3, "a", "z"), (3, "a", "z")], "item_id int, subtopic string, topic_key string")
    assert sorted(tuple(r) for r in upsert.replace_groups(t, put, touched, ["item_id", "subtopic"]).collect()) == [(2, "a", "y"), (3, "a", "z")]
    assert upsert.cascade(t, spark.createDataFrame([(2,)], "id int"), "item_id").count() == 1


def test_failures_in_a_row(spark):
    e = spark.createDataFrame([("a", 1, "ok"), ("a", 2, "error"), ("a", 3, "error"), ("b", 1, "error"), ("c", 2, "error"), ("c", 3, "ok")], "s string, t int, k string")
    got = {r.source: r.consecutive_failures for r in upsert.failures_in_a_row(e, "s", F.col("k") == "error", ["t"]).collect()}
    assert got == {"a": 2, "b": 1, "c": 0}


def test_classification(spark):
    t = items(spark, {"title": "zoning reform"}, {"title": "nothing"}, {"title": "reward model alignment"}, {"title": "alignment BOOM"})
    open_, rejected = classify.split_by_prefilter(t, TAX)
    assert sorted(r.id for r in open_.collect()) == [0, 2, 3] and rejected.count() == 2

    def failing(prompt, batch):
        if any("BOOM" in x["title"] for x in batch):
            raise RuntimeError("no")
        return "```json\n" + classify.keyword_classifier(TAX)(prompt, batch) + "\n```"

    got = {(r.item_id, r.subtopic): r for r in classify.classify(open_.coalesce(1), TAX, failing).collect()}
    assert len(got) == 6 and got[(0, "abundance")].relevant and got[(0, "abundance")].topics == ["housing"]
    assert got[(2, "ai")].relevant and got[(3, "ai")].reasoning == "Classification failed"
    partial = {(r.item_id, r.subtopic): r.reasoning for r in classify.classify(open_, TAX, lambda p, b: '{"0": {"ai": {"relevant": "true"}}}', 1).collect()}
    assert partial[(0, "abundance")] == "Not evaluated" and partial[(0, "ai")] == ""
    assert classify.parse_reply("no json") == classify.parse_reply("[1]") == {} and classify.parse_reply('```\n{"a": 1}') == {"a": 1}


def test_classifier_and_writer_see_whole_contents(spark):
    t = items(spark, {"title": "a", "content": "x " * 4000 + "zoning reform"}, {"title": "b", "abstract": "x " * 4000 + "zoning reform"})
    ask = classify.keyword_classifier(TAX)
    got = {(r.item_id, r.subtopic): r.topics for r in classify.classify(t, TAX, ask).collect()}
    assert got[(0, "abundance")] == got[(1, "abundance")] == ["housing"]
    assert not any(r.topics for r in classify.classify(t, TAX, ask, most=3000).collect())
    size = lambda title, content, source: f"{len(content)} characters in all"
    assert summaries.written(t, size).where("item_id = 0").first().reply == "8013 characters in all"
    assert summaries.written(t, size, 3000).where("item_id = 0").first().reply == "3000 characters in all"


def verdict_rows(spark, rows):
    return spark.createDataFrame(rows, "item_id bigint, subtopic string, relevant boolean, confidence string, reasoning string, topics array<string>")


def test_prefilter_within_classification(spark):
    t = items(spark, {"title": "zoning reform"}, {"title": "nothing"}, {"title": None, "content": ""}, {"title": "reward model alignment"})
    seen = spark.sparkContext.accumulator(0)

    def ask(prompt, batch):
        seen.add(len(batch))
        return classify.keyword_classifier(TAX)(prompt, batch)

    got = {(r.item_id, r.subtopic): (r.relevant, r.reasoning) for r in classify.classify(t, TAX, ask, threshold=0.02).collect()}
    assert seen.value == 2 and len(got) == 8 and got[(1, "ai")] == got[(2, "abundance")] == (False, classify.BELOW) and got[(0, "abundance")][0]


def test_taxonomy_of_a_thousand_topics(spark):
    big = Taxonomy(tuple(Topic(f"s{i % 20}", f"t{i}", i, keywords=tuple(f"word{i}x{k}" for k in range(10))) for i in range(1000)), network={"author": {f"writer {i} of many": "x" for i in range(500)}})
    t = items(spark, {"title": "word7x1 and word999x0"}, {"title": "nothing", "authors": "Writer 77 Of Many"})
    assert {(r.item_id, r.topic): r.score for r in scoring.keyword_scores(t, big).where("score > 0").collect()} == {(0, "t7"): 0.1, (0, "t999"): 0.1}
    assert [r.passes for r in scoring.potentially_relevant(t, big).orderBy("id").collect()] == [True, False]
    assert [r.connection_name for r in scoring.network_matches(t, big).collect()] == ["Writer 77 Of Many"]
    assert sorted(r.topic for r in scoring.audit_hits(t, big).collect()) == ["t7", "t999"]


def test_batches_of_a_hot_source_and_null(spark):
    rows = [(i, "hot" if i % 3 else None if i % 2 else "b") for i in range(200)]
    t = spark.createDataFrame(rows, "id int, source string").repartition(7)
    got = {r.id: r.batch for r in dedup.numbered_batches(t, 5, "source", "id").collect()}
    want = {i: n // 5 for s in ("hot", None, "b") for n, i in enumerate(i for i, x in rows if x == s)}
    assert got == want and dedup.numbered_batches(t.limit(0), 5, "source", "id").count() == 0


def test_set_hash_by_stretches(spark):
    import hashlib

    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    df = spark.createDataFrame([("a", 3), ("a", 12), ("a", 11), ("b", 11), ("b", 12), (None, 1)], "g string, i bigint")
    got = {r.g: (r.item_hash, r.n_items) for r in feed.item_set_hash(df, ["g"], "i", 10).collect()}
    assert got == {"a": (sha(sha("3") + "," + sha("11,12"))[:16], 3), "b": (sha("11,12")[:16], 2), None: (sha("1")[:16], 1)}


def test_auto_tags(spark):
    t = items(spark, {"source": "movement"}, {"source": "other"})
    v = verdict_rows(spark, [(0, "abundance", True, "", "", []), (0, "ai", True, "", "", []), (1, "abundance", True, "", "", []), (9, "abundance", True, "", "", ["housing"])])
    got = {(r.item_id, r.subtopic): r.topics for r in classify.auto_tagged(v, t, TAX).collect()}
    assert got == {(0, "abundance"): ["general"], (0, "ai"): [], (1, "abundance"): [], (9, "abundance"): ["housing"]}
    kept = verdict_rows(spark, [(0, "abundance", True, "", "", ["housing"]), (0, "abundance", True, "", "", ["general"]), (0, "abundance", False, "", "", None)])
    assert [r.topics for r in classify.auto_tagged(kept, t, TAX).collect()] == [["housing"], ["general"], None]


def model_audit(hits, verdicts):
    out = []
    for s in TAX.subtopics:
        filled = {t for _, u, rel, _, _, topics in verdicts if u == s and rel for t in topics}
        empty = [t.topic for t in TAX.of(s) if t.topic not in filled]
        for i in sorted({i for i, u, rel, *_ in verdicts if u == s and not rel}):
            claim = next((t for t in empty if (i, s, t) in hits), None)
            if claim:
                empty.remove(claim)
                out.append((i, s, claim))
    return sorted(out)


def test_category_audit_against_the_walk(spark):
    words = ["zoning reform", "nuclear energy", "abundance agenda", "alignment", "zoning reform nuclear energy", "none"]
    t = items(spark, *[{"title": words[(i * 7) % 6]} for i in range(60)])
    verdicts = [(i, s, i % 9 == 0 and s == "ai", "", "", ["bare"]) for i in range(60) for s in TAX.subtopics]
    hits = scoring.audit_hits(t, TAX)
    got = sorted(tuple(r) for r in classify.category_audit(hits, verdict_rows(spark, verdicts), TAX).collect())
    assert got == model_audit({(r.item_id, r.subtopic, r.topic) for r in hits.collect()}, verdicts) and got


def test_summaries(spark):
    long = "The council met on a cold day and chose nothing. Nobody had expected that it would come to this. " * 3
    t = items(spark, {"content": long, "abstract": "", "title": "ok"}, {"content": long, "title": "no"}, {"content": "short", "title": "no"}, {"content": long, "title": "err"}, {"content": long, "abstract": "x" * 60}, {"content": None})
    now = dt.datetime(2026, 3, 1)

    def writer(title, content, source):
        if title == "err":
            raise RuntimeError("down")
        return "I'm sorry, no." if title == "no" else "An abstract that is long enough."

    asked = summaries.candidates(t)
    assert sorted(r.id for r in asked.collect()) == [0, 1, 2, 3]
    out = summaries.summarized(t, summaries.written(asked, writer), now)
    got = {r.id: r for r in out.collect()}
    assert [got[i].outcome for i in range(6)] == ["written", "extracted", "failed", "failed", "kept", "kept"]
    assert got[1].abstract.startswith("- The council") and got[3].api_refusal_type == "abstract" and got[0].api_refused_at is None
    again = {r.id: r for r in summaries.retried(out.drop("outcome"), summaries.written(out.where("api_refused_at is not null"), lambda *a: "A second abstract, long enough.")).collect()}
    assert again[3].api_refused_at is None and again[3].abstract.startswith("A second")


def test_enriched(spark):
    t = items(spark, {"url": "a", "content": "short"}, {"url": "b", "content": None, "abstract": "x" * 50}, {"url": "c", "content": "y" * 600}, {"url": "d"})
    pages = spark.createDataFrame([("a", "t" * 100), ("a", "t" * 50), ("b", "t" * 50), ("c", "t" * 9000), ("d", None)], "url string, text string")
    got = {r.url: (r.enriched, len(r.content or "")) for r in summaries.enriched(t, pages).collect()}
    assert got == {"a": (True, 100), "b": (False, 0), "c": (False, 600), "d": (False, 0)}


def test_enriched_items_take_the_whole_document(spark, tmp_path):
    items(spark, {"url": "a", "content": "short"}, {"url": "b", "content": "y" * 600}).write.parquet(f"{tmp_path}/items.parquet")
    spark.createDataFrame([(0, "t" * 9000), (1, "t" * 9000)], "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    assert {r.id: (r.enriched, r.n_chars) for r in queries.enriched_items(spark, str(tmp_path)).collect()} == {0: (True, 9000), 1: (False, 600)}


def test_topic_summaries(spark):
    t = items(spark, {"title": "One", "abstract": "x" * 400, "source_name": "S"}, {"title": None, "abstract": None})
    topics = spark.createDataFrame([(0, "ai_safety"), (1, "ai_safety"), (1, "ai_safety"), (1, "law"), (0, "bad")], "item_id bigint, topic_key string")
    prompts = summaries.topic_prompts(t, topics)
    got = {r.topic_key: r for r in prompts.collect()}
    assert got["ai_safety"].prompt == "- One (S): " + "x" * 300 + "\n- Untitled (s): " and got["ai_safety"].n_items == 2
    cached = spark.createDataFrame([("law", got["law"].item_hash, "kept"), ("bad", "old", "gone")], "topic_key string, item_hash string, summary string")
    asked = spark.sparkContext.accumulator(0)

    def writer(name, prompt, _):
        asked.add(1)
        if name == "Bad":
            raise RuntimeError("no")
        return f"On {name}"

    out = {r.topic_key: (r.summary, r.status) for r in summaries.topic_summaries(prompts, cached, {}, writer).collect()}
    assert out == {"law": ("kept", "hit"), "ai_safety": ("On AI Safety", "miss"), "bad": ("1 recent items on Bad.", "failed")} and asked.value == 2


def test_crawls_written(spark):
    sources = spark.createDataFrame([("a", "ok", None, 0, None, "x"), ("b", "error", "old", 2, None, "x"), ("c", "error", "old", None, None, "x"), ("d", "pending", None, 4, None, "x")], "key string, crawl_status string, crawl_error string, consecutive_failures int, last_crawled_at timestamp, at string")
    t = lambda d: dt.datetime(2026, 1, d)
    crawls = spark.createDataFrame([("a", t(1), 3, "boom"), ("a", t(2), 0, None), ("b", t(1), 5, "boom"), ("b", t(2), None, "bang"), ("c", t(1), 1, ""), ("c", t(2), 1, "late"), ("gone", t(1), 1, None), (None, t(1), 1, None)], "source string, at timestamp, n_items int, error string")
    got = {r.key: (r.crawl_status, r.crawl_error, r.consecutive_failures, r.last_crawled_at) for r in upsert.crawls_written(sources, crawls).collect()}
    assert got == {"a": ("empty", None, 0, t(2)), "b": ("error", "bang", 4, t(2)), "c": ("error", "late", 1, t(2)), "d": ("pending", None, 4, None)}
    assert upsert.crawls_written(sources, crawls.limit(0)).count() == 4 and upsert.crawls_written(sources.limit(0), crawls).count() == 0


def test_storage_rows(spark):
    rows = [(1, None, "B Lee", "w7", None, "Tides", "2026-01-02", '{"images": ["u"], "other": 1, "keyword_scores": {"k": 0.5}}'), (2, "A", "B", None, "s", None, None, None), (3, "", None, None, None, None, "soon", "broken")]
    df = spark.createDataFrame(rows, "id int, authors string, author string, paper_number string, source_id string, substack_name string, date string, raw_metadata string")
    df = df.withColumns({"abstract": F.lit(None).cast("string"), "content": F.lit("c"), "date": F.try_to_date("date", "yyyy-MM-dd")})
    got = {r.id: r for r in upsert.storage_rows(df).collect()}
    assert (got[1].authors, got[1].source_id, got[1].source_name, got[1].published_date, got[1].abstract) == ("B Lee", "w7", "Tides", dt.date(2026, 1, 2), "")
    assert json.loads(got[1].raw_metadata) == {"images": ["u"], "keyword_scores": {"k": 0.5}} and got[2].authors == "A" and got[2].source_id == "s" and got[3].published_date is None
    assert upsert.storage_rows(df.select("id", "abstract", "content").limit(0)).count() == 0


def test_weekly_prompts_and_stored_summaries(spark):
    items = spark.createDataFrame([(1, "T", "s", "", "abc", dt.date(2026, 3, 2)), (2, None, None, "N", None, dt.date(2026, 3, 8)), (3, "U", "s", None, "d", dt.date(2026, 3, 9)), (4, "V", "s", None, "d", None)], "id int, title string, source string, source_name string, abstract string, published_date date")
    topics = spark.createDataFrame([(1, "k"), (1, "k"), (2, "k"), (3, "k"), (4, "k"), (9, "k"), (None, "k")], "item_id int, topic_key string")
    week = F.next_day(F.date_sub("published_date", 1), "SUN")
    p = {r.week_ending: r for r in summaries.topic_prompts(items, topics, week=week, link=text.deep_link("https://x.example/", F.lit("f"), F.col("id"))).collect()}
    assert p[dt.date(2026, 3, 8)].prompt == "- T (s): abc\n  https://x.example/digests/f#item-1\n- Untitled (N): \n  https://x.example/digests/f#item-2" and p[dt.date(2026, 3, 15)].n_items == 1 and len(p) == 2
    rows = [("k", dt.date(2026, 3, 8), "h2", "new", "stale"), ("m", dt.date(2026, 3, 8), "h3", "first", "miss"), ("f", dt.date(2026, 3, 8), "h4", "3 recent items", "failed"), ("g", dt.date(2026, 3, 8), "h5", "same", "hit")]
    new = spark.createDataFrame(rows, "topic_key string, week_ending date, item_hash string, summary string, status string")
    t0, t1 = dt.datetime(2026, 3, 1), dt.datetime(2026, 3, 9)
    cache = spark.createDataFrame([(5, 1, "k", dt.date(2026, 3, 8), "old", "h1", t0), (6, 1, "g", dt.date(2026, 3, 8), "same", "h5", t0), (7, 2, "k", dt.date(2026, 3, 8), "of another feed", "h1", t0)], "id bigint, feed_id bigint, topic_key string, week_ending date, summary string, item_hash string, created_at timestamp")
    got = {(r.feed_id, r.topic_key): (r.summary, r.created_at, r.id) for r in summaries.stored(cache, new, 1, t1).collect()}
    assert got[1, "k"] == ("new", t1, 5) and got[1, "g"] == ("same", t0, 6) and got[2, "k"] == ("of another feed", t0, 7) and got[1, "m"][:2] == ("first", t1) and len(got) == 4


def test_batch_prompt():
    batch = [{"title": "A", "content": "long " * 10, "authors": None, "source": "s", "subtopics": ["b", "a"]}, {"title": None, "content": None, "authors": "Q", "source": None, "subtopics": []}]
    told = classify.batch_prompt(batch, 4)
    assert told.startswith("### Item 0\nTitle: A\nSource: s\nSubtopics: a, b\nContent: long\n\n### Item 1\nAuthors: Q\n\nReply") and "long long" in classify.batch_prompt(batch)
    form = json.loads(told.partition("only:")[2])
    assert list(form["0"]) == ["a", "b"] and form["1"] == {} and told == classify.batch_prompt([dict(reversed(x.items())) for x in batch], 4)
    assert classify.parse_reply(told.partition("only:")[2])["0"]["a"]["relevant"] is True and classify.batch_prompt([]).endswith("{}")
