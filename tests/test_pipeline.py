import datetime as dt

from heddle.operators.classify import keyword_classifier
from heddle.plans.pipeline import classify_pending, ingest, ingest_each
from heddle.sources.fetch import Reply, fetched, get, wait_before
from heddle.sources.store import Store
from test_operators import TAX

NOW = dt.datetime(2026, 3, 1)


def test_two_phases(spark, tmp_path):
    s = Store(spark, f"file://{tmp_path}/root")
    rows = [("u1", "Zoning reform now", "movement", "about housing supply", "Jane Quimby", dt.date(2026, 2, 27)), ("u2", "zoning reform NOW", "b", "about housing supply in full", "A Quimby", None), ("u3", "Nothing here", "b", "", "", dt.date(2027, 1, 1)), ("", "no address", "b", "", "", None)]
    crawled = spark.createDataFrame(rows, "url string, title string, source string, abstract string, authors string, published_date date")
    assert ingest(s, crawled, NOW) == {"crawled": 3, "refused": 1, "known": 0, "stored": 2}
    kept = {r.url: r for r in s.read("items").collect()}
    assert sorted(kept) == ["u2", "u3"] and kept["u3"].published_date is None and sorted(r.id for r in kept.values()) == [1, 2]
    assert ingest(s, crawled.where("url = 'u3'"), NOW) == {"crawled": 1, "refused": 0, "known": 1, "stored": 0}
    done = classify_pending(s, TAX, keyword_classifier(TAX), NOW)
    assert done == {"items": 2, "verdicts": 4, "relevant": 1} and classify_pending(s, TAX, keyword_classifier(TAX), NOW)["items"] == 0
    assert s.read("classifications").count() == 4 and [r.topic_key for r in s.read("item_topics").collect()] == ["housing"]


def test_retries():
    asked, slept = [], []

    def transport(url, headers):
        asked.append(url)
        if url == "gone":
            return Reply(404)
        if len(asked) < 3:
            return Reply(503, retry_after="5" if len(asked) == 1 else "x")
        return Reply(200, "ok")

    assert get(transport, "u", sleep=slept.append).body == "ok" and slept == [5.0, 2.0]
    assert get(transport, "gone", sleep=slept.append).status == 404 and len(slept) == 2
    assert wait_before(2, None) == 4.0 and wait_before(0, "-1") == 1.0


def test_fetched(spark):
    def transport(url, headers):
        if url.endswith("lost"):
            raise OSError("no")
        return Reply(500 if url.endswith("bad") else 200, headers["User-Agent"])

    rows = [(f"https://{h}.example/{p}", "s") for h in "ab" for p in ("x", "bad", "lost")] + [(None, "s")]
    got = {r.url: (r.status, r.document) for r in fetched(spark.createDataFrame(rows, "url string, source string"), transport, "reader", "mail@x.example", pause=0.0, sleep=lambda s: None).collect()}
    assert got["https://a.example/x"] == (200, "reader (+mail@x.example)") and got["https://b.example/bad"] == (500, None) and got["https://b.example/lost"] == (0, None) and len(got) == 6


def crawl(spark, *urls, source="s"):
    return spark.createDataFrame([(u, f"Title of {u}", source) for u in urls], "url string, title string, source string")


def test_only_touched_buckets_are_rewritten_and_the_state_moves_with_the_items(spark, tmp_path):
    s = Store(spark, f"file://{tmp_path}/root", buckets=16)
    ingest(s, crawl(spark, *[f"u{i}" for i in range(40)]), NOW)
    before = s._tables()[1]["items"]["folders"]
    later = NOW + dt.timedelta(days=90)
    assert ingest(s, crawl(spark, "u1", "new"), later)["stored"] == 2
    after = s._tables()[1]["items"]["folders"]
    assert sum(before.get(b) != f for b, f in after.items()) <= 2 and s.read("items").count() == 41
    ids = [r.id for r in s.read("items").collect()]
    assert len(set(ids)) == 41 and {r.url: r.crawled_at for r in s.read("items").collect()}["u1"] == later
    assert [(r.source, r.saved, r.last_run) for r in s.read("crawl_state").collect()] == [("s", later.replace(hour=8) - dt.timedelta(days=1), later)]


def test_sources_are_committed_one_by_one(spark, tmp_path):
    s = Store(spark, f"file://{tmp_path}/root", buckets=4)
    s.write("sources", spark.createDataFrame([("a", 0, "x"), ("b", 2, None), ("c", 1, None)], "key string, consecutive_failures int, crawl_error string"))

    def broken():
        raise OSError("no answer")

    got = ingest_each(s, {"a": lambda: crawl(spark, "u1", "u2", source="a"), "b": broken, "c": lambda: crawl(spark, source="c")}, NOW)
    assert got == {"a": "ok", "b": "error", "c": "empty"} and s.read("items").count() == 2
    assert {r.key: (r.crawl_status, r.consecutive_failures, r.crawl_error) for r in s.read("sources").collect()} == {"a": ("ok", 0, None), "b": ("error", 3, "OSError: no answer"), "c": ("empty", 0, None)}
    assert [r.source for r in s.read("crawl_state").collect()] == ["a"]
