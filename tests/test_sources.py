import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from heddle.sources import definitions, feeds, listings, works
from heddle.sources.markup import article_text, parse
from heddle.sources.store import TABLES, Store

RSS = """<?xml version="1.0"?><rss version="2.0" xmlns:dc="http://purl.org/dc/elements/1.1/" xmlns:media="http://search.yahoo.com/mrss/" xmlns:content="http://purl.org/rss/1.0/modules/content/"><channel><title>T</title>
<item><title>Tide tables, explained</title><link>https://a.example/p/1</link><description><![CDATA[<p>Water <b>rises</b></p><img src="https://a.example/i.png" width="50" height="50"><img src="https://a.example/big.png" width="500">]]></description><pubDate>Thu, 4 Sep 2025 06:30:00 GMT</pubDate><dc:creator>Runa Weir</dc:creator><enclosure url="https://a.example/e.png" type="image/png"/></item>
<item><title>Second</title><link>https://a.example/p/2</link><content:encoded>Body</content:encoded><pubDate>Fri, 02 Jun 2023 10:00:00 GMT</pubDate></item>
<item><title>No date</title><link>https://a.example/p/3</link></item><item><title>No link</title></item></channel></rss>"""
RDF = """<rdf:RDF xmlns:rdf="http://www.w3.org/1999/02/22-rdf-syntax-ns#" xmlns="http://purl.org/rss/1.0/" xmlns:dc="http://purl.org/dc/elements/1.1/"><item><title>R</title><link>https://r.example/1</link><dc:creator>Ann</dc:creator><dc:date>2025-11-21T00:00:00Z</dc:date><description>d</description></item></rdf:RDF>"""
ATOM = """<feed xmlns="http://www.w3.org/2005/Atom"><entry><id>http://x.example/abs/0704.99x</id><title>  A  wide
 title </title><summary> Some
 text </summary><published>2031-07-09T00:00:00Z</published><link href="http://x.example/pdf" type="application/pdf"/><link href="http://x.example/abs/0704.99x" type="text/html"/><author><name>Noor Vale</name></author><author><name>Tomas Quill</name></author><category term="geo.tides"/><category term="geo.maps"/></entry>
<entry><id>http://x.example/abs/2</id><title>Id is the address</title><updated>2020-01-01</updated></entry><entry><id>3</id></entry></feed>"""


def docs(spark, *texts):
    return spark.createDataFrame([(f"https://slow.substack.com/{i}", "src", t) for i, t in enumerate(texts)], "feed_url string, source string, document string")


def test_feed_items(spark):
    got = {r.url: r for r in feeds.feed_items(docs(spark, RSS, RDF, "<rss", "", None, "<!DOCTYPE x><rss/>", "<html/>")).collect()}
    first = got["https://a.example/p/1"]
    assert (first.title, first.abstract, first.authors, first.published_date, first.source_name) == ("Tide tables, explained", "Water rises", "Runa Weir", dt.date(2025, 9, 4), "slow")
    assert first.images == ["https://a.example/e.png", "https://a.example/big.png"] and got["https://a.example/p/2"].content == "Body"
    assert got["https://r.example/1"].published_date == dt.date(2025, 11, 21) and got["https://r.example/1"].authors == "Ann" and len(got) == 4
    later = feeds.feed_items(docs(spark, RSS), F.lit(dt.datetime(2025, 9, 4, 12)))
    assert sorted(r.url[-1] for r in later.collect()) == ["1", "3"]


def test_feeds_with_a_doctype():
    body = "<rss><channel><item><title>T</title><link>https://x.example/1</link><description><![CDATA[of <!DOCTYPE html> and <!ENTITY]]></description></item></channel></rss>"
    assert len(list(feeds.entries('<!DOCTYPE rss PUBLIC "-//X//DTD RSS 0.91//EN" "http://x.example/rss.dtd">' + body))) == 1 and len(list(feeds.entries(body))) == 1
    assert list(feeds.entries('<!DOCTYPE rss [<!ENTITY a "aa">]>' + body)) == [] and list(feeds.entries('<!DOCTYPE rss [<!ENTITY % a SYSTEM "x">%a;]>' + body)) == []


def test_preprint_and_paper_feeds(spark):
    got = {r.url: r for r in feeds.preprint_feed_items(docs(spark, ATOM, ATOM)).collect()}
    r = got["http://x.example/abs/0704.99x"]
    assert (r.title, r.abstract, r.authors, r.source_id, r.subjects) == ("A wide title", "Some text", "Noor Vale, Tomas Quill", "0704.99x", ["geo.tides", "geo.maps"])
    assert len(got) == 2 and feeds.preprint_feed_items(docs(spark, ATOM), F.lit(dt.datetime(2021, 1, 1))).count() == 1
    papers = RSS.replace("Second", "Ferries at night -- by R. Weir, N. Vale").replace("https://a.example/p/2", "https://n.example/papers/w4071#fromrss")
    p = {r.source_id: r for r in feeds.paper_feed_items(docs(spark, papers), F.lit(dt.date(2026, 3, 1))).collect()}
    assert (p["w4071"].title, p["w4071"].authors, p["w4071"].url) == ("Ferries at night", "R. Weir, N. Vale", "https://n.example/papers/w4071")


def test_works(spark):
    today = F.lit(dt.date(2026, 3, 1))
    reply = lambda o: spark.createDataFrame([("s", json.dumps(o)), ("s", "broken"), ("s", None)], "source string, reply string")
    reg = works.registry_works(reply({"message": {"items": [{"title": ["A  B"], "DOI": "10.1/x", "abstract": "<jats:p>Text</jats:p>", "author": [{"given": "Ann", "family": "Lee"}, {"family": "Org"}, {}], "published": {"date-parts": [[2025, 4]]}}, {"title": ["C"], "link": [{"URL": "https://l.example"}], "created": {"date-parts": [[2040, 1, 1]]}}, {"title": ["no address"]}, {"DOI": "10.1/y"}]}}), today).collect()
    assert sorted((r.url, r.title, r.abstract, r.authors, r.published_date) for r in reg) == [("https://doi.org/10.1/x", "A B", "Text", "Ann Lee, Org", dt.date(2025, 4, 1)), ("https://l.example", "C", "", "", dt.date(2026, 3, 1))]
    opened = works.open_works(reply({"results": [{"id": "W1", "doi": "https://doi.org/10.1/z", "title": "T", "publication_date": "2026-12-01", "authorships": [{"author": {"display_name": "Ann"}}], "abstract_inverted_index": {"marsh": [1], "Salt": [0]}}, {"id": "W2", "display_name": "U"}]}), today).collect()
    assert sorted((r.url, r.abstract, r.published_date) for r in opened) == [("W2", "", None), ("https://doi.org/10.1/z", "Salt marsh", dt.date(2026, 3, 1))]
    person = {"embeds": {"users": {"data": {"attributes": {"full_name": "Ann"}}}}}
    entry = {"id": "abc", "attributes": {"title": "P", "description": "<b>d</b>", "date_created": "2026-01-02T03:04:05Z", "subjects": [[{"text": "Law"}, {"text": "Law"}], [{"text": "Art"}]]}, "links": {}, "embeds": {"contributors": {"data": [person, person]}}}
    pre = works.preprint_works(reply({"data": [entry, entry]}), F.lit(dt.datetime(2026, 1, 2))).collect()
    assert [(r.url, r.abstract, r.authors, r.subjects, r.published_date) for r in pre] == [("https://osf.io/abc", "d", "Ann, Ann", ["Law", "Art"], dt.date(2026, 1, 2))]
    items = spark.createDataFrame([(1, "s", "a", ""), (2, "s", "b", ""), (3, "s", "c", "has one")], "id int, source string, url string, abstract string")
    found = spark.createDataFrame([("a", "x"), ("b", "y"), ("c", "z")], "url string, abstract string")
    assert {r.id: r.abstract for r in works.backfilled(items, found, 1).collect()} == {1: "x", 2: "", 3: "has one"}


LISTING = """<ul class="site-list-wide"><li class="item"><a href="/p/1"><time datetime="2025-08-19">Aug</time><span class="title">One</span></a></li><li class="item"><a href="/p/2"><span class="date">no</span><span class="date">7 October 2023</span><span class="title">Two</span></a>
<li class="item"><a href="/p/1"><span class="title">One again</span></a></li><li class="item"><a href="/p/3"><span class="title">Undated</span></a></li><li class="item"><span class="title">No link</span></li></ul><a class="card" href="https://o.example/x"><h3>Card</h3></a>"""
CONF = {"listing_url": "https://s.example/all/", "article_selector": "ul[class*='list'] li.item, a.card", "title_selector": ".title, h3", "url_selector": "a[href]", "date_selector": "time, span.date"}


def test_listings(spark):
    rows = [("s", json.dumps(CONF), LISTING), ("bad", json.dumps({"listing_url": "x"}), LISTING), ("none", None, LISTING), ("empty", json.dumps(CONF), None)]
    df = spark.createDataFrame(rows, "source string, crawl_config string, html string")
    got = {r.url: (r.title, r.published_date) for r in listings.listing_items(df, 2026).collect()}
    assert got == {"https://s.example/p/1": ("One", dt.date(2025, 8, 19)), "https://s.example/p/2": ("Two", dt.date(2023, 10, 7)), "https://s.example/p/3": ("Undated", None), "https://o.example/x": ("Card", None)}
    assert listings.listing_items(df, 2026, F.lit(dt.datetime(2025, 1, 1))).count() == 3


def test_selectors_and_article_text():
    t = parse("<div id=a class='x y'><p>one<p>two<br>three</div><div class=y><p data-k='v w'>four</div>")
    assert [x.text() for x in t.select("#a p")] == ["one", "two three"] and [x.text() for x in t.select("div.x.y, [data-k~=w]")] == ["one two three", "four"]
    assert t.select("p[data-k^='v'][data-k$=w]") and not t.select("#a [data-k]")
    assert article_text("<nav>n</nav><article><script>var t='</p>'</script><p>Body <b>bold</b></article>") == "Body bold"
    assert article_text("<div>a</div><div>longer <i>text</i></div>") == "longer text" and article_text("") == ""
    assert article_text("<blockquote class='abstract mathjax'>Abs</blockquote><article>x</article>", "https://arxiv.org/abs/1") == "Abs"
    assert article_text("<meta content='Substack'><div class='body markup'>News</div><article>x</article>") == "News"
    assert article_text("<article>" + "x" * 9000 + "</article>", most=10) == "x" * 10


def test_page_texts_are_whole(spark):
    words = " ".join(f"w{i}" for i in range(9000))
    bodies = {"https://a.example/1": f"<article>{words}</article>", "https://a.example/2": f"<div>{words}</div>", "https://arxiv.org/abs/1": f"<blockquote class='abstract mathjax'>{words}</blockquote>", "https://a.example/3": ""}
    df = spark.createDataFrame(list(bodies.items()), "url string, html string")
    assert {r.url: r.text for r in listings.page_texts(df).collect()} == {u: words if h else "" for u, h in bodies.items()}
    assert {len(r.text) for r in listings.page_texts(df, 10).collect()} == {10, 0}


def test_definitions(spark, tmp_path):
    path = tmp_path / "s.json"
    path.write_text(json.dumps([{"key": "a", "name": "A", "source_type": "blog", "crawler_type": "rss", "subtopics": ["x"], "crawl_config": {"k": 1}}, {"key": "a", "name": "", "source_type": "blog", "crawler_type": "odd"}, {"name": "B", "source_type": "b", "crawler_type": "nber"}]))
    s = definitions.read_definitions(spark, str(path)).coalesce(1).withColumn("id", F.monotonically_increasing_id())
    assert json.loads(s.first().crawl_config) == {"k": 1}
    got = sorted((r.position, r.problem) for r in definitions.problems(s).collect())
    assert got == [(1, "key stands at 0"), (1, "name is missing"), (1, "unknown crawler_type odd"), (2, "key is missing")]


def test_store(spark, tmp_path):
    s = Store(spark, f"file://{tmp_path}/root")
    assert s.missing() == list(TABLES) and s.read("items").count() == 0
    s.write("item_topics", spark.createDataFrame([(1, 2, "a", "x")], TABLES["item_topics"]))
    s.write("item_topics", s.read("item_topics").unionByName(spark.createDataFrame([(2, 3, "a", "y")], TABLES["item_topics"])))
    assert s.read("item_topics").count() == 2
    with pytest.raises(Exception, match="boom"):
        s.write("item_topics", s.read("item_topics").withColumn("topic_key", F.raise_error(F.lit("boom")).cast("string")))
    assert s.read("item_topics").count() == 2 and s.create_missing() == [t for t in TABLES if t != "item_topics"] and s.missing() == []


def test_a_commit_that_stops_between_its_steps_leaves_the_table_as_it_was(spark, tmp_path):
    s = Store(spark, f"file://{tmp_path}/root")
    row = lambda i: spark.createDataFrame([(i, i, "a", "x")], TABLES["item_topics"])
    s.write("item_topics", row(1))
    whole = s._fs

    class Stopping:
        def __getattr__(self, name):
            if name == "rename":
                raise RuntimeError("stopped")
            return getattr(whole, name)

    s._fs = Stopping()
    with pytest.raises(RuntimeError, match="stopped"):
        s.write("item_topics", row(2))
    s._fs = whole
    assert [r.id for r in s.read("item_topics").collect()] == [1]
    s.write("item_topics", row(3))
    s.write("item_topics", row(4))
    assert [r.id for r in s.read("item_topics").collect()] == [4] and sorted(s._numbers()) == [1, 2, 3]


def test_commits_of_several_tables_and_two_writers(spark, tmp_path):
    a, b = (Store(spark, f"file://{tmp_path}/root") for _ in range(2))
    topic = lambda i: spark.createDataFrame([(i, i, "a", "x")], TABLES["item_topics"])
    verdict = spark.createDataFrame([(1, 1, "a", True)], "id bigint, item_id bigint, subtopic string, relevant boolean")
    with pytest.raises(Exception, match="boom"):
        a.commit({"item_topics": topic(1), "classifications": verdict.withColumn("subtopic", F.raise_error(F.lit("boom")).cast("string"))})
    assert a.read("item_topics").count() == 0 and a._numbers() == []
    a.commit({"item_topics": topic(1), "classifications": verdict})
    assert a.read("item_topics").count() == b.read("classifications").count() == 1
    b.read("item_topics")
    a.write("item_topics", topic(2))
    with pytest.raises(RuntimeError, match="another writer"):
        b.write("item_topics", topic(3))
    b.write("network_connections", spark.createDataFrame([], TABLES["network_connections"]))
    assert [r.id for r in b.read("item_topics").collect()] == [2]


def test_changes_are_applied_once(spark, tmp_path):
    s = Store(spark, f"file://{tmp_path}/root")
    add = lambda i: lambda s: {"item_topics": s.read("item_topics").unionByName(spark.createDataFrame([(i, i, "a", "x")], TABLES["item_topics"]))}
    now = dt.datetime(2026, 3, 1)
    assert s.apply({"b": add(2), "a": add(1)}, now, dry=True) == ["a", "b"] and s.read("item_topics").count() == 0
    assert s.apply({"b": add(2), "a": add(1)}, now) == ["a", "b"] and s.apply({"a": add(1), "c": add(3)}, now) == ["c"]
    assert sorted(r.id for r in s.read("item_topics").collect()) == [1, 2, 3]
