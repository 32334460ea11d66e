import datetime as dt
import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from heddle.functions import dates
from heddle.functions import text as T


def one(spark, expr, **values):
    df = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} {'int' if isinstance(v, int) else 'string'}" for k, v in values.items()))
    return df.select(expr).first()[0]


def hashes(spark, *rows):
    return [r[0] for r in spark.createDataFrame(list(rows), "t string, a string").select(T.content_hash(F.col("t"), F.col("a"))).collect()]


@settings(max_examples=15, deadline=None)
@given(st.lists(st.text("abcz0_ ", min_size=1, max_size=20), min_size=1, max_size=6), st.sampled_from([",", ".", "!", "-", "'", '"']), st.sampled_from(["\t", "  ", "\u00a0", " \n "]))
def test_content_hash_ignores_how_a_title_is_typed(spark, titles, sign, space):
    plain = hashes(spark, *[(t, "Ada Okafor") for t in titles])
    other = hashes(spark, *[(sign + t.upper().replace(" ", space) + sign, "B.  OKAFOR, Someone Else") for t in titles])
    assert plain == other and all(len(h) == 16 and set(h) <= set("0123456789abcdef") for h in plain)


def test_content_hash_tells_works_apart(spark):
    assert hashes(spark, ("Harbour lights", "Ada Okafor"), (None, None)) == [hashlib.sha256(x).hexdigest()[:16] for x in (b"harbour lights|okafor", b"|")]
    one_title = hashes(spark, ("Harbour lights", "Ada Okafor"), ("Harbour lights", "Ada Weir"), ("Harbour lights", None), ("Harbour light", "Ada Okafor"))
    assert len(set(one_title)) == 4 and hashes(spark, ("Hârbour lïghts", "X, Ada Okafor"))[0] == hashes(spark, ("Harbour lights", "x"))[0]


FORMS = ["%Y-%m-%d", "%Y-%m-%d at noon", "%b %d, %Y", "%B %d %Y", "%d %B %Y", "%d %b %Y, by us", "  %B %d, %Y | desk"]


@settings(max_examples=10, deadline=None)
@given(st.lists(st.dates(dt.date(1000, 1, 1), dt.date(2999, 12, 31)), min_size=1, max_size=5))
def test_flexible_date_reads_what_was_written(spark, days):
    typed = [(d.strftime(f), d) for d in days for f in FORMS] + [(f"{d:%B} {d.day}", d.replace(year=2024)) for d in days]
    got = spark.createDataFrame(typed, "t string, d date").select(dates.flexible_date(F.col("t"), 2024), "d").collect()
    assert [r[0] for r in got] == [r[1] for r in got]


@pytest.mark.parametrize("typed", ["31 April 2021", "2021-13-01", "Smarch 4, 2021", "4 2021 June", "June 4 21", "4 June", "yesterday", "", "   ", None])
def test_flexible_date_reads_nothing_else(spark, typed):
    assert spark.createDataFrame([(typed,)], "t string").select(dates.flexible_date(F.col("t"), 2024)).first()[0] is None


def test_other_dates(spark):
    assert one(spark, dates.flexible_date(F.col("t"), 2024, "dd.MM.yy"), t="09.11.21") == dt.date(2021, 11, 9) == one(spark, dates.flexible_date(F.col("t"), 2024, "dd.MM.yy"), t="9 Nov 2021")
    assert one(spark, dates.rss_date(F.col("t")), t="Sun, 7 Sep 2025 23:59:00 -0800") == dt.date(2025, 9, 7)
    assert one(spark, dates.rss_date(F.col("t")), t="soon") is None
    assert one(spark, dates.month_year(F.col("t")), t="November 2021") == dt.date(2021, 11, 1)
    today = F.lit(dt.date(2024, 6, 1))
    parts = spark.createDataFrame([([2023, 4],), ([2023, 2, 31],), ([2030, 1, 1],), ([],), (None,)], "p array<int>").select(dates.from_parts(F.col("p"), today)).collect()
    assert [r[0] for r in parts] == [dt.date(2023, 4, 1)] + [dt.date(2024, 6, 1)] * 4
    assert one(spark, dates.last_boundary(F.to_timestamp("t")), t="2024-03-01 07:59:59") == dt.datetime(2024, 2, 29, 8)
    assert one(spark, dates.week_ending(F.to_date("t")), t="2024-03-03") == dt.date(2024, 3, 3)


def test_text_functions(spark):
    assert one(spark, T.strip_html(F.col("t")), t="<p>a&nbsp;<b>b</b>\n c</p>") == "a&nbsp; b c"
    assert one(spark, T.topic_key(F.col("t")), t="Housing Supply-Side") == "housing_supply_side"
    assert one(spark, T.host(F.col("t")), t="https://WWW.Site.example/a?b") == "www.site.example"
    assert one(spark, T.host_label(F.col("t"), "substack.com"), t="https://slow.substack.com/feed") == "slow"
    assert one(spark, T.title_case(F.col("t")), t="jane o'neil-smith") == "Jane O'Neil-Smith"
    assert one(spark, T.fenced_json(F.col("t")), t='so:\n```json\n{"a": 1}\n```') == '{"a": 1}' == one(spark, T.fenced_json(F.col("t")), t='```\n{"a": 1}')
    assert [one(spark, T.contains_name(F.col("t"), n), t="the mit lab, summit") for n in ("mit", "summit", "su")] == [True, True, False]
    assert [one(spark, T.needs_abstract(F.col("t")), t=x) for x in ("", "x" * 49, "x" * 50, " " * 60)] == [True, True, False, True]
    index = spark.createDataFrame([({"b": [1], "a": [0, 2], "c": [3]},)], "m map<string, array<int>>")
    assert index.select(T.from_inverted_index(F.col("m"))).first()[0] == "a b a c"


def abstracts(spark, *texts):
    return [r[0] for r in spark.createDataFrame([(t,) for t in texts], "t string").select(T.extractive_abstract(F.col("t"))).collect()]


def test_extractive_abstract_takes_the_first_sentences(spark):
    text = "Tiny start. <b>The ferry left the quay at seven in the morning.</b> Follow us for more news from the harbour today. Nobody on board had seen the second boat, they said; Its captain had not slept for two nights in a row,"
    assert abstracts(spark, text) == ["- The ferry left the quay at seven in the morning.\n- Nobody on board had seen the second boat, they said; Its captain had not slept for two..."]
    assert abstracts(spark, None, "", "Too short to say anything. It ends here.", "One long sentence only, " + "and on " * 20 + "to the end.") == [None] * 4


@settings(max_examples=10, deadline=None)
@given(st.lists(st.sampled_from(["Rain fell on the long road to the north.", "Share this page with all of your friends today.", "No.", "A " + "very " * 50 + "long way.", "Wind came up from the sea and " + "then " * 15 + "it went.", "The mill stood still for years after that"]), max_size=9))
def test_extractive_abstract_holds_whole_words_of_the_text(spark, sentences):
    text = " ".join(sentences)
    got = abstracts(spark, text)[0]
    if got is not None:
        bullets = got.split("\n")
        assert 2 <= len(bullets) <= 3 and all(b.startswith("- ") and b[-1] in ".!?" and len(b) <= 97 and "Share" not in b for b in bullets)
        assert all(w in text.split() for b in bullets for w in b[2:].rstrip(".").split()[:-1])
