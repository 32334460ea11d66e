from hypothesis import given
from hypothesis import strategies as st

from heddle.llm import names
from heddle.operators.packed import PRIOR, Code


def osa(a, b):
    d = [[max(i, j) if 0 in (i, j) else 0 for j in range(len(b) + 1)] for i in range(len(a) + 1)]
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            d[i][j] = min(d[i - 1][j] + 1, d[i][j - 1] + 1, d[i - 1][j - 1] + (a[i - 1] != b[j - 1]))
            if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                d[i][j] = min(d[i][j], d[i - 2][j - 2] + 1)
    return d[-1][-1]


@given(st.text("abc", max_size=7), st.text("abc", max_size=7))
def test_near_is_the_ball_of_the_metric(a, b):
    assert names.near(a, b) == (osa(a, b) <= 1)


def test_radius_join_is_exact(spark):
    import itertools
    import random

    r = random.Random(2)
    keys = {"".join(r.choice("abcdefgh") for _ in range(r.randint(3, 6))) for _ in range(400)}
    got = {tuple(x) for x in names.radius_join(spark.createDataFrame([(k,) for k in keys], "key string")).collect()}
    assert got == {(a, b) for a, b in itertools.combinations(sorted(keys), 2) if osa(a, b) == 1}


def test_readings():
    code = Code(PRIOR)
    read = lambda n: names.reading(n, code)
    assert read("Lumnisige, Edward") == read("Edward Lumnisige") == ("full", "lumnisige", "edward", "e")
    assert read("E. L. Lumnisige")[:3] == ("initial", "lumnisige", "") and read("Lumnisige EL") == read("EL Lumnisige")
    assert read("Prof. Edward Lumnisige PhD")[1:3] == ("lumnisige", "edward")
    assert read("The Birdefa Lab. of Public Accounts, Inc.")[1] == read("Birdefa Public Accounts Laboratory")[1]
    assert read("Staff")[0] == read("")[0] == read("  ")[0] == "none"


def test_variants(spark):
    people = ["Edward Lumnisige", "Helga Pimvadiba", "Yusuf Schelmirtuzu", "Bianca Rampimabi", "Walter Korsalefe", "Nadia Lunvifute"]
    rows = [(i, n) for i, n in enumerate(people * 6)]
    variants = ["Lumnisige, Edward", "Ted Lumnisige", "E. Lumnisige", "Edwrad Lumnisige", "EDWARD LUMNISIGE", "Helga Lumnisige", "Sarbomeni Council on Public Accounts", "Sarbomeni Cncl. on Public Accounts", "Staff", "H. Pimvadiba"]
    rows += [(100 + i, v) for i, v in enumerate(variants)] + [(200, None), (201, ""), (None, "Edward Lumnisige")]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "id bigint, authors string, name string, entity int")
    e = {r.name: r.entity for r in names.entities(df, "id", "authors").collect()}
    same = ["Edward Lumnisige", "Lumnisige, Edward", "Ted Lumnisige", "E. Lumnisige", "Edwrad Lumnisige", "EDWARD LUMNISIGE"]
    assert len({e[n] for n in same}) == 1 and e["Helga Lumnisige"] != e["Edward Lumnisige"] and e["Helga Lumnisige"] != e["Helga Pimvadiba"]
    assert e["Sarbomeni Council on Public Accounts"] == e["Sarbomeni Cncl. on Public Accounts"] and "Staff" not in e
    assert e["H. Pimvadiba"] == e["Helga Pimvadiba"]
    pairs = {tuple(r) for r in names.variants(df, "id", "authors").collect()}
    assert ("E. Lumnisige", "Edward Lumnisige") in pairs and all(a < b for a, b in pairs)


def test_short_forms_without_the_formal_name(spark):
    people = ["Sam Schirvabega", "Jen Heskagamu", "Jenny Heskagamu", "Alex Korsalefe", "Sandy Korsalefe", "Sam Lunvifute", "Sammy Lunvifute", "Jenny Rampimabi", "John Rampimabi", "Bill Lumnisige", "William Lumnisige", "Chris Pimvadiba", "Christopher Pimvadiba", "Christine Pimvadiba"]
    alone = ["S. Schirvabega", "J. Heskagamu", "S. Lunvifute", "J. Rampimabi", "W. Lumnisige", "C. Pimvadiba"]
    df = spark.createDataFrame([*enumerate(people * 6), *enumerate(alone, 100)], "id bigint, authors string")
    e = {r.name: r.entity for r in names.entities(df, "id", "authors").collect()}
    assert e["S. Schirvabega"] == e["Sam Schirvabega"] and e["Jen Heskagamu"] == e["Jenny Heskagamu"] == e["J. Heskagamu"]
    assert e["Alex Korsalefe"] == e["Sandy Korsalefe"] and e["W. Lumnisige"] == e["Bill Lumnisige"] == e["William Lumnisige"]
    # several fit: Samuel or Samantha, John or Jenny, one of two Chrises
    assert len({e[n] for n in ("Sam Lunvifute", "Sammy Lunvifute", "S. Lunvifute")}) == 3 and len({e[n] for n in ("Jenny Rampimabi", "John Rampimabi", "J. Rampimabi")}) == 3
    assert len({e[n] for n in (*people[-3:], "C. Pimvadiba")}) == 4 and len(e) == len(people) + len(alone)


def test_initials_that_contradict_are_not_one(spark):
    people = ["Helga Pimvadiba", "Edward Lumnisige"]
    alone = ["K. A. Zorbalefe", "K. B. Zorbalefe", "K. Zorbalefe", "Zorbalefe KA", "M. Q. Trovimabi", "M. Trovimabi", "Trovimabi, M.Q."]
    df = spark.createDataFrame([*enumerate(people * 6), *enumerate(alone, 100)], "id bigint, authors string")
    e = {r.name: r.entity for r in names.entities(df, "id", "authors").collect()}
    assert len({e[n] for n in alone[:3]}) == 3 and e["K. A. Zorbalefe"] == e["Zorbalefe KA"]
    assert len({e[n] for n in alone[4:]}) == 1 and e["M. Trovimabi"] != e["K. Zorbalefe"]


def test_empty(spark):
    assert names.variants(spark.createDataFrame([], "id bigint, authors string"), "id", "authors").count() == 0
