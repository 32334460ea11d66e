import random

import numpy as np
from pyspark.sql import functions as F

from heddle.llm import similar
from heddle.llm.words import runs, words_of

R = random.Random(5)
VOCABULARY = [f"w{i}" for i in range(3000)]


def text(n):
    return " ".join(R.choice(VOCABULARY) for _ in range(n))


def jaccard(a, b, k=3):
    def s(t):
        w = t.lower().split()
        return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)}

    x, y = s(a), s(b)
    return len(x & y) / max(1, len(x | y))


def edited(t, n):
    w = t.split()
    for _ in range(n):
        w[R.randrange(len(w))] = R.choice(VOCABULARY)
    return " ".join(w)


def test_words_are_runs_of_letters_and_digits():
    hashes, doc, start, end, chars = words_of(["Café-au lait_2, ÉTÉ", "", "été 漢字"])
    got = ["".join(map(chr, chars[s:e])) for s, e in zip(start, end)]
    assert got == ["café", "au", "lait", "2", "été", "été", "漢字"] and list(doc) == [0, 0, 0, 0, 0, 2, 2]
    assert hashes[4] == hashes[5] and len(set(hashes)) == 6
    assert len(runs(hashes, doc, 3)[0]) == 3


def test_sketches_fill_and_estimate():
    rng = np.random.default_rng(1)
    a = rng.integers(0, 2**63, 300, dtype=np.uint64)
    b = np.concatenate([a[:200], rng.integers(0, 2**63, 100, dtype=np.uint64)])
    s = similar.sketches(np.concatenate([a, b, a[:3]]), np.repeat([0, 1, 2], [300, 300, 3]), 4, 512)
    full = np.uint64(0xFFFFFFFFFFFFFFFF)
    assert (s[:3] != full).all() and (s[3] == full).all()
    assert abs((s[0] == s[1]).mean() - 0.5) < 0.08


def test_pairs_against_brute_force(spark):
    base = [text(120) for _ in range(60)]
    rows = [(i, t) for i, t in enumerate(base)] + [(100 + i, edited(t, 1 + i % 12)) for i, t in enumerate(base)] + [(500, base[0]), (501, base[0]), (502, "two words"), (503, ""), (504, None), (500, base[0])]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "id bigint, text string, rep int, bucket string")
    links, member = similar.similar_pairs(df, "id", F.col("text"), 0.5, 3)
    got = {tuple(r) for r in similar.all_pairs(links, member).collect()}
    texts = dict(rows)
    true = {(a, b) for a in texts for b in texts if a < b and texts[a] and texts[b] and (jaccard(texts[a], texts[b]) >= 0.5 or texts[a] == texts[b])}
    assert got <= true and len(got) >= 0.95 * len(true)
    assert {(a, b) for a, b in true if jaccard(texts[a], texts[b]) >= 0.65} <= got
    groups = {r.item_id: r for r in similar.groups(links, member).collect()}
    assert groups[500].class_id == 0 and groups[501].class_id == 0 and groups[504].n_links == 0 and groups[100].group_id == 0


def test_a_large_bucket_is_parted_not_dropped(spark, monkeypatch):
    monkeypatch.setattr(similar, "CELL", 5)
    t = text(200)
    df = spark.createDataFrame([(i, t + " " + VOCABULARY[i]) for i in range(30)], "id bigint, text string")
    links, _ = similar.similar_pairs(df, "id", F.col("text"), 0.8, 5)
    assert links.count() == 30 * 29 // 2


def test_cells_hold_each_pair_of_a_bucket_once(spark, monkeypatch):
    monkeypatch.setattr(similar, "CELL", 7)
    held = spark.createDataFrame([(r, b, n) for b, n in ((1, 40), (2, 7), (3, 2)) for r in range(n)], "rep bigint, bucket bigint, n bigint")
    cells = {}
    for c, side, rep in similar._cells(held).collect():
        cells.setdefault(c, []).append((side, rep))
    pairs = [tuple(sorted((x[1], y[1]))) for own in cells.values() for i, x in enumerate(own) for y in own[:i] if x[0] == 2 or x[0] != y[0]]
    want = [(i, j) for n in (40, 7, 2) for j in range(n) for i in range(j)]
    assert sorted(pairs) == sorted(want) and max(map(len, cells.values())) < 40


def test_a_large_bucket_keeps_pairs_at_the_threshold(spark, monkeypatch):
    """1,000 classes in one bucket, 500 pairs of them at 0.5 to 0.6: none of them is lost, and nothing else is found."""

    def pair(i):
        shared = text(81 + i % 9).split()
        return (" ".join(shared + text(120 - len(shared)).split()) for _ in range(2))

    rows = [(2 * i + j, t) for i in range(500) for j, t in enumerate(pair(i))]
    assert all(0.5 <= jaccard(rows[2 * i][1], rows[2 * i + 1][1]) <= 0.6 for i in range(500))
    df = spark.createDataFrame(rows, "id bigint, text string")
    one = similar._rows(df, "id", F.col("text")).select("rep", F.lit(1).cast("bigint").alias("bucket"), F.lit(1000).alias("n"))
    monkeypatch.setattr(similar, "_buckets", lambda *_: one)
    links, member = similar.similar_pairs(df, "id", F.col("text"), 0.5, 3)
    assert {tuple(r) for r in similar.all_pairs(links, member).collect()} == {(2 * i, 2 * i + 1) for i in range(500)}


def test_bands_alone_lose_few_pairs_at_the_threshold(spark):
    def pair(i):
        shared = text(82 + i % 9).split()
        return (" ".join(shared + text(120 - len(shared)).split()) for _ in range(2))

    rows = [(2 * i + j, t) for i in range(400) for j, t in enumerate(pair(i))]
    links, _ = similar.similar_pairs(spark.createDataFrame(rows, "id bigint, text string"), "id", F.col("text"), 0.5, 3)
    assert links.count() >= 0.97 * 400


def test_components_and_empty(spark):
    edges = spark.createDataFrame([(1, 2), (2, 3), (9, 8), (3, 4), (5, 5), (4, 7), (7, 6)], "a bigint, b bigint")
    assert {tuple(r) for r in similar.components(edges).collect()} == {(1, 1), (2, 1), (3, 1), (4, 1), (6, 1), (7, 1), (8, 8), (9, 8)}
    none = spark.createDataFrame([], "id bigint, text string")
    links, member = similar.similar_pairs(none, "id", F.col("text"))
    assert links.count() == 0 and similar.groups(links, member).count() == 0
