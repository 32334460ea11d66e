import math
import random

from hypothesis import given
from hypothesis import strategies as st

from heddle.llm import packing


@given(st.lists(st.integers(0, 50), max_size=60))
def test_pack_keeps_the_rules(sizes):
    at = packing.pack(sizes, 50)
    used = {}
    for s, a in zip(sizes, at):
        used[a] = used.get(a, 0) + s
    assert all(u <= 50 for u in used.values()) and set(used) == set(range(len(used)))


def test_pack_is_tight():
    r = random.Random(1)
    sizes = [r.randint(1, 600) for _ in range(3000)]
    assert max(packing.pack(sizes, 1000)) + 1 <= math.ceil(sum(sizes) / 1000) * 1.01


def test_containers(spark):
    r = random.Random(4)
    rows = [(i, r.choice([0, 5, 40, 99, 100, 101, 250, 300, 777])) for i in range(500)]
    sizes = spark.createDataFrame(rows, "doc_id bigint, n_tokens bigint")
    targets = spark.createDataFrame([("t", 100, "x"), ("u", 1000, "y"), ("none", None, "z"), ("bad", 0, "z")], "target_name string, capacity int, block string")
    got = packing.packed(sizes, targets, block=120).collect()
    assert {x.target_name for x in got} == {"t", "u"}
    for name, capacity in (("t", 100), ("u", 1000)):
        own = [x for x in got if x.target_name == name]
        by = {}
        for x in own:
            by.setdefault(x.container, []).append(x)
        assert sorted(by) == list(range(1, len(by) + 1)) and all(sum(x.n_tokens for x in c) <= capacity for c in by.values())
        pieces = {}
        for x in own:
            pieces.setdefault(x.doc_id, []).append((x.piece_no, x.start_token, x.n_tokens))
        assert len(pieces) == 500
        for doc, n in rows:
            p = sorted(pieces[doc])
            assert len(p) == max(1, math.ceil(n / capacity)) and sum(x[2] for x in p) == n and [x[1] for x in p] == [capacity * i for i in range(len(p))]


def test_sizes_nulls_and_empty(spark):
    docs = spark.createDataFrame([(1, "Hello world", 9), (2, "", 9), (3, None, 9), (None, "x", 9), (4, "word " * 30000, 9), (1, "Hello world", 9)], "doc_id bigint, text string, n_tokens int")
    assert sorted((r.doc_id, r.n_tokens) for r in packing.token_sizes(docs, "doc_id", "text").collect()) == [(1, 2), (1, 2), (2, 0), (3, 0), (4, 30001)]
    targets = spark.createDataFrame([("t", 100)], "target_name string, capacity int")
    assert packing.packed(spark.createDataFrame([], "doc_id bigint, n_tokens bigint"), targets).count() == 0
