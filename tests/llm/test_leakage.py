import random

import numpy as np

from heddle.llm import leakage

R = random.Random(8)
V = [f"word{i}" for i in range(2000)]


def text(n):
    return " ".join(R.choice(V) for _ in range(n))


def truth(docs, items):
    out = set()
    for i, t in items:
        w = (t or "").lower().split()
        three = {tuple(w[k : k + 3]) for k in range(len(w) - 2)}
        long = {tuple(w[k : k + 12]) for k in range(len(w) - 11)}
        for d, s in docs:
            x = (s or "").lower().split()
            own = {tuple(x[k : k + 3]) for k in range(len(x) - 2)}
            if three and (len(three & own) >= 0.6 * len(three) or long & {tuple(x[k : k + 12]) for k in range(len(x) - 11)}):
                out.add((d, i))
    return out


def test_against_brute_force(spark):
    items = [(i, text(R.choice([4, 6, 20, 60, 100]))) for i in range(40)] + [(90, None), (91, ""), (92, "one two")]
    docs = []
    for d in range(160):
        i, t = items[d % 40]
        w = t.split()
        kind = d % 5
        if kind == 0:
            part = t
        elif kind == 1:
            part = " ".join(w[: R.choice([11, 12, 13])])
        elif kind == 2:  # a word exchanged here and there
            part = " ".join(R.choice(V) if k % R.choice([6, 8, 11]) == 0 else x for k, x in enumerate(w))
        elif kind == 3:  # a word put in every five to nine
            n = R.choice([5, 6, 7, 9])
            part = " ".join(x + (" " + R.choice(V) if k % n == n - 1 else "") for k, x in enumerate(w))
        else:
            part = ""
        docs.append((d, f"{text(30)} {part.upper()} {text(30)}"))
    docs += [(500, None), (501, ""), (502, text(40000) + " " + items[3][1] + " " + items[4][1])]
    df = spark.createDataFrame([(*x, 1, "y") for x in [*docs, docs[0], (None, "a b c")]], "doc_id bigint, text string, item_id int, share string")
    test = spark.createDataFrame([(*x, "s", 2) for x in items], "item_id bigint, text string, suite string, doc_id int")
    found = leakage.leaked(df, test)
    got = [(r.doc_id, r.item_id) for r in found.collect()]
    assert len(got) == len(set(got)) and set(got) == truth(docs, items)
    report = {r.item_id: r.n_docs for r in leakage.leak_report(found, test).collect()}
    assert report[90] == 0 and sum(report.values()) == len(got)


def test_empty_tables(spark):
    items = [(i, text(40)) for i in range(9)]
    docs = spark.createDataFrame([(i, t) for i, t in items], "doc_id bigint, text string")
    test = spark.createDataFrame(items, "item_id bigint, text string")
    assert leakage.leaked(docs, test).count() == 9
    assert leakage.leaked(docs.limit(0), test).count() == 0 and leakage.leaked(docs, test.limit(0)).count() == 0


def test_blocks_hold_every_fingerprint_within_the_radius():
    rng = np.random.default_rng(3)
    a = rng.integers(0, 2**64, 2000, dtype=np.uint64)
    for bits in range(leakage.RADIUS + 2):
        b = a.copy()
        for i in range(len(b)):
            for k in rng.choice(64, bits, replace=False):
                b[i] ^= np.uint64(1) << np.uint64(k)
        agree = np.any([x == y for x, y in zip(leakage._keys(a, 5), leakage._keys(b, 5))], axis=0)
        assert agree.all() if bits <= leakage.RADIUS else not agree.all()
    assert not set(leakage._keys(a, 5)[0]) & set(leakage._keys(a, 3)[0])


def test_an_instruction_that_all_items_share_makes_no_candidates(spark):
    ask = text(11)
    items = [(i, f"{ask} {text(60)}") for i in range(50)]
    docs = [(i, f"{text(40)} before{i} {ask} after{i} {text(40)}") for i in range(50)] + [(99, items[7][1])]
    pair = lambda rows, c: spark.createDataFrame(rows, f"{c} bigint, text string")
    got = leakage.candidates(pair(docs, "doc_id"), pair(items, "item_id"))
    assert (99, 7) in {tuple(r) for r in got.collect()} and got.count() < 60
    found = {r.item_id: r for r in leakage.leaked(pair(docs, "doc_id"), pair(items, "item_id")).collect()}
    assert list(found) == [7] and found[7].share == 1.0 and found[7].weighted == 1.0


def test_weights_by_rarity(spark):
    shared, own = text(30), [text(20) for _ in range(10)]
    items = spark.createDataFrame([(i, f"{shared} {own[i]}") for i in range(10)], "item_id bigint, text string")
    docs = spark.createDataFrame([(0, shared), (1, own[3])], "doc_id bigint, text string")
    got = {(r.doc_id, r.item_id): r for r in leakage.leaked(docs, items).collect()}
    assert len(got) == 11 and got[(0, 3)].weighted < 0.2 < 0.5 < got[(0, 3)].share and got[(1, 3)].weighted > 0.7 > got[(1, 3)].share


def test_short_items_with_words_put_in_are_found(spark):
    def parted(words, *sizes):
        out = []
        for k, n in enumerate(sizes):
            out += [*words[:n], f"gap{k}"]
            words = words[n:]
        return " ".join(out)

    items = {i: [f"i{i}w{j}" for j in range(n)] for i, n in enumerate((12, 22, 47))}
    docs = [(0, parted(items[0], 4, 4, 4)), (1, parted(items[1], 5, 5, 4, 4, 4)), (2, parted(items[2], *[5] * 7, *[4] * 3))]
    found = leakage.leaked(spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame([(i, " ".join(w)) for i, w in items.items()], "item_id bigint, text string"))
    assert sorted((r.doc_id, r.item_id, r.has_run) for r in found.collect()) == [(0, 0, False), (1, 1, False), (2, 2, False)]
