import random

import numpy as np

from heddle.llm import subjects

R = random.Random(6)
WORDS = {s: [f"{s}term{'x' * i}" for i in range(25)] for s in ("law", "sport", "space")}
COMMON = ["the", "panel", "said", "that", "most", "years", "were", "slow", "in", "town"]


def sentence(s):
    return " ".join(R.choice(COMMON) if R.random() < 0.6 else R.choice(WORDS[s]) for _ in range(10)).capitalize() + "."


def document(mix):
    return " ".join(sentence(s) for s, n in mix for _ in range(n))


def test_held_out_accuracy(spark):
    docs, truth, labels = [], {}, []
    for d in range(400):
        a, b = R.sample(list(WORDS), 2)
        mix = [(a, 10)] if d % 2 else [(a, 6), (b, 4)]
        docs.append((d, document(mix), "x", 1))
        truth[d] = {s for s, _ in mix}
        if d % 8 == 0 or d % 8 == 3:
            labels += [(d, s, "y") for s in truth[d]]
    labels += [(3, "unknown", "y"), (None, "law", "y"), labels[0]]
    docs += [(900, None, "x", 1), (901, "", "x", 1), (902, "...", "x", 1), (None, "law", "x", 1), (903, document([("law", 300)]), "x", 1)]
    frame = spark.createDataFrame(docs, "doc_id bigint, text string, subject string, labels int")
    names = spark.createDataFrame([(s, "n") for s in [*WORDS, None]], "subject string, name string")
    got = subjects.subject_posteriors(frame, spark.createDataFrame(labels, "doc_id bigint, subject string, share string"), names).where("assigned").collect()
    found = {}
    for r in got:
        found.setdefault(r.doc_id, set()).add(r.subject)
    assert set(found) == set(truth) | {903} and found[903] == {"law"}
    held = [d for d in truth if d % 8 not in (0, 3)]
    assert np.mean([found[d] == truth[d] for d in held]) > 0.97


def test_nothing_to_learn_from(spark):
    docs = spark.createDataFrame([(1, "some text here")], "doc_id bigint, text string")
    labels = spark.createDataFrame([], "doc_id bigint, subject string")
    names = spark.createDataFrame([("law",)], "subject string")
    assert subjects.subject_posteriors(docs, labels, names).count() == 0
    assert subjects.subject_posteriors(docs, labels, names.limit(0)).count() == 0
    assert subjects.subject_posteriors(docs.limit(0), labels, names).count() == 0


def test_calibration_finds_the_step():
    bins = np.zeros((101, 2))
    bins[:12, 0], bins[18:, 1], bins[18:, 0] = 50, 20, 3
    _, middle = subjects.calibrated(bins)
    assert 0.11 <= middle <= 0.19
