"""Subject areas of documents: complement naive Bayes, refined by expectation-maximisation, with calibrated independent posteriors."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from heddle.functions.tables import has_text, materialize
from heddle.llm.words import chunks, words_of

FEATURES = 1 << 16  # words are hashed into so many features: the size of the model, whatever the vocabulary
SMOOTHING, ROUNDS, INNER, PRIOR, LABEL_WEIGHT = 0.5, 3, 6, 0.1, 4.0
MAX_LABELLED = 200_000  # documents with labels that the first model and the calibration take; beyond it a sample by hash of doc_id


def _tokenized(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Each text as the features of its words (uint16) and the number of words of each of its sentences (uint16; a longer one goes on in the next).

    A sentence ends at a full stop, question mark, exclamation mark or colon before white space or a closing quote, or at a line's end.
    """
    for b in batches:
        ids = b["doc_id"].to_numpy()
        for first, part in chunks(b["text"]):
            hashes, doc, start, _, chars = words_of(part)
            if not len(hashes):
                continue
            after = np.append(chars[1:], 10)
            stop = (chars == 10) | (np.isin(chars, (33, 46, 58, 63)) & np.isin(after, (9, 10, 13, 32, 34, 160, 0x201D)))
            mark = np.cumsum(stop)[start]
            new = np.ones(len(start), dtype=bool)
            new[1:] = (mark[1:] != mark[:-1]) | (doc[1:] != doc[:-1])
            begin = np.flatnonzero(new)
            length, owner = np.diff(np.append(begin, len(start))), doc[begin]
            feature = (hashes & np.uint64(FEATURES - 1)).astype("<u2")
            rows = []
            for d in np.unique(doc):
                own = length[np.searchsorted(owner, d) : np.searchsorted(owner, d, side="right")]
                while (own > 60_000).any():
                    own = np.concatenate([[60_000, x - 60_000] if x > 60_000 else [x] for x in own])
                rows.append((ids[first + d], feature[np.searchsorted(doc, d) : np.searchsorted(doc, d, side="right")].tobytes(), own.astype("<u2").tobytes()))
            yield pd.DataFrame(rows, columns=["doc_id", "words", "sentences"])


def _laid_out(b: pd.DataFrame) -> Iterator[tuple[slice, np.ndarray, np.ndarray, np.ndarray]]:
    """A batch in parts of some million words: rows, features, start of each sentence, and the row of each sentence within the part."""
    size = b["words"].map(len).to_numpy()
    at = 0
    while at < len(b):
        end = max(at + 1, int(np.searchsorted(np.cumsum(size[at:]), 2_000_000, side="right")) + at)
        part = b.iloc[at:end]
        feature = np.frombuffer(b"".join(part["words"]), dtype="<u2").astype(np.int64)
        length = np.frombuffer(b"".join(part["sentences"]), dtype="<u2").astype(np.int64)
        owner = np.repeat(np.arange(len(part)), part["sentences"].map(len).to_numpy() // 2)
        yield slice(at, end), feature, np.cumsum(length) - length, owner
        at = end


def _posteriors(weights: np.ndarray, feature: np.ndarray, start: np.ndarray, owner: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """The posterior of each subject for each sentence, the mixture of subjects of each document being estimated along with it."""
    score = np.add.reduceat(weights[feature], start, axis=0)
    like = np.exp(np.maximum(score - score.max(axis=1, keepdims=True), -60))
    n, k = len(labels), weights.shape[1]
    favour = np.where(labels > 0, LABEL_WEIGHT, 1.0)
    first = np.searchsorted(owner, np.arange(n))
    count = np.bincount(owner, minlength=n)[:, None]
    mixture = favour / favour.sum(axis=1, keepdims=True)
    for _ in range(INNER):
        p = like * mixture[owner]
        p /= p.sum(axis=1, keepdims=True)
        mixture = favour * (np.add.reduceat(p, first, axis=0) + PRIOR) / (count + PRIOR * k)
        mixture /= mixture.sum(axis=1, keepdims=True)
    return p


def _labels(b: pd.DataFrame, rows: slice, k: int) -> np.ndarray:
    out = np.zeros((rows.stop - rows.start, k))
    for i, own in enumerate(b["labels"].iloc[rows]):
        if own is not None:
            out[i, list(own)] = 1
    return out


def _expected(batches: Iterator[pd.DataFrame], weights: np.ndarray | None, k: int) -> Iterator[pd.DataFrame]:
    """Expected word counts of each subject and of all sentences over a task's documents; without a model, by the labels alone."""
    total = np.zeros((FEATURES, k + 1))
    for b in batches:
        for rows, feature, start, owner in _laid_out(b):
            labels = _labels(b, rows, k)
            if weights is None:
                p = (labels / labels.sum(axis=1, keepdims=True))[owner]
            else:
                p = _posteriors(weights, feature, start, owner, labels)
            by_word = np.repeat(p, np.diff(np.append(start, len(feature))), axis=0)
            for c in range(k):
                total[:, c] += np.bincount(feature, weights=by_word[:, c], minlength=FEATURES)
            total[:, k] += np.bincount(feature, minlength=FEATURES)
    seen = np.flatnonzero(total[:, k])
    out = pd.DataFrame(total[seen], columns=[f"c{i}" for i in range(k + 1)])
    out.insert(0, "feature", seen)
    yield out


def _shares(batches: Iterator[pd.DataFrame], weights: np.ndarray, k: int) -> Iterator[pd.DataFrame]:
    """Each document's share of sentences that treat each subject, and the number of its sentences. No labels are used."""
    for b in batches:
        for rows, feature, start, owner in _laid_out(b):
            n = rows.stop - rows.start
            p = _posteriors(weights, feature, start, owner, np.zeros((n, k)))
            treats = (p > 0.5).astype(float)
            count = np.bincount(owner, minlength=n)
            share = np.stack([np.bincount(owner, weights=treats[:, c], minlength=n) for c in range(k)], axis=1) / count[:, None]
            mean = np.stack([np.bincount(owner, weights=p[:, c], minlength=n) for c in range(k)], axis=1) / count[:, None]
            yield pd.DataFrame({"doc_id": b["doc_id"].iloc[rows].to_numpy(), "n_sentences": count, "shares": list(share), "means": list(mean)})


def complement_weights(counts: np.ndarray) -> np.ndarray:
    """Complement naive Bayes from expected counts (features x subjects, the last column all words): how little a word is to be expected outside a subject."""
    outside = np.maximum(counts[:, -1:] - counts[:, :-1], 0) + SMOOTHING
    w = -np.log(outside / outside.sum(axis=0))
    return (w - w.mean(axis=1, keepdims=True)).astype(np.float32)


def calibrated(bins: np.ndarray) -> tuple[float, float]:
    """(steepness, middle) of the logistic in the share that best explains labels: ``bins`` has for each hundredth the labelled documents
    without and with the label. Labels are noisy: the curve runs between a rate of wrong labels and one of labels not left out, both fitted."""
    x = np.arange(len(bins)) / (len(bins) - 1)
    best = (-np.inf, 60.0, 0.15)
    for m in np.arange(0.04, 0.41, 0.01):
        for s in (30.0, 60.0, 120.0):
            t = 1 / (1 + np.exp(-s * (x - m)))
            for low in (0.001, 0.005, 0.01, 0.02, 0.05):
                for high in (0.6, 0.7, 0.8, 0.85, 0.9, 0.95, 0.99):
                    p = low + (high - low) * t
                    fit = (bins[:, 1] * np.log(p) + bins[:, 0] * np.log(1 - p)).sum()
                    if fit > best[0]:
                        best = (fit, s, m)
    return best[1], best[2]


def subject_posteriors(docs: DataFrame, labels: DataFrame, subjects: DataFrame, id_col: str = "doc_id", text: str = "text", label_id: str = "doc_id", max_labelled: int = MAX_LABELLED, rounds: int = ROUNDS) -> DataFrame:
    """``doc_id, subject, share, posterior, assigned``: a row for every subject with a share of a document's sentences.

    Complement naive Bayes is trained on the labelled documents. Each round of expectation-maximisation then goes over all
    documents: every sentence gets its subjects' posteriors under the document's own mixture of subjects, and the expected word counts, summed in
    Spark, make the next model. The model has FEATURES rows, so what comes to the driver and goes to the tasks doesn't grow with the documents.
    The share of sentences that treat a subject is turned into a posterior per subject by a logistic fitted to the labelled documents; a subject is
    assigned from 0.5 up, and the likeliest one where none reaches it. Null and "" texts, texts without words and rows without an id have no rows; unknown
    labels and repeated ones count for nothing; without labels or subjects there are no rows. A doc_id that comes twice has a row for each.
    """
    names = [r[0] for r in subjects.where("subject is not null").select("subject").distinct().orderBy("subject").collect()]
    k = len(names)
    spark = docs.sparkSession
    schema = "doc_id bigint, subject string, share double, posterior double, assigned boolean"
    rows = docs.where(has_text(F.col(text)) & F.col(id_col).isNotNull()).select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    if not k:
        return spark.createDataFrame([], schema)
    number = F.create_map(*[x for i, n in enumerate(names) for x in (F.lit(n), F.lit(i))])
    own = labels.select(F.col(label_id).cast("bigint").alias("doc_id"), F.try_element_at(number, F.col("subject")).alias("c"))
    held = own.where("c is not null and doc_id is not null").groupBy("doc_id").agg(F.sort_array(F.collect_set("c")).alias("labels"))
    n_labelled = held.count()
    if n_labelled > max_labelled:
        held = held.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < int(1e6 * max_labelled / n_labelled))
    tokens = materialize(rows.mapInPandas(_tokenized, "doc_id bigint, words binary, sentences binary").join(held, "doc_id", "left"))

    columns = ", ".join(["feature int", *(f"c{i} double" for i in range(k + 1))])

    def counted(over: DataFrame, weights: np.ndarray | None) -> np.ndarray:
        sums = over.mapInPandas(lambda it: _expected(it, weights, k), columns).groupBy("feature").agg(*(F.sum(f"c{i}").alias(f"c{i}") for i in range(k + 1))).toPandas()
        out = np.zeros((FEATURES, k + 1))
        out[sums["feature"].to_numpy()] = sums.drop(columns="feature").to_numpy()
        return out

    counts = counted(tokens.where("labels is not null"), None)
    if not counts.any():
        return spark.createDataFrame([], schema)
    weights = complement_weights(counts)
    for _ in range(rounds):
        weights = complement_weights(counted(tokens, weights))
    final = weights
    shares = materialize(tokens.mapInPandas(lambda it: _shares(it, final, k), "doc_id bigint, n_sentences bigint, shares array<double>, means array<double>"))

    each = shares.join(held, "doc_id").select("labels", F.posexplode("shares").alias("c", "share"))
    table = each.groupBy("c", F.round(F.col("share") * 100).cast("int").alias("bin"), F.array_contains("labels", F.col("c")).alias("y")).agg(F.count("*").alias("n")).collect()
    bins = np.zeros((k, 101, 2))
    for r in table:
        bins[r["c"], r["bin"], int(r["y"])] = r["n"]
    pooled = bins.sum(axis=0)
    curves = [calibrated(bins[c] + pooled) for c in range(k)]  # few labels lie near the middle, so each subject leans on all
    steep, middle = (F.array(*[F.lit(float(x[i])) for x in curves]) for i in (0, 1))
    posterior = 1 / (1 + F.exp(-F.element_at(steep, F.col("c") + 1) * (F.col("share") - F.element_at(middle, F.col("c") + 1))))
    subject = F.element_at(F.array(*map(F.lit, names)), F.col("c") + 1)
    # the likeliest subject of each document, within its row of shares
    any_over = F.exists(F.zip_with("shares", middle, lambda x, m: x >= m), lambda y: y)
    flags = shares.select("doc_id", F.posexplode(F.arrays_zip("shares", "means")).alias("c", "v"), F.array_position("means", F.array_max("means")).alias("first"), any_over.alias("any_over"))
    out = flags.select("doc_id", "c", F.col("v.shares").alias("share"), "first", "any_over").withColumn("posterior", posterior)
    assigned = (F.col("posterior") >= 0.5) | (~F.col("any_over") & (F.col("c") + 1 == F.col("first")))
    return out.select("doc_id", subject.alias("subject"), "share", F.round("posterior", 6).alias("posterior"), assigned.alias("assigned")).where("share > 0 or assigned")


def composition(posteriors: DataFrame) -> DataFrame:
    """``subject, n_docs, share_docs, mean_share``: the corpus by subject; a document of two subjects counts for both."""
    docs = posteriors.select("doc_id").distinct().agg(F.count("*").alias("n_all"))
    per = posteriors.groupBy("subject").agg(F.count_if("assigned").alias("n_docs"), F.sum("share").alias("s"))
    return per.join(F.broadcast(docs)).select("subject", "n_docs", F.round(F.col("n_docs") / F.col("n_all"), 6).alias("share_docs"), F.round(F.col("s") / F.col("n_all"), 6).alias("mean_share"))
