"""Evaluation texts leaking into training text: fingerprints of windows, multi-index Hamming blocks, exact verification.

Test items and documents are laid out in windows of words. A window's fingerprint is the SimHash of its word shingles; its 64 bits
are held in RADIUS + 1 blocks, so that any two fingerprints within RADIUS agree in a block, and the blocks are what documents and items are
joined by. A candidate is verified by the shingles and runs of both whole texts.

No leak is missed: a run of RUN words holds RUN - WINDOW + 1 windows that stand in both texts. A document that keeps SHARE of an item's
three-word runs, with words put in, left out or exchanged, loses two runs or more at each gap, and holds as many windows if the item has more than
45 runs; shorter items are looked up by windows of one shingle. As a leak has so many windows, an item's RUN - WINDOW commonest ones (an
instruction that many items share) needn't be looked up.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from heddle.functions.tables import broadcast_if_small, has_text, materialize
from heddle.llm.similar import bitmap_of, in_bitmap
from heddle.llm.words import chunks, mix, runs, words_of

WINDOW, SHINGLE, RADIUS = 5, 3, 1
RUN, SHARE = 12, 0.6
MAX_KEYS = 200_000  # blocks of items that may go to all tasks, 24 bytes each; beyond that documents and items are shuffled by block
PAIRS = 2_000  # pairs that are verified together, about


def fingerprints(hashes: np.ndarray, doc: np.ndarray, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """SimHash of every window of ``window`` words that lies within one text, and the index of its first word.

    A window has an odd number of shingles, so no vote is tied, and one shingle exchanged changes about a quarter of the bits.
    """
    shingle, _ = runs(hashes, doc, SHINGLE)
    n = len(hashes) - window + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
    starts = np.flatnonzero(doc[:n] == doc[window - 1 :])
    # a text of m words has m - SHINGLE + 1 shingles, so the shingle that starts at word i is number i - (SHINGLE - 1) * texts before it
    lengths = np.bincount(doc)
    short = np.minimum(lengths, SHINGLE - 1)
    first = starts - (np.cumsum(short) - short)[doc[starts]]
    k = window - SHINGLE + 1
    out = np.zeros(len(starts), dtype=np.uint64)
    bits = mix(shingle + np.uint64(0x9E3779B97F4A7C15))
    for b in range(64):
        vote = ((bits >> np.uint64(b)) & np.uint64(1)).astype(np.int8) * np.int8(2) - np.int8(1)
        total = np.zeros(len(starts), dtype=np.int8)
        for j in range(k):
            total += vote[first + j]
        out |= (total > 0).astype(np.uint64) << np.uint64(b)
    return out, starts


def _keys(prints: np.ndarray, window: int) -> list[np.ndarray]:
    """A key for each block of each fingerprint, distinct for windows of each size."""
    bits = 64 // (RADIUS + 1)
    mask = np.uint64((1 << bits) - 1)
    return [mix(((prints >> np.uint64(bits * k)) & mask) ^ mix(np.array([window * 64 + k + 1], dtype=np.uint64))).view(np.int64) for k in range(RADIUS + 1)]


def _looked_up(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The fingerprints of each item's windows, with how many windows have each, and how many of an item's windows may be left out."""
    for b in batches:
        ids = b["item_id"].to_numpy()
        for first, part in chunks(b["text"]):
            hashes, doc, *_ = words_of(part)
            three, at3 = runs(hashes, doc, SHINGLE)
            n = np.array([len(np.unique(three[at3 == i])) for i in range(len(part))])
            # k stretches of an item of n runs hold n + 2 - 2k of them and n + 2 - 4k windows, so with SHARE of the runs n / 5 - 2 windows at least
            short = np.ceil(SHARE * n / (WINDOW - SHINGLE + 1)) - 2 < RUN - WINDOW + 1
            for size, spare, mine in ((WINDOW, RUN - WINDOW, ~short), (SHINGLE, 0, short)):
                prints, starts = fingerprints(hashes, doc, size)
                own = doc[starts]
                keep = mine[own] if len(own) else np.zeros(0, dtype=bool)
                yield pd.DataFrame({"item_id": ids[first + own[keep]], "print": prints[keep].view(np.int64), "size": size, "spare": spare})


def _blocked(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        for size in (WINDOW, SHINGLE):
            own = b[b["size"] == size]
            for key in _keys(own["print"].to_numpy().view(np.uint64), size):
                yield pd.DataFrame({"key": key, "own": own["print"].to_numpy(), "item_id": own["item_id"].to_numpy()})


def _met(batches: Iterator[pd.DataFrame], bitmap: np.ndarray, sizes: list[int]) -> Iterator[pd.DataFrame]:
    """The blocks of each document's windows that some item may have, each once a document."""
    for b in batches:
        ids = b["doc_id"].to_numpy()
        for first, part in chunks(b["text"]):
            hashes, doc, *_ = words_of(part)
            for size in sizes:
                prints, starts = fingerprints(hashes, doc, size)
                own = doc[starts]
                for key in _keys(prints, size):
                    hit = in_bitmap(bitmap, key)
                    yield pd.DataFrame({"key": key[hit], "print": prints[hit].view(np.int64), "doc_id": ids[first + own[hit]]}).drop_duplicates()


def _profiles(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Each item's distinct shingles and its runs of RUN words."""
    for b in batches:
        ids = b["item_id"].to_numpy()
        for first, part in chunks(b["text"]):
            hashes, doc, *_ = words_of(part)
            (three, at3), (long, at12) = runs(hashes, doc, SHINGLE), runs(hashes, doc, RUN)
            yield pd.DataFrame([(ids[first + i], np.unique(three[at3 == i]).view(np.int64), np.unique(long[at12 == i]).view(np.int64)) for i in range(len(part))], columns=["item_id", "three", "long"])


def _verified(pairs: pd.DataFrame, texts: pd.DataFrame) -> pd.DataFrame:
    """Of each document and its candidates: the share of the item's shingles it holds, each counted once and by its weight, and whether it holds a run."""
    items = {r.id: (r.three, r.weights, r.long) for r in texts[texts["text"].isna()].itertuples(index=False)}
    asked = pairs.groupby("doc_id")["item_id"].agg(list)
    held = texts[texts["text"].notna() & texts["id"].isin(asked.index)]
    ids, out = held["id"].to_numpy(), []
    for first, part in chunks(held["text"]):
        hashes, doc, *_ = words_of(part)
        (three, at3), (long, at12) = runs(hashes, doc, SHINGLE), runs(hashes, doc, RUN)
        for d in range(len(part)):
            own3, own12 = (np.unique(x[np.searchsorted(at, d) : np.searchsorted(at, d, side="right")].view(np.int64)) for x, at in ((three, at3), (long, at12)))
            for i in asked[ids[first + d]]:
                shingles, weights, passages = items[i]
                both = np.isin(shingles, own3, assume_unique=True)
                if len(both):
                    out.append((ids[first + d], i, float(both.mean()), float(weights[both].sum() / weights.sum()), bool(np.isin(passages, own12).any())))
    return pd.DataFrame(out, columns=["doc_id", "item_id", "share", "weighted", "has_run"])


def candidates(rows: DataFrame, test: DataFrame) -> DataFrame:
    """``doc_id, item_id``: each document (``doc_id, text``) and item (``item_id, text``) that have windows within RADIUS of one another, as many as a leak has at least."""
    prints = test.mapInPandas(_looked_up, "item_id bigint, print bigint, size int, spare int").groupBy("item_id", "print", "size", "spare").agg(F.count("*").alias("n"))
    common = prints.groupBy("size", "print").agg(F.count("*").alias("n_items"))
    order = Window.partitionBy("item_id").orderBy(F.col("n_items").desc(), "print").rowsBetween(Window.unboundedPreceding, 0)
    kept = prints.join(common, ["size", "print"]).withColumn("up_to", F.sum("n").over(order)).where(F.col("up_to") > F.col("spare"))
    keys = broadcast_if_small(kept.select("item_id", "print", "size").mapInPandas(_blocked, "key bigint, own bigint, item_id bigint"), MAX_KEYS)
    bitmap, sizes = bitmap_of(keys.select("key"), 32), [r[0] for r in kept.select("size").distinct().collect()]
    met = rows.mapInPandas(lambda it: _met(it, bitmap, sizes), "key bigint, print bigint, doc_id bigint")
    near = F.bit_count(F.col("print").bitwiseXOR(F.col("own"))) <= RADIUS
    return met.join(keys, "key").where(near).select("doc_id", "item_id").distinct()


def leaked(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """``doc_id, item_id, share, weighted, has_run``: the documents that hold RUN words in a row of a test item, or SHARE of its distinct three-word runs.

    weighted is the share with each run weighed by its rarity among the items, so that an instruction of many items counts for little. Documents are
    fingerprinted where they are; what is shuffled are the blocks that some item has, told by a bitmap of bounded size, and the texts of candidates.
    Neither items nor fingerprints come to the driver, and documents are read twice whatever the number of items. Null and "" texts and rows without
    an id hold nothing, in either table; an item of fewer than three words can't be found. Whole texts are read. A document or item that comes twice has its pairs once.
    """
    test = materialize(items.where(has_text(F.col(item_text)) & F.col(item_id).isNotNull()).select(F.col(item_id).cast("bigint").alias("item_id"), F.col(item_text).alias("text")).distinct())
    rows = docs.where(has_text(F.col(text)) & F.col(id_col).isNotNull()).select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    pairs = materialize(candidates(rows, test))

    profiles = test.mapInPandas(_profiles, "item_id bigint, three array<bigint>, long array<bigint>").join(pairs.select("item_id").distinct(), "item_id", "left_semi")
    each = profiles.select("item_id", "long", F.explode("three").alias("h"))
    rarity = profiles.select(F.explode("three").alias("h")).groupBy("h").agg((1 / F.count("*")).alias("w"))
    weighed = each.join(rarity, "h").groupBy("item_id", "long").agg(F.collect_list("h").alias("three"), F.collect_list("w").alias("weights"))
    # pairs are verified together, about PAIRS at a time, all those of a document in one place
    part = lambda c: F.pmod(F.xxhash64(c), F.lit(parts))
    parts = max(1, pairs.count() // PAIRS)
    asked = bitmap_of(pairs.select(F.xxhash64("doc_id")))
    concerned = rows.withColumn("slot", F.xxhash64("doc_id")).mapInPandas(lambda it: (b.loc[in_bitmap(asked, b["slot"].to_numpy()), ["doc_id", "text"]] for b in it), "doc_id bigint, text string")
    texts = concerned.select(part("doc_id").alias("part"), F.col("doc_id").alias("id"), "text")
    sets = pairs.select(part("doc_id").alias("part"), "item_id").distinct().join(weighed.hint("merge"), "item_id").select("part", F.col("item_id").alias("id"), "three", "weights", "long")
    both = texts.unionByName(sets, allowMissingColumns=True)
    found = pairs.select(part("doc_id").alias("home"), "doc_id", "item_id").groupBy("home").cogroup(both.groupBy("part")).applyInPandas(_verified, "doc_id bigint, item_id bigint, share double, weighted double, has_run boolean")
    leaks = found.where(F.col("has_run") | (F.col("share") >= SHARE))
    return leaks.groupBy("doc_id", "item_id").agg(F.max("share").alias("share"), F.max("weighted").alias("weighted"), F.max("has_run").alias("has_run"))


def leak_report(found: DataFrame, items: DataFrame, item_id: str = "item_id") -> DataFrame:
    """``item_id, suite, n_docs, n_runs, max_share, max_weighted`` for every test item, 0 for those that leaked nowhere."""
    per = found.groupBy("item_id").agg(F.count("*").alias("n_docs"), F.count_if("has_run").alias("n_runs"), F.max("share").alias("max_share"), F.max("weighted").alias("max_weighted"))
    out = items.select(F.col(item_id).cast("bigint").alias("item_id"), "suite").distinct().join(per, "item_id", "left")
    count = lambda c: F.coalesce(c, F.lit(0)).cast("bigint").alias(c)
    share = lambda c: F.round(F.coalesce(c, F.lit(0.0)), 6).alias(c)
    return out.select("item_id", "suite", count("n_docs"), count("n_runs"), share("max_share"), share("max_weighted"))
