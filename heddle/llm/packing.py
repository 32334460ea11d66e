"""Texts packed into containers of fixed capacity: large items matched in pairs, small ones best-fit into the gaps."""

from __future__ import annotations

import base64
import bisect
import functools
import math
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from heddle.functions.tables import materialize

TOKENIZERS = "/opt/tokenizers"
# Fixed value: the pattern that splits text before the merges of the 50k byte-level vocabulary.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
MAX_TARGETS = 1_000  # capacities: each document is packed for each of them, in one pass
BLOCK = 20_000  # items packed together; the space left by a block's last containers is lost among so many


@functools.lru_cache(2)
def encoder(folder: str, vocabulary: str = "byte_bpe_50k.tiktoken"):
    import tiktoken

    with open(f"{folder}/{vocabulary}", "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def token_sizes(docs: DataFrame, id_col: str, text: str, tokenizers: str = TOKENIZERS) -> DataFrame:
    """``doc_id, n_tokens``: the tokens of each text; 0 for a null or "" one. Rows without an id are left out."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = encoder(tokenizers).encode_ordinary
        for b in batches:
            yield pd.DataFrame({"doc_id": b["doc_id"], "n_tokens": [len(encode(t)) if t else 0 for t in b["text"]]})

    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text).alias("text")).where("doc_id is not null")
    return rows.mapInPandas(run, "doc_id bigint, n_tokens bigint")


def pack(sizes: list[int], capacity: int) -> list[int]:
    """A container (from 0) for each of ``sizes``, none of which exceeds ``capacity``.

    No container takes three items above a third of the capacity. So these are matched: from the largest down, each with the
    largest unmatched one that fits beside it. The others, from the largest down, go where they leave the least gap, or open a container.
    """
    order = sorted(range(len(sizes)), key=lambda i: (-sizes[i], i))
    large = [i for i in order if 3 * sizes[i] > capacity]
    at = [0] * len(sizes)
    gaps: dict[int, list[int]] = {}
    n = 0
    # large items by size, ascending; a partner is the last one at or below the gap
    waiting = large[::-1]
    keys = [sizes[i] for i in waiting]
    while waiting:
        i, size = waiting.pop(), keys.pop()
        at[i] = n
        gap = capacity - size
        j = bisect.bisect_right(keys, gap) - 1
        if j >= 0:
            gap -= keys.pop(j)
            at[waiting.pop(j)] = n
        gaps.setdefault(gap, []).append(n)
        n += 1
    free = sorted(gaps)
    for i in order[len(large) :]:
        size = sizes[i]
        j = bisect.bisect_left(free, size)
        if j == len(free):
            gap, at[i] = capacity, n
            n += 1
        else:
            gap = free[j]
            at[i] = gaps[gap].pop()
            if not gaps[gap]:
                del gaps[gap]
                free.pop(j)
        rest = gap - size
        if rest not in gaps:
            gaps[rest] = []
            bisect.insort(free, rest)
        gaps[rest].append(at[i])
    return at


def packed(sizes: DataFrame, targets: DataFrame, block: int = BLOCK) -> DataFrame:
    """``target_name, doc_id, piece_no, start_token, n_tokens, container`` for every document and every capacity.

    sizes: ``doc_id, n_tokens``; targets: ``target_name, capacity``, at most MAX_TARGETS, else an error. A document within the capacity is one piece. One that exceeds it is
    cut into pieces of the whole capacity, each a container of its own, and a last piece that is packed like a document. Items are
    dealt by hash into blocks of about ``block``, each packed on its own in one task, whatever the number of documents; containers
    are numbered from 1 within a target, through all blocks. A document of no tokens is a piece of 0. Equal sizes go by doc_id. Repeated
    rows are packed once each. A null or non-positive capacity is no target. Empty tables give no rows.
    """
    goal = targets.where("capacity > 0").select("target_name", F.col("capacity").cast("bigint").alias("capacity")).distinct().limit(MAX_TARGETS + 1).collect()
    if len(goal) > MAX_TARGETS:
        raise ValueError(f"there are at most {MAX_TARGETS} targets")
    blocks = max(1, math.ceil(sizes.count() / block))
    each = [F.struct(F.lit(r["target_name"]).alias("target_name"), F.lit(r["capacity"]).cast("bigint").alias("capacity")) for r in goal]
    items = sizes.select("*", F.inline(F.array(*each) if each else F.array().cast("array<struct<target_name string, capacity bigint>>")))
    whole = F.when(F.col("n_tokens") > F.col("capacity"), F.floor((F.col("n_tokens") - 1) / F.col("capacity"))).otherwise(F.lit(0)).cast("bigint")
    items = items.withColumn("whole", whole).withColumn("block", F.pmod(F.xxhash64("doc_id"), F.lit(blocks)))

    def run(b: pd.DataFrame) -> pd.DataFrame:
        b = b.sort_values(["n_tokens", "doc_id"], kind="stable")
        capacity = int(b["capacity"].iloc[0])
        rest = (b["n_tokens"] - b["whole"] * capacity).tolist()
        at = pack(rest, capacity)
        return pd.DataFrame({"target_name": b["target_name"], "block": b["block"], "doc_id": b["doc_id"], "n_tokens": rest, "whole": b["whole"], "capacity": capacity, "local": at})

    schema = "target_name string, block bigint, doc_id bigint, n_tokens bigint, whole bigint, capacity bigint, local bigint"
    placed = materialize(items.groupBy("target_name", "block").applyInPandas(run, schema))
    # containers of each block: those its items share, then one for each whole piece
    used = placed.groupBy("target_name", "block").agg((F.max("local") + 1).alias("shared"), F.sum("whole").alias("wholes"))
    before = Window.partitionBy("target_name").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    first = used.select("target_name", "block", "shared", F.coalesce(F.sum(F.col("shared") + F.col("wholes")).over(before), F.lit(0)).alias("base"))
    mine = placed.join(first, ["target_name", "block"])
    last = mine.select("target_name", "doc_id", (F.col("whole") + 1).alias("piece_no"), (F.col("whole") * F.col("capacity")).alias("start_token"), "n_tokens", (F.col("base") + F.col("local") + 1).alias("container"))
    running = Window.partitionBy("target_name", "block").orderBy("doc_id").rowsBetween(Window.unboundedPreceding, -1)
    cut = mine.where("whole > 0").withColumn("earlier", F.coalesce(F.sum("whole").over(running), F.lit(0)))
    pieces = cut.select("*", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("whole"))).alias("piece_no"))
    full = pieces.select("target_name", "doc_id", "piece_no", ((F.col("piece_no") - 1) * F.col("capacity")).alias("start_token"), F.col("capacity").alias("n_tokens"), (F.col("base") + F.col("shared") + F.col("earlier") + F.col("piece_no")).alias("container"))
    return last.unionByName(full)


def filling(pieces: DataFrame, targets: DataFrame) -> DataFrame:
    """``target_name, capacity, n_pieces, n_containers, n_tokens, n_over, share_unused``: how well each target's containers are filled."""
    each = pieces.groupBy("target_name", "container").agg(F.count("*").alias("n"), F.sum("n_tokens").alias("t")).join(F.broadcast(targets.select("target_name", F.col("capacity").cast("bigint").alias("capacity"))), "target_name")
    out = each.groupBy("target_name", "capacity").agg(F.sum("n").alias("n_pieces"), F.count("*").alias("n_containers"), F.sum("t").alias("n_tokens"), F.count_if(F.col("t") > F.col("capacity")).alias("n_over"))
    return out.withColumn("share_unused", F.round(1 - F.col("n_tokens") / (F.col("n_containers") * F.col("capacity")), 6))
