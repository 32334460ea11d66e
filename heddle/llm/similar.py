"""Near-duplicate records: fast similarity sketching, banding, exact verification.

The sketch is that of Dahlgaard, Knudsen and Thorup, "Fast Similarity Sketching" (2017): in each of the first ``t`` rounds
every element is thrown into a hashed bin, in the next ``t`` rounds every element is thrown into the bin of that round; a bin
keeps the least value of the first round that reached it. Every coordinate is filled for certain, and the share of equal
coordinates of two sketches is concentrated about the Jaccard similarity as with fully independent samples.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from heddle.functions.tables import materialize
from heddle.llm.words import chunks, mix, runs, words_of

BANDS, ROWS = 128, 5  # a pair at similarity 0.5 is missed once in 58 times, at 0.55 once in 800, at 0.6 once in 30,000
COMPARED, MARGIN = 128, 0.20  # coordinates of a signature, four bits each, and how far below the threshold its estimate may lie for an exact comparison
CELL = 500  # classes of one side of a cell: a bucket of more is compared in several cells, each two of its parts in one
PAIRS = 2_000  # pairs whose shingle sets are compared together, about
SLOTS = 27  # the bitmap that tells which classes are asked for has at most 2^27 bits, 16 MB


def sketches(elements: np.ndarray, owner: np.ndarray, n: int, t: int) -> np.ndarray:
    """The sketches (``n`` x ``t``, uint64) of ``n`` sets given as element hashes and the set each belongs to. Sets without elements keep the largest value."""
    full = np.uint64(0xFFFFFFFFFFFFFFFF)
    out = np.full(n * t, full, dtype=np.uint64)
    have = np.bincount(owner, minlength=n) > 0
    open_ = have.copy()
    for i in range(2 * t):
        h = mix(elements ^ mix(np.full(1, i + 1, dtype=np.uint64)))
        place = (h % np.uint64(t)).astype(np.int64) if i < t else np.full(len(h), i - t)
        np.minimum.at(out, owner * t + place, (np.uint64(i) << np.uint64(44)) | (h >> np.uint64(20)))
        open_ = have & (out.reshape(n, t) == full).any(axis=1)
        if not open_.any():
            break
        keep = open_[owner]
        elements, owner = elements[keep], owner[keep]
    return out.reshape(n, t)


def _sets(ids: pd.Series, texts: list[str], k: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """By chunk: ids, shingle hashes (each once per text), and the row within the chunk of each."""
    ids = ids.to_numpy()
    for first, part in chunks(texts):
        hashes, doc, *_ = words_of(part)
        element, owner = runs(hashes, doc, k)
        order = np.lexsort((element, owner))
        element, owner = element[order], owner[order]
        new = np.ones(len(element), dtype=bool)
        new[1:] = (element[1:] != element[:-1]) | (owner[1:] != owner[:-1])
        yield ids[first : first + len(part)], element[new], owner[new]


def _once(b: pd.DataFrame) -> pd.DataFrame:
    """A batch with each class of copies once, so that a class that holds much of the rows is little work and few rows."""
    return b.drop_duplicates("rep")


def _banded(batches: Iterator[pd.DataFrame], k: int, bands: int, rows: int) -> Iterator[pd.DataFrame]:
    for b in map(_once, batches):
        for ids, element, owner in _sets(b["rep"], b["text"].tolist(), k):
            have = np.bincount(owner, minlength=len(ids)) > 0
            if not have.any():
                continue
            s = sketches(element, owner, len(ids), bands * rows)[have].reshape(-1, bands, rows)
            key = np.tile(mix(np.arange(1, bands + 1, dtype=np.uint64)), (len(s), 1))
            for j in range(rows):
                key = mix(key ^ s[:, :, j]) + np.uint64(j)
            yield pd.DataFrame({"rep": np.repeat(ids[have], bands), "bucket": key.reshape(-1).view(np.int64)})


def in_bitmap(bitmap: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Whether the slot of each value (int64) is set in a bitmap."""
    slot = values.view(np.uint64) & np.uint64(len(bitmap) * 64 - 1)
    return (bitmap[(slot >> np.uint64(6)).astype(np.int64)] >> (slot & np.uint64(63))) & np.uint64(1) == 1


def _asked_for(batches: Iterator[pd.DataFrame], bitmap: np.ndarray) -> Iterator[pd.DataFrame]:
    """The rows of classes whose slot in the bitmap is set: all that are asked for and a few more."""
    for b in map(_once, batches):
        yield b[in_bitmap(bitmap, b["rep"].to_numpy())]


def _signed(batches: Iterator[pd.DataFrame], k: int, t: int) -> Iterator[pd.DataFrame]:
    for b in batches:
        for ids, element, owner in _sets(b["rep"], b["text"].tolist(), k):
            s = (sketches(element ^ np.uint64(0x5851F42D4C957F2D), owner, len(ids), t) & np.uint64(15)).astype(np.uint8)
            yield pd.DataFrame({"rep": ids, "sig": [x.tobytes() for x in s[:, ::2] << 4 | s[:, 1::2]]})


def _shingled(batches: Iterator[pd.DataFrame], k: int) -> Iterator[pd.DataFrame]:
    for b in batches:
        for ids, element, owner in _sets(b["rep"], b["text"].tolist(), k):
            cut = np.searchsorted(owner, np.arange(len(ids) + 1))
            yield pd.DataFrame({"rep": ids, "shingles": [element[x:y].astype("<u8").tobytes() for x, y in zip(cut[:-1], cut[1:])]})


def _estimates(sig: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The similarity that the signatures of each two rows suggest: the share of equal coordinates, less the sixteenth that agree by chance."""
    out = np.empty(len(a))
    for i in range(0, len(a), 100_000):
        x = sig[a[i : i + 100_000]] ^ sig[b[i : i + 100_000]]
        equal = ((x & 15) == 0).mean(axis=1) / 2 + ((x >> 4) == 0).mean(axis=1) / 2
        out[i : i + 100_000] = (equal - 1 / 16) * 16 / 15
    return out


def _compared(batches: Iterator[pd.DataFrame], least: float) -> Iterator[pd.DataFrame]:
    """The pairs of each cell whose signatures suggest ``least`` or more. Rows come sorted by cell; a cell has at most some hundreds on each side."""

    def pairs(rows: pd.DataFrame) -> Iterator[pd.DataFrame]:
        cell, rep, side = rows["cell"].to_numpy(), rows["rep"].to_numpy(), rows["side"].to_numpy()
        sig = np.frombuffer(b"".join(rows["sig"]), dtype=np.uint8).reshape(len(rows), -1)
        start = np.flatnonzero(np.append(True, cell[1:] != cell[:-1]))
        size = np.diff(np.append(start, len(cell)))
        for m in np.unique(size[size > 1]):
            first, second = np.triu_indices(m, 1)
            at = start[size == m]
            for i in range(0, len(at), max(1, 500_000 // len(first))):
                own = at[i : i + max(1, 500_000 // len(first)), None]
                a, b = (own + first).ravel(), (own + second).ravel()
                # side 2 is that of a cell within one part; in another cell only rows of different sides are a pair
                keep = (side[a] == 2) | (side[a] != side[b])
                a, b = a[keep], b[keep]
                near = _estimates(sig, a, b) >= least
                a, b = a[near], b[near]
                yield pd.DataFrame({"a": np.minimum(rep[a], rep[b]), "b": np.maximum(rep[a], rep[b]), "cell": cell[a]})

    held = None
    for b in batches:
        b = b if held is None or held.empty else pd.concat([held, b], ignore_index=True)
        cut = int(np.searchsorted(b["cell"].to_numpy(), b["cell"].iloc[-1])) if len(b) else 0
        yield from pairs(b.iloc[:cut]) if cut else ()
        held = b.iloc[cut:]
    if held is not None and len(held):
        yield from pairs(held)


def _exact(pairs: pd.DataFrame, sets: pd.DataFrame) -> pd.DataFrame:
    """The Jaccard similarity of each pair, from the shingle sets of the classes in it."""
    of = {r: np.frombuffer(x, dtype="<u8") for r, x in zip(sets["rep"], sets["shingles"])}

    def one(a: int, b: int) -> float:
        x, y = of[a], of[b]
        both = len(np.intersect1d(x, y, assume_unique=True))
        return both / max(1, len(x) + len(y) - both)

    return pd.DataFrame({"a": pairs["a"], "b": pairs["b"], "similarity": [one(a, b) for a, b in zip(pairs["a"], pairs["b"])]})


def _rows(df: DataFrame, id_col: str, text: F.Column) -> DataFrame:
    """``id, rep, text``: rep is a 64-bit hash of the text, one for all its copies; texts of nothing are no copies of each other."""
    rows = df.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("bigint").alias("id"), F.coalesce(text, F.lit("")).alias("text"))
    return rows.select("id", F.when(F.length(F.trim("text")) > 0, F.xxhash64("text")).otherwise(F.xxhash64(F.lit("row"), "id")).alias("rep"), "text")


def _buckets(texts: DataFrame, shingle: int, bands: int, rows: int) -> DataFrame:
    """``rep, bucket, n`` for the buckets of more than one class, each class once, written: it is little, and all that follows reads it."""
    banded = texts.select("rep", "text").mapInPandas(lambda it: _banded(it, shingle, bands, rows), "rep bigint, bucket bigint")
    sorted_ = Window.partitionBy("bucket").orderBy("rep")
    first = banded.withColumn("new", F.coalesce(F.lag("rep").over(sorted_) != F.col("rep"), F.lit(True)).cast("int"))
    counted = first.withColumn("n", F.sum("new").over(sorted_.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    return materialize(counted.where("n > 1 and new = 1").select("rep", "bucket", "n"))


def bitmap_of(values: DataFrame, room: int = 8) -> np.ndarray:
    """A bitmap in which the slot of every value is set (one column, hashes of 64 bits): the low bits of a value are its slot. It has ``room`` bits or
    more for each value, up to 2^SLOTS bits, so its size has a bound; where more are asked for it just keeps fewer rows back."""
    each = values.toDF("v").distinct()
    bits = 1 << min(SLOTS, max(10, (room * each.count()).bit_length()))
    slot = each.select(F.col("v").bitwiseAND(F.lit(bits - 1).cast("bigint")).alias("s"))
    words = slot.select(F.shiftright("s", 6).alias("w"), F.expr("shiftleft(1L, cast(s % 64 as int))").alias("bit"))
    out = np.zeros(bits // 64, dtype=np.int64)
    got = words.groupBy("w").agg(F.bit_or("bit").alias("bits")).toPandas()
    out[got["w"].to_numpy(dtype=np.int64)] = got["bits"].to_numpy(dtype=np.int64)
    return out.view(np.uint64)


def _cells(held: DataFrame) -> DataFrame:
    """``cell, side, rep``: the classes of each bucket laid out so that each two of them meet in one cell, and no cell has many.

    A bucket of over CELL classes is parted by hash; each two parts are a cell (sides 0 and 1), each part is one (side 2). A class is in as many
    cells as its bucket has parts, so a hot bucket is spread over tasks and none of its pairs is left out.
    """
    parts = F.ceil(F.col("n") / CELL).cast("int")
    own = F.pmod(F.xxhash64("rep", F.lit(1)), parts).cast("int")
    spread = held.select("bucket", "rep", own.alias("own"), F.explode(F.sequence(F.lit(0), parts - 1)).alias("other"))
    side = F.when(F.col("own") == F.col("other"), 2).when(F.col("own") < F.col("other"), 0).otherwise(1)
    cell = F.xxhash64("bucket", F.least("own", "other"), F.greatest("own", "other"))
    return spread.select(cell.alias("cell"), side.alias("side"), "rep")


def similar_pairs(df: DataFrame, id_col: str, text: F.Column, threshold: float = 0.8, shingle: int = 5, bands: int = BANDS, rows: int = ROWS) -> tuple[DataFrame, DataFrame]:
    """(links, classes). links: ``a, b, similarity``, a < b, the pairs of classes of copies whose Jaccard similarity over distinct runs of
    ``shingle`` words is at least ``threshold``; classes: ``id, rep``, the class of every row, a 64-bit hash of its text.

    Texts stay where they are, in every step: they are sketched there, and only (class, bucket) is shuffled. All classes of a bucket are compared by
    signatures, however many they are: a signature goes once to each cell of its class, and only pairs whose estimate leaves the threshold possible
    leave the cell. Those are compared by their whole shingle sets, pairs of a cell together, so that a set is sent once for all its pairs there.
    Signatures and sets are made of the classes asked for, held back by a bitmap of bounded size. Null ids are no rows; null
    texts count as ""; texts with fewer than ``shingle`` words have no runs and no links. Links are direct, never by way of a third row.
    An id that comes with several texts is in the class of each.
    """
    texts = _rows(df, id_col, text)

    def made(asked: DataFrame, fn, value: str) -> DataFrame:
        bitmap = bitmap_of(asked.select("rep"))
        return texts.select("rep", "text").mapInPandas(lambda it: fn(_asked_for(it, bitmap), shingle), f"rep bigint, {value} binary").dropDuplicates(["rep"])

    held = _buckets(texts, shingle, bands, rows)
    signed = made(held, lambda it, k: _signed(it, k, COMPARED), "sig")
    laid = _cells(held).join(signed, "rep").repartition("cell").sortWithinPartitions("cell")
    least = max(0.0, threshold - MARGIN)
    near = laid.mapInPandas(lambda it: _compared(it, least), "a bigint, b bigint, cell bigint").groupBy("a", "b").agg(F.min("cell").alias("cell"))
    near = materialize(near)
    part = F.pmod(F.xxhash64("cell"), F.lit(max(1, near.count() // PAIRS)))
    member = near.select(part.alias("part"), F.explode(F.array("a", "b")).alias("rep")).distinct()
    sets = member.join(made(member, _shingled, "shingles"), "rep")
    exact = near.select("a", "b", part.alias("home")).groupBy("home").cogroup(sets.groupBy("part")).applyInPandas(_exact, "a bigint, b bigint, similarity double")
    return materialize(exact.where(F.col("similarity") >= threshold)), texts.select("id", "rep")


def all_pairs(links: DataFrame, member: DataFrame) -> DataFrame:
    """``a, b``, a < b: every pair of rows that are copies of one another or of linked texts. Grows with the square of a class; groups() doesn't."""
    m = member.select("id", "rep").distinct()
    across = links.join(m.toDF("i", "a"), "a").join(m.toDF("j", "b"), "b").select(F.least("i", "j").alias("a"), F.greatest("i", "j").alias("b"))
    alike = m.toDF("i", "rep").join(m.toDF("j", "rep"), "rep").where("i < j").select(F.col("i").alias("a"), F.col("j").alias("b"))
    return across.union(alike)


def components(edges: DataFrame) -> DataFrame:
    """``node, root``: connected components of ``a, b`` edges, root the least node of each. Nodes without edges have no row.

    Rounds of alternating large-star and small-star (Kiveris et al., "Connected Components in MapReduce and Beyond", 2014), each
    written to the shared folder; only a count and checksums of the edges come to the driver.
    """
    def state(e: DataFrame):
        return e.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.pmod(F.xxhash64("b", "a"), F.lit(1 << 31)))).first()

    now = materialize(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct())
    was, is_ = None, state(now)
    while was != is_:
        both = now.union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        low2 = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low2, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).union(low2.select("a", F.col("m").alias("b"))).where("a <> b").distinct()
        now = materialize(small)
        was, is_ = is_, state(now)
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(now.select(F.col("b").alias("node"), F.col("b").alias("root"))).distinct()


def groups(links: DataFrame, member: DataFrame) -> DataFrame:
    """``item_id, class_id, n_links, group_id``: for every row the least id of its exact copies, the number of other classes linked to its own, and the least id of all rows joined by links."""
    degree = links.select(F.explode(F.array("a", "b")).alias("rep")).groupBy("rep").agg(F.count("*").alias("n_links"))
    class_ = member.groupBy("rep").agg(F.min("id").alias("class_id")).join(components(links).withColumnRenamed("node", "rep"), "rep", "left").withColumn("root", F.coalesce("root", "rep"))
    least = class_.groupBy("root").agg(F.min("class_id").alias("group_id"))
    out = member.distinct().join(class_.join(least, "root"), "rep").join(degree, "rep", "left")
    return out.select(F.col("id").alias("item_id"), "class_id", F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"), "group_id")
