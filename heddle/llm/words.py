"""Words of many texts as arrays of 64-bit hashes, without a Python loop over words.

Words are maximal runs of letters and digits (Unicode), in lower case. A batch of texts is laid end to end as code
points; one table lookup finds the word characters, and a prefix sum of a polynomial in the code points gives the hash
of every word at once.
"""

from __future__ import annotations

import functools
from collections.abc import Iterable, Iterator

import numpy as np

BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
CHUNK = 1 << 20  # characters laid end to end at a time; a longer text is a chunk of its own


@functools.lru_cache(1)
def _word_table() -> np.ndarray:
    return np.fromiter((chr(c).isalnum() for c in range(0x110000)), dtype=bool, count=0x110000)


@functools.lru_cache(2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    up = np.full(n, BASE, dtype=np.uint64)
    down = np.full(n, pow(BASE, -1, 1 << 64), dtype=np.uint64)
    up[0] = down[0] = 1
    return np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values whose output bits all depend on all input bits (splitmix64's finaliser)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def words_of(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For all words of ``texts``: hash, index of the text, start, end; and the code points they refer to."""
    joined = "\n".join(texts).lower()
    if joined.count("\n") - sum(t.count("\n") for t in texts) != len(texts) - 1:
        raise ValueError("lower case changed the lines")
    chars = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    n = len(chars)
    # lower case can change a text's length, so the starts are those of the lowered texts
    lengths = np.fromiter((len(t.lower()) for t in texts), dtype=np.int64, count=len(texts))
    starts_of = np.concatenate([[0], np.cumsum(lengths + 1)])[: len(texts)]
    inside = np.zeros(n + 2, dtype=np.int8)
    inside[1 : n + 1] = _word_table()[chars]
    edge = np.diff(inside)
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    size = 1 << max(10, int(n + 1).bit_length())
    up, down = _powers(size)
    total = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum((chars.astype(np.uint64) + np.uint64(1)) * up[:n], dtype=np.uint64, out=total[1:])
    hashes = mix((total[end] - total[start]) * down[start] + (end - start).astype(np.uint64))
    return hashes, np.searchsorted(starts_of, start, side="right") - 1, start, end, chars


def chunks(texts: Iterable[str]) -> Iterator[tuple[int, list[str]]]:
    """The texts in order, in lists of about CHUNK characters, each with the index of its first text."""
    held, size, first, i = [], 0, 0, -1
    for i, t in enumerate(texts):
        if held and size + len(t) > CHUNK:
            yield first, held
            held, size, first = [], 0, i
        held.append(t)
        size += len(t) + 1
    if held:
        yield first, held


def runs(hashes: np.ndarray, doc: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``k`` words that lie within one text, and the index of the text of each."""
    m = len(hashes) - k + 1
    if m <= 0:
        return np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
    acc = np.zeros(m, dtype=np.uint64)
    for j in range(k):
        acc = acc * np.uint64(BASE) + hashes[j : j + m]
    same = doc[:m] == doc[k - 1 :]
    return mix(acc[same]), doc[:m][same]
