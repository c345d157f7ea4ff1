"""Words of whole Arrow text columns as 64-bit hashes, in numpy.

A word is a run of bytes other than ASCII white space (0x20, 0x09-0x0D), so
words of UTF-8 text come out whole.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

#: Bytes that are hashed at once.
BLOCK_BYTES = 1 << 18
MULT = np.uint64(0x9E3779B97F4A7C15)      # odd, so powers never vanish modulo 2^64


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(n: int) -> np.ndarray:
    return np.multiply.accumulate(np.concatenate([np.ones(1, np.uint64), np.full(max(0, n - 1), MULT)]), dtype=np.uint64)


def byte_values(lower: bool) -> np.ndarray:
    """A random-looking value per byte; upper-case ASCII like lower-case if asked."""
    b = np.arange(256, dtype=np.uint64)
    if lower:
        b[65:91] += np.uint64(32)
    return mix(b + np.uint64(1))


def word_hashes(column: pa.Array, lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each word, cuts): the words of row i are cuts[i]:cuts[i + 1].  Null rows have none."""
    column = column.fill_null("").cast(pa.large_binary())
    off = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", dtype=np.uint8)[off[0]:off[-1]]
    off = off - off[0]
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(len(off), np.int64)
    inside = ~((data == 32) | ((data >= 9) & (data <= 13)))
    edge = np.zeros(len(data) + 1, dtype=bool)       # a row starts here
    edge[off] = True
    before = np.concatenate([[False], inside[:-1]]) & ~edge[:-1]
    after = np.concatenate([inside[1:], [False]]) & ~edge[1:]
    starts = np.flatnonzero(inside & ~before)
    lens = np.flatnonzero(inside & ~after) + 1 - starts
    cuts = np.searchsorted(starts, off)
    if not len(starts):
        return np.zeros(0, np.uint64), cuts
    value, power = byte_values(lower), powers(int(lens.max()))
    sums = np.empty(len(starts), np.uint64)
    blocks = np.flatnonzero(np.diff(np.cumsum(lens) // BLOCK_BYTES)) + 1
    for i, j in zip([0, *blocks.tolist()], [*blocks.tolist(), len(starts)]):
        n = lens[i:j]
        cum = np.cumsum(n) - n
        place = np.arange(int(n.sum())) - np.repeat(cum, n)
        sums[i:j] = np.add.reduceat(value[data[place + np.repeat(starts[i:j], n)]] * power[place], cum)
    return mix(sums + lens.astype(np.uint64)), cuts


def ngrams(h: np.ndarray, n: int) -> np.ndarray:
    """Hash of the n values from each position on (shorter than ``h`` by n - 1)."""
    m = max(0, len(h) - n + 1)
    out = np.zeros(m, np.uint64)
    for k in range(n):
        out = out * MULT + h[k:k + m]
    return mix(out + np.uint64(n))
