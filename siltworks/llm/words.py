"""Words of whole Arrow batches as numpy arrays: where they are, whose they are, and 64-bit hashes of them.

A word is a run of bytes without blanks (space and \\x09 to \\x0D), so UTF-8 is cut only at ASCII. Hashes are sums
of bytes times odd numbers drawn by position, modulo 2^64: two different words collide with a chance of about
2^-56. Work per byte goes in blocks of about a megabyte, so that a very long text needs no more memory than many
short ones.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK = 1 << 20


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (the finaliser of splitmix64)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _odd(n: int, salt: int) -> np.ndarray:
    steps = np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return mix64(steps + np.uint64(salt)) | np.uint64(1)


_TABLES: dict[int, np.ndarray] = {}


def _by_position(n: int) -> np.ndarray:
    size = 1 << max(8, (n - 1).bit_length())
    if size not in _TABLES:
        _TABLES[size] = _odd(size, 7)
    return _TABLES[size]


@dataclass
class Words:
    data: np.ndarray  # bytes of all texts, one after the other
    offsets: np.ndarray  # where each text begins, and the end
    starts: np.ndarray  # of the words, in data
    ends: np.ndarray
    first: np.ndarray  # of each text, its first word's number, and the end

    def hashes(self) -> np.ndarray:
        """A hash for each word."""
        n = len(self.starts)
        out = np.zeros(n, dtype=np.uint64)
        lengths = self.ends - self.starts
        upto = np.cumsum(lengths)
        at = 0
        while at < n:
            done = upto[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(upto, done + BLOCK, side="right")))
            size = lengths[at:to]
            begins = np.cumsum(size) - size
            position = np.arange(int(size.sum()), dtype=np.int64) - np.repeat(begins, size)
            spread = self.data[position + np.repeat(self.starts[at:to], size)].astype(np.uint64)
            spread += np.uint64(1)
            spread *= _by_position(int(size.max()))[position]
            out[at:to] = np.add.reduceat(spread, begins)
            at = to
        return mix64(out ^ (lengths.astype(np.uint64) << np.uint64(48)))

    def counts(self) -> np.ndarray:
        return np.diff(self.first)


def words_of(texts: pa.Array, lower: bool = False) -> Words:
    """The words of the texts; NULL texts have none. ``lower`` maps A-Z to a-z first."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    n = len(texts)
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + n + 1]
    body = texts.buffers()[2]
    data = np.frombuffer(body, dtype=np.uint8) if body is not None else np.zeros(0, dtype=np.uint8)
    data, offsets = data[offsets[0] : offsets[-1]], offsets - offsets[0]
    if lower:
        data = data + (((data >= 65) & (data <= 90)).astype(np.uint8) << 5)
    solid = (data != 32) & ((data < 9) | (data > 13))
    begin = solid.copy()
    begin[1:] &= ~solid[:-1]
    finish = solid.copy()
    finish[:-1] &= ~solid[1:]
    edges = offsets[:-1][np.diff(offsets) > 0]
    begin[edges] = solid[edges]  # a text's first byte begins a word even if the text before ends with one
    ends = offsets[1:][np.diff(offsets) > 0] - 1
    finish[ends] = solid[ends]
    starts = np.flatnonzero(begin)
    return Words(data, offsets, starts, np.flatnonzero(finish) + 1, np.searchsorted(starts, offsets))


def windows(hashes: np.ndarray, k: int, salt: int = 11) -> np.ndarray:
    """The hash of each k consecutive numbers; shorter input gives one hash of all of it, empty input none."""
    n = len(hashes)
    if not n:
        return np.zeros(0, dtype=np.uint64)
    odd = _odd(k, salt)
    width = min(k, n)
    out = np.full(n - width + 1, np.uint64(width * 0x9E3779B1), dtype=np.uint64)
    for j in range(width):
        out += hashes[j : n - width + 1 + j] * odd[j]
    return mix64(out)


def chunks(batch: pa.RecordBatch, text: int, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The batch in slices of about ``most`` bytes of text, one row at least."""
    sizes = np.cumsum(pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < batch.num_rows:
        done = sizes[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(sizes, done + most, side="right")))
        yield batch.slice(at, to - at)
        at = to
