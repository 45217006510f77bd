"""Which 64-bit keys occur more than once, found without a row per key.

Map tasks pack keys into one binary row per bucket and batch; after an exchange by bucket, numpy sorts each
partition's keys. A key that a batch already has twice is known to be shared there: all but one of its entries
pass through the exchange unlooked at, so a key that a third of all documents have costs its reducer one entry per
batch, not one per document.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from siltworks.llm.tables import arrow_map, shuffle_width
from siltworks.llm.words import mix64

PACKED = "bucket int, k binary, owner binary, extra binary, known boolean"
_PACKED = pa.schema(
    [("bucket", pa.int32()), ("k", pa.binary()), ("owner", pa.binary()), ("extra", pa.binary()), ("known", pa.bool_())]
)
SHARED = "k long, owner long, extra int"
_SHARED = pa.schema([("k", pa.int64()), ("owner", pa.int64()), ("extra", pa.int32())])

Entries = tuple[np.ndarray, np.ndarray, np.ndarray]  # keys, owners, extras


def bucket_count(df: DataFrame) -> int:
    return 4 * shuffle_width(df.sparkSession)


def _runs(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order that groups the keys, and where in that order each group begins."""
    order = np.argsort(keys, kind="stable")
    grouped = keys[order]
    new = np.ones(len(keys), dtype=bool)
    new[1:] = grouped[1:] != grouped[:-1]
    return order, new


def pack(entries: Entries, buckets: int) -> pa.RecordBatch:
    """Entries of one batch, with an owner at most once per key, as rows of ``PACKED``.

    An entry that stands for a key known to be shared has its extra stored as ``-1 - extra``.
    """
    keys, owners, extras = entries
    order, new = _runs(keys)
    keys, owners, extras = keys[order], owners[order], extras[order].astype(np.int32)
    group = np.cumsum(new) - 1
    shared = np.bincount(group)[group] > 1 if len(keys) else np.zeros(0, dtype=bool)
    extras = np.where(shared & new, -1 - extras, extras).astype(np.int32)
    bucket = (mix64(keys) % np.uint64(buckets)).astype(np.int32)
    rows: list[tuple] = []
    for known, chosen in ((False, new), (True, shared & ~new)):
        at = np.flatnonzero(chosen)
        at = at[np.argsort(bucket[at], kind="stable")]
        own, begins = np.unique(bucket[at], return_index=True)
        for b, i, j in zip(own.tolist(), begins.tolist(), [*begins[1:].tolist(), len(at)]):
            part = at[i:j]
            rows.append((b, keys[part].tobytes(), owners[part].tobytes(), extras[part].tobytes(), known))
    columns = list(zip(*rows)) or [[]] * 5
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _PACKED)], schema=_PACKED)


def _rows(keys: np.ndarray, owners: np.ndarray, extras: np.ndarray) -> Iterator[pa.RecordBatch]:
    for i in range(0, len(keys), 1 << 16):
        part = slice(i, i + (1 << 16))
        arrays = [pa.array(keys[part].view(np.int64)), pa.array(owners[part]), pa.array(extras[part])]
        yield pa.RecordBatch.from_arrays(arrays, schema=_SHARED)


def unpack(column: pa.Array, kind: type) -> np.ndarray:
    """The numbers of a column of packed arrays, one after the other."""
    return np.frombuffer(b"".join(column.to_pylist()), dtype=kind)


def _reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[Entries] = []
    for batch in batches:
        known = batch.column(4).to_numpy(zero_copy_only=False)
        for passing in (True, False):
            part = batch.filter(pa.array(known == passing))
            if not part.num_rows:
                continue
            entries = tuple(unpack(part.column(i), t) for i, t in ((1, np.uint64), (2, np.int64), (3, np.int32)))
            if passing:
                yield from _rows(*entries)
            else:
                held.append(entries)
    if not held:
        return
    keys, owners, extras = (np.concatenate(x) for x in zip(*held))
    held.clear()
    order, new = _runs(keys)
    keys, owners, extras = keys[order], owners[order], extras[order]
    group = np.cumsum(new) - 1
    size = np.bincount(group)
    shared = size[group] > 1
    known = extras < 0
    shared |= known  # a key known to be shared is one wherever else it occurs, see the size
    extras = np.where(known, -1 - extras, extras).astype(np.int32)
    yield from _rows(keys[shared], owners[shared], extras[shared])


def shared_keys(df: DataFrame, entries: Callable[[Iterator[pa.RecordBatch]], Iterator[Entries]]) -> DataFrame:
    """``k, owner, extra`` of the keys that at least two entries have.

    ``entries`` turns a task's Arrow batches into arrays of keys, owners and extras (from 0); within one of them
    an owner has a key once. The same owner may come again in another one, and then counts again.
    """
    buckets = bucket_count(df)

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for found in entries(batches):
            if len(found[0]):
                yield pack(found, buckets)

    width = shuffle_width(df.sparkSession)
    return arrow_map(arrow_map(df, packed, PACKED).repartition(width, "bucket"), _reduce, SHARED)
