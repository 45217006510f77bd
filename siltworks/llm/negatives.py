"""Hard negatives by inner product, with one candidate list for each cluster of anchors.

Anchors are clustered by direction. An anchor u of a cluster with centre c and radius r (the largest angle between c
and a member) cannot score more with a candidate x than |u| |x| cos(max(0, angle(x, c) - r)). For every cluster a
block of candidates is put in the order of that bound once; all members walk the same list, a stride at a time, and
each leaves it when the bound, which only falls, is below the worst score it still needs. Nothing that is left out
could have been in its result.

Candidates stay where they are. Anchors go to them in blocks of a fixed number, so what is broadcast has a fixed
size; a task keeps the best of what it has seen for each anchor, and the tasks' lists are merged by Spark.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from siltworks.llm.tables import arrow_map, written

SCALE = 256
BLOCK = 1 << 15  # anchors of a broadcast
FIT = 4096  # anchors the clusters' centres are fitted on, at most
MEMBERS = 32  # anchors for each centre, on average, up to
CENTRES = 64
STRIDE = 1024
LONGEST = 1 << 26  # of a scaled vector: inner products of two are exact in doubles

_ROWS = "row long, id long, label long, anchor boolean, vector binary"
_FOUND = "anchor long, slot int, other long, id long, score long"


def scaled_vectors(vectors: DataFrame, anchor: Column) -> DataFrame:
    """``row, id, label, anchor, vector`` of the rows that take part; vectors as 32-bit integers, floor(256 x)."""
    source = vectors.select(
        F.monotonically_increasing_id().alias("row"), F.col("vec_id").cast("long").alias("id"),
        F.col("label").cast("long").alias("label"), F.coalesce(anchor, F.lit(False)).alias("anchor"),
        F.col("embedding").cast("array<double>").alias("vector"),
    )

    def scaled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(pc.and_(batch.column(2).is_valid(), batch.column(4).is_valid()))
            lists = batch.column(4)
            sizes = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
            values = pc.fill_null(lists.flatten(), float("nan")).to_numpy(zero_copy_only=False)
            with np.errstate(over="ignore", invalid="ignore"):
                numbers = np.floor(values * SCALE)
                owner = np.repeat(np.arange(len(sizes)), sizes)
                square = np.bincount(owner, weights=numbers * numbers, minlength=len(sizes))
            good = np.isfinite(square) & (square <= float(LONGEST) ** 2)
            data = numbers[good[owner]].astype("<i4").tobytes()
            offsets = np.concatenate([[0], np.cumsum(4 * sizes[good])]).astype(np.int32)
            kept = batch.filter(pa.array(good))
            packed = pa.Array.from_buffers(pa.binary(), kept.num_rows, [None, pa.py_buffer(offsets), pa.py_buffer(data)])
            yield pa.RecordBatch.from_arrays([*(kept.column(i) for i in range(4)), packed], ["row", "id", "label", "anchor", "vector"])

    return arrow_map(source, scaled, _ROWS)


def _matrix(vectors: pa.Array | pa.ChunkedArray, width: int) -> np.ndarray:
    """Vectors as rows of doubles: shorter ones end in zeros, what is beyond ``width`` meets zeros only."""
    sizes = pc.binary_length(vectors).to_numpy(zero_copy_only=False) // 4 if len(vectors) else np.zeros(0, np.int64)
    flat = np.frombuffer(b"".join(vectors.to_pylist()), dtype="<i4")
    if (sizes == width).all():
        return flat.reshape(len(sizes), width).astype(np.float64)
    out = np.zeros((len(sizes), width))
    at = 0
    for i, size in enumerate(sizes.tolist()):
        out[i, : min(size, width)] = flat[at : at + size][:width]
        at += size
    return out


def _norms(vectors: pa.Array) -> np.ndarray:
    return np.array([np.sqrt((np.frombuffer(v, dtype="<i4").astype(np.float64) ** 2).sum()) for v in vectors.to_pylist()])


def _directions(matrix: np.ndarray) -> np.ndarray:
    return matrix / np.maximum(np.linalg.norm(matrix, axis=1, keepdims=True), 1e-300)


def fit_centres(anchors: np.ndarray, count: int, rounds: int = 6) -> np.ndarray:
    """Unit centres of the anchors by spherical k-means, from evenly spaced first ones."""
    units = _directions(anchors)
    centres = units[np.linspace(0, len(units) - 1, count).astype(int)].copy()
    for _ in range(rounds):
        own = (units @ centres.T).argmax(axis=1)
        for c in range(count):
            total = units[own == c].sum(axis=0)
            if (length := np.linalg.norm(total)) > 0:
                centres[c] = total / length
    return centres


@dataclass
class Block:
    """Anchors of one broadcast, by cluster, and what each looks for: a range of scores in every slot."""

    rows: np.ndarray
    labels: np.ndarray
    matrix: np.ndarray
    centres: np.ndarray
    low: np.ndarray  # anchors x slots: the least score that counts, and the largest
    high: np.ndarray
    same: bool  # whether candidates have the anchor's label, or another one

    def clusters(self) -> list[tuple[np.ndarray, np.ndarray, float]]:
        """Each cluster's members, centre and radius."""
        cosine = _directions(self.matrix) @ self.centres.T
        own = cosine.argmax(axis=1)
        some = self.matrix.any(axis=1)  # a null vector scores 0 with everything and has no direction
        out = []
        for c in np.unique(own):
            members = np.flatnonzero(own == c)
            angles = np.arccos(np.clip(cosine[members[some[members]], c], -1, 1))
            out.append((members, self.centres[c], float(angles.max(initial=0.0))))
        return out


class _Best:
    """The best candidates of a cluster's members so far, a few for each member and slot."""

    def __init__(self, block: Block, members: np.ndarray, keep: int):
        self.low, self.high, self.keep = block.low[members], block.high[members], keep
        self.need = self.low.copy()  # a slot's worst score once it is full
        self.slots = self.low.shape[1]
        self.entries = [np.zeros(0, np.int64) for _ in range(5)]  # slot of member, minus score, id, no id, row

    def worst(self) -> np.ndarray:
        return self.need.min(axis=1)

    def add(self, member: np.ndarray, score: np.ndarray, ids: np.ndarray, unknown: np.ndarray, rows: np.ndarray) -> None:
        found = []
        for slot in range(self.slots):
            ok = (score >= self.need[member, slot]) & (score <= self.high[member, slot])
            found.append([member[ok] * self.slots + slot, -score[ok], ids[ok], unknown[ok], rows[ok]])
        if not any(len(x[0]) for x in found):
            return
        entries = [np.concatenate([own, *(x[i] for x in found)]) for i, own in enumerate(self.entries)]
        slot, less, ids, unknown, rows = entries
        order = np.lexsort((rows, ids, unknown, less, slot))
        entries = [x[order] for x in entries]
        slot = entries[0]
        first = np.searchsorted(slot, slot)
        place = np.arange(len(slot)) - first
        self.entries = [x[place < self.keep] for x in entries]
        full = place == self.keep - 1
        member, which = np.divmod(slot[full], self.slots)
        self.need[member, which] = np.maximum(self.low[member, which], -entries[1][full])


def _walk(block: Block, clusters: list, best: list[_Best], rows, ids, unknown, labels, matrix, norms) -> None:
    """Let every cluster's members walk a block of candidates in the order of the cluster's bound."""
    own = np.linalg.norm(block.matrix, axis=1)
    units = matrix / np.maximum(norms, 1e-300)[:, None]
    for (members, centre, radius), top in zip(clusters, best):
        angle = np.arccos(np.clip(units @ centre, -1, 1))
        bound = norms * np.cos(np.maximum(0, angle - radius - 1e-6))
        order = np.argsort(-bound, kind="stable")
        active = np.arange(len(members))
        for at in range(0, len(order), STRIDE):
            reach = bound[order[at]] * own[members[active]]
            active = active[reach + np.abs(reach) * 1e-9 + 1e-6 >= top.worst()[active]]
            if not len(active):
                break
            listed = order[at : at + STRIDE]
            who = members[active]
            score = block.matrix[who] @ matrix[listed].T
            fits = (block.labels[who][:, None] == labels[listed][None, :]) == block.same
            fits &= block.rows[who][:, None] != rows[listed][None, :]
            i, j = np.nonzero(fits & (score >= top.worst()[active][:, None]))
            if len(i):
                chosen = listed[j]
                top.add(active[i], score[i, j].astype(np.int64), ids[chosen], unknown[chosen], rows[chosen])


def _best_in_tasks(candidates: DataFrame, block: Block, keep: int) -> DataFrame:
    """Each task's best candidates for the block's anchors."""
    shared = candidates.sparkSession.sparkContext.broadcast(block)

    def walked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        clusters = own.clusters()
        best = [_Best(own, members, keep) for members, _, _ in clusters]
        for batch in batches:
            if not batch.num_rows:
                continue
            row, label = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 2))
            unknown = batch.column(1).is_null().to_numpy(zero_copy_only=False).astype(np.int64)
            ids = pc.fill_null(batch.column(1), 0).to_numpy(zero_copy_only=False)
            vectors = batch.column(3)
            _walk(own, clusters, best, row, ids, unknown, label, _matrix(vectors, own.matrix.shape[1]), _norms(vectors))
        for (members, _, _), top in zip(clusters, best):
            slot, less, ids, unknown, row = top.entries
            if len(slot):
                member, which = np.divmod(slot, top.slots)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(own.rows[members[member]]), pa.array(which.astype(np.int32)), pa.array(row),
                     pa.array(ids, mask=unknown.astype(bool)), pa.array(-less)],
                    ["anchor", "slot", "other", "id", "score"],
                )

    return arrow_map(candidates.select("row", "id", "label", "vector"), walked, _FOUND)


def _merged(found: DataFrame, keep: int) -> DataFrame:
    """The best of all tasks, with ``place`` from 1."""
    order = Window.partitionBy("anchor", "slot").orderBy(F.col("score").desc(), F.col("id").asc_nulls_last(), "other")
    return found.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= keep)


def mine_negatives(
    vectors: DataFrame, anchor: Column, positives: int = 5, negatives: int = 5, low: int = 80, high: int = 100,
    block_anchors: int = BLOCK,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    ``vectors`` has ``vec_id``, ``label`` and ``embedding``; ``anchor`` says which rows are anchors. Components are
    scaled to floor(256 x), scores are inner products of those, higher ones first, ties by the smaller id, no id
    last. An anchor's positives are its best rows of the same label. For each, the negatives are the anchor's best
    rows of other labels whose score is between ``low`` and ``high`` percent of the positive's; a negative positive
    score has none.

    Rows without a label or vector, and vectors with a component that is NULL or not finite, take no part, and so
    do vectors longer than 2^18, whose scores would not be exact. Vectors of unequal length are compared as if the
    shorter one ended in zeros. Repeated rows are rows of their own; only the anchor's own row is not its positive.
    A NULL ``anchor`` is none. Other columns are not looked at; an empty table, or one without anchors, gives no
    rows. The clusters' centres are fitted on at most 4,096 anchors; that changes the work, not the result.
    """
    spark = vectors.sparkSession
    rows = written(scaled_vectors(vectors, anchor), "scaled-vectors")
    anchors = rows.filter("anchor")
    count = anchors.count()
    blocks = max(1, -(-count // block_anchors))
    sample = anchors.select("vector").orderBy(F.xxhash64("row")).limit(FIT).toArrow().column(0)
    width = max((len(v) // 4 for v in sample.to_pylist()), default=0)
    found = spark.createDataFrame(
        [], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    )
    if not count:
        return found
    for k in range(blocks):
        own = anchors.filter(F.pmod(F.xxhash64("row"), F.lit(blocks)) == k).toArrow()
        if not own.num_rows:
            continue
        wide = max(width, pc.max(pc.binary_length(own.column("vector"))).as_py() // 4)
        centres = fit_centres(_matrix(sample, wide), min(CENTRES, -(-len(sample) // MEMBERS)))
        names = {row: i for i, row in enumerate(own.column("row").to_pylist())}
        everything = np.full((len(names), 1), np.inf)
        block = Block(
            own.column("row").to_numpy(), own.column("label").to_numpy(), _matrix(own.column("vector"), wide), centres,
            -everything, everything, True,
        )
        best = written(_merged(_best_in_tasks(rows, block, positives), positives), "positives")
        chosen = best.toArrow()  # a few rows for each anchor of the block
        floor, ceiling = np.full((len(names), positives), np.inf), np.full((len(names), positives), -np.inf)
        who = np.array([names[row] for row in chosen.column("anchor").to_pylist()], dtype=np.int64)
        place, score = chosen.column("place").to_numpy() - 1, chosen.column("score").to_numpy()
        useful = score >= 0
        who, place, score = who[useful], place[useful], score[useful]
        floor[who, place] = -(-low * score // 100)
        ceiling[who, place] = high * score // 100
        block = Block(block.rows, block.labels, block.matrix, centres, floor, ceiling, False)
        mined = _merged(_best_in_tasks(rows, block, negatives), negatives)
        positive = best.select("anchor", (F.col("place") - 1).alias("slot"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
        pairs = mined.join(positive, ["anchor", "slot"]).join(anchors.select(F.col("row").alias("anchor"), F.col("id").alias("anchor_id")), "anchor")
        found = found.unionAll(written(
            pairs.select(
                "anchor_id", "positive_id", F.col("place").cast("int").alias("rank"), F.col("id").alias("negative_id"),
                "positive_score", F.col("score").alias("negative_score"),
            ), "negatives",
        ))
    return found
