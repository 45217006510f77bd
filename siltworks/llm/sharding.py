"""Shards over fixed virtual slots: records hash into slots, slots are mapped to shards, and the map is versioned.

The number of slots never changes, so a record's slot is final. What changes is the slot-to-shard map: a small
table, stored by version, that ``rebalance`` edits by moving as few slots as the balance needs.
"""

from __future__ import annotations

import heapq
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from siltworks.llm.tables import text_or_empty, written
from siltworks.workspace import scratch_dir

SLOTS = 4096
PARTS = 32  # of a slot, for numbering its rows in several tasks
_MAP_SCHEMA = T.StructType(
    [
        T.StructField("vslot", T.IntegerType()),
        T.StructField("shard", T.IntegerType()),
        T.StructField("first", T.LongType()),
    ]
)


def record_size(text: str = "text") -> Column:
    """Bytes of the UTF-8 text (NULL: none) and one for the record's end."""
    return F.octet_length(text_or_empty(text)).cast("long") + F.lit(1)


def virtual_slot(doc_id: str = "doc_id", slots: int = SLOTS) -> Column:
    """The record's slot for good, by a hash of its id, or of its text where it has no id."""
    return F.pmod(F.coalesce(F.when(F.col(doc_id).isNotNull(), F.xxhash64(F.col(doc_id))), F.xxhash64(text_or_empty())), F.lit(slots)).cast("int")


def slot_part(parts: int = PARTS) -> Column:
    """Which part of its slot a record is in, by another hash of id and text."""
    return F.pmod(F.xxhash64(F.col("doc_id"), text_or_empty(), F.lit(1)), F.lit(parts)).cast("int")


def part_sizes(docs: DataFrame, slots: int = SLOTS, parts: int = PARTS) -> DataFrame:
    """Rows and bytes of every part of every slot: ``vslot, part, n, b``, at most slots times parts rows."""
    sized = docs.select(virtual_slot(slots=slots).alias("vslot"), slot_part(parts).alias("part"), record_size().alias("size"))
    return sized.groupBy("vslot", "part").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("b"))


def slot_sizes(sizes: DataFrame, slots: int = SLOTS) -> list[tuple[int, int]]:
    """Rows and bytes of every slot: at most ``slots`` rows leave the cluster, whatever the input."""
    totals = {r["vslot"]: (r["n"], r["b"]) for r in sizes.groupBy("vslot").agg(F.sum("n").alias("n"), F.sum("b").alias("b")).collect()}
    return [totals.get(slot, (0, 0)) for slot in range(slots)]


def balanced_map(sizes: Sequence[tuple[int, int]], shards: int) -> list[int]:
    """A first map: the largest slots first, each to the shard with the fewest bytes so far."""
    if shards < 1:
        raise ValueError("at least one shard is needed")
    loads = [(0, shard) for shard in range(shards)]
    shard_of = [0] * len(sizes)
    for slot in sorted(range(len(sizes)), key=lambda s: (-sizes[s][1], s)):
        load, shard = heapq.heappop(loads)
        shard_of[slot] = shard
        heapq.heappush(loads, (load + sizes[slot][1], shard))
    return shard_of


def rebalance(shard_of: Sequence[int], sizes: Sequence[tuple[int, int]], shards: int, tolerance: float = 0.02) -> list[int]:
    """Edit a map for new sizes or another number of shards, moving few slots.

    Slots of shards that are gone move first. Then, while a shard is above the mean by more than ``tolerance``,
    it gives the largest slot that still fits to the emptiest shard. All other slots stay where they are.
    """
    loads = [0] * shards
    for slot, shard in enumerate(shard_of):
        if shard < shards:
            loads[shard] += sizes[slot][1]
    edited = list(shard_of)
    homeless = [s for s, shard in enumerate(shard_of) if shard >= shards]
    for slot in sorted(homeless, key=lambda s: (-sizes[s][1], s)):
        to = min(range(shards), key=lambda shard: (loads[shard], shard))
        edited[slot], loads[to] = to, loads[to] + sizes[slot][1]
    limit = sum(loads) / shards * (1 + tolerance)
    for giver in sorted(range(shards), key=lambda shard: -loads[shard]):
        for slot in sorted((s for s in range(len(edited)) if edited[s] == giver), key=lambda s: (-sizes[s][1], s)):
            to = min(range(shards), key=lambda shard: (loads[shard], shard))
            if loads[giver] <= limit or to == giver:
                break
            if loads[to] + sizes[slot][1] < loads[giver]:
                edited[slot] = to
                loads[giver] -= sizes[slot][1]
                loads[to] += sizes[slot][1]
    return edited


def write_map(spark: SparkSession, path: str, version: int, shard_of: Sequence[int], sizes: Sequence[tuple[int, int]]) -> None:
    """Store one version of the map, with the number that each slot's first row has within its shard."""
    next_row: dict[int, int] = {}
    rows = []
    for slot, shard in enumerate(shard_of):
        first = next_row.get(shard, 0)
        rows.append((slot, shard, first))
        next_row[shard] = first + sizes[slot][0]
    spark.createDataFrame(rows, _MAP_SCHEMA).coalesce(1).write.mode("errorifexists").parquet(f"{path}/version={version}")


def read_map(spark: SparkSession, path: str, version: int) -> DataFrame:
    return spark.read.schema(_MAP_SCHEMA).parquet(f"{path}/version={version}")


def shard_documents(
    docs: DataFrame, shards: int, slots: int = SLOTS, map_path: str | None = None, parts: int = PARTS
) -> DataFrame:
    """Put every record into one of ``shards`` shards of near equal bytes.

    Adds ``shard``, ``slot`` (the row's number within its shard, without gaps from 0) and ``vslot``; columns of
    the input with these names are replaced. The map goes to ``map_path`` as version 0.

    One scan sums rows and bytes per part of a slot; the map comes from ``slots`` numbers on the driver. The slot is
    the unit of the map, the part that of numbering: one exchange by part numbers the rows, each part going on
    where the one before it ends, so a task holds a ``parts``-th of a slot. A NULL text has the size 1. Rows without
    an id go to the slot of their text and repeated ids to the slot of the id. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    by_part = written(part_sizes(docs, slots, parts), "shard-parts")
    sizes = slot_sizes(by_part, slots)
    path = map_path or scratch_dir(spark, "llm-shard-map")
    write_map(spark, path, 0, balanced_map(sizes, shards), sizes)
    before = F.sum("n").over(Window.partitionBy("vslot").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    firsts = by_part.select("vslot", "part", F.coalesce(before, F.lit(0)).alias("__before"))
    places = read_map(spark, path, 0).select("vslot", "shard", F.col("first").alias("__first"))
    places = firsts.join(places, "vslot").select(
        F.col("vslot").alias("__vslot"), F.col("part").alias("__of"), "shard", (F.col("__first") + F.col("__before")).alias("__start")
    )
    kept = [c for c in docs.columns if c not in ("shard", "slot", "vslot")]
    rows = docs.select(*[F.col(f"`{c}`") for c in kept], virtual_slot(slots=slots).alias("vslot"), slot_part(parts).alias("__part"))
    order = Window.partitionBy("vslot", "__part").orderBy(F.col("doc_id").asc_nulls_first(), F.xxhash64(text_or_empty()))
    numbered = rows.withColumn("__number", F.row_number().over(order).cast("long") - 1)
    # Rows are dealt out by slot and part already, so only the places move, which are slots times parts rows at most.
    mapped = numbered.join(places.hint("merge"), (F.col("vslot") == F.col("__vslot")) & (F.col("__part") == F.col("__of")))
    return mapped.select(*[F.col(f"`{c}`") for c in kept], "shard", (F.col("__start") + F.col("__number")).alias("slot"), "vslot")
