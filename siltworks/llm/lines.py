"""Line de-duplication over levelled sorted runs of line hashes, in native expressions.

A run is a Parquet table of 128-bit line hashes, bucketed and sorted by them, with the first document that holds each
line. A new batch of documents goes to the buckets in one exchange and is merge-joined against the runs where they are:
lines that a run has are copies, the others become a run of level 0. When a level has ``fanout`` runs they are merged
into one run of the next level, so a store of n batches has about log(n) runs to join, and a run is shuffled only when
it is merged.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siltworks.llm.tables import BLANKS, lower_ascii, shuffle_width, text_or_empty, written
from siltworks.workspace import scratch_dir

MIN_CHARS = 10
_RUN = "a long, b long, owner {kind}"


def line_key(line: Column) -> Column:
    """The line without blanks at its ends and with A-Z lower-cased."""
    return lower_ascii(F.btrim(line, F.lit(BLANKS)))


def _hashes(text: Column) -> Column:
    """Per line the two halves of its key's hash, NULL for keys under ten code points."""

    def hashed(line: Column) -> Column:
        key = line_key(line)
        pair = F.struct(F.xxhash64(key).alias("a"), F.xxhash64(key, F.lit(1)).alias("b"))
        return F.when(F.char_length(F.btrim(line, F.lit(BLANKS))) >= MIN_CHARS, pair)

    return F.transform(F.split(text, "\n"), hashed)


class LineRuns:
    """A store of sorted runs below ``path``; ``levels`` lists the runs' tables, newest last.

    ``kind`` is the type of the document ids. Batches must come in ascending order of ids: the first document
    that holds a line is then the one with the smallest id. Rows without an id count as one last document. A run has
    ``buckets`` buckets, by default the session's shuffle partitions. Runs are external tables of the current
    database, which is where Spark keeps what it knows of buckets; ``close`` removes the entries and keeps the files.
    """

    def __init__(self, spark: SparkSession, path: str, kind: str = "bigint", fanout: int = 3, buckets: int | None = None):
        self.spark, self.path, self.kind, self.fanout = spark, path.rstrip("/"), kind, fanout
        self.buckets = buckets or shuffle_width(spark)
        self.name = f"siltworks_line_runs_{uuid.uuid4().hex}"
        self.levels: list[list[str]] = []
        self.made = 0

    def runs(self) -> list[str]:
        return [run for level in self.levels for run in level]

    def known(self) -> DataFrame:
        """All hashes of the store; no two runs share one."""
        if not self.runs():
            return self.spark.createDataFrame([], _RUN.format(kind=self.kind))
        return reduce(DataFrame.unionAll, [self.spark.table(run) for run in self.runs()])

    def close(self) -> None:
        for run in self.runs():
            self.spark.sql(f"DROP TABLE IF EXISTS {run}")

    def _add(self, rows: DataFrame, level: int) -> None:
        run = f"{self.name}_{self.made}"
        writer = rows.select("a", "b", "owner").write.bucketBy(self.buckets, "a", "b").sortBy("a", "b")
        writer.option("path", f"{self.path}/level={level}/run-{self.made}").saveAsTable(run)
        self.made += 1
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(run)

    def _compact(self) -> None:
        level = 0
        while level < len(self.levels):
            if len(self.levels[level]) >= self.fanout:
                merged, self.levels[level] = self.levels[level], []
                rows = reduce(DataFrame.unionAll, [self.spark.table(run) for run in merged])
                self._add(rows.repartition(self.buckets, "a", "b"), level + 1)
                for run in merged:
                    self.spark.sql(f"DROP TABLE {run}")
            level += 1

    def looked_up(self, owners: DataFrame) -> DataFrame:
        """Distinct hashes ``a, b, …`` with ``held``, the document in the store that holds the line, or NULL.

        The runs' rows are not moved: each run is joined bucket by bucket.
        """
        found = owners
        for k, run in enumerate(self.runs()):
            own = self.spark.table(run).select("a", "b", F.struct("owner").alias(f"run{k}"))
            found = found.join(own.hint("merge"), ["a", "b"], "left")
        held = [F.col(f"run{k}") for k in range(len(self.runs()))]
        nothing = F.lit(None).cast(f"struct<owner:{self.kind}>")
        return found.withColumn("held", F.coalesce(*held, nothing)).drop(*[f"run{k}" for k in range(len(held))])

    def absorb(self, keys: DataFrame) -> DataFrame:
        """Add a batch of ``doc_id, a, b`` (distinct); returns those whose line an earlier document holds.

        The smallest id per hash combines before its exchange, so the runs meet one row per line, however many
        documents hold it. The batch's own rows are then joined with the lines that occur elsewhere, by plain
        exchanges, which adaptive execution splits where very many documents hold one line.
        """
        owners = keys.groupBy("a", "b").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("copies"))
        looked = written(self.looked_up(owners), "line-owners")
        fresh = looked.filter("held is null").select("a", "b", F.col("first").alias("owner"))
        self._add(fresh.repartition(self.buckets, "a", "b"), 0)
        owner = F.when(F.col("held").isNotNull(), F.col("held.owner")).otherwise(F.col("first"))
        shared = looked.filter("held is not null or copies > 1").select("a", "b", owner.alias("owner")).hint("merge")
        later = F.col("owner").isNotNull() & (F.col("doc_id").isNull() | (F.col("doc_id") > F.col("owner")))
        copies = written(keys.join(shared, ["a", "b"]).filter(later).select("doc_id", "a", "b"), "line-copies")
        self._compact()
        return copies


def _between(low: object, high: object) -> Column:
    """Ids above ``low`` and up to ``high``; without ``high`` also rows without an id."""
    inside = F.lit(True) if low is None else F.col("doc_id") > F.lit(low)
    if high is None:
        return F.coalesce(inside, F.lit(True))
    return F.coalesce(inside & (F.col("doc_id") <= F.lit(high)), F.lit(False))


def dedup_lines(docs: DataFrame, batches: int = 4, fanout: int = 3, runs_path: str | None = None) -> DataFrame:
    """Drop each line whose key an earlier document holds; per row ``doc_id, n_lines, n_dropped, kept``.

    ``kept`` is the text of the lines that stay, joined by line feeds. Keys of under ten code points always
    stay, and so do all lines in the smallest id that holds their key. Documents go through the runs in
    ``batches`` of ascending ids, as they would arrive.

    Only hashes are shuffled by line; the texts are shuffled once, by id, next to the hashes that each of them
    loses. NULL and empty texts are one empty line. Rows without an id are one document, after all others; rows
    that repeat an id are one document too and each keeps a row. An empty table gives no rows.
    """
    spark = docs.sparkSession
    kind = docs.schema["doc_id"].dataType.simpleString()
    texts = docs.select("doc_id", text_or_empty().alias("text"))
    hashed = texts.select("doc_id", F.array_distinct(F.filter(_hashes(F.col("text")), lambda k: k.isNotNull())).alias("keys"))
    hashed = written(hashed, "line-hashes")
    runs = LineRuns(spark, runs_path or scratch_dir(spark, "llm-line-runs"), kind, fanout)
    steps = [i / batches for i in range(1, batches)] or [1.0]
    bounds = sorted(set(hashed.select(F.percentile_approx("doc_id", steps, 10_000)).first()[0] or []))
    copies = []
    for low, high in zip([None, *bounds], [*bounds, None]):
        keys = hashed.filter(_between(low, high)).select("doc_id", F.explode("keys").alias("key"))
        copies.append(runs.absorb(keys.select("doc_id", "key.a", "key.b")))
    runs.close()
    lost = reduce(DataFrame.unionByName, copies).groupBy("doc_id").agg(F.collect_set(F.struct("a", "b")).alias("lost"))
    lost = lost.withColumnRenamed("doc_id", "lost_id")

    joined = texts.join(lost, F.col("doc_id").eqNullSafe(F.col("lost_id")), "left")
    pairs = F.arrays_zip(F.split("text", "\n").alias("line"), _hashes(F.col("text")).alias("key"))
    stays = F.filter(pairs, lambda p: p["key"].isNull() | ~F.coalesce(F.array_contains(F.col("lost"), p["key"]), F.lit(False)))
    kept = F.when(F.col("lost").isNull(), F.lit(None)).otherwise(F.transform(stays, lambda p: p["line"]))
    joined = joined.select("doc_id", "text", F.size(F.split("text", "\n")).cast("long").alias("n_lines"), kept.alias("kept_lines"))
    return joined.select(
        "doc_id", "n_lines",
        F.when(F.col("kept_lines").isNull(), 0).otherwise(F.col("n_lines") - F.size("kept_lines")).cast("long").alias("n_dropped"),
        F.when(F.col("kept_lines").isNull(), F.col("text")).otherwise(F.array_join("kept_lines", "\n")).alias("kept"),
    )
