"""What the batches of a streaming query did, kept in a small file that later runs go on with.

A listener adds up the query's progress events; the sums, one line per query, replace the file at most every few
seconds and at the query's end. However many batches there are, two small files stay.
"""

from __future__ import annotations

import json
import threading
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from siltworks.sources.replace import file_system, qualified

REPORT_SCHEMA = "query_id string, batches long, input_rows long, late_rows long, last_batch long"
_FILES_KEPT = 2


def _files(spark: SparkSession, path: str) -> list[str]:
    files, make = file_system(spark, path)
    if not files.exists(make(path)):
        return []
    return sorted(s.getPath().getName() for s in files.listStatus(make(path)) if s.getPath().getName().endswith(".json"))


def batch_report(spark: SparkSession, path: str) -> DataFrame:
    """One row per query of a report: batches with rows, input rows, and rows dropped for being behind the watermark."""
    path = qualified(spark, path)
    names = _files(spark, path)
    return spark.read.schema(REPORT_SCHEMA).json(f"{path}/{names[-1]}") if names else spark.createDataFrame([], REPORT_SCHEMA)


class BatchReport(StreamingQueryListener):
    """Listens to the queries of a session, adds up their batches and keeps the sums below ``path``.

    A batch counts once however often its progress is told, also over restarts from the same checkpoint. Use it as
    a context around the start and the end of the queries: leaving it waits for the events of the queries that have
    ended, and writes the sums.
    """

    def __init__(self, spark: SparkSession, path: str, every_seconds: float = 5.0):
        self.spark, self.path, self.every = spark, qualified(spark, path), every_seconds
        self.sums = {r["query_id"]: r.asDict() for r in batch_report(spark, path).collect()}
        self.open: dict[str, tuple[int, int]] = {}  # the last batch of each query: its rows may be told again
        self.running: set[str] = set()
        self.changed, self.written_at, self.lock, self.idle = False, 0.0, threading.RLock(), threading.Condition()

    def add(self, query: str, batch: int, rows: int, late: int) -> None:
        """Count a batch; the batch that was told last may be told again with more rows."""
        with self.lock:
            own = self.sums.setdefault(query, dict(query_id=query, batches=0, input_rows=0, late_rows=0, last_batch=-1))
            before = self.open.get(query, (0, 0)) if batch == own["last_batch"] else (0, 0)
            if batch < own["last_batch"] or batch == own["last_batch"] and query not in self.open or not (rows or late):
                return
            own["batches"] += batch > own["last_batch"]
            own["input_rows"] += max(0, rows - before[0])
            own["late_rows"] += max(0, late - before[1])
            own["last_batch"] = batch
            self.open[query] = (max(rows, before[0]), max(late, before[1]))
            self.changed = True

    def write(self) -> None:
        """Replace the file, if anything has changed."""
        with self.lock:
            if not self.changed:
                return
            files, make = file_system(self.spark, self.path)
            names = _files(self.spark, self.path)
            number = int(names[-1].split(".")[0]) + 1 if names else 1
            text = "".join(json.dumps(own) + "\n" for own in self.sums.values())
            hidden, shown = make(f"{self.path}/_{number:012d}"), make(f"{self.path}/{number:012d}.json")
            out = files.create(hidden, True)
            out.write(bytearray(text.encode()))
            out.close()
            files.rename(hidden, shown)  # readers see whole files only
            for name in names[: 1 - _FILES_KEPT]:
                files.delete(make(f"{self.path}/{name}"), False)
            self.changed, self.written_at = False, time.monotonic()

    def write_now_and_then(self) -> None:
        if time.monotonic() - self.written_at >= self.every:
            self.write()

    def __enter__(self) -> BatchReport:
        self.spark.streams.addListener(self)
        return self

    def __exit__(self, *exception: object) -> None:
        started = {query.id for query in self.spark.streams.active}
        with self.idle:
            self.idle.wait_for(lambda: not (self.running - started), timeout=60)
        self.spark.streams.removeListener(self)
        self.write()

    def onQueryStarted(self, event) -> None:
        self.running.add(str(event.id))

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        late = sum(op.numRowsDroppedByWatermark for op in progress.stateOperators)
        self.add(str(progress.id), progress.batchId, progress.numInputRows, late)
        self.write_now_and_then()

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        with self.idle:
            self.running.discard(str(event.id))
            self.idle.notify_all()


def add_recent(report: BatchReport, query: StreamingQuery) -> None:
    """Add the batches that the query still holds reports of: those that ended before the report listened."""
    for p in query.recentProgress:
        report.add(str(p["id"]), p["batchId"], p["numInputRows"], sum(op["numRowsDroppedByWatermark"] for op in p["stateOperators"]))
