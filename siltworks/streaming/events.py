"""Events conformed as a stream: null keys dropped, redeliveries removed, text normalised, date stamped.

The source is any streaming DataFrame: files here, a message topic where its connector is installed.
"""

from __future__ import annotations

import datetime
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from siltworks.contracts import TableContract
from siltworks.functions import named
from siltworks.operators import drop_null_key
from siltworks.plans.conform import Rules, check_rules, in_range, normalise, stamp
from siltworks.streaming.reports import BatchReport, add_recent, batch_report

_SALT = "__salt"
_PARTITIONS = "spark.sql.shuffle.partitions"
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_REPORTS = "spark.sql.streaming.numRecentProgressUpdates"
_SEED = 20240131
FILES_PER_BATCH = 1000


def stream_session(spark: SparkSession, *, state_partitions: int | None = None, rocksdb: bool = False) -> SparkSession:
    """A session of the stream's own, for its source and everything after it; the caller's settings stay as they are.

    ``state_partitions`` is over how many tasks keys are remembered, ``rocksdb`` keeps them on the executors' disks
    instead of in their memory. The session holds many progress reports, so that none is missed by ``await_sink``.
    """
    own = spark.newSession()
    for name in (_PARTITIONS, "spark.checkpoint.dir", "spark.sql.session.timeZone"):
        if (value := spark.conf.get(name, None)) is not None and spark.conf.isModifiable(name):
            own.conf.set(name, value)
    if state_partitions is not None:
        own.conf.set(_PARTITIONS, state_partitions)
    if rocksdb:
        own.conf.set(_PROVIDER, _ROCKSDB)
    own.conf.set(_REPORTS, 10_000)
    return own


def scan_stream(
    spark: SparkSession, contract: TableContract, path: str, *, max_files_per_trigger: int | None = None,
    rfc4180: bool = True,
) -> DataFrame:
    """Stream the CSV files of a directory, with the contract's schema, as they arrive."""
    reader = spark.readStream.option("header", True).schema(contract.schema)
    if rfc4180:
        reader = reader.option("escape", '"')
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.csv(path)


def events_silver_stream(
    events: DataFrame, keys: Sequence[str], event_time: str, watermark: str, rules: Rules = Rules(),
    run_date: datetime.date | None = None, *, salts: int = 32,
) -> DataFrame:
    """Conform a stream of events.

    The first arrival of a key survives (the batch job keeps the smallest row), so stream and batch agree
    where duplicates are exact redeliveries. ``watermark`` must cover the real disorder of the stream:
    rows behind it are dropped, see ``late_rows``. A key is remembered until the watermark passes its
    event time plus that delay. Rows without an event time would be remembered for one batch only, and could be in
    the sink twice: they are not part of the result, see ``untimed_events``.

    De-duplication has no per-task combine, so a key that is redelivered very often would send all its
    rows to one task. It therefore runs twice: first by key and salt, which spreads such a key over
    up to ``salts`` tasks and lets one row of each pass, then by key alone. The salt is drawn per row, also within
    one source partition; its seed is fixed, so a rerun task draws the same. ``salts=1`` leaves the first step out.
    """
    check_rules(events, rules)
    timed = as_instant(events, event_time).filter(named(event_time).isNotNull())
    first = first_of_key(drop_null_key(timed, keys).withWatermark(event_time, watermark), keys, salts)
    ranged = first.filter(in_range(rules)) if rules.ranges else first
    return stamp(normalise(ranged, rules), run_date)


def as_instant(events: DataFrame, event_time: str) -> DataFrame:
    """Watermarks need an instant; of a time without a zone the session time zone says which one."""
    if isinstance(events.schema[event_time].dataType, T.TimestampNTZType):
        return events.withColumns({event_time: named(event_time).cast("timestamp")})
    return events


def first_of_key(events: DataFrame, keys: Sequence[str], salts: int) -> DataFrame:
    """The first arrival of each key of a stream with a watermark, in two steps if ``salts`` is more than one."""
    if salts > 1:
        events = (
            events.withColumns({_SALT: F.floor(F.rand(_SEED) * salts)})
            .dropDuplicatesWithinWatermark([*keys, _SALT])
            .drop(_SALT)
        )
    return events.dropDuplicatesWithinWatermark(list(keys))


def untimed_events(events: DataFrame, event_time: str, run_date: datetime.date | None = None) -> DataFrame:
    """The rows without an event time, as they came, to be kept apart: for a sink of their own."""
    return stamp(events.filter(named(event_time).isNull()), run_date)


def trigger(writer: DataStreamWriter, processing_time: str | None) -> DataStreamWriter:
    """Every so often, or over what is there in bounded batches."""
    return writer.trigger(processingTime=processing_time) if processing_time else writer.trigger(availableNow=True)


def start_events_sink(
    silver: DataFrame, path: str, checkpoint: str, *, processing_time: str | None = None, name: str | None = None,
    state_partitions: int | None = None,
) -> StreamingQuery:
    """Append the stream to a Parquet directory, exactly once per checkpoint.

    Without ``processing_time`` the query takes what is there in bounded batches and ends. Both paths
    must be on storage that every executor sees. ``state_partitions`` is over how many tasks the keys are
    remembered, by default the session's shuffle partitions; a checkpoint keeps its first number. It is set on the
    session for the moment of the start: where other threads use the session, take ``stream_session`` instead.
    """
    writer = silver.writeStream.format("parquet").outputMode("append")
    writer = writer.option("path", path).option("checkpointLocation", checkpoint)
    writer = trigger(writer.queryName(name) if name else writer, processing_time)
    if state_partitions is None:
        return writer.start()
    conf = silver.sparkSession.conf
    before = conf.get(_PARTITIONS)
    conf.set(_PARTITIONS, state_partitions)
    try:
        return writer.start()  # the query runs in a copy of the session made here
    finally:
        conf.set(_PARTITIONS, before)


def await_all(queries: Sequence[StreamingQuery], poll_seconds: float = 0.5) -> None:
    """Wait until all queries have ended. If one fails, the others are stopped and its error is raised."""
    try:
        while any(query.isActive for query in queries):
            for query in queries:
                query.awaitTermination(poll_seconds)  # raises what made the query fail
    finally:
        for query in queries:
            query.stop()


def await_sink(query: StreamingQuery, late_report: str, poll_seconds: float = 0.5) -> int:
    """Wait for a query's end; return the rows that all its runs dropped for being behind the watermark.

    The sums are kept in ``late_report``, see ``BatchReport``, so that later runs from the same checkpoint add to them;
    a batch that ran again counts once. To listen from before the start, use ``BatchReport`` itself.
    """
    spark = SparkSession.active()
    report = BatchReport(spark, late_report)
    try:
        while not query.awaitTermination(poll_seconds):
            add_recent(report, query)
            report.write_now_and_then()
    finally:
        add_recent(report, query)
        report.write()
    return late_rows_of(spark, late_report)


def late_rows_of(spark: SparkSession, late_report: str) -> int:
    """The sum over all queries of a report; 0 if there is none."""
    return batch_report(spark, late_report).agg(F.coalesce(F.sum("late_rows"), F.lit(0))).first()[0]


def late_rows(query: StreamingQuery) -> int:
    """Rows dropped for being behind the watermark, over the progress reports that the query still holds.

    A query holds a hundred of them by default; ``BatchReport`` counts every batch.
    """
    last = {p["batchId"]: sum(op["numRowsDroppedByWatermark"] for op in p["stateOperators"]) for p in query.recentProgress}
    return sum(last.values())
