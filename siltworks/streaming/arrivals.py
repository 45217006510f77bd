"""Events as they arrive, from one read of their source: timely rows for the silver stream, late and untimed ones kept.

Each micro-batch is written once, as three parts of one folder that appears when it is whole; a batch that runs again
after a crash finds its folder and writes nothing. A row is late if it is as far as the watermark behind the newest
event of the batches before the last one, which is when Spark itself drops a row; here it goes to a table instead.

The folder's name says up to which event time the stream had come. The silver stream takes that as its clock, which
never runs back, so it drops no timely row, and forgets a key once the clock has moved on by the watermark.
"""

from __future__ import annotations

import datetime
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from siltworks.functions import named
from siltworks.operators import drop_null_key
from siltworks.plans.conform import Rules, check_rules, in_range, normalise, stamp
from siltworks.sources.replace import file_system, qualified, remove_directory
from siltworks.streaming.events import as_instant, first_of_key, trigger

TIMELY, LATE, UNTIMED = "timely", "late", "untimed"
_BATCH, _UNTIL, _KIND = "arrival_batch", "arrival_until", "arrival_kind"
_CLOCK = "__clock"


def _delay_ms(spark: SparkSession, watermark: str) -> int:
    """The watermark in milliseconds; months have no fixed length and are refused."""
    delay = spark.sql(f"SELECT CAST(INTERVAL '{watermark}' AS INTERVAL DAY TO SECOND) AS delay").first()["delay"]
    return int(delay / datetime.timedelta(milliseconds=1))


def _reached(spark: SparkSession, path: str, batch: int) -> int | None:
    """The newest event time, in milliseconds, of the batches before this one."""
    files, make = file_system(spark, path)
    if not files.exists(make(path)):
        return None
    names = (status.getPath().getName() for status in files.listStatus(make(path)))
    earlier = [int(name.partition("=")[2]) for name in names if name.startswith(f"{_BATCH}=")]
    earlier = [number for number in earlier if number < batch]
    if not earlier:
        return None
    (until,) = files.listStatus(make(f"{path}/{_BATCH}={max(earlier)}"))
    return int(until.getPath().getName().partition("=")[2])


def start_arrivals(
    events: DataFrame, event_time: str, watermark: str, path: str, checkpoint: str, *, processing_time: str | None = None,
    name: str | None = None,
) -> StreamingQuery:
    """Write a stream of events, read once, to ``path``: see ``scan_arrivals`` and ``arrivals_silver_stream``.

    ``watermark`` is how far behind the newest event of the batches before the last one a row may be; it must not have
    months. Rows at or behind that are late, rows without an event time untimed. Every row is in one part, exactly once per
    checkpoint. The path needs storage that renames a folder in one step. Without ``processing_time`` the query takes
    what is there in bounded batches and ends.
    """
    if clash := {_BATCH, _UNTIL, _KIND} & set(events.columns):
        raise ValueError(f"columns {sorted(clash)} are names of the arrivals' own")
    events = as_instant(events, event_time)
    path, delay = qualified(events.sparkSession, path), _delay_ms(events.sparkSession, watermark)

    def land(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        files, make = file_system(spark, path)
        place, staged = f"{path}/{_BATCH}={number}", f"{path}/.arriving-{number}"
        if files.exists(make(place)):
            return  # written before a crash, which kept the batch from being marked as done
        remove_directory(spark, staged)
        reached, before, at = _reached(spark, path, number), _reached(spark, path, number - 1), named(event_time)
        late = at <= F.timestamp_millis(F.lit(before - delay)) if before is not None else F.lit(False)
        kind = F.when(at.isNull(), UNTIMED).when(late, LATE).otherwise(TIMELY)
        seen = Observation()
        rows = batch.withColumns({_KIND: kind}).observe(seen, F.max(F.unix_millis(at)).alias("newest"))
        spark.conf.set("spark.sql.maxConcurrentOutputFileWriters", 3)  # of the query's own session: no sort by kind
        rows.write.partitionBy(_KIND).parquet(f"{staged}/rows")
        until = max(1, *(ms for ms in (seen.get["newest"], reached) if ms is not None), 1)
        for old, new in ((f"{staged}/rows", f"{staged}/{_UNTIL}={until}"), (staged, place)):
            if not files.rename(make(old), make(new)):
                raise OSError(f"cannot move {old}")

    writer = events.writeStream.foreachBatch(land).option("checkpointLocation", checkpoint)
    return trigger(writer.queryName(name) if name else writer, processing_time).start()


def scan_arrivals(spark: SparkSession, path: str, kind: str, schema: T.StructType) -> DataFrame:
    """All rows that have arrived so far of one kind: ``timely``, ``late`` or ``untimed``. ``schema`` is the events'."""
    if kind not in (TIMELY, LATE, UNTIMED):
        raise ValueError(f"unknown kind of arrivals {kind!r}")
    files, make = file_system(spark, path)
    if not files.globStatus(make(f"{path}/{_BATCH}=*/{_UNTIL}=*/{_KIND}={kind}")):
        return spark.createDataFrame([], schema)
    rows = spark.read.schema(_with_parts(schema)).parquet(qualified(spark, path))
    return rows.filter(F.col(_KIND) == kind).drop(_BATCH, _UNTIL, _KIND)


def _with_parts(schema: T.StructType) -> T.StructType:
    parts = [T.StructField(_BATCH, T.LongType()), T.StructField(_UNTIL, T.LongType()), T.StructField(_KIND, T.StringType())]
    return T.StructType([*schema.fields, *parts])


def arrivals_silver_stream(
    spark: SparkSession, path: str, schema: T.StructType, keys: Sequence[str], watermark: str, rules: Rules = Rules(),
    run_date: datetime.date | None = None, *, salts: int = 32, max_files_per_trigger: int | None = None,
) -> DataFrame:
    """The timely arrivals conformed, one row per key: ``events_silver_stream`` without a row lost to the watermark.

    A key is remembered until the newest event is further than the watermark from where the stream was when the key
    came first. ``schema`` is that of the events, with the event time as a timestamp.
    """
    reader = spark.readStream.schema(_with_parts(schema)).option("basePath", qualified(spark, path))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    rows = reader.parquet(f"{qualified(spark, path)}/{_BATCH}=*/{_UNTIL}=*/{_KIND}={TIMELY}")
    check_rules(rows, rules)
    clocked = drop_null_key(rows, keys).withColumns({_CLOCK: F.timestamp_millis(_UNTIL)}).drop(_BATCH, _UNTIL, _KIND)
    first = first_of_key(clocked.withWatermark(_CLOCK, watermark), keys, salts).drop(_CLOCK)
    ranged = first.filter(in_range(rules)) if rules.ranges else first
    return stamp(normalise(ranged, rules), run_date)
