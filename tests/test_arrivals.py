"""Arrivals: every delivery is kept once, as timely, late or untimed; reports stay small."""

from __future__ import annotations

import datetime
import os
from collections import Counter
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from siltworks.streaming import (
    BatchReport, arrivals, arrivals_silver_stream, batch_report, events_silver_stream, scan_arrivals, start_arrivals,
    start_events_sink, stream_session,
)
from siltworks.streaming.events import await_all

SCHEMA = "event_id long, ts timestamp, v string"


def _at(day, hour=0):
    return None if day is None else datetime.datetime(2024, 1, 1) + datetime.timedelta(days=day - 1, hours=hour)


def _feed(spark, home, *batches):
    for rows in batches:
        rows = [(i, _at(day), f"v{i}") for i, day in rows]
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(f"{home}/feed")


def _schema(spark):
    return spark.createDataFrame([], SCHEMA).schema


def _arrive(own, home, watermark="1 day", name="feed"):
    source = own.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{home}/{name}")
    return start_arrivals(source, "ts", watermark, f"{home}/arrivals", f"{home}/cp")


def _silver(own, home, watermark="1 day", **options):
    silver = arrivals_silver_stream(own, f"{home}/arrivals", _schema(own), ["event_id"], watermark, **options)
    return start_events_sink(silver, f"{home}/silver", f"{home}/cp-silver")


def _ids(df):
    return Counter(r["event_id"] for r in df.collect())


def _kept(spark, home):
    parts = [spark.read.parquet(f"{home}/silver")]
    parts += [scan_arrivals(spark, f"{home}/arrivals", kind, _schema(spark)) for kind in ("late", "untimed")]
    return [_ids(df) for df in parts]


def test_silver_late_and_untimed_are_all_deliveries(spark, tmp_path):
    own = stream_session(spark, state_partitions=2)
    _feed(spark, tmp_path, [(1, 20), (9, None)], [(1, 20), (2, 20), (None, 20)], [(3, 2), (4, 21), (9, None)], [(5, 20), (6, 19), (3, 2)])
    _arrive(own, tmp_path).awaitTermination()
    _silver(own, tmp_path).awaitTermination()
    # Day 19 is exactly a day behind day 20, and late by the rule that Spark has: at or behind the watermark.
    assert _kept(spark, tmp_path) == [Counter([1, 2, 4, 5]), Counter({3: 2, 6: 1}), Counter({9: 2})]
    _feed(spark, tmp_path, [(7, 30), (4, 21), (8, 21)], [(10, 30), (13, 29)], [(10, 30), (11, 29), (12, 28)])
    _arrive(own, tmp_path).awaitTermination()
    _silver(own, tmp_path).awaitTermination()
    silver, late, untimed = _kept(spark, tmp_path)
    assert silver == Counter([1, 2, 4, 5, 7, 8, 10, 13]) and late == Counter({3: 2, 6: 1, 11: 1, 12: 1}) and untimed == Counter({9: 2})
    assert sorted(spark.read.parquet(f"{tmp_path}/silver").columns) == ["event_id", "ingestion_date", "ts", "v"]


def test_late_is_what_spark_itself_would_drop(spark, tmp_path):
    own = stream_session(spark, state_partitions=2)
    r = F.rand(5)
    for part in range(6):
        rows = spark.range(200).select(
            (F.col("id") + 1000 * part).alias("event_id"),
            F.expr(f"timestamp'2024-01-01' + make_interval(0, 0, 0, {part}, 0, 0, 0)").alias("ts"), F.lit("x").alias("v"),
        ).withColumn("ts", F.col("ts") - F.make_dt_interval(F.floor(r * 6), F.floor(r * 24)))
        rows.coalesce(1).write.mode("append").parquet(f"{tmp_path}/feed")
    _arrive(own, tmp_path, "2 days").awaitTermination()
    _silver(own, tmp_path, "2 days").awaitTermination()
    source = own.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/feed")
    plain = events_silver_stream(source, ["event_id"], "ts", "2 days")
    start_events_sink(plain, f"{tmp_path}/plain", f"{tmp_path}/cp-plain").awaitTermination()
    silver, late, _ = _kept(spark, tmp_path)
    assert silver == _ids(spark.read.parquet(f"{tmp_path}/plain"))
    assert late and sum(silver.values()) + sum(late.values()) == 1200


def test_the_silver_stream_may_take_parts_of_batches_that_jump_in_time(spark, tmp_path):
    """One batch of arrivals spans more than the watermark, in several files: none of its rows is late."""
    own = stream_session(spark, state_partitions=2)
    own.conf.set("spark.sql.files.maxPartitionBytes", 1)
    days = [(i, 1 + (i * 37) % 90) for i in range(60)]
    rows = [(i, _at(day), "v") for i, day in days]
    spark.createDataFrame(rows, SCHEMA).repartition(6).write.parquet(f"{tmp_path}/feed")
    source = own.readStream.schema(SCHEMA).parquet(f"{tmp_path}/feed")
    start_arrivals(source, "ts", "1 day", f"{tmp_path}/arrivals", f"{tmp_path}/cp").awaitTermination()
    query = _silver(own, tmp_path, max_files_per_trigger=1)
    query.awaitTermination()
    assert len(query.recentProgress) > 3
    assert _kept(spark, tmp_path)[0] == Counter(range(60))


@pytest.mark.parametrize("point", ["before", "between", "after"])
def test_a_crash_and_a_restart_keep_every_row_once(spark, tmp_path, monkeypatch, point):
    own = stream_session(spark, state_partitions=2)
    _feed(spark, tmp_path, [(1, 20), (9, None)], [(2, 21)], [(4, 21), (5, None), (2, 21), (3, 2)])
    true_files, calls = arrivals.file_system, []

    class Breaking:
        """A file system whose rename of the second batch fails, or fails after it was done."""

        def __init__(self, files):
            self.files = files

        def rename(self, old, new):
            name = new.getName()
            hit = "arrival_until" in name and point == "before" or name == "arrival_batch=1" and point != "before"
            if hit and "-1/" in old.toString() + "/" and not calls:
                calls.append(name)
                if point == "after":
                    self.files.rename(old, new)
                raise RuntimeError("lost")
            return self.files.rename(old, new)

        def __getattr__(self, name):
            return getattr(self.files, name)

    def breaking(*args):
        files, make = true_files(*args)
        return Breaking(files), make

    monkeypatch.setattr(arrivals, "file_system", breaking)
    with pytest.raises(Exception, match="lost"):
        _arrive(own, tmp_path).awaitTermination()
    monkeypatch.undo()
    assert calls
    _silver(own, tmp_path).awaitTermination()
    _arrive(own, tmp_path).awaitTermination()
    _silver(own, tmp_path).awaitTermination()
    assert _kept(spark, tmp_path) == [Counter([1, 2, 4]), Counter([3]), Counter([9, 5])]
    assert not [n for n in os.listdir(f"{tmp_path}/arrivals") if n.startswith(".arriving")]


def test_nothing_has_arrived_yet(spark, tmp_path):
    own = stream_session(spark)
    assert scan_arrivals(spark, f"{tmp_path}/arrivals", "late", _schema(spark)).collect() == []
    with pytest.raises(ValueError, match="unknown kind"):
        scan_arrivals(spark, f"{tmp_path}/arrivals", "lost", _schema(spark))
    os.makedirs(f"{tmp_path}/feed")
    source = own.readStream.schema("event_id long, ts timestamp, arrival_kind string").parquet(f"{tmp_path}/feed")
    with pytest.raises(ValueError, match="arrivals' own"):
        start_arrivals(source, "ts", "1 day", f"{tmp_path}/arrivals", f"{tmp_path}/cp")


def test_old_events_and_times_without_zone(spark, tmp_path):
    own = stream_session(spark, state_partitions=2)
    rows = [(1, datetime.datetime(1950, 1, 1)), (2, datetime.datetime(1950, 1, 2)), (3, None)]
    spark.createDataFrame(rows, "event_id long, ts timestamp_ntz").coalesce(1).write.parquet(f"{tmp_path}/feed")
    source = own.readStream.schema("event_id long, ts timestamp_ntz").parquet(f"{tmp_path}/feed")
    start_arrivals(source, "ts", "1 day", f"{tmp_path}/arrivals", f"{tmp_path}/cp").awaitTermination()
    schema = spark.createDataFrame([], "event_id long, ts timestamp").schema
    silver = arrivals_silver_stream(own, f"{tmp_path}/arrivals", schema, ["event_id"], "1 day")
    start_events_sink(silver, f"{tmp_path}/silver", f"{tmp_path}/cp-silver").awaitTermination()
    assert _ids(spark.read.parquet(f"{tmp_path}/silver")) == Counter([1, 2])
    assert _ids(scan_arrivals(spark, f"{tmp_path}/arrivals", "untimed", schema)) == Counter([3])


def test_a_failure_of_one_stream_ends_the_other(spark, tmp_path):
    own = stream_session(spark, state_partitions=2)
    _feed(spark, tmp_path, [(1, 20)])
    source = own.readStream.schema(SCHEMA).parquet(f"{tmp_path}/feed")
    running = start_arrivals(source, "ts", "1 day", f"{tmp_path}/arrivals", f"{tmp_path}/cp", processing_time="1 second")
    broken = source.withColumn("v", F.raise_error(F.lit("lost")).cast("string"))
    failing = start_arrivals(broken, "ts", "1 day", f"{tmp_path}/other", f"{tmp_path}/cp2", processing_time="1 second")
    with pytest.raises(Exception, match="lost"):
        await_all([running, failing])
    assert not running.isActive and not failing.isActive


# ---- reports ---------------------------------------------------------------------------------------


def _told(batch, rows, late, query="q"):
    operators = [SimpleNamespace(numRowsDroppedByWatermark=late)]
    return SimpleNamespace(progress=SimpleNamespace(id=query, batchId=batch, numInputRows=rows, stateOperators=operators))


def test_a_report_of_two_thousand_batches_is_two_files(spark, tmp_path):
    path = f"{tmp_path}/report"
    report = BatchReport(spark, path, every_seconds=0.0)
    for batch in range(2000):
        report.onQueryProgress(_told(batch, 10, batch % 2))
    assert len([n for n in os.listdir(path) if n.endswith(".json")]) == 2
    assert [tuple(r) for r in batch_report(spark, path).collect()] == [("q", 2000, 20_000, 1000, 1999)]


def test_a_batch_counts_once(spark, tmp_path):
    path = f"{tmp_path}/report"
    report = BatchReport(spark, path)
    for told in [(0, 5, 0), (0, 5, 0), (1, 0, 0), (1, 7, 2), (1, 7, 3), (0, 5, 0), (2, 1, 1)]:
        report.onQueryProgress(_told(*told))
    report.onQueryProgress(_told(0, 4, 4, "other"))
    report.write()
    again = BatchReport(spark, path)  # a restart, which is told the last batch again
    again.onQueryProgress(_told(2, 1, 1))
    again.onQueryProgress(_told(3, 2, 0))
    again.write()
    assert sorted(tuple(r) for r in batch_report(spark, path).collect()) == [("other", 1, 4, 4, 0), ("q", 4, 15, 4, 3)]
    assert batch_report(spark, f"{tmp_path}/none").collect() == []


def test_a_listener_counts_the_late_rows_of_every_batch(spark, tmp_path):
    own = stream_session(spark, state_partitions=2)
    path = f"{tmp_path}/report"
    for part in ([[(1, 20)], [(2, 20)], [(3, 2), (4, 21)], [(5, 21)]], [[(6, 3), (7, 3), (8, 23)]]):
        _feed(spark, tmp_path, *part)
        source = own.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/feed")
        silver = events_silver_stream(source, ["event_id"], "ts", "1 day")
        with BatchReport(own, path):
            start_events_sink(silver, f"{tmp_path}/sink", f"{tmp_path}/cp").awaitTermination()
    (row,) = batch_report(spark, path).collect()
    assert (row["batches"], row["input_rows"], row["late_rows"]) == (5, 8, 3)
