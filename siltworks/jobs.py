"""Command line for ``spark-submit``: land, gate, files, refine, deliver, profile, publish, query and events.

    spark-submit run_job.py land   --raw hdfs:///data/raw --bronze hdfs:///data/bronze
    spark-submit run_job.py refine --bronze hdfs:///data/bronze --silver hdfs:///data/silver --table products

Session settings come from ``spark-submit``.
"""

from __future__ import annotations

import argparse
import datetime
import sys
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltworks.contracts import CONTRACTS, GATE_TABLES, LANDING_TABLES, TableContract, load_contracts
from siltworks.plans import (
    RULES,
    ProfileSpec,
    Rules,
    file_findings,
    merge_delivery,
    profile_table,
    refine_all,
    run_gate,
    silver_of_state,
)
from siltworks.plans.increment import BUCKETS
from siltworks.sources import create_database, land_bronze, register_table, scan_contract, sql_query
from siltworks.sources.landing import bronze_path
from siltworks.sources.versions import KEPT
from siltworks.sources.silver import silver_location, silver_path, write_silver
from siltworks.streaming import (
    BatchReport,
    arrivals_silver_stream,
    await_all,
    scan_arrivals,
    scan_stream,
    start_arrivals,
    start_events_sink,
    stream_session,
)
from siltworks.streaming.events import FILES_PER_BATCH
from siltworks.workspace import side_by_side


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser("siltworks", description=__doc__, formatter_class=argparse.RawTextHelpFormatter)
    jobs = parser.add_subparsers(dest="job", required=True)

    def job(name: str, *required: str, tables: bool = True) -> argparse.ArgumentParser:
        sub = jobs.add_parser(name)
        for option in required:
            sub.add_argument(f"--{option}", required=True)
        if tables:
            sub.add_argument("--table", action="append", help="repeatable; all tables by default")
        sub.add_argument("--contracts", help="directory of JSON contracts instead of the bundled ones")
        sub.add_argument("--spark-quoting", action="store_true", help="backslash escapes instead of doubled quotes")
        sub.add_argument("--multi-line", action="store_true", help="line breaks inside quotes; one task per file")
        return sub

    land = job("land", "raw", "bronze")
    land.add_argument("--max-rejected", type=float, default=0.0, help="share of malformed rows up to which a table lands without them")
    job("gate", "bronze")
    refine = job("refine", "bronze", "silver")
    refine.add_argument("--run-date", type=datetime.date.fromisoformat)
    refine.add_argument("--keep-versions", type=int, help="keep silver tables as so many versions")
    deliver = job("deliver", "bronze", "silver", "database")
    deliver.add_argument("--run-date", type=datetime.date.fromisoformat)
    deliver.add_argument("--buckets", type=int, default=BUCKETS, help="of a table's first delivery")
    deliver.add_argument("--keep-versions", type=int, default=KEPT)
    job("files", "bronze")
    job("profile", "bronze")
    job("publish", "silver", "database")
    job("query", "sql", "out", tables=False).add_argument("--database")
    events = job("events", "source", "silver", "checkpoint", "watermark", tables=False)
    events.add_argument("--processing-time")
    events.add_argument("--state-partitions", type=int)
    events.add_argument("--files-per-batch", type=int, default=FILES_PER_BATCH)
    events.add_argument("--rocksdb", action="store_true", help="keep state on the executors' disks")
    return parser


def run(spark: SparkSession, argv: Sequence[str]) -> DataFrame | None:
    """Run one job; return its report. A query's rows, all of them, go to Parquet in ``--out``."""
    args = _parser().parse_args(argv)
    contracts = load_contracts(args.contracts) if args.contracts else CONTRACTS
    rfc4180, multi_line = not args.spark_quoting, args.multi_line
    tables = getattr(args, "table", None)
    if args.job == "land":
        return land_bronze(
            spark, args.raw, args.bronze, tables or LANDING_TABLES, contracts, rfc4180=rfc4180, multi_line=multi_line,
            max_rejected=args.max_rejected,
        )
    if args.job == "gate":
        return run_gate(spark, args.bronze, tables or GATE_TABLES, contracts, rfc4180=rfc4180, multi_line=multi_line)
    if args.job == "refine":
        return refine_all(
            spark, args.bronze, args.silver, tables or GATE_TABLES, contracts, run_date=args.run_date, rfc4180=rfc4180,
            multi_line=multi_line, keep_versions=args.keep_versions,
        )
    if args.job == "deliver":
        return _deliver(spark, args, contracts, rfc4180, multi_line)
    if args.job == "files":
        found = [
            file_findings(spark, contracts[table], bronze_path(args.bronze, table), rfc4180=rfc4180, multi_line=multi_line, only_bad=True)
            .select(F.lit(table).alias("table"), "*")
            for table in tables or GATE_TABLES
        ]
        return reduce(DataFrame.unionByName, found)
    if args.job == "profile":
        report = None
        for table in tables or GATE_TABLES:
            bronze = scan_contract(spark, contracts[table], bronze_path(args.bronze, table), rfc4180=rfc4180, multi_line=multi_line)
            rows = profile_table(bronze, ProfileSpec.of(contracts[table])).select(F.lit(table).alias("table"), "*")
            report = rows if report is None else report.unionByName(rows)
        return report
    if args.job == "publish":
        create_database(spark, args.database)
        for table in tables or GATE_TABLES:
            register_table(spark, f"{args.database}.{table}", silver_location(spark, args.silver, table))
        return sql_query(spark, "SHOW TABLES", args.database)
    if args.job == "query":
        written = write_silver(sql_query(spark, args.sql, args.database), args.out)
        return spark.createDataFrame([(args.out, written)], "out string, rows_written long")
    return _events(spark, args, contracts["events"], rfc4180)


def _deliver(
    spark: SparkSession, args: argparse.Namespace, contracts: Mapping[str, TableContract], rfc4180: bool, multi_line: bool
) -> DataFrame:
    """Merge what is in bronze into the survivors of earlier deliveries, and write the silver tables from those."""
    create_database(spark, args.database)

    def deliver(table: str) -> tuple:
        contract, state = contracts[table], f"{args.database}.{table}_survivors"
        delivery = scan_contract(spark, contract, bronze_path(args.bronze, table), rfc4180=rfc4180, multi_line=multi_line)
        counts = merge_delivery(delivery, state, contract.key, buckets=args.buckets)
        silver = silver_of_state(spark, state, contract.key, RULES.get(table, Rules()), args.run_date)
        written = write_silver(silver, silver_path(args.silver, table), keep_versions=args.keep_versions)
        return table, counts["keys"], counts["new"], counts["again"], written

    rows = side_by_side(spark, deliver, args.table or GATE_TABLES)
    return spark.createDataFrame(rows, "table string, keys long, new long, again long, rows_written long")


def _events(spark: SparkSession, args: argparse.Namespace, contract: TableContract, rfc4180: bool) -> DataFrame:
    """The arrivals, from one read of the source, and the silver stream of the timely ones among them.

    With a processing time both run on; if one fails, the other is stopped and the job fails.
    """
    own = stream_session(spark, state_partitions=args.state_partitions, rocksdb=args.rocksdb)
    checkpoint, time, schema = args.checkpoint.rstrip("/"), args.processing_time, contract.schema
    source = scan_stream(own, contract, args.source, max_files_per_trigger=args.files_per_batch, rfc4180=rfc4180)
    arrived = silver_path(args.silver, "events_arrivals")
    with BatchReport(own, f"{checkpoint}/batches"):
        arrivals = start_arrivals(
            source, "created_at", args.watermark, arrived, f"{checkpoint}/arrivals", processing_time=time
        )
        if not time:
            arrivals.awaitTermination()
        silver = start_events_sink(
            arrivals_silver_stream(own, arrived, schema, contract.key, args.watermark, max_files_per_trigger=args.files_per_batch),
            silver_path(args.silver, "events"), f"{checkpoint}/events", processing_time=time,
        )
        await_all([arrivals, silver])
    late, untimed = (scan_arrivals(spark, arrived, kind, schema).count() for kind in ("late", "untimed"))
    return spark.createDataFrame([("events", late, untimed)], "table string, late_rows long, untimed_rows long")


def main() -> None:
    spark = SparkSession.builder.appName("siltworks").getOrCreate()
    try:
        report = run(spark, sys.argv[1:])
        report.show(max(1, report.count()), truncate=False)  # a report has one row per table or column
    finally:
        spark.stop()
