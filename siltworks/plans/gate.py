"""The bronze gate: does each table read, has it the contract's width, and has every row a key?"""

from __future__ import annotations

import logging
from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltworks.contracts import CONTRACTS, GATE_TABLES, TableContract
from siltworks.functions import has_key, named
from siltworks.sources.csv import MALFORMED, field_count, scan_strings
from siltworks.sources.landing import bronze_path
from siltworks.workspace import error_class, side_by_side

log = logging.getLogger(__name__)

REPORT_SCHEMA = (
    "table string, file_exists boolean, column_count_ok boolean, pk_null_count long, row_count long, passed boolean,"
    " malformed_rows long, error string"
)


class GateFailure(RuntimeError):
    """Some tables failed; ``report`` has one row per table."""

    def __init__(self, tables: list[str], report: DataFrame):
        super().__init__(f"tables that did not pass the gate: {tables}")
        self.tables = tables
        self.report = report


def column_count_check(df: DataFrame, contract: TableContract, *, check_names: bool = False) -> bool:
    """Has the table as many columns as its contract, or with ``check_names`` the same ones in order?"""
    return df.columns == contract.columns if check_names else len(df.columns) == len(contract.columns)


def _not_read(contract: TableContract, error: Exception | None = None) -> tuple:
    return contract.name, False, False, -1, 0, False, 0, error_class(error) if error else None


def validate_table(
    spark: SparkSession, contract: TableContract, path: str, *, rfc4180: bool = True, check_names: bool = False,
    multi_line: bool = False,
) -> DataFrame:
    """One report row for one table.

    ``file_exists`` means that the file reads and has a row. ``pk_null_count`` is -1 and ``row_count`` 0
    where they were not computed: the table is unreadable or empty, or its header lacks the key. A wrong
    column count fails the table but does not stop the key check. Only the number of columns is compared,
    their names too with ``check_names``. Duplicates are not looked for. ``malformed_rows`` counts rows with more or
    fewer fields than the header; they do not fail the table. ``error`` is Spark's name for why a table was not read.

    The reader opens the first file for its header, which shows whether the path can be read; all the rest
    is one lazy pass over whole rows.
    """
    try:
        rows = scan_strings(spark, path, rfc4180=rfc4180, multi_line=multi_line, flag_malformed=True)
    except Exception as error:  # whatever keeps the file from being read is the finding
        log.error("%s: cannot read %s: %s", contract.name, path, error)
        return spark.createDataFrame([_not_read(contract, error)], REPORT_SCHEMA)
    df = rows.drop(MALFORMED)
    if not df.columns:
        log.warning("%s: %s has no header", contract.name, path)
        return spark.createDataFrame([_not_read(contract)], REPORT_SCHEMA)

    width_ok = column_count_check(df, contract, check_names=check_names)
    missing = [k for k in contract.key if k not in df.columns]
    if missing:
        log.warning("%s: key columns %s not in the header", contract.name, missing)
    key_is_null = F.lit(False) if missing else ~has_key(contract.key)
    counts = rows.agg(
        F.count_if(key_is_null).alias("nulls"), F.count(F.lit(1)).alias("rows"),
        # Spark refuses a scan for the flag alone: the comparison, which is always true, names another column.
        F.count_if(
            F.col(MALFORMED).isNotNull() & (F.coalesce(named(df.columns[0]), F.lit("")) != F.lit("\x00"))
        ).alias("malformed"),
    )

    exists = F.col("rows") > 0
    pk_nulls = F.lit(-1).cast("long") if missing else F.when(exists, F.col("nulls")).otherwise(-1)
    return counts.select(
        F.lit(contract.name).alias("table"),
        exists.alias("file_exists"),
        (exists & F.lit(width_ok)).alias("column_count_ok"),
        pk_nulls.alias("pk_null_count"),
        (F.lit(0).cast("long") if missing else F.col("rows")).alias("row_count"),
        (exists & F.lit(width_ok) & (pk_nulls == 0)).alias("passed"),
        F.col("malformed").alias("malformed_rows"),
        F.lit(None).cast("string").alias("error"),
    )


def file_findings(
    spark: SparkSession, contract: TableContract, path: str, *, rfc4180: bool = True, multi_line: bool = False,
    only_bad: bool = False,
) -> DataFrame:
    """One row per file of a table: which of them have short or long rows, or rows without a key.

    ``file, row_count, short_rows, long_rows, unreadable_rows, null_key_rows, passed``: a file passes if it has none
    of these. Files without a row do not appear; if the header lacks a key column, every row is without a key.
    ``only_bad`` leaves out the files that pass. One pass over whole rows; tasks send a row per file that they read.
    A path that cannot be read raises, as any scan of it does.
    """
    rows = scan_strings(spark, path, rfc4180=rfc4180, multi_line=multi_line, flag_malformed=True)
    columns = [c for c in rows.columns if c != MALFORMED]
    if not columns:
        raise ValueError(f"{path} has no header line")
    missing = [k for k in contract.key if k not in columns]
    bad, fields = F.col(MALFORMED).isNotNull(), field_count(F.col(MALFORMED), rfc4180)
    # Spark refuses a scan for the flag alone: this, which is always true, names another column.
    any_row = F.coalesce(named(columns[0]), F.lit("")) != F.lit("\x00")
    kind = F.when(bad, F.when(fields < len(columns), "short").when(fields > len(columns), "long").otherwise("unreadable"))
    null_key = any_row if missing else ~has_key(contract.key) & any_row
    marked = rows.select(
        F.col("_metadata.file_path").alias("file"), kind.alias("kind"),
        (~bad & null_key).alias("null_key"),
    )
    counts = marked.groupBy("file").agg(
        F.count(F.lit(1)).alias("row_count"),
        *[F.count_if(F.col("kind") == kind).alias(f"{kind}_rows") for kind in ("short", "long", "unreadable")],
        F.count_if("null_key").alias("null_key_rows"),
    )
    flawed = F.col("short_rows") + F.col("long_rows") + F.col("unreadable_rows") + F.col("null_key_rows")
    judged = counts.withColumn("passed", flawed == 0)
    return judged.filter(~F.col("passed")) if only_bad else judged


def validate_all(
    spark: SparkSession, bronze_dir: str, tables: Iterable[str] = GATE_TABLES,
    contracts: Mapping[str, TableContract] = CONTRACTS, *, rfc4180: bool = True, check_names: bool = False,
    multi_line: bool = False,
) -> DataFrame:
    """One report row per table. The counts of all tables run as one job, side by side."""

    def validate(table: str) -> DataFrame:
        path = bronze_path(bronze_dir, table)
        return validate_table(
            spark, contracts[table], path, rfc4180=rfc4180, check_names=check_names, multi_line=multi_line
        )

    return reduce(DataFrame.unionByName, side_by_side(spark, validate, tables))


def require_passed(report: DataFrame) -> DataFrame:
    """Run the report and return it as computed, or raise naming the tables that failed."""
    rows = report.collect()  # one row per table
    computed = report.sparkSession.createDataFrame(rows, REPORT_SCHEMA)
    if failed := [row["table"] for row in rows if not row["passed"]]:
        raise GateFailure(failed, computed)
    return computed


def run_gate(
    spark: SparkSession, bronze_dir: str, tables: Iterable[str] = GATE_TABLES,
    contracts: Mapping[str, TableContract] = CONTRACTS, *, rfc4180: bool = True, check_names: bool = False,
    multi_line: bool = False,
) -> DataFrame:
    """Validate every table, then pass the report on or raise.

    Tables are counted in jobs of their own, a few at a time: one whose files break in the middle is reported
    as unreadable and the others are still checked.
    """

    def validate(table: str) -> tuple:
        path = bronze_path(bronze_dir, table)
        try:
            return tuple(
                validate_table(
                    spark, contracts[table], path, rfc4180=rfc4180, check_names=check_names, multi_line=multi_line
                ).first()
            )
        except Exception as error:
            log.error("%s: cannot read all of %s: %s", table, path, error)
            return _not_read(contracts[table], error)

    return require_passed(spark.createDataFrame(side_by_side(spark, validate, tables), REPORT_SCHEMA))
