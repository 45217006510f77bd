"""Raw to bronze: land each raw CSV as an all-string CSV directory that later scans can split.

One write has two outputs: rows that parse go to bronze, the others to a table of rejects, verbatim, with their file
and what is wrong with them.
"""

from __future__ import annotations

import logging
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from siltworks.contracts import CONTRACTS, LANDING_TABLES, TableContract
from siltworks.functions import named
from siltworks.sources.csv import MALFORMED, field_count, scan_strings, write_strings
from siltworks.sources.replace import Refused, file_system, qualified, remove_directory, replace_directory
from siltworks.workspace import error_class, session_like, side_by_side

log = logging.getLogger(__name__)

REPORT_SCHEMA = (
    "table string, source_exists boolean, contract_exists boolean, landed boolean, row_count long,"
    " malformed_rows long, error string"
)


REJECTS_SCHEMA = "file string, reason string, line string"
_PART, _KEPT, _REJECTED = "__part", "kept", "rejected"
# Both outputs of a task are open at a time; else Spark would sort the rows by output first.
_TWO_OUTPUTS = {"spark.sql.maxConcurrentOutputFileWriters": "2"}

Report = tuple[str, bool, bool, bool, int, int, str | None]


class LandingFailure(RuntimeError):
    """Some tables did not land; ``report`` has one row per table that was tried."""

    def __init__(self, tables: list[str], report: DataFrame):
        super().__init__(f"landing failed for: {tables}")
        self.tables = tables
        self.report = report


def bronze_path(bronze_dir: str, table: str) -> str:
    return f"{bronze_dir.rstrip('/')}/{table}/{table}.csv"


def rejects_path(bronze_dir: str, table: str) -> str:
    return f"{bronze_dir.rstrip('/')}/_rejects/{table}"


def read_rejects(spark: SparkSession, bronze_dir: str, table: str) -> DataFrame:
    """``file, reason, line`` of the rows that the last landing of a table rejected; no rows if it rejected none."""
    path = rejects_path(bronze_dir, table)
    files, make = file_system(spark, path)
    return spark.read.parquet(path) if files.exists(make(path)) else spark.createDataFrame([], REJECTS_SCHEMA)


def split_rows(raw: DataFrame, rfc4180: bool = True) -> DataFrame:
    """Rows of a flagged scan with the output that each is for.

    Both outputs have the same columns. A rejected row has its file, reason and text as JSON in the first one.
    """
    columns = [c for c in raw.columns if c != MALFORMED]
    line, bad = named(MALFORMED), named(MALFORMED).isNotNull()
    fields = field_count(line, rfc4180)
    reason = F.when(fields < len(columns), "too few fields").when(fields > len(columns), "too many fields").otherwise("unreadable")
    why = F.to_json(F.struct(F.col("_metadata.file_path").alias("file"), reason.alias("reason"), line.alias("line")))
    return raw.select(
        *[F.when(~bad, named(c)).otherwise(why if i == 0 else None).alias(c) for i, c in enumerate(columns)],
        F.when(bad, _REJECTED).otherwise(_KEPT).alias(_PART),
    )


def _keep_rejects(spark: SparkSession, found: str | None, path: str) -> None:
    """Replace the table of rejects by what a landing rejected, or remove the one of an earlier landing."""
    if found is None:
        remove_directory(spark, path)
        return
    rows = scan_strings(spark, found)
    parsed = rows.select(F.from_json(named(rows.columns[0]), REJECTS_SCHEMA).alias("r")).select("r.*")
    replace_directory(spark, path, lambda staged: parsed.write.parquet(staged))


def land_table(
    spark: SparkSession, table: str, raw_dir: str, bronze_dir: str, contracts: Mapping[str, TableContract] = CONTRACTS,
    *, rfc4180: bool = True, multi_line: bool = False, max_rejected: float = 0.0,
) -> Report:
    """Land one table and return its report row. A failure is reported, not raised.

    Values are kept, bytes are not: a quoted field may lose quotes that it does not need. Rows that would change,
    with more or fewer fields than the header, are malformed: they go to the table of rejects instead, see
    ``read_rejects``, with their text as it was. If they are more than the share ``max_rejected`` of all rows, the
    table does not land, what landed before stays, and the rejects say why. Line breaks inside quotes make such rows,
    unless ``multi_line`` reads them as values, with one task per file; bronze then has to be read with
    ``multi_line`` too. The source is read once. The rows are counted by the write itself, in its only stage, so a
    retried task is not counted twice; ``row_count`` is that of the rows that landed.
    """
    source = f"{raw_dir.rstrip('/')}/{table}.csv"
    own = session_like(spark, _TWO_OUTPUTS)
    try:
        raw = scan_strings(own, source, rfc4180=rfc4180, multi_line=multi_line, flag_malformed=True)
    except Exception as error:  # missing, unreadable or without a header line
        log.error("%s: cannot read %s: %s", table, source, error)
        missing = error_class(error)
        return table, missing != "PATH_NOT_FOUND", table in contracts, False, 0, 0, missing
    if table not in contracts:
        log.error("%s: no contract", table)
        return table, True, False, False, 0, 0, None

    def write(staged: str) -> dict[str, int]:
        if MALFORMED not in raw.columns:
            raise ValueError(f"{source} has no header line")
        seen, both = Observation(), f"{staged}.parts"
        try:
            counted = split_rows(raw, rfc4180).observe(
                seen, F.count(F.lit(1)).alias("rows"), F.count_if(F.col(_PART) == _REJECTED).alias("malformed")
            )
            write_strings(counted, both, partition_by=_PART)
            files, make = file_system(own, both)
            kept, rejected = (f"{both}/{_PART}={part}" for part in (_KEPT, _REJECTED))
            if not files.exists(make(kept)):  # no row at all: bronze still has the header
                write_strings(raw.drop(MALFORMED).limit(0), staged)
            elif not files.rename(make(kept), make(staged)):
                raise OSError(f"cannot move {kept}")
            _keep_rejects(own, rejected if files.exists(make(rejected)) else None, qualified(own, rejects_path(bronze_dir, table)))
        finally:
            remove_directory(own, both)
        return seen.get

    def few_rejected(counts: dict[str, int]) -> bool:
        return counts["malformed"] <= max_rejected * counts["rows"]

    try:
        counts = replace_directory(own, bronze_path(bronze_dir, table), write, few_rejected)
    except Refused as refused:
        log.error("%s: %s malformed rows", table, refused.result["malformed"])
        return table, True, True, False, 0, refused.result["malformed"], None
    except Exception as error:  # any failure of one table must not keep the others from landing
        log.error("%s: landing failed: %s", table, error)
        return table, True, True, False, 0, 0, error_class(error)
    return table, True, True, True, counts["rows"] - counts["malformed"], counts["malformed"], None


def land_bronze(
    spark: SparkSession, raw_dir: str, bronze_dir: str, tables: Iterable[str] = LANDING_TABLES,
    contracts: Mapping[str, TableContract] = CONTRACTS, *, rfc4180: bool = True, multi_line: bool = False,
    max_rejected: float = 0.0,
) -> DataFrame:
    """Land every table; return one report row per table, or raise once all have been tried."""

    def land(table: str) -> Report:
        return land_table(
            spark, table, raw_dir, bronze_dir, contracts, rfc4180=rfc4180, multi_line=multi_line, max_rejected=max_rejected
        )

    rows = side_by_side(spark, land, tables)
    report = spark.createDataFrame(rows, REPORT_SCHEMA)
    if failed := [row[0] for row in rows if not row[3]]:
        raise LandingFailure(failed, report)
    return report
