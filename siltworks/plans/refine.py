"""The silver job: scan bronze by contract, conform, write Parquet, report the counts."""

from __future__ import annotations

import datetime
import logging
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, Observation, SparkSession

from siltworks.contracts import CONTRACTS, GATE_TABLES, TableContract
from siltworks.plans.conform import RULES, Rules, audit_of, conform_counted
from siltworks.sources.csv import scan_contract
from siltworks.sources.landing import bronze_path
from siltworks.sources.replace import replace_directory
from siltworks.sources.silver import silver_path
from siltworks.sources.versions import NewVersion
from siltworks.workspace import error_class, side_by_side

log = logging.getLogger(__name__)

REPORT_SCHEMA = (
    "table string, rows_read long, null_key_rows long, duplicate_rows long, out_of_range_rows long, rows_written long,"
    " malformed_rows long, refined boolean, error string"
)


class RefineFailure(RuntimeError):
    """Some tables were not refined; ``report`` has one row per table that was tried."""

    def __init__(self, tables: list[str], report: DataFrame):
        super().__init__(f"not refined: {tables}")
        self.tables = tables
        self.report = report


def _refine(
    spark: SparkSession, contract: TableContract, rules: Rules, bronze_dir: str, silver_dir: str,
    run_date: datetime.date | None, rfc4180: bool, multi_line: bool = False, keep_versions: int | None = None,
) -> dict[str, object]:
    bronze = scan_contract(
        spark, contract, bronze_path(bronze_dir, contract.name), rfc4180=rfc4180, multi_line=multi_line, flag_malformed=True
    )

    def write(staged: str) -> dict[str, int]:
        seen = Observation()
        conform_counted(bronze, contract.key, rules, run_date, seen).write.parquet(staged)
        return audit_of(seen)

    path = silver_path(silver_dir, contract.name)
    if keep_versions is None:
        counts = replace_directory(spark, path, write)
    else:
        version = NewVersion(spark, path)
        try:
            counts = write(version.location)
        except BaseException:
            version.discard()
            raise
        version.commit(keep_versions)
    return {"table": contract.name, **counts, "refined": True, "error": None}


def refine_table(
    spark: SparkSession, contract: TableContract, bronze_dir: str, silver_dir: str, rules: Rules | None = None,
    run_date: datetime.date | None = None, *, rfc4180: bool = True, multi_line: bool = False,
    keep_versions: int | None = None,
) -> DataFrame:
    """Replace one silver table from its bronze CSV in a single run of the plan; return a report row.

    ``rules`` default to the bundled ones of the contract's name, or to none. ``malformed_rows`` counts rows with
    too many or too few fields or with a value that is not of its type. A failed run leaves the earlier table.
    With ``keep_versions`` the table is kept as so many versions, see ``write_silver``.
    """
    rules = rules if rules is not None else RULES.get(contract.name, Rules())
    row = _refine(spark, contract, rules, bronze_dir, silver_dir, run_date, rfc4180, multi_line, keep_versions)
    return spark.createDataFrame([row], REPORT_SCHEMA)


def refine_all(
    spark: SparkSession, bronze_dir: str, silver_dir: str, tables: Iterable[str] = GATE_TABLES,
    contracts: Mapping[str, TableContract] = CONTRACTS, rules: Mapping[str, Rules] = RULES,
    run_date: datetime.date | None = None, *, rfc4180: bool = True, multi_line: bool = False,
    keep_versions: int | None = None,
) -> DataFrame:
    """``refine_table`` for each table; one report row per table, or ``RefineFailure`` once all have been tried."""

    def refine(table: str) -> dict[str, object]:
        try:
            return _refine(
                spark, contracts[table], rules.get(table, Rules()), bronze_dir, silver_dir, run_date, rfc4180, multi_line,
                keep_versions,
            )
        except Exception as error:  # any failure of one table must not keep the others from being refined
            log.error("%s: not refined: %s", table, error)
            return {"table": table, "refined": False, "error": error_class(error)}

    rows = side_by_side(spark, refine, tables)
    names = [field.split()[0] for field in REPORT_SCHEMA.split(", ")]
    report = spark.createDataFrame([tuple(row.get(n) for n in names) for row in rows], REPORT_SCHEMA)
    if failed := [str(row["table"]) for row in rows if not row["refined"]]:
        raise RefineFailure(failed, report)
    return report
