"""Sources and sinks: CSV scans, landing, Parquet silver tables, catalog tables and SQL."""

from siltworks.sources.catalog import (
    create_database,
    create_table,
    drop_database,
    drop_table,
    insert_rows,
    publish_table,
    read_table,
    register_table,
    replace_table,
    sql_query,
)
from siltworks.sources.csv import scan_contract, scan_inferred, scan_strings, write_strings
from siltworks.sources.landing import LandingFailure, land_bronze, land_table, read_rejects
from siltworks.sources.silver import read_silver, silver_location, write_silver
from siltworks.sources.versions import read_current, take_back, versions, write_version

__all__ = [
    "LandingFailure",
    "create_database",
    "create_table",
    "drop_database",
    "drop_table",
    "insert_rows",
    "land_bronze",
    "land_table",
    "publish_table",
    "read_current",
    "read_rejects",
    "read_silver",
    "read_table",
    "register_table",
    "replace_table",
    "scan_contract",
    "scan_inferred",
    "scan_strings",
    "silver_location",
    "sql_query",
    "take_back",
    "versions",
    "write_silver",
    "write_strings",
    "write_version",
]
