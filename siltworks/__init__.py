"""Retail tables from raw CSV to clean Parquet: landing, quality gate, profile, conforming, publishing."""

from siltworks.contracts import CONTRACTS, GATE_TABLES, LANDING_TABLES, TableContract, contract_schema, load_contracts
from siltworks.plans import (
    PROFILES,
    RULES,
    ProfileSpec,
    Rules,
    add_load,
    conform,
    file_findings,
    merge_delivery,
    profile_of_state,
    profile_table,
    refine_all,
    refine_table,
    run_gate,
    silver_of_state,
    silver_table,
    validate_all,
    validate_table,
)
from siltworks.sources import (
    land_bronze,
    publish_table,
    read_rejects,
    read_silver,
    scan_contract,
    sql_query,
    take_back,
    write_silver,
)
from siltworks.streaming import (
    BatchReport,
    arrivals_silver_stream,
    events_silver_stream,
    scan_arrivals,
    start_arrivals,
    start_events_sink,
)

__all__ = [
    "CONTRACTS",
    "GATE_TABLES",
    "LANDING_TABLES",
    "PROFILES",
    "RULES",
    "BatchReport",
    "ProfileSpec",
    "Rules",
    "TableContract",
    "add_load",
    "arrivals_silver_stream",
    "conform",
    "contract_schema",
    "events_silver_stream",
    "file_findings",
    "land_bronze",
    "load_contracts",
    "merge_delivery",
    "profile_of_state",
    "profile_table",
    "publish_table",
    "read_rejects",
    "read_silver",
    "refine_all",
    "refine_table",
    "run_gate",
    "scan_arrivals",
    "scan_contract",
    "silver_of_state",
    "silver_table",
    "sql_query",
    "start_arrivals",
    "start_events_sink",
    "take_back",
    "validate_all",
    "validate_table",
    "write_silver",
]
