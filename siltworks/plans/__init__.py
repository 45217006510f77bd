"""Composite jobs: conform to silver, the bronze gate and the table profile."""

from siltworks.plans.conform import RULES, Rules, audit_of, conform, conform_counted, normalise, silver_table
from siltworks.plans.gate import (
    GateFailure,
    column_count_check,
    file_findings,
    require_passed,
    run_gate,
    validate_all,
    validate_table,
)
from siltworks.plans.increment import merge_delivery, silver_of_state
from siltworks.plans.profile import PROFILES, ProfileSpec, profile_table
from siltworks.plans.profile_state import add_load, loads_of, profile_of_state
from siltworks.plans.refine import RefineFailure, refine_all, refine_table

__all__ = [
    "PROFILES",
    "RULES",
    "GateFailure",
    "ProfileSpec",
    "RefineFailure",
    "Rules",
    "add_load",
    "audit_of",
    "column_count_check",
    "conform",
    "conform_counted",
    "file_findings",
    "loads_of",
    "merge_delivery",
    "normalise",
    "profile_of_state",
    "profile_table",
    "refine_all",
    "refine_table",
    "require_passed",
    "run_gate",
    "silver_of_state",
    "silver_table",
    "validate_all",
    "validate_table",
]
