"""Bronze to silver: de-duplicate, drop null keys, check ranges, normalise text, stamp the load date.

The order is fixed. De-duplication comes before the range check, so a key whose surviving row is out of
range is gone even if another of its rows was in range.
"""

from __future__ import annotations

import datetime
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from siltworks import functions as X
from siltworks.contracts import CONTRACTS
from siltworks.functions import named
from siltworks.operators import dedup_by_key, drop_null_key
from siltworks.sources.csv import MALFORMED

LOAD_DATE = "ingestion_date"
_COPIES, _BAD = "__copies", "__malformed"


@dataclass(frozen=True)
class Rules:
    """What a table needs besides its key: columns to trim, to trim and lower, and inclusive ranges."""

    trim: tuple[str, ...] = ()
    lower: tuple[str, ...] = ()
    ranges: tuple[tuple[str, float, float], ...] = ()

    @property
    def columns(self) -> set[str]:
        return {*self.trim, *self.lower, *(name for name, _, _ in self.ranges)}


# The silver rules per table.
RULES: Mapping[str, Rules] = {
    "products": Rules(trim=("name", "brand", "category", "department")),
    "users": Rules(trim=("first_name", "last_name", "country", "city"), lower=("email",)),
    "orders": Rules(trim=("status", "gender")),
    "distribution_centers": Rules(trim=("name",), ranges=(("latitude", -90, 90), ("longitude", -180, 180))),
    "order_items": Rules(),
    "inventory_items": Rules(),
}


def check_rules(df: DataFrame, rules: Rules) -> None:
    if missing := sorted(rules.columns - set(df.columns)):
        raise ValueError(f"rules name columns {missing}, which are not in {df.columns}")


def in_range(rules: Rules) -> Column:
    """All range rules hold; true when there is none, NULL or false otherwise."""
    verdict = F.lit(True)
    for name, low, high in rules.ranges:
        verdict = verdict & X.within(name, low, high)
    return verdict


def normalise(df: DataFrame, rules: Rules) -> DataFrame:
    """Trim and lower in place."""
    values = {name: X.trimmed(name) for name in rules.trim} | {name: X.lower_trimmed(name) for name in rules.lower}
    return df.withColumns(values) if values else df


def stamp(df: DataFrame, run_date: datetime.date | None) -> DataFrame:
    return df.withColumns({LOAD_DATE: X.load_date(run_date)})


def conform(
    df: DataFrame, keys: Sequence[str], rules: Rules = Rules(), run_date: datetime.date | None = None
) -> DataFrame:
    """The silver rows. One exchange, by the key; null-key rows are filtered out below it, at the scan.

    The range check stays above it, because it looks at the surviving row.
    """
    check_rules(df, rules)
    kept = drop_null_key(dedup_by_key(df, keys), keys)
    ranged = kept.filter(in_range(rules)) if rules.ranges else kept
    return stamp(normalise(ranged, rules), run_date)


def silver_table(df: DataFrame, table: str, run_date: datetime.date | None = None) -> DataFrame:
    """``conform`` by the bundled key and rules of a table."""
    return conform(df, CONTRACTS[table].key, RULES[table], run_date)


def conform_counted(
    df: DataFrame, keys: Sequence[str], rules: Rules, run_date: datetime.date | None, seen: Observation
) -> DataFrame:
    """``conform``, with what it loses counted into ``seen`` by the action that writes it.

    All counts are taken above the exchange. Spark adds up an observation below an exchange again when a
    lost executor's map tasks rerun, but takes each task of the last stage once. So null-key rows travel
    as one counted group per task instead of being filtered out at the scan. Rows that the scan marked as
    malformed are counted too.
    """
    check_rules(df, rules)
    bad = named(MALFORMED).isNotNull() if MALFORMED in df.columns else F.lit(False)
    rows = df.withColumns({_BAD: bad.cast("long")}).drop(MALFORMED)
    groups = dedup_by_key(rows, keys, copies=_COPIES, sums=[_BAD])
    keyed = X.has_key(keys)
    copies = F.col(_COPIES)
    observed = groups.observe(
        seen,
        F.sum(copies).alias("rows_read"),
        F.sum(_BAD).alias("malformed_rows"),
        F.sum(F.when(~keyed, copies)).alias("null_key_rows"),
        F.sum(F.when(keyed, copies - 1)).alias("duplicate_rows"),
        F.count_if(keyed & ~F.coalesce(in_range(rules), F.lit(False))).alias("out_of_range_rows"),
    )
    kept = drop_null_key(observed, keys).drop(_COPIES, _BAD)
    ranged = kept.filter(in_range(rules)) if rules.ranges else kept
    return stamp(normalise(ranged, rules), run_date)


def audit_of(seen: Observation) -> dict[str, int]:
    """The counts of ``conform_counted`` once its write is done, with ``rows_written`` derived."""
    counts = {name: value or 0 for name, value in seen.get.items()}
    counts["rows_written"] = (
        counts["rows_read"] - counts["null_key_rows"] - counts["duplicate_rows"] - counts["out_of_range_rows"]
    )
    return counts
