"""The table profile: all quality checks of a table as one report, one row per column."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltworks import functions as X
from siltworks.contracts import TableContract


@dataclass(frozen=True)
class ProfileSpec:
    """Which columns get which check. NULLs are counted for every column in any case.

    ``groups`` are the columns whose distinct and repeated values are counted, besides the key; these
    are the only checks that shuffle. ``bad`` gives a column a rule for its bad rows.
    """

    key: tuple[str, ...]
    padded: tuple[str, ...] = ()
    lower: tuple[str, ...] = ()
    groups: tuple[str, ...] = ()
    extremes: tuple[str, ...] = ()
    bad: Mapping[str, Callable[[], Column]] = field(default_factory=dict)

    @classmethod
    def of(cls, contract: TableContract) -> ProfileSpec:
        """The bundled checks of the contract's name, or else its key and the padding of its text columns."""
        texts = tuple(f.name for f in contract.schema.fields if f.dataType.typeName() == "string")
        return PROFILES.get(contract.name) or cls(contract.key, padded=texts)


# The checks per table.
PROFILES: Mapping[str, ProfileSpec] = {
    "distribution_centers": ProfileSpec(key=("id",), padded=("name",), groups=("name",)),
    "products": ProfileSpec(
        key=("id",),
        padded=("category", "name", "brand"),
        groups=("category", "name", "brand", "department", "distribution_center_id"),
        bad={"cost": X.bad_cost, "retail_price": X.bad_price},
    ),
    "users": ProfileSpec(
        key=("id",),
        padded=("first_name", "email"),
        lower=("email",),
        groups=("gender", "state", "city", "country", "traffic_source"),
        extremes=("age",),
    ),
    "orders": ProfileSpec(key=("order_id",), groups=("status", "gender")),
}


def row_measures(df: DataFrame, spec: ProfileSpec) -> DataFrame:
    """Every check that looks at one row, for all columns, in one pass without an exchange of rows."""

    def entry(label: str, is_null: Column) -> Column:
        column = X.named(label)

        def rows_where(condition: Column | None) -> Column:
            return F.lit(None).cast("long") if condition is None else F.count_if(condition)

        def value(extreme: Callable[[Column], Column]) -> Column:
            return (extreme(column) if label in spec.extremes else F.lit(None)).cast("string")

        return F.struct(
            F.lit(label).alias("column_name"),
            F.count(F.lit(1)).alias("row_count"),
            rows_where(is_null).alias("null_count"),
            rows_where(X.padded(label) if label in spec.padded else None).alias("padded_count"),
            rows_where(X.not_lower(label) if label in spec.lower else None).alias("not_lower_count"),
            rows_where(spec.bad[label]() if label in spec.bad else None).alias("bad_count"),
            value(F.min).alias("min_value"),
            value(F.max).alias("max_value"),
        )

    entries = [entry(name, X.named(name).isNull()) for name in df.columns]
    if len(spec.key) > 1:
        entries.append(entry(label_of(spec.key), ~X.has_key(spec.key)))
    return df.agg(F.array(*entries).alias("entries")).select(F.inline("entries"))


def label_of(key: tuple[str, ...]) -> str:
    return ",".join(key)


def value_groups(df: DataFrame, spec: ProfileSpec) -> DataFrame:
    """Rows per value of the key and of each ``groups`` column, in one scan: ``set_id, __label, copies`` and the columns.

    The grouping sets count rows per (column, value), combined per task before the exchange, so a value
    that fills the table is one row per task. Columns that a row is not about are NULL.
    """
    sets = list(dict.fromkeys([spec.key, *[(name,) for name in spec.groups]]))
    columns = list(dict.fromkeys(name for group in sets for name in group))
    grouped = df.groupingSets([[X.named(n) for n in group] for group in sets], *[X.named(n) for n in columns]).agg(
        F.grouping_id().alias("set_id"), F.count(F.lit(1)).alias("copies")
    )
    # A set's id has one bit per grouping column, leftmost highest, set where the column is not in it.
    ids = [int("".join("0" if c in group else "1" for c in columns), 2) for group in sets]
    labels = [part for i, group in zip(ids, sets) for part in (F.lit(i).cast("long"), F.lit(label_of(group)))]
    # Every id has a label; saying so keeps the join from testing it for NULL on each expanded row.
    label = F.coalesce(F.create_map(*labels)[F.col("set_id")], F.lit(""))
    return grouped.withColumn("__label", label)


def _group_measures(df: DataFrame, spec: ProfileSpec) -> DataFrame:
    """Distinct and repeated values, folded to one row per column by a second small count."""
    folded = value_groups(df, spec).groupBy("set_id", "__label").agg(
        F.count(F.lit(1)).alias("distinct_count"), F.count_if(F.col("copies") > 1).alias("duplicated_values")
    )
    return folded.select(F.col("__label").alias("column_name"), "distinct_count", "duplicated_values")


def check_spec(df: DataFrame, spec: ProfileSpec) -> None:
    named = {*spec.key, *spec.padded, *spec.lower, *spec.groups, *spec.extremes, *spec.bad}
    if missing := sorted(named - set(df.columns)):
        raise ValueError(f"profile names columns {missing}, which are not in {df.columns}")


def profile_table(df: DataFrame, spec: ProfileSpec) -> DataFrame:
    """One row per column (and one for a composite key), in two scans of the table.

    ``distinct_count`` counts NULL as a value; ``duplicated_values`` counts values found more than once.
    Checks that the spec does not ask for are NULL.
    """
    check_spec(df, spec)
    groups = _group_measures(df, spec)
    grouped = F.col("column_name").isin(label_of(spec.key), *spec.groups)

    def counted(name: str) -> Column:
        return F.when(grouped, F.coalesce(F.col(name), F.lit(0))).alias(name)  # an empty table has no groups

    # At most one row per grouping set, whatever the size of the table: safe to broadcast.
    return row_measures(df, spec).join(F.broadcast(groups), "column_name", "left").select(
        "column_name",
        "row_count",
        "null_count",
        "padded_count",
        "not_lower_count",
        "bad_count",
        counted("distinct_count"),
        counted("duplicated_values"),
        "min_value",
        "max_value",
    )
