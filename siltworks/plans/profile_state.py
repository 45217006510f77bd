"""Profiles over loads: what a profile needs of earlier loads is kept, and a new load is added to it.

Distinct and repeated values need the number of rows per column and value, everything else one row per load and
column. Both are rows of one catalog table, bucketed by column and value, so that adding a load is one swap of the
table, earlier loads are not read again and their counts not shuffled. A load has a name; one that has been added
is not added again.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltworks import functions as X
from siltworks.plans.increment import bucket_count
from siltworks.plans.profile import ProfileSpec, check_spec, label_of, row_measures, value_groups
from siltworks.sources.catalog import replace_table

BUCKETS = 200
_VALUE, _LOAD = "value", "load"
_SUMS = ("row_count", "null_count", "padded_count", "not_lower_count", "bad_count")
_KEY = ["kind", "column_name", "value"]
_SCHEMA = "kind string, column_name string, value string, copies long, " + ", ".join(f"{c} long" for c in _SUMS) + (
    ", min_value string, max_value string"
)


def _entries(df: DataFrame, spec: ProfileSpec, load: str) -> DataFrame:
    """A load's rows of the state: one per column and value, and one per column with its counts."""
    groups = value_groups(df, spec)
    columns = [c for c in groups.columns if c not in ("set_id", "__label", "copies")]
    # NULLs are left out of the text, so that columns that a row is not about do not matter.
    value = F.to_json(F.struct(*[X.named(c) for c in columns]))
    values = groups.select(F.lit(_VALUE).alias("kind"), F.col("__label").alias("column_name"), value.alias("value"), "copies")
    loads = row_measures(df, spec).withColumns({"kind": F.lit(_LOAD), "value": F.lit(load)})
    rows = values.unionByName(loads, allowMissingColumns=True)
    return rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in _schema().fields])


def _schema() -> T.StructType:
    return T.StructType.fromDDL(_SCHEMA)


def merged_entries(state: DataFrame, entries: DataFrame) -> DataFrame:
    """State and load joined by column and value: copies add up, a load's own rows stand on one side only."""
    rest = [f.name for f in _schema().fields if f.name not in _KEY]

    def side(df: DataFrame, name: str) -> DataFrame:
        return df.select(*_KEY, F.struct(*rest).alias(name))

    both = side(state, "__kept").join(side(entries, "__new"), _KEY, "full_outer")
    kept, new = F.col("__kept"), F.col("__new")
    copies = F.coalesce(kept["copies"] + new["copies"], kept["copies"], new["copies"]).alias("copies")
    return both.select(*_KEY, copies, *[F.coalesce(kept[c], new[c]).alias(c) for c in rest if c != "copies"])


def add_load(df: DataFrame, spec: ProfileSpec, state: str, load: str, *, buckets: int = BUCKETS) -> bool:
    """Add a load's rows to the profile in the catalog table ``state``, which the first load makes.

    Returns whether the load was new; one whose name is known changes nothing. A failure leaves the state. ``buckets``
    counts for the first load only.
    """
    check_spec(df, spec)
    spark, entries = df.sparkSession, _entries(df, spec, load)
    if spark.catalog.tableExists(state):
        earlier = spark.table(state)
        if not earlier.filter((F.col("kind") == _LOAD) & (F.col("value") == load)).isEmpty():
            return False
        rows, buckets = merged_entries(earlier, entries), bucket_count(spark, state)
    else:
        rows = entries.repartition(buckets, *_KEY)
    replace_table(spark, state, lambda staged: rows.write.bucketBy(buckets, *_KEY).sortBy(*_KEY).saveAsTable(staged))
    return True


def loads_of(spark: SparkSession, state: str) -> list[str]:
    """The names of the loads that the profile covers."""
    rows = spark.table(state).filter(F.col("kind") == _LOAD).select("value").distinct().collect()  # a row per load
    return sorted(row["value"] for row in rows)


def profile_of_state(spark: SparkSession, state: str, spec: ProfileSpec, types: Mapping[str, T.DataType]) -> DataFrame:
    """``profile_table`` of all loads together, from the state alone.

    ``types`` has the types of the ``extremes`` columns, whose smallest and largest values are compared as such.
    """
    rows = spark.table(state)
    values = rows.filter(F.col("kind") == _VALUE).groupBy("column_name").agg(
        F.count(F.lit(1)).alias("distinct_count"), F.count_if(F.col("copies") > 1).alias("duplicated_values")
    )

    def extreme(name: str, function: Callable[[Column], Column]) -> Column:
        found = F.lit(None).cast("string")
        for column in spec.extremes:
            own = F.when(F.col("column_name") == column, F.col(name)).cast(types[column])
            found = F.coalesce(function(own).cast("string"), found)
        return found.alias(name)

    loads = rows.filter(F.col("kind") == _LOAD).groupBy("column_name").agg(
        *[F.sum(c).alias(c) for c in _SUMS], extreme("min_value", F.min), extreme("max_value", F.max)
    )
    grouped = F.col("column_name").isin(label_of(spec.key), *spec.groups)
    counted = [F.when(grouped, F.coalesce(F.col(c), F.lit(0))).alias(c) for c in ("distinct_count", "duplicated_values")]
    # At most one row per column on either side: safe to broadcast.
    return loads.join(F.broadcast(values), "column_name", "left").select(
        "column_name", *_SUMS, *counted, "min_value", "max_value"
    )
