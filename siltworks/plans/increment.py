"""Silver tables kept up to date delivery by delivery, without going over what has been delivered before.

What a silver table needs of all earlier deliveries is the surviving raw row of each key, and the smallest row of a
key is the smallest of the smallest rows of its deliveries. Those survivors are a catalog table, bucketed by the key: a
delivery is reduced to one row per key, goes to the buckets in one exchange, and is joined with them where they
are. The state's own rows are read and written once, in order, and never shuffled. Merging a delivery again changes
nothing.
"""

from __future__ import annotations

import datetime
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from siltworks.functions import named
from siltworks.operators import dedup_by_key, drop_null_key
from siltworks.plans.conform import Rules, check_rules, in_range, normalise, stamp
from siltworks.sources.catalog import replace_table

BUCKETS = 200
_KEPT, _NEW = "__kept", "__new"


def merged_survivors(state: DataFrame, delivery: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The survivors of a state and a delivery, one row per key. Both have the same columns; rows without a key go.

    ``__kept`` and ``__new`` say which of the two had the key, for counting.
    """
    keys = list(keys)
    rest = [c for c in state.columns if c not in keys]
    came = drop_null_key(dedup_by_key(delivery.select(*[named(c) for c in state.columns]), keys), keys)

    def row(df: DataFrame, as_name: str) -> DataFrame:
        return df.select(*[named(k) for k in keys], F.struct(F.lit(0).alias("_"), *[named(c) for c in rest]).alias(as_name))

    both = row(state, _KEPT).join(row(came, _NEW), keys, "full_outer")
    survivor = F.least(F.col(_KEPT), F.col(_NEW))  # NULL, where one has no such key, is left out
    columns = [named(c) if c in keys else survivor.getField(c).alias(c) for c in state.columns]
    return both.select(*columns, F.col(_KEPT).isNotNull().alias(_KEPT), F.col(_NEW).isNotNull().alias(_NEW))


def merge_delivery(delivery: DataFrame, state: str, keys: Sequence[str], *, buckets: int = BUCKETS) -> dict[str, int]:
    """Merge a delivery's raw rows into the catalog table ``state``, which the first delivery makes.

    Returns how many ``keys`` the state has now, and how many of them are ``new`` or came ``again``. A failed merge
    leaves the state. ``buckets`` counts for the first delivery only; a bucket is a task of every later merge, so choose
    it for the size the table will have. Columns are bound by name; a delivery must have the state's.
    """
    spark, keys = delivery.sparkSession, list(keys)
    if spark.catalog.tableExists(state):
        earlier = spark.table(state)
        if missing := [c for c in earlier.columns if c not in delivery.columns]:
            raise ValueError(f"the delivery has no columns {missing}")
        rows, buckets = merged_survivors(earlier, delivery, keys), bucket_count(spark, state)
    else:
        first = drop_null_key(dedup_by_key(delivery, keys), keys).repartition(buckets, *[named(k) for k in keys])
        rows = first.withColumns({_KEPT: F.lit(False), _NEW: F.lit(True)})
    seen, kept, new = Observation(), F.col(_KEPT), F.col(_NEW)
    counted = rows.observe(
        seen, F.count(F.lit(1)).alias("keys"), F.count_if(~kept).alias("new"), F.count_if(kept & new).alias("again")
    ).drop(_KEPT, _NEW)
    replace_table(spark, state, lambda staged: counted.write.bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(staged))
    return seen.get


def bucket_count(spark: SparkSession, state: str) -> int:
    named_as = ".".join("`" + part.replace("`", "``") + "`" for part in state.split("."))
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {named_as}").filter("col_name = 'Num Buckets'").collect()
    if not rows:
        raise ValueError(f"{state} is not a table of survivors: it has no buckets")
    return int(rows[0]["data_type"])


def silver_of_state(
    spark: SparkSession, state: str, keys: Sequence[str], rules: Rules = Rules(), run_date: datetime.date | None = None
) -> DataFrame:
    """The silver rows of all deliveries so far: ``conform`` of their union. No exchange: keys are unique in the state."""
    rows = drop_null_key(spark.table(state), keys)
    check_rules(rows, rules)
    ranged = rows.filter(in_range(rules)) if rules.ranges else rows
    return stamp(normalise(ranged, rules), run_date)
