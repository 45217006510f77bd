"""Counts and groups.

Every grouping here is a count, so each task first combines its own rows per value: a value that holds
a third of the table reaches the shuffle as one row per task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltworks.functions import named


def row_count(df: DataFrame) -> DataFrame:
    """One row: ``row_count``."""
    return df.agg(F.count(F.lit(1)).alias("row_count"))


def group_count(df: DataFrame, *names: str) -> DataFrame:
    """Rows per value, as ``count``; NULL is a value."""
    return df.groupBy(*[named(n) for n in names]).agg(F.count(F.lit(1)).alias("count"))


def ordered_group_count(df: DataFrame, *names: str) -> DataFrame:
    """Rows per value in ascending order of the value, NULL first. Only the groups are sorted."""
    return group_count(df, *names).orderBy(*[named(n).asc_nulls_first() for n in names])


def duplicate_keys(df: DataFrame, *names: str) -> DataFrame:
    """Values found more than once, with their ``count``."""
    return group_count(df, *names).filter(F.col("count") > 1)


def duplicate_key_count(df: DataFrame, *names: str) -> DataFrame:
    """One row: how many values are found more than once."""
    return duplicate_keys(df, *names).agg(F.count(F.lit(1)).alias("duplicate_key_count"))


def distinct_values(df: DataFrame, *names: str) -> DataFrame:
    return df.select(*[named(n) for n in names]).distinct()


def distinct_count(df: DataFrame, *names: str) -> DataFrame:
    """One row: number of distinct values, NULL counted as one (``count(distinct)`` would leave it out)."""
    return distinct_values(df, *names).agg(F.count(F.lit(1)).alias("distinct_count"))


def min_max(df: DataFrame, name: str) -> DataFrame:
    """One row: ``min`` and ``max`` of a column."""
    return df.agg(F.min(named(name)).alias("min"), F.max(named(name)).alias("max"))
