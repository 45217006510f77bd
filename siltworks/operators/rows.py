"""Row filters, projections and limits. None of them shuffles, except the order of ``limit_rows``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame

from siltworks import functions as X


def select_cols(df: DataFrame, *names: str) -> DataFrame:
    return df.select(*[X.named(n) for n in names])


def with_column(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Replace a column where it stands, or append it."""
    return df.withColumns({name: value})


def drop_null_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key is complete. Needed after every file read: readers do not enforce nullability."""
    return df.filter(X.has_key(keys))


def geo_range(df: DataFrame, latitude: str = "latitude", longitude: str = "longitude") -> DataFrame:
    return df.filter(X.geo_in_range(latitude, longitude))


def null_rows(df: DataFrame, name: str) -> DataFrame:
    return df.filter(X.named(name).isNull())


def padded_rows(df: DataFrame, name: str) -> DataFrame:
    return df.filter(X.padded(name))


def not_lower_rows(df: DataFrame, name: str) -> DataFrame:
    return df.filter(X.not_lower(name))


def bad_cost_rows(df: DataFrame, cost: str = "cost") -> DataFrame:
    return df.filter(X.bad_cost(cost))


def bad_price_rows(df: DataFrame, price: str = "retail_price", cost: str = "cost") -> DataFrame:
    return df.filter(X.bad_price(price, cost))


def equals_literal(df: DataFrame, name: str, value: object) -> DataFrame:
    return df.filter(X.equals(name, value))


def cross_column_neq(df: DataFrame, left: str, right: str) -> DataFrame:
    """Rows where one column differs from another's trimmed form."""
    return df.filter(X.differs_from_trimmed(left, right))


def limit_rows(df: DataFrame, n: int, order_by: Sequence[str] | None = None) -> DataFrame:
    """The first ``n`` rows by the given columns, or any ``n`` without them.

    Order and limit together become one top-n: each task keeps ``n`` rows, nothing is sorted whole.
    """
    if order_by:
        df = df.orderBy(*[X.named(c).asc_nulls_first() for c in order_by])
    return df.limit(n)


def is_empty(df: DataFrame) -> bool:
    """Whether there is no row at all; reads only as far as the first one."""
    return df.isEmpty()
