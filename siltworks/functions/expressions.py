"""Column expressions by column name.

Predicates follow SQL's three-valued logic: unless a rule tests for NULL itself, a NULL input gives
NULL and the row does not match.
"""

from __future__ import annotations

import datetime
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def named(name: str) -> Column:
    """The column of exactly this name, also when the name has dots or spaces."""
    return F.col("`" + name.replace("`", "``") + "`")


def has_key(keys: Sequence[str]) -> Column:
    """Every key column is present."""
    return reduce(Column.__and__, [named(k).isNotNull() for k in keys])


def within(name: str, low: float, high: float) -> Column:
    """Inclusive range; NULL does not match, nor does NaN (it sorts above every number)."""
    return named(name).between(low, high)


def geo_in_range(latitude: str = "latitude", longitude: str = "longitude") -> Column:
    """A point on the globe: latitude in -90..90 and longitude in -180..180, inclusive."""
    return within(latitude, -90, 90) & within(longitude, -180, 180)


def trimmed(name: str) -> Column:
    """Without leading and trailing spaces (U+0020 only: tabs and no-break spaces stay)."""
    return F.trim(named(name))


def lower_trimmed(name: str) -> Column:
    return F.lower(trimmed(name))


def padded(name: str) -> Column:
    """Differs from its trimmed form."""
    return named(name) != trimmed(name)


def not_lower(name: str) -> Column:
    """Differs from its lower-case form."""
    return named(name) != F.lower(named(name))


def equals(name: str, value: object) -> Column:
    return named(name) == F.lit(value)


def differs_from_trimmed(left: str, right: str) -> Column:
    """One column differs from another's trimmed form."""
    return named(left) != trimmed(right)


def bad_cost(cost: str = "cost") -> Column:
    """Missing, zero or negative."""
    return (named(cost) <= 0) | named(cost).isNull()


def bad_price(price: str = "retail_price", cost: str = "cost") -> Column:
    """Missing, negative or below cost."""
    return (named(price) < named(cost)) | named(price).isNull() | (named(price) < 0)


def load_date(run_date: datetime.date | None = None) -> Column:
    """The given date, or the current date (one value per query, or per micro-batch of a stream)."""
    return F.current_date() if run_date is None else F.lit(run_date)
