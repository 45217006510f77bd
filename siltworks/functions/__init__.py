"""Column expressions: row predicates and text normalisation. All are native, none is a UDF."""

from siltworks.functions.expressions import (
    bad_cost,
    bad_price,
    differs_from_trimmed,
    equals,
    geo_in_range,
    has_key,
    load_date,
    lower_trimmed,
    named,
    not_lower,
    padded,
    trimmed,
    within,
)

__all__ = [
    "bad_cost",
    "bad_price",
    "differs_from_trimmed",
    "equals",
    "geo_in_range",
    "has_key",
    "load_date",
    "lower_trimmed",
    "named",
    "not_lower",
    "padded",
    "trimmed",
    "within",
]
