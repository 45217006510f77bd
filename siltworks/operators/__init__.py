"""DataFrame-to-DataFrame operators."""

from siltworks.operators.dedup import dedup_by_key
from siltworks.operators.grouping import (
    distinct_count,
    distinct_values,
    duplicate_key_count,
    duplicate_keys,
    group_count,
    min_max,
    ordered_group_count,
    row_count,
)
from siltworks.operators.rows import (
    bad_cost_rows,
    bad_price_rows,
    cross_column_neq,
    drop_null_key,
    equals_literal,
    geo_range,
    is_empty,
    limit_rows,
    not_lower_rows,
    null_rows,
    padded_rows,
    select_cols,
    with_column,
)

__all__ = [
    "bad_cost_rows",
    "bad_price_rows",
    "cross_column_neq",
    "dedup_by_key",
    "distinct_count",
    "distinct_values",
    "drop_null_key",
    "duplicate_key_count",
    "duplicate_keys",
    "equals_literal",
    "geo_range",
    "group_count",
    "is_empty",
    "limit_rows",
    "min_max",
    "not_lower_rows",
    "null_rows",
    "ordered_group_count",
    "padded_rows",
    "row_count",
    "select_cols",
    "with_column",
]
