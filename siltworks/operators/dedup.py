"""De-duplication by key with a survivor that does not depend on partitioning or row order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltworks.functions import named

_SURVIVOR = "__survivor"


def _orderable(data_type: T.DataType) -> bool:
    if isinstance(data_type, T.StructType):
        return all(_orderable(f.dataType) for f in data_type.fields)
    if isinstance(data_type, T.ArrayType):
        return _orderable(data_type.elementType)
    return not isinstance(data_type, (T.MapType, T.VariantType))


def dedup_by_key(
    df: DataFrame, keys: Sequence[str], copies: str | None = None, sums: Sequence[str] = ()
) -> DataFrame:
    """One row per key: the smallest by the other columns in schema order, NULL smallest.

    Rows without a key form one group, as they do in ``dropDuplicates``. ``copies`` names an extra
    column for the number of rows that had the key. Columns named in ``sums`` take no part in the choice and are
    added up over those rows.

    The minimum combines per task before the shuffle, so a key with very many rows costs one row per
    task; a window would bring all of them to one task. One exchange, by the key.
    """
    keys = list(keys)
    rest = [f for f in df.schema.fields if f.name not in keys and f.name not in sums]
    if unorderable := [f.name for f in df.schema.fields if not _orderable(f.dataType)]:
        raise ValueError(f"cannot choose a smallest row: map or variant columns {unorderable}")
    if missing := [k for k in keys if k not in df.columns]:
        raise ValueError(f"key columns {missing} not in {df.columns}")

    aggregates = []
    if rest:
        aggregates.append(F.min(F.struct(*[named(f.name) for f in rest])).alias(_SURVIVOR))
    if copies or not rest:
        aggregates.append(F.count(F.lit(1)).alias(copies or "__copies"))
    aggregates += [F.sum(named(c)).alias(c) for c in sums]
    grouped = df.groupBy(*[named(k) for k in keys]).agg(*aggregates)
    survivor = F.col(_SURVIVOR)
    restored = [named(c) if c in keys or c in sums else survivor.getField(c).alias(c) for c in df.columns]
    return grouped.select(*restored, *([named(copies)] if copies else []))
