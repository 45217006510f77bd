from __future__ import annotations

import pytest

from siltworks import functions as X
from siltworks.plans import ProfileSpec, profile_table

ROWS = [
    (1, 10, " a", "X", 5.0),
    (1, 10, "b", None, 0.0),
    (None, 10, "b", "x", None),
    (2, None, None, "x", -1.0),
    (3, 11, "c ", "x", 2.0),
]
SCHEMA = "id int, line int, name string, code string, cost double"


def _by_column(report):
    return {r["column_name"]: r.asDict() for r in report.collect()}


def test_profile(spark):
    spec = ProfileSpec(
        key=("id",), padded=("name",), lower=("code",), groups=("name", "code"), extremes=("line",),
        bad={"cost": X.bad_cost},
    )
    rows = _by_column(profile_table(spark.createDataFrame(ROWS, SCHEMA), spec))
    assert list(rows) == ["id", "line", "name", "code", "cost"]
    assert {r["row_count"] for r in rows.values()} == {5}
    assert [r["null_count"] for r in rows.values()] == [1, 1, 1, 1, 1]
    assert rows["name"]["padded_count"] == 2 and rows["code"]["padded_count"] is None
    assert rows["code"]["not_lower_count"] == 1
    assert rows["cost"]["bad_count"] == 3
    assert (rows["line"]["min_value"], rows["line"]["max_value"]) == ("10", "11")
    assert (rows["id"]["distinct_count"], rows["id"]["duplicated_values"]) == (4, 1)
    assert (rows["name"]["distinct_count"], rows["name"]["duplicated_values"]) == (4, 1)
    assert (rows["code"]["distinct_count"], rows["code"]["duplicated_values"]) == (3, 1)
    assert rows["cost"]["distinct_count"] is None


def test_composite_key(spark):
    spec = ProfileSpec(key=("id", "line"), groups=("id", "line"))
    rows = _by_column(profile_table(spark.createDataFrame(ROWS, SCHEMA), spec))
    assert (rows["id,line"]["null_count"], rows["id,line"]["distinct_count"]) == (2, 4)
    assert rows["id,line"]["duplicated_values"] == 1
    assert (rows["line"]["distinct_count"], rows["line"]["duplicated_values"]) == (3, 1)


def test_many_grouped_columns(spark):
    names = [f"c{i}" for i in range(45)]
    df = spark.range(10).selectExpr("id", *[f"id % {i + 1} as c{i}" for i in range(45)])
    rows = _by_column(profile_table(df, ProfileSpec(key=("id",), groups=(*names, "c3"))))
    assert [rows[n]["distinct_count"] for n in names] == [min(i + 1, 10) for i in range(45)]
    assert rows["id"]["distinct_count"] == 10 and rows["c0"]["duplicated_values"] == 1


def test_empty_table(spark):
    spec = ProfileSpec(key=("id",), groups=("name",), padded=("name",))
    rows = _by_column(profile_table(spark.createDataFrame([], SCHEMA), spec))
    assert {r["row_count"] for r in rows.values()} == {0}
    assert rows["name"]["distinct_count"] == rows["id"]["duplicated_values"] == 0
    assert rows["code"]["distinct_count"] is None


def test_unknown_column_is_refused(spark):
    with pytest.raises(ValueError, match="profile names columns"):
        profile_table(spark.range(1), ProfileSpec(key=("id",), groups=("nope",)))
