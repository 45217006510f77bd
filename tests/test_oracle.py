"""Every registered query against its oracle SQL in DuckDB."""

from __future__ import annotations

import math
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as registry

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels"
    " conversations"
).split()
SF_DIRS = {sf: f"/root/testdata/sf{sf}" for sf in ("0.001", "0.01")}


@pytest.fixture(scope="module", params=sorted(SF_DIRS))
def engine(request):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{SF_DIRS[request.param]}/{name}.parquet'")
    yield SF_DIRS[request.param], con
    con.close()


def _plain(value):
    if isinstance(value, float) and math.isnan(value):
        return "NaN"
    return value


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def test_every_query_has_an_oracle():
    own = {name for name in registry.queries() if name.startswith("q_")}
    assert own <= set(registry.oracle_sql()) <= set(registry.queries())


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_matches_oracle(spark, engine, name):
    sf_dir, con = engine
    ours = registry.queries()[name](spark, sf_dir)
    theirs = con.execute(registry.oracle_sql()[name])
    columns = [d[0] for d in theirs.description]
    assert sorted(ours.columns) == sorted(columns)
    expected = _rows(columns, theirs.fetchall())
    assert _rows(ours.columns, ours.collect()) == expected
    assert sum(expected.values()) > 0


def test_entry(spark):
    assert registry.entry(spark).count() == 198
