"""Conforming: survivors, order independence, counts, and refusals."""

from __future__ import annotations

import datetime
import random

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from siltworks.contracts import TableContract
from siltworks.operators import dedup_by_key
from siltworks.plans import RULES, Rules, audit_of, conform, conform_counted, refine_table
from siltworks.sources import read_silver, write_silver, write_strings
from siltworks.sources.landing import bronze_path
from standins import STANDIN_CONTRACTS, dirty

DAY = datetime.date(2024, 1, 31)
SF = "/root/testdata/sf0.001"


def _brute_survivors(rows, key):
    """One row per key, the smallest by the other values with None smallest: the definition, in Python."""
    def rank(row):
        return [(v is not None, v) if v is not None else (False, 0) for i, v in enumerate(row) if i != key]

    best = {}
    for row in rows:
        if row[key] not in best or rank(row) < rank(best[row[key]]):
            best[row[key]] = row
    return sorted(best.values(), key=str)


def test_survivors_match_brute_force(spark):
    rng = random.Random(3)
    pool = [None, "", " ", "a", "A", "b ", "é"]
    rows = [
        (rng.choice([None, *range(40)]), rng.choice(pool), rng.choice([None, 0.5, -1.0, 7.0]), rng.choice([None, 1, 2]))
        for _ in range(2000)
    ]
    df = spark.createDataFrame(rows, "a long, s string, d double, i int").select("s", "a", "d", "i")
    expected = _brute_survivors([(s, a, d, i) for a, s, d, i in rows], 1)
    for parts in (1, 7):
        got = sorted((tuple(r) for r in dedup_by_key(df.repartition(parts), ["a"]).collect()), key=str)
        assert got == expected


def test_a_key_with_most_of_the_rows(spark):
    hot = spark.range(200_000).select(
        F.when(F.col("id") % 3 > 0, 7).otherwise(F.col("id")).alias("k"), (-F.col("id")).alias("v")
    )
    rows = {r["k"]: r["v"] for r in dedup_by_key(hot.repartition(16), ["k"]).filter("k < 10").collect()}
    assert rows == {0: 0, 3: -3, 6: -6, 9: -9, 7: -199_999}


def test_key_only_table_and_composite_key(spark):
    df = spark.createDataFrame([(1, 2), (1, 2), (None, 2), (None, 2), (1, None)], "a int, b int")
    rows = sorted((tuple(r) for r in dedup_by_key(df, ["a", "b"]).collect()), key=str)
    assert rows == sorted([(1, 2), (None, 2), (1, None)], key=str)
    assert [tuple(r)[:2] for r in conform(df, ["a", "b"], run_date=DAY).collect()] == [(1, 2)]


def test_odd_column_names(spark):
    df = spark.createDataFrame([(1, " x "), (1, "y")], "`the.id` int, `a b` string")
    out = conform(df, ["the.id"], Rules(trim=("a b",)), DAY)
    assert out.columns == ["the.id", "a b", "ingestion_date"]
    assert [tuple(r) for r in out.collect()] == [(1, "x", DAY)]


def test_unorderable_columns_are_refused(spark):
    df = spark.createDataFrame([(1, {"a": 1})], "id int, m map<string,int>")
    with pytest.raises(ValueError, match="map or variant"):
        dedup_by_key(df, ["id"])


def test_missing_columns_are_refused(spark):
    df = spark.range(1)
    with pytest.raises(ValueError, match="key columns"):
        dedup_by_key(df, ["nope"])
    with pytest.raises(ValueError, match="rules name columns"):
        conform(df, ["id"], Rules(trim=("nope",)))


def test_range_check_looks_at_the_survivor(spark):
    """Key 1 keeps its smallest row, which is out of range, so the key is gone."""
    rows = [(1, "a", 100.0), (1, "b", 10.0), (2, "c", 10.0)]
    df = spark.createDataFrame(rows, "id int, name string, latitude double")
    out = conform(df, ["id"], Rules(ranges=(("latitude", -90, 90),)), DAY)
    assert [r["id"] for r in out.collect()] == [2]


def test_trim_strips_spaces_only(spark):
    df = spark.createDataFrame([(1, " \ta\t "), (2, "   "), (3, None), (4, " b ")], "id int, name string")
    out = {r["id"]: r["name"] for r in conform(df, ["id"], Rules(trim=("name",)), DAY).collect()}
    assert out == {1: "\ta\t", 2: "", 3: None, 4: " b"}


def test_current_date_by_default(spark):
    out = conform(spark.range(3), ["id"])
    assert dict(out.dtypes)["ingestion_date"] == "date"
    assert out.filter(F.col("ingestion_date") == F.current_date()).count() == 3


@pytest.mark.parametrize("name", sorted(STANDIN_CONTRACTS.keys() & RULES.keys() - {"order_items", "inventory_items"}))
def test_idempotent_unique_and_order_independent(spark, name):
    key, rules = STANDIN_CONTRACTS[name].key, RULES[name]
    source = dirty(spark, SF, name)
    once = conform(source, key, rules, DAY)
    rows = sorted((tuple(r) for r in once.collect()), key=str)
    keys = [r[once.columns.index(key[0])] for r in rows]
    assert None not in keys and len(set(keys)) == len(keys)
    again = conform(once.drop("ingestion_date"), key, rules, DAY)
    assert sorted((tuple(r) for r in again.collect()), key=str) == rows
    shuffled = conform(source.orderBy(F.rand(5)).repartition(13), key, rules, DAY)
    assert sorted((tuple(r) for r in shuffled.collect()), key=str) == rows


@pytest.mark.parametrize("name", ["products", "distribution_centers"])
def test_counted_conform_gives_the_same_rows_and_true_counts(spark, tmp_path, name):
    key, rules = STANDIN_CONTRACTS[name].key, RULES[name]
    source = dirty(spark, SF, name)
    seen = Observation()
    conform_counted(source, key, rules, DAY, seen).write.parquet(str(tmp_path / "silver"))
    written = spark.read.parquet(str(tmp_path / "silver"))
    plain = conform(source, key, rules, DAY)
    assert written.exceptAll(plain).isEmpty() and plain.exceptAll(written).isEmpty()
    counts = audit_of(seen)
    assert counts["rows_read"] == source.count()
    assert counts["null_key_rows"] == source.filter(f"{key[0]} is null").count() > 0
    assert counts["rows_written"] == written.count()
    one_each = dedup_by_key(source.filter(f"{key[0]} is not null"), key).count()
    assert counts["duplicate_rows"] == counts["rows_read"] - counts["null_key_rows"] - one_each > 0
    assert counts["out_of_range_rows"] == one_each - written.count()


def test_counts_of_an_empty_table(spark, tmp_path):
    contract = TableContract.of("t", "id", "id integer; name string")
    write_strings(spark.createDataFrame([], "id int, name string"), bronze_path(str(tmp_path), "t"))
    report = refine_table(spark, contract, str(tmp_path), str(tmp_path / "silver"), Rules(trim=("name",)), DAY)
    assert [tuple(r) for r in report.collect()] == [("t", 0, 0, 0, 0, 0, 0, True, None)]


def test_refine_writes_once_and_replaces(spark, tmp_path):
    bronze, silver = str(tmp_path / "bronze"), str(tmp_path / "silver")
    contract = STANDIN_CONTRACTS["orders"]
    write_strings(dirty(spark, SF, "orders"), bronze_path(bronze, "orders"))
    first = refine_table(spark, contract, bronze, silver, run_date=DAY).collect()
    second = refine_table(spark, contract, bronze, silver, run_date=DAY).collect()
    assert first == second
    assert read_silver(spark, silver, "orders").count() == first[0]["rows_written"]
    assert read_silver(spark, silver, "orders").schema["created_at"].dataType.simpleString() == "timestamp"


def test_write_silver_counts_what_it_writes(spark, tmp_path):
    path = str(tmp_path / "t")
    assert write_silver(spark.range(1234), path) == 1234
    assert write_silver(spark.range(0), path) == 0
    assert spark.read.parquet(path).count() == 0
