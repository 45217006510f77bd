"""State that grows by deliveries: survivors, profiles, and the files that findings come from."""

from __future__ import annotations

import datetime
import re
import uuid

import pytest
from pyspark.sql import functions as F

from siltworks import jobs
from siltworks.contracts import CONTRACTS, TableContract
from siltworks.plans import (
    ProfileSpec, Rules, add_load, conform, file_findings, loads_of, merge_delivery, profile_of_state, profile_table,
    silver_of_state,
)
from siltworks.plans.increment import bucket_count, merged_survivors
from siltworks.plans.profile_state import _entries, merged_entries
from siltworks.sources import create_database, drop_database, read_silver, versions
from standins import STANDIN_CONTRACTS, dirty

DAY = datetime.date(2024, 1, 31)
SF = "/root/testdata/sf0.001"
SCHEMA = "a int, b string, v double, w string"


@pytest.fixture
def database(spark, tmp_path):
    name = f"db_{uuid.uuid4().hex}"
    create_database(spark, name, f"{tmp_path}/db")
    yield name
    drop_database(spark, name, cascade=True)


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def _frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


ROWS = [
    (1, "x", 2.0, " p "), (1, "x", None, "q"), (1, "y", 5.0, "r"), (None, "x", 1.0, "s"), (2, None, 1.0, "t"),
    (2, "x", float("nan"), None), (2, "x", 3.0, None), (2, "x", 3.0, "u"), (3, "z", -7.0, "low"), (3, "z", 7.0, "high"),
]


# ---- survivors -------------------------------------------------------------------------------------


def test_deliveries_in_any_order_give_what_all_rows_give(spark, database):
    keys, rules = ["a", "b"], Rules(trim=("w",), ranges=(("v", -10, 10),))
    whole = _rows(conform(_frame(spark, ROWS), keys, rules, DAY))
    for k, order in enumerate(([0, 1, 2], [2, 0, 1], [1, 1, 0, 2, 0])):
        state = f"{database}.s{k}"
        for part in order:
            merge_delivery(_frame(spark, ROWS[part::3]), state, keys, buckets=3)
        assert _rows(silver_of_state(spark, state, keys, rules, DAY)) == whole
        assert bucket_count(spark, state) == 3


def test_counts_and_repeated_deliveries(spark, database):
    state, keys = f"{database}.s", ["a", "b"]
    assert merge_delivery(_frame(spark, ROWS[:3]), state, keys, buckets=2) == {"keys": 2, "new": 2, "again": 0}
    assert merge_delivery(_frame(spark, ROWS[2:]), state, keys) == {"keys": 4, "new": 2, "again": 1}
    before = _rows(spark.table(state))
    assert merge_delivery(_frame(spark, ROWS), state, keys) == {"keys": 4, "new": 0, "again": 4}
    assert _rows(spark.table(state)) == before
    assert merge_delivery(_frame(spark, []), state, keys)["keys"] == 4


def test_a_failed_merge_leaves_the_state(spark, database):
    state = f"{database}.s"
    merge_delivery(_frame(spark, ROWS), state, ["a"], buckets=2)
    before = _rows(spark.table(state))
    broken = _frame(spark, ROWS).withColumn("w", F.raise_error(F.lit("lost")).cast("string"))
    with pytest.raises(Exception, match="lost"):
        merge_delivery(broken, state, ["a"])
    with pytest.raises(ValueError, match="no columns"):
        merge_delivery(_frame(spark, ROWS).drop("w"), state, ["a"])
    assert _rows(spark.table(state)) == before and len(spark.catalog.listTables(database)) == 1
    spark.range(3).write.saveAsTable(f"{database}.plain")
    with pytest.raises(ValueError, match="no buckets"):
        merge_delivery(spark.range(3), f"{database}.plain", ["id"])


def test_columns_in_another_order_and_extra_ones(spark, database):
    state = f"{database}.s"
    merge_delivery(_frame(spark, ROWS[:5]), state, ["a", "b"], buckets=2)
    other = _frame(spark, ROWS[5:]).withColumn("more", F.lit(1)).select("w", "more", "v", "b", "a")
    merge_delivery(other, state, ["a", "b"])
    assert _rows(silver_of_state(spark, state, ["a", "b"], run_date=DAY)) == _rows(conform(_frame(spark, ROWS), ["a", "b"], run_date=DAY))


def _exchanges_above(plan: str, scan: str) -> int:
    """Exchanges between a scan and the join above it, in a plan printed as a tree."""
    lines = plan.splitlines()
    at = next(i for i, line in enumerate(lines) if scan in line)
    depth, found = re.search(r"[A-Za-z]", lines[at]).start(), 0
    for line in reversed(lines[:at]):
        own = re.search(r"[A-Za-z*]", line)
        if own and own.start() < depth:
            depth = own.start()
            if "Join" in line:
                return found
            found += "Exchange" in line
    raise AssertionError("no join above the scan")


def test_the_state_is_not_shuffled(spark, database):
    state = f"{database}.s"
    hot = spark.range(20_000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), (F.col("id") * 7 % 1000).alias("v"))
    merge_delivery(hot, state, ["k"], buckets=8)
    plan = merged_survivors(spark.table(state), hot, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert _exchanges_above(plan, "FileScan parquet") == 0 and plan.count("Exchange hashpartitioning") == 1
    merge_delivery(hot.withColumn("v", F.col("v") - 1), state, ["k"])
    assert spark.table(state).agg(F.count("*"), F.min("v")).first()[:] == (13_334, -1)
    files = [f.rsplit("/", 1)[1] for f in spark.table(state).inputFiles()]
    assert len(files) <= 8  # a file per bucket, so a later merge reads each in one task


def test_the_job_merges_what_is_in_bronze(spark, tmp_path):
    database = f"db_{uuid.uuid4().hex}"
    header = ",".join(CONTRACTS["distribution_centers"].columns)
    args = ["deliver", "--bronze", f"{tmp_path}/bronze", "--silver", f"{tmp_path}/silver", "--database", database]
    args += ["--table", "distribution_centers", "--buckets", "2", "--keep-versions", "3"]
    try:
        for lines, expected in ((["1, b ,1,1", "2,c,1,1", ",x,1,1"], (2, 2, 0, 2)), (["1,a,99,1", "3,d,1,1"], (3, 1, 1, 3))):
            (tmp_path / "raw").mkdir(exist_ok=True)
            (tmp_path / "raw" / "distribution_centers.csv").write_text("\n".join([header, *lines]) + "\n")
            jobs.run(spark, ["land", "--raw", f"{tmp_path}/raw", "--bronze", f"{tmp_path}/bronze", "--table", "distribution_centers"])
            assert tuple(jobs.run(spark, args).first()) == ("distribution_centers", *expected)
        silver = read_silver(spark, f"{tmp_path}/silver", "distribution_centers")
        assert sorted((r["id"], r["name"]) for r in silver.collect()) == [(1, "b"), (2, "c"), (3, "d")]
        assert versions(spark, f"{tmp_path}/silver/distribution_centers") == [1, 2]
    finally:
        drop_database(spark, database, cascade=True)


# ---- profiles --------------------------------------------------------------------------------------

SPEC = ProfileSpec(key=("a", "b"), padded=("w",), lower=("w",), groups=("v", "b"), extremes=("v", "a"))


def test_a_profile_of_loads_is_that_of_their_union(spark, database):
    state, df = f"{database}.p", _frame(spark, ROWS + [(None, None, None, None)] * 2 + [(11, "x", -0.0, "W"), (9, "x", 0.0, " W")])
    types = {f.name: f.dataType for f in df.schema.fields}
    parts = [df.filter(F.pmod(F.xxhash64(*df.columns), F.lit(3)) == k) for k in range(3)]
    for k, part in enumerate(parts):
        assert add_load(part, SPEC, state, f"day {k}", buckets=3)
        assert not add_load(part, SPEC, state, f"day {k}")  # the same load again
    assert _rows(profile_of_state(spark, state, SPEC, types)) == _rows(profile_table(df, SPEC))
    assert loads_of(spark, state) == ["day 0", "day 1", "day 2"]


def test_an_empty_load_and_a_failed_one(spark, database):
    state, df = f"{database}.p", _frame(spark, ROWS)
    types = {f.name: f.dataType for f in df.schema.fields}
    assert add_load(df.limit(0), SPEC, state, "nothing", buckets=2)
    assert _rows(profile_of_state(spark, state, SPEC, types)) == _rows(profile_table(df.limit(0), SPEC))
    add_load(df, SPEC, state, "first")
    before = _rows(spark.table(state))
    with pytest.raises(Exception, match="lost"):
        add_load(df.withColumn("w", F.raise_error(F.lit("lost")).cast("string")), SPEC, state, "second")
    with pytest.raises(ValueError, match="names columns"):
        add_load(df.drop("v"), SPEC, state, "second")
    assert _rows(spark.table(state)) == before and _rows(profile_of_state(spark, state, SPEC, types)) == _rows(profile_table(df, SPEC))


def test_profile_counts_are_not_shuffled_again(spark, database):
    df = dirty(spark, SF, "users")
    spec = ProfileSpec(key=("id",), groups=("city", "country"))
    add_load(df, spec, f"{database}.p", "one", buckets=8)
    plan = merged_entries(spark.table(f"{database}.p"), _entries(df, spec, "two"))._jdf.queryExecution().executedPlan().toString()
    assert _exchanges_above(plan, f"FileScan parquet spark_catalog.{database}.p") == 0
    assert set(STANDIN_CONTRACTS["users"].columns) <= set(df.columns)


# ---- findings per file -----------------------------------------------------------------------------


def test_findings_name_the_files(spark, tmp_path):
    contract = TableContract.of("t", "id", "id integer; v string")
    (tmp_path / "t.csv").mkdir()
    files = {"good.csv": ["1,a", "2,b"], "bad.csv": ["1", "2,b,c", ",x", '3,"a,b"', '4,"x,y",z', "5,ok"], "none.csv": [], "keyless.csv": [",y"]}
    for name, lines in files.items():
        (tmp_path / "t.csv" / name).write_text("\n".join(["id,v", *lines]) + "\n")
    found = {r["file"].rsplit("/", 1)[1]: tuple(r)[1:] for r in file_findings(spark, contract, f"{tmp_path}/t.csv").collect()}
    assert found == {
        "good.csv": (2, 0, 0, 0, 0, True), "bad.csv": (6, 1, 2, 0, 1, False), "keyless.csv": (1, 0, 0, 0, 1, False),
    }
    bad = file_findings(spark, contract, f"{tmp_path}/t.csv", only_bad=True)
    assert {r["file"].rsplit("/", 1)[1] for r in bad.collect()} == {"bad.csv", "keyless.csv"}
    other = TableContract.of("t", "nokey", "nokey integer; v string")
    assert {r["null_key_rows"] == r["row_count"] - r["short_rows"] - r["long_rows"] for r in file_findings(spark, other, f"{tmp_path}/t.csv").collect()} == {True}
    (tmp_path / "bronze" / "products").mkdir(parents=True)
    (tmp_path / "bronze" / "products" / "products.csv").write_text(",".join(CONTRACTS["products"].columns) + "\n1,2\n")
    (row,) = jobs.run(spark, ["files", "--bronze", f"{tmp_path}/bronze", "--table", "products"]).collect()
    assert (row["table"], row["row_count"], row["short_rows"], row["passed"]) == ("products", 1, 1, False)
