"""The plans that Catalyst makes of the queries: what is shuffled, what is read, what must not appear."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import Observation

import __spark_entry__ as registry
from siltworks import functions as X
from siltworks import operators as O
from siltworks.contracts import TableContract
from siltworks.plans import RULES, conform, conform_counted, validate_table
from siltworks.sources import scan_contract, write_strings
from standins import STANDIN_CONTRACTS, dirty, table

SF = "/root/testdata/sf0.001"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_conform_shuffles_once_after_combining(spark):
    plan = _plan(registry.q_silver_order_items(spark, SF))
    assert plan.count("Exchange") == 1
    assert plan.index("Exchange hashpartitioning(l_orderkey") < plan.index("partial_min")
    assert "PushedFilters: [IsNotNull(l_orderkey), IsNotNull(l_linenumber)]" in plan


def test_range_check_stays_above_the_shuffle(spark):
    plan = _plan(conform(dirty(spark, SF, "distribution_centers"), ("id",), RULES["distribution_centers"]))
    assert plan.count("Exchange") == 1
    assert re.search(r"Filter.*latitude.*90", plan[: plan.index("Exchange")])


def test_counts_are_taken_above_the_shuffle(spark):
    source = dirty(spark, SF, "distribution_centers")
    plan = _plan(conform_counted(source, ("id",), RULES["distribution_centers"], None, Observation()))
    assert plan.count("Exchange") == plan.count("CollectMetrics") == 1
    assert plan.index("CollectMetrics") < plan.index("Exchange")


def test_gate_reads_only_the_key(spark, tmp_path):
    path = str(tmp_path / "t")
    write_strings(table(spark, SF, "orders"), path)
    contract = TableContract.of(
        "t", "o_orderkey", ";".join(f"{c} string" for c in table(spark, SF, "orders").columns)
    )
    plan = _plan(validate_table(spark, contract, path))
    assert "ReadSchema: struct<o_orderkey:string,_corrupt_record:string>" in plan
    assert plan.count("FileScan") == 1


def test_csv_scan_prunes_columns(spark, tmp_path):
    path = str(tmp_path / "t")
    write_strings(dirty(spark, SF, "products"), path)
    scan = scan_contract(spark, STANDIN_CONTRACTS["products"], path)
    assert "ReadSchema: struct<name:string>" in _plan(scan.select("name"))


def test_filters_and_projections_reach_the_parquet_scan(spark):
    orders = table(spark, SF, "orders")
    plan = _plan(O.select_cols(O.equals_literal(orders, "o_orderstatus", "F"), "o_custkey"))
    assert "PushedFilters: [IsNotNull(o_orderstatus), EqualTo(o_orderstatus,F)]" in plan
    assert "ReadSchema: struct<o_custkey:bigint,o_orderstatus:string>" in plan
    assert "PushedFilters: [IsNull(o_custkey)]" in _plan(O.null_rows(orders, "o_custkey"))
    prices = _plan(O.bad_cost_rows(orders, "o_totalprice"))
    assert "PushedFilters: [Or(LessThanOrEqual(o_totalprice,0.0),IsNull(o_totalprice))]" in prices
    places = spark.read.schema("id long, latitude double, longitude double").parquet(f"{SF}/orders.parquet")
    north = _plan(places.filter(X.within("latitude", -90, 90)))  # one range, so the plan text is not cut short
    assert "GreaterThanOrEqual(latitude,-90.0), LessThanOrEqual(latitude,90.0)]" in north


def test_limit_is_a_top_n(spark):
    plan = _plan(registry.q_limit(spark, SF))
    assert "TakeOrderedAndProject" in plan and "Exchange" not in plan


def test_profile_scans_twice_and_joins_one_row_per_column(spark):
    plan = _plan(registry.q_profile_products(spark, SF))
    assert plan.count("FileScan") == 4  # the dirty input reads its table twice
    assert plan.count("Expand") == 1
    assert not re.search(r"Filter isnotnull\(map", plan)


@pytest.mark.parametrize("name", sorted(name for name in registry.queries() if name.startswith("q_")))
def test_no_python_and_no_pairing(spark, name):
    plan = _plan(registry.queries()[name](spark, SF))
    assert not re.search(r"EvalPython|MapInPandas|MapInArrow|FlatMapGroups|Cartesian|NestedLoop", plan)
