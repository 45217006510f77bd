"""Replacing tables: a failure leaves what was there."""

from __future__ import annotations

import os
import threading
import uuid

import pytest

from siltworks.contracts import TableContract
from siltworks.plans import RefineFailure, refine_all
from siltworks.sources import (
    create_database, create_table, drop_database, insert_rows, publish_table, read_table, register_table, sql_query,
    write_silver, write_strings,
)
from siltworks.sources.landing import bronze_path
from siltworks.workspace import clear_scratch, scratch_dir

BREAKS = "case when id = 3 then raise_error('lost') else id end"


def test_a_failed_write_leaves_the_earlier_table(spark, tmp_path):
    path = f"{tmp_path}/silver/t"
    assert write_silver(spark.range(5), path) == 5
    with pytest.raises(Exception, match="lost"):
        write_silver(spark.range(9).selectExpr(f"{BREAKS} as id"), path)
    assert spark.read.parquet(path).count() == 5
    assert write_silver(spark.range(7), path) == 7
    assert spark.read.parquet(path).count() == 7 and os.listdir(f"{tmp_path}/silver") == ["t"]


@pytest.fixture
def database(spark, tmp_path):
    name = f"db_{uuid.uuid4().hex}"
    create_database(spark, name, f"{tmp_path}/db")
    yield name
    drop_database(spark, name, cascade=True)


def test_registering_a_wrong_path_leaves_the_table(spark, tmp_path, database):
    publish_table(spark.range(5), f"{database}.t")
    with pytest.raises(Exception):
        register_table(spark, f"{database}.t", f"{tmp_path}/nowhere")
    spark.range(3).write.parquet(f"{tmp_path}/other")
    with pytest.raises(ValueError, match="owns its files"):
        register_table(spark, f"{database}.t", f"{tmp_path}/other")
    assert read_table(spark, f"{database}.t").count() == 5
    register_table(spark, f"{database}.t", f"{tmp_path}/other", replace_managed=True)
    assert read_table(spark, f"{database}.t").count() == 3
    spark.range(2).write.parquet(f"{tmp_path}/third")
    register_table(spark, f"{database}.t", f"{tmp_path}/third")
    assert read_table(spark, f"{database}.t").count() == 2 and spark.read.parquet(f"{tmp_path}/other").count() == 3


def test_queries_on_two_threads_keep_their_databases(spark, tmp_path):
    names = [f"db_{uuid.uuid4().hex}" for _ in range(2)]
    for i, name in enumerate(names):
        create_database(spark, name, f"{tmp_path}/{name}")
        create_table(spark, f"{name}.t", "v long", path=f"{tmp_path}/{name}/t")
        insert_rows(spark.createDataFrame([(i,)], "v long"), f"{name}.t")
    before, wrong = spark.catalog.currentDatabase(), []

    def ask(i):
        for _ in range(8):
            if sql_query(spark, "select v from t", names[i]).first()["v"] != i:
                wrong.append(i)

    threads = [threading.Thread(target=ask, args=(i,)) for i in range(2)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert not wrong and spark.catalog.currentDatabase() == before
    for name in names:
        drop_database(spark, name, cascade=True)


def test_a_failed_table_keeps_the_report_of_the_others(spark, tmp_path):
    contracts = {n: TableContract.of(n, "id", "id integer; v string") for n in ("a", "gone", "b")}
    for name in ("a", "b"):
        write_strings(spark.createDataFrame([(1, "x"), (1, "y"), (2, "z")], "id int, v string"), bronze_path(f"{tmp_path}/bronze", name))
    with open(f"{tmp_path}/bronze/b/b.csv/part-bad.csv", "w") as file:
        file.write("id,v\n7,w,MORE\nnone,w\n")
    with pytest.raises(RefineFailure) as failure:
        refine_all(spark, f"{tmp_path}/bronze", f"{tmp_path}/silver", contracts, contracts, {})
    rows = {r["table"]: r for r in failure.value.report.collect()}
    assert failure.value.tables == ["gone"]
    assert (rows["gone"]["refined"], rows["gone"]["error"]) == (False, "PATH_NOT_FOUND")
    assert (rows["a"]["rows_read"], rows["a"]["rows_written"], rows["a"]["malformed_rows"]) == (3, 2, 0)
    assert (rows["b"]["rows_read"], rows["b"]["rows_written"], rows["b"]["malformed_rows"]) == (5, 3, 2)


def test_scratch_is_cleared(spark):
    clear_scratch(spark)
    path = scratch_dir(spark, "mine")
    spark.range(3).write.parquet(path)
    assert clear_scratch(spark) == 1 and not os.path.exists(path.removeprefix("file:"))
