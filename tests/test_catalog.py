from __future__ import annotations

import uuid

import pytest

from siltworks.sources import (
    create_database,
    create_table,
    drop_database,
    drop_table,
    insert_rows,
    publish_table,
    read_table,
    register_table,
    sql_query,
    write_silver,
)


@pytest.fixture
def database(spark, tmp_path):
    name = f"db_{uuid.uuid4().hex}"
    create_database(spark, name, str(tmp_path / "it's here"))
    yield name
    drop_database(spark, name, cascade=True)


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_create_insert_read_drop(spark, database):
    table = f"{database}.students"
    create_table(spark, table, "id INT, name STRING")
    create_table(spark, table, "id INT, name STRING")
    assert _rows(read_table(spark, table)) == []
    insert_rows(spark.createDataFrame([(1, "Ann"), (2, "Bo")], "id int, name string"), table)
    insert_rows(spark.createDataFrame([(3, "Cy")], "id int, name string"), table)
    assert _rows(read_table(spark, table)) == [(1, "Ann"), (2, "Bo"), (3, "Cy")]
    with pytest.raises(Exception, match="TABLE_OR_VIEW_ALREADY_EXISTS"):
        create_table(spark, table, "id INT", exist_ok=False)
    drop_table(spark, table, missing_ok=False)
    drop_table(spark, table)
    with pytest.raises(Exception, match="TABLE_OR_VIEW_NOT_FOUND"):
        drop_table(spark, table, missing_ok=False)


def test_publish_replaces(spark, database):
    table = f"{database}.numbers"
    for n in (5, 3):
        publish_table(spark.range(n), table)
        assert _rows(read_table(spark, table)) == [(i,) for i in range(n)]


def test_registered_files_are_not_copied_and_outlive_the_table(spark, database, tmp_path):
    path = str(tmp_path / "silver")
    write_silver(spark.range(4), path)
    for _ in range(2):
        register_table(spark, f"{database}.numbers", path)
    assert read_table(spark, f"{database}.numbers").inputFiles() == spark.read.parquet(path).inputFiles()
    drop_table(spark, f"{database}.numbers")
    assert spark.read.parquet(path).count() == 4


def test_databases(spark, database):
    create_database(spark, database)
    with pytest.raises(Exception, match="SCHEMA_ALREADY_EXISTS"):
        create_database(spark, database, exist_ok=False)
    publish_table(spark.range(1), f"{database}.t")
    with pytest.raises(Exception, match="SCHEMA_NOT_EMPTY"):
        drop_database(spark, database)
    drop_database(spark, "never_made")
    with pytest.raises(Exception, match="SCHEMA_NOT_FOUND"):
        drop_database(spark, "never_made", missing_ok=False)


def test_sql_in_a_database(spark, database):
    publish_table(spark.range(10), f"{database}.numbers")
    before = spark.catalog.currentDatabase()
    df = sql_query(spark, "select sum(id) as total from numbers where id > :low", database, {"low": 7})
    assert spark.catalog.currentDatabase() == before
    assert _rows(df) == [(17,)]
    with pytest.raises(Exception, match="TABLE_OR_VIEW_NOT_FOUND"):
        sql_query(spark, "select * from numbers")
    with pytest.raises(Exception, match="TABLE_OR_VIEW_NOT_FOUND"):
        sql_query(spark, "select * from nothing", database)
    assert spark.catalog.currentDatabase() == before
