"""Tables kept as versions, and catalog entries that survive what fails."""

from __future__ import annotations

import os
import threading
import uuid

import pytest

from siltworks.contracts import TableContract
from siltworks.plans import refine_all
from siltworks.sources import (
    create_database, drop_database, drop_table, publish_table, read_current, read_silver, read_table, register_table,
    silver_location, take_back, versions, write_silver, write_strings, write_version,
)
from siltworks.sources import catalog
from siltworks.sources.landing import bronze_path

BREAKS = "case when id = 3 then raise_error('lost') else id end"


@pytest.fixture
def database(spark, tmp_path):
    name = f"db_{uuid.uuid4().hex}"
    create_database(spark, name, f"{tmp_path}/db")
    yield name
    drop_database(spark, name, cascade=True)


def _breaking(spark):
    return spark.range(9).selectExpr(f"{BREAKS} as id")


# ---- versions --------------------------------------------------------------------------------------


def test_a_reader_finds_a_whole_table_at_any_moment(spark, tmp_path):
    home = f"{tmp_path}/silver"
    write_silver(spark.range(1000), f"{home}/t", keep_versions=3)
    stop, seen, wrong = threading.Event(), [], []

    def poll():
        while not stop.is_set():
            try:
                seen.append(read_silver(spark, home, "t").count())
            except Exception as error:  # the reader must never fail
                wrong.append(error)

    reader = threading.Thread(target=poll)
    reader.start()
    for i in range(10):
        assert write_silver(spark.range(1001 + i), f"{home}/t", keep_versions=3) == 1001 + i
    stop.set()
    reader.join()
    assert not wrong and seen == sorted(seen) and set(seen) <= set(range(1000, 1011))
    assert len(versions(spark, f"{home}/t")) == 11  # all were current just now
    write_version(spark.range(5), f"{home}/t", keep=3, grace=0)
    assert versions(spark, f"{home}/t") == [10, 11, 12] and len(os.listdir(f"{home}/t")) == 3 + 1


def test_the_last_version_can_be_taken_back(spark, tmp_path):
    path = f"{tmp_path}/t"
    for n in (3, 5, 8):
        write_version(spark.range(n), path, keep=3, grace=0)
    assert read_current(spark, path).count() == 8 and read_current(spark, path, 1).count() == 3
    assert take_back(spark, path) == 4
    assert read_current(spark, path).count() == 5 and versions(spark, path) == [1, 2, 3, 4]
    with pytest.raises(FileNotFoundError):
        read_current(spark, path, 9)
    write_version(spark.range(1), path, keep=1, grace=0)
    assert versions(spark, path) == [5] and sum(n.startswith("v-") for n in os.listdir(path)) == 1
    with pytest.raises(ValueError, match="no earlier"):
        take_back(spark, path)
    with pytest.raises(ValueError, match="kept"):
        write_version(spark.range(1), path, keep=0)


def test_a_failed_write_is_no_version(spark, tmp_path):
    path = f"{tmp_path}/t"
    with pytest.raises(Exception, match="lost"):
        write_version(_breaking(spark), path)
    with pytest.raises(FileNotFoundError):
        read_current(spark, path)
    write_version(spark.range(5), path)
    with pytest.raises(Exception, match="lost"):
        write_version(_breaking(spark), path)
    assert versions(spark, path) == [1] and read_current(spark, path).count() == 5
    assert sorted(n[0] for n in os.listdir(path)) == ["_", "v"]


def test_relative_paths_stay_below_the_working_directory(spark, monkeypatch):
    name = f"relative-{uuid.uuid4().hex}"
    before = set(os.listdir("/"))
    try:
        for n in (4, 6):
            assert write_silver(spark.range(n), name) == n
        assert spark.read.parquet(name).count() == 6
        write_version(spark.range(7), f"{name}-v")
        assert read_current(spark, f"{name}-v").count() == 7
        assert set(os.listdir("/")) == before
    finally:
        from siltworks.sources.replace import qualified, remove_directory

        for made in (name, f"{name}-v"):
            remove_directory(spark, qualified(spark, made))


def test_the_silver_job_can_keep_versions(spark, tmp_path, database):
    contracts = {"t": TableContract.of("t", "id", "id integer; v string")}
    bronze, silver = f"{tmp_path}/bronze", f"{tmp_path}/silver"
    for n in (3, 4):
        write_strings(spark.range(n).selectExpr("id", "'x' as v"), bronze_path(bronze, "t"))
        report = refine_all(spark, bronze, silver, contracts, contracts, {}, keep_versions=2).collect()
        assert [(r["rows_written"], r["refined"]) for r in report] == [(n, True)]
        register_table(spark, f"{database}.t", silver_location(spark, silver, "t"))
        assert read_table(spark, f"{database}.t").count() == n
    assert read_silver(spark, silver, "t").count() == 4 and versions(spark, f"{silver}/t") == [1, 2]
    take_back(spark, f"{silver}/t")
    assert read_silver(spark, silver, "t").count() == 3


# ---- catalog entries -------------------------------------------------------------------------------


def _names(spark, database):
    return sorted(t.name for t in spark.catalog.listTables(database))


@pytest.mark.parametrize("external", [False, True])
def test_a_failed_publish_leaves_the_table(spark, tmp_path, database, external):
    table, path = f"{database}.t", f"{tmp_path}/files" if external else None
    publish_table(spark.range(5), table, path=path)
    with pytest.raises(Exception, match="lost"):
        publish_table(_breaking(spark), table, path=path)
    assert read_table(spark, table).count() == 5 and _names(spark, database) == ["t"]
    assert not [n for n in os.listdir(f"{tmp_path}/db") if n != "t"]
    publish_table(spark.range(7), table, path=path)  # the same columns
    assert read_table(spark, table).count() == 7
    publish_table(spark.range(2).selectExpr("id", "'x' as more"), table, path=path)  # other columns
    assert read_table(spark, table).columns == ["id", "more"] and _names(spark, database) == ["t"]
    publish_table(read_table(spark, table).filter("id = 0"), table, path=path)  # from itself
    assert [tuple(r) for r in read_table(spark, table).collect()] == [(0, "x")]
    kind = spark.catalog.getTable(table).tableType
    assert kind == ("EXTERNAL" if external else "MANAGED")
    drop_table(spark, table)
    if external:
        assert read_current(spark, path).count() == 1 and len(versions(spark, path)) == 4


@pytest.mark.parametrize("step", ["create", "rename"])
def test_an_entry_that_cannot_be_made_or_renamed_leaves_the_table(spark, tmp_path, database, monkeypatch, step):
    table = f"{database}.t"
    publish_table(spark.range(5), table, path=f"{tmp_path}/files")
    spark.range(3).selectExpr("id as other").write.parquet(f"{tmp_path}/new")
    spark.range(3).selectExpr("id as other").write.orc(f"{tmp_path}/orc")
    if step == "create":
        monkeypatch.setattr(type(spark.catalog), "createTable", lambda *a, **b: (_ for _ in ()).throw(RuntimeError("no entry")))
    else:
        true_rename = catalog._rename

        def rename(own, old, to):
            if "__new_" in old:
                raise RuntimeError("no entry")
            true_rename(own, old, to)

        monkeypatch.setattr(catalog, "_rename", rename)
    with pytest.raises(RuntimeError, match="no entry"):
        register_table(spark, table, f"{tmp_path}/new")
    with pytest.raises(RuntimeError, match="no entry"):
        register_table(spark, table, f"{tmp_path}/orc", provider="orc")
    with pytest.raises(RuntimeError, match="no entry"):
        publish_table(spark.range(3).selectExpr("id as other"), table, path=f"{tmp_path}/files")
    monkeypatch.undo()
    assert read_table(spark, table).columns == ["id"] and read_table(spark, table).count() == 5
    assert _names(spark, database) == ["t"] and len(versions(spark, f"{tmp_path}/files")) == 1
    register_table(spark, table, f"{tmp_path}/orc", provider="orc")
    assert read_table(spark, table).columns == ["other"]


def test_readers_of_a_table_find_it_while_it_is_published(spark, tmp_path, database):
    table = f"{database}.t"
    publish_table(spark.range(10), table, path=f"{tmp_path}/files", keep_versions=3)
    stop, wrong = threading.Event(), []

    def poll():
        while not stop.is_set():
            try:
                assert read_table(spark, table).count() >= 10
            except Exception as error:
                wrong.append(error)

    reader = threading.Thread(target=poll)
    reader.start()
    for n in range(11, 17):
        publish_table(spark.range(n), table, path=f"{tmp_path}/files", keep_versions=3)
    stop.set()
    reader.join()
    assert not wrong and read_table(spark, table).count() == 16


def test_tables_of_the_current_database(spark, tmp_path, database):
    before = spark.catalog.currentDatabase()
    spark.catalog.setCurrentDatabase(database)
    try:
        for n in (2, 4):
            publish_table(spark.range(n), "plain")
            publish_table(spark.range(n), "apart", path=f"{tmp_path}/apart")
        assert read_table(spark, "plain").count() == read_table(spark, "apart").count() == 4
    finally:
        spark.catalog.setCurrentDatabase(before)
