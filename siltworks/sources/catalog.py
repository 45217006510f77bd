"""Catalog tables and SQL over them. Works with the built-in catalog; Hive support is not required."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from siltworks.sources.replace import qualified, remove_directory
from siltworks.sources.versions import KEPT, NewVersion


def _quoted(name: str) -> str:
    return ".".join("`" + part.replace("`", "``") + "`" for part in name.split("."))


def _location(path: str | None) -> str:
    if not path:
        return ""
    return " LOCATION '" + path.replace("\\", "\\\\").replace("'", "\\'") + "'"


def create_database(spark: SparkSession, name: str, location: str | None = None, *, exist_ok: bool = True) -> None:
    spark.sql(f"CREATE DATABASE {'IF NOT EXISTS ' if exist_ok else ''}{_quoted(name)}{_location(location)}")


def drop_database(spark: SparkSession, name: str, *, missing_ok: bool = True, cascade: bool = False) -> None:
    """Drop a database; one that still has tables is refused unless ``cascade``."""
    spark.sql(
        f"DROP DATABASE {'IF EXISTS ' if missing_ok else ''}{_quoted(name)}{' CASCADE' if cascade else ''}"
    )


def create_table(
    spark: SparkSession, table: str, schema: T.StructType | str, *, path: str | None = None,
    provider: str = "parquet", exist_ok: bool = True,
) -> None:
    """Create an empty table; with ``path`` its files outlive a drop.

    ``provider="hive"`` needs a session with Hive support.
    """
    columns = schema if isinstance(schema, str) else schema.toDDL()
    spark.sql(
        f"CREATE TABLE {'IF NOT EXISTS ' if exist_ok else ''}{_quoted(table)} ({columns}) USING {provider}"
        + _location(path)
    )


def insert_rows(df: DataFrame, table: str) -> None:
    """Append to a table. Columns bind by position, as in ``INSERT INTO``."""
    df.write.insertInto(table)


def _sibling(table: str, mark: str) -> str:
    """Another name in the same database."""
    return f"{table}__{mark}_{uuid.uuid4().hex[:12]}"


def _provider(spark: SparkSession, table: str) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {_quoted(table)}").filter("col_name = 'Provider'").collect()
    return rows[0]["data_type"].lower() if rows else ""


def _columns(schema: T.StructType) -> list[tuple[str, str]]:
    return [(field.name, field.dataType.simpleString()) for field in schema.fields]


def _rename(spark: SparkSession, table: str, to: str) -> None:
    spark.sql(f"ALTER TABLE {_quoted(table)} RENAME TO {_quoted('.'.join(to.split('.')[-2:]))}")


def _put_in_place(spark: SparkSession, staged: str, table: str) -> None:
    """Give the staged entry the table's name. The earlier entry waits under another name until that has worked."""
    earlier = _sibling(table, "old") if spark.catalog.tableExists(table) else None
    if earlier:
        _rename(spark, table, earlier)
    try:
        _rename(spark, staged, table)
    except BaseException:
        if earlier:
            _rename(spark, earlier, table)
        raise
    if earlier:
        drop_table(spark, earlier)


def _point(spark: SparkSession, table: str, location: str, provider: str, schema: T.StructType) -> None:
    """Let the table's entry name another directory, in one step if it is external and its columns stay the same.

    Else an entry is made under another name first, so that nothing is lost if it cannot be made.
    """
    if spark.catalog.tableExists(table) and spark.catalog.getTable(table).tableType == "EXTERNAL":
        if _provider(spark, table) == provider.lower() and _columns(spark.table(table).schema) == _columns(schema):
            spark.sql(f"ALTER TABLE {_quoted(table)} SET{_location(location)}")
            return
    staged = _sibling(table, "new")
    spark.catalog.createTable(staged, path=location, source=provider, schema=schema)
    try:
        _put_in_place(spark, staged, table)
    except BaseException:
        drop_table(spark, staged)  # of an external table this removes the entry only
        raise


def publish_table(
    df: DataFrame, table: str, *, path: str | None = None, provider: str = "parquet", keep_versions: int = KEPT
) -> None:
    """Create or replace a table from the rows. A publish that fails leaves the earlier table and its rows.

    With ``path`` the table's files outlive a drop. Each publish then writes a version of its own below ``path`` and
    points the entry at it, in one step while the columns stay the same; ``keep_versions`` of them are kept, and
    ``versions.read_current`` reads the last one without the catalog. Without ``path`` the rows are written as a
    table under another name, which takes the place of the earlier one by two renames of entries. The rows may come
    from the table that is replaced.
    """
    spark = df.sparkSession
    if path:
        version = NewVersion(spark, path)
        try:
            df.write.format(provider).save(version.location)
            _point(spark, table, version.location, provider, spark.read.format(provider).load(version.location).schema)
        except BaseException:
            version.discard()
            raise
        version.commit(keep_versions)
        return
    replace_table(spark, table, lambda staged: df.write.format(provider).saveAsTable(staged))


def replace_table(spark: SparkSession, table: str, write: Callable[[str], None]) -> None:
    """Let ``write`` make a table of another name, then give that the table's name. A failure leaves the earlier one."""
    staged = _sibling(table, "new")
    try:
        write(staged)
        _put_in_place(spark, staged, table)
    except BaseException:
        _remove_staged(spark, staged)
        raise


def _remove_staged(spark: SparkSession, staged: str) -> None:
    """The entry, if it was made, and the files that a write left where it would have been."""
    drop_table(spark, staged)
    *database, name = staged.split(".")
    home = spark.catalog.getDatabase(database[-1] if database else spark.catalog.currentDatabase()).locationUri
    remove_directory(spark, f"{home.rstrip('/')}/{name}")


def register_table(
    spark: SparkSession, table: str, path: str, *, provider: str = "parquet", replace_managed: bool = False
) -> None:
    """Make a directory that is already written a catalog table, without copying it.

    The directory is read first, and the new entry made before the earlier one goes: if either fails, an earlier entry
    of that name stays. One whose files the catalog owns, and would delete, is refused unless ``replace_managed``.
    """
    schema = spark.read.format(provider).load(path).schema
    if spark.catalog.tableExists(table) and spark.catalog.getTable(table).tableType == "MANAGED" and not replace_managed:
        raise ValueError(f"{table} owns its files, which replacing it would delete")
    _point(spark, table, qualified(spark, path), provider, schema)


def read_table(spark: SparkSession, table: str) -> DataFrame:
    return spark.table(table)


def drop_table(spark: SparkSession, table: str, *, missing_ok: bool = True) -> None:
    spark.sql(f"DROP TABLE {'IF EXISTS ' if missing_ok else ''}{_quoted(table)}")


def sql_query(spark: SparkSession, sql: str, database: str | None = None, args: dict | None = None) -> DataFrame:
    """Run SQL over published tables, as a DataFrame: rows stay on the executors until asked for.

    ``database`` is where unqualified table names are looked up. The query then runs in a session of its own, which
    shares the catalog but neither temporary views nor settings made at run time, so that queries on other threads
    keep their database. ``args`` binds ``:name`` markers.
    """
    if database is None:
        return spark.sql(sql, args=args)
    own = spark.newSession()
    own.catalog.setCurrentDatabase(database)
    return own.sql(sql, args=args)
