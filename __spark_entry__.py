"""

All inputs are the driver's parquet tables or derived from them by Spark, whole.
"""

from __future__ import annotations

import datetime
import sys
import uuid
from collections.abc import Callable
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402
from pyspark.sql.types import StringType, StructField, StructType  # noqa: E402

from siltworks import functions as X  # noqa: E402
from siltworks import operators as O  # noqa: E402
from siltworks import sources as S  # noqa: E402
from siltworks.contracts import GATE_TABLES, TableContract  # noqa: E402
from siltworks.plans import (  # noqa: E402
    PROFILES,
    RULES,
    GateFailure,
    ProfileSpec,
    RefineFailure,
    add_load,
    conform,
    file_findings,
    merge_delivery,
    profile_of_state,
    profile_table,
    refine_all,
    run_gate,
    silver_of_state,
    silver_table,
    validate_all,
    validate_table,
)
from siltworks.sources.landing import bronze_path  # noqa: E402
from siltworks.streaming import (  # noqa: E402
    arrivals_silver_stream,
    await_sink,
    events_silver_stream,
    scan_arrivals,
    scan_stream,
    start_arrivals,
    start_events_sink,
    stream_session,
    untimed_events,
)
from siltworks.workspace import scratch_dir  # noqa: E402
from standins import DIRTY_SQL, STANDIN_CONTRACTS, dirty, table  # noqa: E402

RUN_DATE = datetime.date(2024, 1, 31)

Query = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, Query] = {}
_ORACLES: dict[str, str] = {}


def _query(oracle: str) -> Callable[[Query], Query]:
    """Register a function under its name, with its oracle SQL."""

    def register(function: Query) -> Query:
        _QUERIES[function.__name__] = function
        _ORACLES[function.__name__] = oracle.strip()
        return function

    return register


def _with_dirty(name: str, sql: str) -> str:
    return f"with dirty as ({DIRTY_SQL[name]})\n{sql}"


def _one_per_key(columns: list[str], keys: tuple[str, ...], source: str = "dirty") -> str:
    """SQL for the smallest row of each key, by the other columns in schema order, NULL first."""
    order = ", ".join(f"{c} asc nulls first" for c in columns if c not in keys)
    return (
        f"(select * from (select *, row_number() over (partition by {', '.join(keys)} order by {order}) as rn"
        f" from {source}) as ranked where rn = 1)"
    )


# ---- silver tables ---------------------------------------------------------------------------------


def _as_text(df: DataFrame) -> DataFrame:
    """The load date as text, so that both engines hand it to the comparison in one form."""
    return df.withColumns({"ingestion_date": F.col("ingestion_date").cast("string")})


def _silver(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return _as_text(silver_table(dirty(spark, sf_dir, name), name, RUN_DATE))


def _silver_sql(name: str, source: str = "dirty") -> str:
    contract, rules = STANDIN_CONTRACTS[name], RULES[name]

    def value(c: str) -> str:
        if c in rules.lower:
            return f"lower(trim({c}, ' ')) as {c}"
        return f"trim({c}, ' ') as {c}" if c in rules.trim else c

    where = [f"{k} is not null" for k in contract.key]
    where += [f"{c} between {low} and {high}" for c, low, high in rules.ranges]
    sql = (
        f"select {', '.join(value(c) for c in contract.columns)}, '{RUN_DATE}' as ingestion_date\n"
        f"from {_one_per_key(contract.columns, contract.key, source)} as kept where {' and '.join(where)}"
    )
    return _with_dirty(name, sql) if source == "dirty" else sql


@_query(_silver_sql("products"))
def q_silver_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _silver(spark, sf_dir, "products")


@_query(_silver_sql("users"))
def q_silver_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _silver(spark, sf_dir, "users")


@_query(_silver_sql("orders"))
def q_silver_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _silver(spark, sf_dir, "orders")


@_query(_silver_sql("distribution_centers"))
def q_silver_dcs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _silver(spark, sf_dir, "distribution_centers")


@_query(_silver_sql("order_items", "lineitem"))
def q_silver_order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = table(spark, sf_dir, "lineitem")
    return _as_text(conform(items, STANDIN_CONTRACTS["order_items"].key, RULES["order_items"], RUN_DATE))


@_query(_silver_sql("inventory_items", "(select l_partkey, l_suppkey, l_quantity from lineitem) as stock"))
def q_silver_inventory_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    contract = STANDIN_CONTRACTS["inventory_items"]
    stock = O.select_cols(table(spark, sf_dir, "lineitem"), *contract.columns)
    return _as_text(conform(stock, contract.key, RULES["inventory_items"], RUN_DATE))


@_query(_silver_sql("products"))
def q_write_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "silver")
    S.write_silver(silver_table(dirty(spark, sf_dir, "products"), "products", RUN_DATE), path)
    return _as_text(spark.read.parquet(path))


@_query(_silver_sql("products"))
def q_silver_increment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Products in four deliveries, the third of which comes again: silver of the merged survivors is that of all rows."""
    database, home = f"db_{uuid.uuid4().hex}", scratch_dir(spark, "increment")
    S.create_database(spark, database, f"{home}/db")
    rows, contract, state = dirty(spark, sf_dir, "products"), STANDIN_CONTRACTS["products"], f"{database}.products"
    part = F.pmod(F.xxhash64(*rows.columns), F.lit(4))
    for delivery in (0, 1, 2, 2, 3):
        merge_delivery(rows.filter(part == delivery), state, contract.key, buckets=8)
    S.write_silver(silver_of_state(spark, state, contract.key, RULES["products"], RUN_DATE), f"{home}/silver")
    S.drop_database(spark, database, cascade=True)
    return _as_text(spark.read.parquet(f"{home}/silver"))


def _refine_counts_sql(name: str) -> str:
    contract, rules = STANDIN_CONTRACTS[name], RULES[name]
    keyed = " and ".join(f"{k} is not null" for k in contract.key)
    inside = " and ".join(f"{c} between {low} and {high}" for c, low, high in rules.ranges) or "true"
    one = _one_per_key(contract.columns, contract.key)
    return f"""select '{name}' as "table", rows_read, null_key_rows, rows_read - null_key_rows - keys as duplicate_rows,
       keys - rows_written as out_of_range_rows, rows_written, 0 as malformed_rows, true as refined,
       cast(null as varchar) as error
from (select (select count(*) from dirty) as rows_read,
             (select count(*) from dirty where not ({keyed})) as null_key_rows,
             (select count(*) from {one} as kept where {keyed}) as keys,
             (select count(*) from {one} as kept where {keyed} and {inside}) as rows_written) as counts"""


@_query(
    " union all ".join(
        f"select * from ({_with_dirty(n, _refine_counts_sql(n))}) as r_{n}"
        for n in ("products", "users", "orders", "distribution_centers")
    )
)
def q_refine_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze CSV to silver Parquet for four tables, with the counts of what was lost on the way."""
    bronze, names = scratch_dir(spark, "bronze"), ("products", "users", "orders", "distribution_centers")
    for name in names:
        S.write_strings(dirty(spark, sf_dir, name), bronze_path(bronze, name))
    return refine_all(spark, bronze, scratch_dir(spark, "silver"), names, STANDIN_CONTRACTS, run_date=RUN_DATE)


@_query(_silver_sql("products"))
def q_write_silver_retry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second write that fails in a task leaves the first one readable."""
    path = scratch_dir(spark, "silver")
    silver = silver_table(dirty(spark, sf_dir, "products"), "products", RUN_DATE)
    S.write_silver(silver, path)
    try:
        S.write_silver(silver.withColumns({"name": F.raise_error(F.lit("lost on purpose"))}), path)
    except Exception as error:
        if "lost on purpose" not in str(error):
            raise
        return _as_text(spark.read.parquet(path))
    raise AssertionError("the second write should have failed")


@_query(
    f"select * from ({_with_dirty('products', _refine_counts_sql('products'))}) as r_products"
    " union all select 'users', null, null, null, null, null, null, false, 'PATH_NOT_FOUND'"
)
def q_refine_failure(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One table is refined, one is missing; the exception has a row for each."""
    bronze = scratch_dir(spark, "bronze")
    S.write_strings(dirty(spark, sf_dir, "products"), bronze_path(bronze, "products"))
    try:
        refine_all(
            spark, bronze, scratch_dir(spark, "silver"), ("products", "users"), STANDIN_CONTRACTS, run_date=RUN_DATE
        )
    except RefineFailure as failure:
        return failure.report
    raise AssertionError("users should have been missing")


@_query(
    f"select p_partkey as id, 1.5 as cost, trim(p_type, ' ') as category, trim(p_name, ' ') as name,"
    f" trim(p_brand, ' ') as brand, 2.5 as retail_price, 'Men' as department, 'S' as sku, 1 as distribution_center_id,"
    f" '{RUN_DATE}' as ingestion_date from part"
)
def q_refine_bundled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Products by the bundled contract and rules, each row delivered twice."""
    part = table(spark, sf_dir, "part")
    rows = part.select(
        F.col("p_partkey").alias("id"), F.lit(1.5).alias("cost"), F.concat("p_type", F.lit(" ")).alias("category"),
        F.concat(F.lit(" "), "p_name").alias("name"), F.col("p_brand").alias("brand"), F.lit(2.5).alias("retail_price"),
        F.lit(" Men").alias("department"), F.lit("S").alias("sku"), F.lit(1).alias("distribution_center_id"),
    )
    bronze, silver = scratch_dir(spark, "bronze"), scratch_dir(spark, "silver")
    S.write_strings(rows.unionAll(rows), bronze_path(bronze, "products"))
    refine_all(spark, bronze, silver, ("products",), run_date=RUN_DATE)
    return _as_text(S.read_silver(spark, silver, "products"))


# ---- scans, landing, publishing --------------------------------------------------------------------


@_query(
    _with_dirty(
        "products",
        "select case when id % 50 = 0 then null else id end as id, cost, category, name, brand, retail_price,"
        " department, distribution_center_id from dirty",
    )
)
def q_scan_contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Some ids are not numbers: they load as NULL and the row stays."""
    path = scratch_dir(spark, "csv")
    bad = F.when(F.col("id") % 50 == 0, F.concat(F.lit("x"), F.col("id"))).otherwise(F.col("id").cast("string"))
    S.write_strings(O.with_column(dirty(spark, sf_dir, "products"), "id", bad), path)
    return S.scan_contract(spark, STANDIN_CONTRACTS["products"], path)


@_query(
    _with_dirty(
        "users",
        "select cast(id as varchar) as id, first_name, last_name, email, cast(age as varchar) as age, city, country"
        " from dirty",
    )
)
def q_scan_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "csv")
    S.write_strings(dirty(spark, sf_dir, "users"), path)
    return S.scan_strings(spark, path)


@_query("select cast(p_partkey as integer) as p_partkey, p_name, p_brand, p_type, p_size, p_retailprice from part")
def q_scan_inferred(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "csv")
    S.write_strings(table(spark, sf_dir, "part"), path)
    return S.scan_inferred(spark, path)


@_query(_with_dirty("products", "select * from dirty"))
def q_land_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw, bronze = scratch_dir(spark, "raw"), scratch_dir(spark, "bronze")
    S.write_strings(dirty(spark, sf_dir, "products"), f"{raw}/products.csv")
    S.land_bronze(spark, raw, bronze, ("products",), STANDIN_CONTRACTS)
    return S.scan_contract(spark, STANDIN_CONTRACTS["products"], bronze_path(bronze, "products"))


@_query(
    _with_dirty(
        "users",
        "select 'users' as \"table\", true as source_exists, true as contract_exists, true as landed,"
        " count(*) as row_count, 0 as malformed_rows, cast(null as varchar) as error from dirty"
        " union all select 'orders', false, true, false, 0, 0, 'PATH_NOT_FOUND'"
        " union all select 'stores', true, false, false, 0, 0, null",
    )
)
def q_land_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One table lands, one has no source, one no contract; all are tried before the failure is raised."""
    raw = scratch_dir(spark, "raw")
    for name in ("users", "stores"):
        S.write_strings(dirty(spark, sf_dir, "users"), f"{raw}/{name}.csv")
    try:
        S.land_bronze(spark, raw, scratch_dir(spark, "bronze"), ("users", "orders", "stores"), STANDIN_CONTRACTS)
    except S.LandingFailure as failure:
        return failure.report
    raise AssertionError("landing should have failed")


def _raw_lines(rows: DataFrame, line: str, header: str, path: str) -> None:
    """Files of text lines, each with the header, as a CSV from elsewhere would be."""
    writer = rows.select(F.expr(line).alias(header)).write.option("header", True)
    writer.option("quote", "").option("sep", "\x01").option("ignoreLeadingWhiteSpace", False).csv(path)


@_query(
    "select 'products' as \"table\", true as source_exists, true as contract_exists, false as landed, 0 as row_count,"
    " count(*) filter (where p_partkey % 10 in (0, 1)) as malformed_rows, cast(null as varchar) as error from part"
)
def q_land_ragged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows with a field too many or too few: the table does not land."""
    raw = scratch_dir(spark, "raw")
    line = """case when p_partkey % 10 = 0 then p_partkey || ',1,EXTRA' when p_partkey % 10 = 1 then '' || p_partkey
              else p_partkey || ',' || p_size end"""
    _raw_lines(table(spark, sf_dir, "part"), line, "id,note", f"{raw}/products.csv")
    contracts = {"products": TableContract.of("products", "id", "id long; note string")}
    try:
        S.land_bronze(spark, raw, scratch_dir(spark, "bronze"), ("products",), contracts)
    except S.LandingFailure as failure:
        return failure.report
    raise AssertionError("landing should have failed")


@_query(
    "select 'bronze' as output, l_orderkey || '' as id, l_shipdate || '' as note, null as reason from lineitem"
    " where l_partkey % 50 not in (0, 1)"
    " union all select 'rejects', 'products.csv', l_orderkey || ',\"a, \"\"b\"\"\",' || l_shipdate, 'too many fields'"
    " from lineitem where l_partkey % 50 = 0"
    " union all select 'rejects', 'products.csv', '' || l_orderkey, 'too few fields' from lineitem where l_partkey % 50 = 1"
)
def q_land_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Some rows have a field too many or too few: they land in the table of rejects, the others in bronze."""
    raw, bronze = scratch_dir(spark, "raw"), scratch_dir(spark, "bronze")
    line = """case when l_partkey % 50 = 0 then l_orderkey || ',"a, \"\"b\"\"\",' || l_shipdate
              when l_partkey % 50 = 1 then '' || l_orderkey else l_orderkey || ',' || l_shipdate end"""
    _raw_lines(table(spark, sf_dir, "lineitem"), line, "id,note", f"{raw}/products.csv")
    contracts = {"products": TableContract.of("products", "id", "id string; note string")}
    S.land_bronze(spark, raw, bronze, ("products",), contracts, max_rejected=0.1)
    kept = S.scan_contract(spark, contracts["products"], bronze_path(bronze, "products"))
    rejects = S.read_rejects(spark, bronze, "products")
    source = F.regexp_extract("file", "([a-z]+[.]csv)/part", 1)
    return kept.select(F.lit("bronze").alias("output"), "id", "note", F.lit(None).cast("string").alias("reason")).unionByName(
        rejects.select(F.lit("rejects").alias("output"), source.alias("id"), F.col("line").alias("note"), "reason")
    )


@_query("select p_partkey as id, 'two' || chr(10) || 'lines of ' || p_name as note from part")
def q_land_line_breaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line breaks inside quotes land as values."""
    raw, bronze = scratch_dir(spark, "raw"), scratch_dir(spark, "bronze")
    note = F.concat(F.lit("two\nlines of "), "p_name").alias("note")
    S.write_strings(table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), note), f"{raw}/products.csv")
    contract = TableContract.of("products", "id", "id long; note string")
    S.land_bronze(spark, raw, bronze, ("products",), {"products": contract}, multi_line=True)
    return S.scan_contract(spark, contract, bronze_path(bronze, "products"), multi_line=True)


@_query(_silver_sql("products"))
def q_register(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A written directory as a table; registering a wrong path after that changes nothing."""
    database, home = f"db_{uuid.uuid4().hex}", scratch_dir(spark, "register")
    S.create_database(spark, database, f"{home}/db")
    S.write_silver(silver_table(dirty(spark, sf_dir, "products"), "products", RUN_DATE), f"{home}/products")
    S.register_table(spark, f"{database}.products", f"{home}/products")
    try:
        S.register_table(spark, f"{database}.products", f"{home}/nowhere")
    except Exception as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
    rows = _as_text(S.read_table(spark, f"{database}.products"))
    S.drop_table(spark, f"{database}.products")
    S.drop_database(spark, database)
    return rows


@_query(_silver_sql("products"))
def q_publish(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Publish silver products, read them back through the catalog, drop table and database."""
    database, home = f"db_{uuid.uuid4().hex}", scratch_dir(spark, "publish")
    S.create_database(spark, database, f"{home}/db")
    silver = silver_table(dirty(spark, sf_dir, "products"), "products", RUN_DATE)
    S.publish_table(silver, f"{database}.products", path=f"{home}/products")
    rows = _as_text(S.read_table(spark, f"{database}.products"))
    S.drop_table(spark, f"{database}.products")
    S.drop_database(spark, database)
    return rows


@_query(
    f"select 'managed' as kept_as, * from ({_silver_sql('products')}) as m"
    f" union all select 'external', * from ({_silver_sql('products')}) as e"
)
def q_publish_retry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Publish silver products twice, managed and external; the second time fails in a task and changes nothing."""
    database, home = f"db_{uuid.uuid4().hex}", scratch_dir(spark, "publish-retry")
    S.create_database(spark, database, f"{home}/db")
    silver = silver_table(dirty(spark, sf_dir, "products"), "products", RUN_DATE)
    failing = silver.withColumns({"name": F.raise_error(F.lit("lost on purpose")).cast("string")})
    kept = None
    for name, path in (("managed", None), ("external", f"{home}/external")):
        S.publish_table(silver, f"{database}.{name}", path=path)
        try:
            S.publish_table(failing, f"{database}.{name}", path=path)
        except Exception as error:
            if "lost on purpose" not in str(error):
                raise
        else:
            raise AssertionError("the second publish should have failed")
        # Published once more under another name: the rows outlive the database, which is dropped below.
        S.write_silver(S.read_table(spark, f"{database}.{name}"), f"{home}/{name}-read")
        rows = _as_text(spark.read.parquet(f"{home}/{name}-read")).select(F.lit(name).alias("kept_as"), "*")
        kept = rows if kept is None else kept.unionByName(rows)
    S.drop_database(spark, database, cascade=True)
    return kept


@_query(
    _with_dirty(
        "users",
        "select country, count(*) as users, min(age) as youngest from dirty where age >= 18 group by country",
    )
)
def q_sql_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Create a table, insert rows, query it with SQL in a default database, drop both and keep the files."""
    database, home = f"db_{uuid.uuid4().hex}", scratch_dir(spark, "sql")
    S.create_database(spark, database, f"{home}/db")
    users = dirty(spark, sf_dir, "users")
    S.create_table(spark, f"{database}.users", users.schema, path=f"{home}/users")
    S.insert_rows(users, f"{database}.users")
    rows = S.sql_query(
        spark,
        "select country, count(*) as users, min(age) as youngest from users where age >= :adult group by country",
        database,
        {"adult": 18},
    )
    S.drop_table(spark, f"{database}.users")
    S.drop_database(spark, database)
    return rows


# ---- the bronze gate -------------------------------------------------------------------------------


def _gate_contracts() -> dict[str, TableContract]:
    """The stand-ins' contracts, with users declared one column wider than its file."""
    users = STANDIN_CONTRACTS["users"]
    wider = StructType([*users.schema.fields, StructField("gender", StringType())])
    return {**STANDIN_CONTRACTS, "users": TableContract("users", wider, users.key)}


def _gate_row_sql(name: str, source: str, width_ok: bool) -> str:
    keyed = " and ".join(f"{k} is not null" for k in STANDIN_CONTRACTS[name].key)
    nulls = f"count(*) filter (where not ({keyed}))"
    return (
        f"select '{name}' as \"table\", true as file_exists, {width_ok} as column_count_ok, {nulls} as pk_null_count,"
        f" count(*) as row_count, {width_ok} and {nulls} = 0 as passed, 0 as malformed_rows,"
        f" cast(null as varchar) as error from {source}"
    )


_GATE_MISSING_SQL = "select 'inventory_items', false, false, -1, 0, false, 0, 'PATH_NOT_FOUND'"
_DIRTY_NAMES = ("distribution_centers", "products", "orders", "users")


@_query(
    "\nunion all ".join(
        [_gate_row_sql(n, f"({DIRTY_SQL[n]}) as d_{n}", n != "users") for n in _DIRTY_NAMES]
        + [_gate_row_sql("order_items", "lineitem", True), _GATE_MISSING_SQL]
    )
)
def q_validate_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four dirty tables, one of them too narrow, one clean table and one that is missing."""
    return validate_all(spark, _gate_bronze(spark, sf_dir), GATE_TABLES, _gate_contracts())


def _gate_bronze(spark: SparkSession, sf_dir: str) -> str:
    bronze = scratch_dir(spark, "bronze")
    for name in _DIRTY_NAMES:
        S.write_strings(dirty(spark, sf_dir, name), bronze_path(bronze, name))
    S.write_strings(table(spark, sf_dir, "lineitem"), bronze_path(bronze, "order_items"))
    return bronze


@_query(_ORACLES["q_validate_all"])
def q_gate_failure(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The gate raises once all tables have been checked; the exception has the report."""
    try:
        run_gate(spark, _gate_bronze(spark, sf_dir), GATE_TABLES, _gate_contracts())
    except GateFailure as failure:
        return failure.report
    raise AssertionError("the gate should have failed")


@_query(_gate_row_sql("order_items", "lineitem", True))
def q_validate_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "csv")
    S.write_strings(table(spark, sf_dir, "lineitem"), path)
    return validate_table(spark, STANDIN_CONTRACTS["order_items"], path)


@_query(
    "select l_linenumber % 3 as part, count(*) as row_count, count(*) filter (where l_linenumber % 3 = 1 and l_partkey % 20 = 0)"
    " as short_rows, count(*) filter (where l_linenumber % 3 = 1 and l_partkey % 20 = 1) as long_rows, 0 as unreadable_rows,"
    " count(*) filter (where l_linenumber % 3 = 1 and l_partkey % 20 = 2) as null_key_rows, l_linenumber % 3 <> 1 as passed"
    " from lineitem group by l_linenumber % 3"
)
def q_gate_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table of three directories of files, one of them with rows that are too short, too long or without a key."""
    home = scratch_dir(spark, "gate-files")
    for part in (0, 1, 2):
        rows = table(spark, sf_dir, "lineitem").filter(F.col("l_linenumber") % 3 == part)
        bad = """case when l_partkey % 20 = 0 then '' || l_orderkey when l_partkey % 20 = 1 then l_orderkey || ',1,"2,3",4'
                 when l_partkey % 20 = 2 then ',' || l_partkey else l_orderkey || ',' || l_partkey end"""
        _raw_lines(rows, bad if part == 1 else "l_orderkey || ',' || l_partkey", "id,note", f"{home}/orders.csv/part={part}")
    contract = TableContract.of("orders", "id", "id long; note string")
    counts = [c for c in file_findings(spark, contract, f"{home}/orders.csv/part=*").columns if c.endswith(("_rows", "_count"))]
    found = file_findings(spark, contract, f"{home}/orders.csv/part=*")
    part = F.regexp_extract("file", "part=([0-9])/", 1).cast("long").alias("part")
    return found.groupBy(part).agg(*[F.sum(c).alias(c) for c in counts], F.bool_and("passed").alias("passed"))


# ---- profiles --------------------------------------------------------------------------------------


def _present(spec: ProfileSpec, columns: list[str]) -> ProfileSpec:
    """The bundled profile without the columns that the stand-in does not have."""
    return ProfileSpec(
        spec.key,
        tuple(c for c in spec.padded if c in columns),
        tuple(c for c in spec.lower if c in columns),
        tuple(c for c in spec.groups if c in columns),
        tuple(c for c in spec.extremes if c in columns),
        spec.bad,
    )


def _profile_sql(columns: list[str], spec: ProfileSpec, source: str = "dirty") -> str:
    bad = {
        "cost": "cost <= 0 or cost is null",
        "retail_price": "retail_price < cost or retail_price is null or retail_price < 0",
    }

    def row(c: str) -> str:
        def count(condition: str, wanted: bool) -> str:
            return f"count(*) filter (where {condition})" if wanted else "cast(null as bigint)"

        grouped = c in spec.groups or c == ",".join(spec.key)
        is_null = " or ".join(f"{part} is null" for part in c.split(","))
        values = f"(select {c}, count(*) as n from {source} group by {c}) as grouped"
        distinct = f"(select count(*) from {values})" if grouped else "cast(null as bigint)"
        repeated = f"(select count(*) from {values} where n > 1)" if grouped else "cast(null as bigint)"
        low, high = (f"cast({f}({c}) as varchar)" for f in ("min", "max"))
        if c not in spec.extremes:
            low = high = "cast(null as varchar)"
        return (
            f"select '{c}' as column_name, count(*) as row_count, {count(is_null, True)} as null_count,"
            f" {count(f'''{c} <> trim({c}, ' ')''', c in spec.padded)} as padded_count,"
            f" {count(f'{c} <> lower({c})', c in spec.lower)} as not_lower_count,"
            f" {count(bad.get(c, 'true'), c in spec.bad)} as bad_count,"
            f" {distinct} as distinct_count, {repeated} as duplicated_values,"
            f" {low} as min_value, {high} as max_value from {source}"
        )

    composite = [",".join(spec.key)] if len(spec.key) > 1 else []
    return "\nunion all ".join(row(c) for c in [*columns, *composite])


def _dirty_profile_sql(name: str) -> str:
    columns = STANDIN_CONTRACTS[name].columns
    return _with_dirty(name, _profile_sql(columns, _present(PROFILES[name], columns)))


def _profile(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    df = dirty(spark, sf_dir, name)
    return profile_table(df, _present(PROFILES[name], df.columns))


@_query(_dirty_profile_sql("products"))
def q_profile_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _profile(spark, sf_dir, "products")


@_query(_dirty_profile_sql("users"))
def q_profile_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _profile(spark, sf_dir, "users")


@_query(_dirty_profile_sql("orders"))
def q_profile_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _profile(spark, sf_dir, "orders")


@_query(_dirty_profile_sql("distribution_centers"))
def q_profile_dcs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _profile(spark, sf_dir, "distribution_centers")


_LINE_PROFILE = ProfileSpec(
    key=("l_orderkey", "l_linenumber"),
    padded=("l_returnflag", "l_linestatus"),
    lower=("l_returnflag",),
    groups=("l_orderkey", "l_partkey", "l_returnflag", "l_linestatus"),
    extremes=("l_linenumber",),
)


@_query(_profile_sql(STANDIN_CONTRACTS["order_items"].columns, _LINE_PROFILE, "lineitem"))
def q_profile_order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A key of two columns has a row of its own."""
    return profile_table(table(spark, sf_dir, "lineitem"), _LINE_PROFILE)


@_query(_dirty_profile_sql("users"))
def q_profile_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users in three loads, the second of which comes again: the merged profile is that of all rows."""
    database, home = f"db_{uuid.uuid4().hex}", scratch_dir(spark, "profile-state")
    S.create_database(spark, database, f"{home}/db")
    rows, state = dirty(spark, sf_dir, "users"), f"{database}.users"
    spec, part = _present(PROFILES["users"], rows.columns), F.pmod(F.xxhash64(*rows.columns), F.lit(3))
    for load in (0, 1, 1, 2):
        add_load(rows.filter(part == load), spec, state, f"load-{load}", buckets=8)
    types = {c: rows.schema[c].dataType for c in spec.extremes}
    profile_of_state(spark, state, spec, types).write.parquet(f"{home}/profile")
    S.drop_database(spark, database, cascade=True)
    return spark.read.parquet(f"{home}/profile")


# ---- row filters and projections -------------------------------------------------------------------


@_query(_with_dirty("products", "select name from dirty"))
def q_select_cols(spark: SparkSession, sf_dir: str) -> DataFrame:
    return O.select_cols(dirty(spark, sf_dir, "products"), "name")


@_query(_with_dirty("products", "select * from dirty where id is not null"))
def q_drop_null_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return O.drop_null_key(dirty(spark, sf_dir, "products"), ["id"])


@_query(
    _with_dirty(
        "distribution_centers",
        "select * from dirty where latitude between -90 and 90 and longitude between -180 and 180",
    )
)
def q_geo_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return O.geo_range(dirty(spark, sf_dir, "distribution_centers"))


@_query(_with_dirty("users", "select * from dirty where email is null"))
def q_null_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return O.null_rows(dirty(spark, sf_dir, "users"), "email")


@_query(_with_dirty("products", "select * from dirty where name <> trim(name, ' ')"))
def q_padded_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return O.padded_rows(dirty(spark, sf_dir, "products"), "name")


@_query(_with_dirty("users", "select * from dirty where email <> lower(email)"))
def q_not_lower(spark: SparkSession, sf_dir: str) -> DataFrame:
    return O.not_lower_rows(dirty(spark, sf_dir, "users"), "email")


@_query(_with_dirty("products", "select * from dirty where cost <= 0 or cost is null"))
def q_bad_cost(spark: SparkSession, sf_dir: str) -> DataFrame:
    return O.bad_cost_rows(dirty(spark, sf_dir, "products"))


@_query(
    _with_dirty("products", "select * from dirty where retail_price < cost or retail_price is null or retail_price < 0")
)
def q_bad_price(spark: SparkSession, sf_dir: str) -> DataFrame:
    return O.bad_price_rows(dirty(spark, sf_dir, "products"))


@_query(_with_dirty("products", "select * from dirty where department = 'Men'"))
def q_equals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return O.equals_literal(dirty(spark, sf_dir, "products"), "department", "Men")


@_query(_with_dirty("users", "select * from dirty where city <> trim(email, ' ')"))
def q_cross_neq(spark: SparkSession, sf_dir: str) -> DataFrame:
    return O.cross_column_neq(dirty(spark, sf_dir, "users"), "city", "email")


@_query(
    _with_dirty(
        "users",
        "select id, trim(first_name, ' ') as first_name, last_name, lower(trim(email, ' ')) as email, age, city,"
        f" country, '{RUN_DATE}' as ingestion_date from dirty",
    )
)
def q_with_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two columns replaced in place, one appended."""
    users = O.with_column(dirty(spark, sf_dir, "users"), "first_name", X.trimmed("first_name"))
    users = O.with_column(users, "email", X.lower_trimmed("email"))
    return _as_text(O.with_column(users, "ingestion_date", X.load_date(RUN_DATE)))


# ---- counts and groups -----------------------------------------------------------------------------


@_query(
    _with_dirty(
        "products",
        f"select * exclude (rn) from {_one_per_key(STANDIN_CONTRACTS['products'].columns, ('id',))} as kept",
    )
)
def q_dedup_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per key, the rows without a key being one group."""
    return O.dedup_by_key(dirty(spark, sf_dir, "products"), ["id"])


@_query(_with_dirty("products", "select count(*) as row_count from dirty"))
def q_row_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return O.row_count(dirty(spark, sf_dir, "products"))


@_query(_with_dirty("products", 'select brand, count(*) as "count" from dirty group by brand'))
def q_group_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return O.group_count(dirty(spark, sf_dir, "products"), "brand")


@_query(_with_dirty("products", 'select id, count(*) as "count" from dirty group by id having count(*) > 1'))
def q_duplicate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return O.duplicate_keys(dirty(spark, sf_dir, "products"), "id")


@_query(
    "select count(*) as duplicate_key_count from"
    " (select l_orderkey, l_linenumber from lineitem group by l_orderkey, l_linenumber having count(*) > 1) as repeated"
)
def q_duplicate_key_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return O.duplicate_key_count(table(spark, sf_dir, "lineitem"), "l_orderkey", "l_linenumber")


@_query(_with_dirty("users", "select distinct city from dirty"))
def q_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return O.distinct_values(dirty(spark, sf_dir, "users"), "city")


@_query(_with_dirty("products", "select count(*) as distinct_count from (select distinct name from dirty) as names"))
def q_distinct_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return O.distinct_count(dirty(spark, sf_dir, "products"), "name")


@_query(_with_dirty("users", 'select min(age) as "min", max(age) as "max" from dirty'))
def q_min_max(spark: SparkSession, sf_dir: str) -> DataFrame:
    return O.min_max(dirty(spark, sf_dir, "users"), "age")


@_query(
    _with_dirty(
        "products",
        'select distribution_center_id, count(*) as "count" from dirty group by distribution_center_id'
        " order by distribution_center_id asc nulls first",
    )
)
def q_ordered_group_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return O.ordered_group_count(dirty(spark, sf_dir, "products"), "distribution_center_id")


_LINE_ORDER = [
    "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
    "l_returnflag", "l_linestatus", "l_shipdate",
]


@_query(f"select * from lineitem order by {', '.join(c + ' asc nulls first' for c in _LINE_ORDER)} limit 10")
def q_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first ten line items of the whole table in a total order."""
    return O.limit_rows(table(spark, sf_dir, "lineitem"), 10, _LINE_ORDER)


@_query(
    "select 'lineitem' as \"table\", count(*) = 0 as is_empty from lineitem"
    " union all select 'orders without a key', count(*) = 0 from orders where o_orderkey is null"
)
def q_is_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    unkeyed = O.null_rows(table(spark, sf_dir, "orders"), "o_orderkey")
    rows = [
        ("lineitem", O.is_empty(table(spark, sf_dir, "lineitem"))),
        ("orders without a key", O.is_empty(unkeyed)),
    ]
    return spark.createDataFrame(rows, "table string, is_empty boolean")


# ---- the event stream ------------------------------------------------------------------------------


@_query(f"select event_id, ts, user_id, event_type, value, props, '{RUN_DATE}' as ingestion_date from events")
def q_events_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every third event is delivered twice; each event is in the sink once."""
    own = stream_session(spark, state_partitions=spark.sparkContext.defaultParallelism)
    source = _event_source(own, spark, sf_dir)
    feed = source.unionAll(source.filter(F.col("event_id") % 3 == 0))
    home = scratch_dir(spark, "events")
    silver = events_silver_stream(feed, ["event_id"], "ts", "31 days", run_date=RUN_DATE)
    start_events_sink(silver, f"{home}/sink", f"{home}/checkpoint").awaitTermination()
    return _as_text(_zoneless(spark.read.parquet(f"{home}/sink")))


def _event_source(own: SparkSession, spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table as a stream of files. As a glob, it may be one file as well as a directory of parts."""
    reader = own.readStream.schema(table(spark, sf_dir, "events").schema).option("maxFilesPerTrigger", 100)
    return reader.parquet(f"{sf_dir}/events[.]parquet")


def _zoneless(sink: DataFrame) -> DataFrame:
    return sink.withColumns({"ts": F.col("ts").cast("timestamp_ntz")})


@_query(
    "select event_id, ts, 'silver' as kept_in from events where event_id % 7 <> 0"
    " union all select event_id, null, 'untimed' from events where event_id % 7 = 0"
    " union all select event_id, null, 'untimed' from events where event_id % 7 = 0"
)
def q_events_null_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event is delivered twice, every seventh without its time: those are kept apart, the others once."""
    own, home = stream_session(spark), scratch_dir(spark, "events")
    source = _event_source(own, spark, sf_dir)
    source = source.withColumns({"ts": F.when(F.col("event_id") % 7 != 0, F.col("ts"))})
    feed = source.unionAll(source)
    silver = events_silver_stream(feed, ["event_id"], "ts", "31 days")
    start_events_sink(silver, f"{home}/sink", f"{home}/checkpoint").awaitTermination()
    start_events_sink(untimed_events(feed, "ts"), f"{home}/apart", f"{home}/apart-checkpoint").awaitTermination()
    kept = _zoneless(spark.read.parquet(f"{home}/sink")).select("event_id", "ts", F.lit("silver").alias("kept_in"))
    apart = spark.read.parquet(f"{home}/apart").select("event_id", "ts", F.lit("untimed").alias("kept_in"))
    return kept.unionByName(apart)


@_query(
    "select (select count(*) from events) as silver_rows,"
    " (select count(*) from events where ts < (select max(ts) - interval '1' day from events)) as late_rows"
)
def q_late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events, then in a second run all of them again under new keys: those a day behind are late, and counted."""
    home = scratch_dir(spark, "late")
    events = table(spark, sf_dir, "events")
    events.write.parquet(f"{home}/feed/day=1")
    late, sink, own = 0, f"{home}/sink", stream_session(spark)
    for run in (1, 2):
        if run == 2:
            again = events.filter(F.col("ts") < events.agg(F.max("ts") - F.expr("interval 1 day")).first()[0])
            again.withColumns({"event_id": -F.col("event_id") - 1}).write.parquet(f"{home}/feed/day=2")
        source = own.readStream.schema(events.schema).parquet(f"{home}/feed")
        silver = events_silver_stream(source, ["event_id"], "ts", "1 day")
        query = start_events_sink(silver, sink, f"{home}/checkpoint")
        late = await_sink(query, f"{home}/late_rows")
    counted = spark.read.parquet(sink).agg(F.count(F.lit(1)).alias("silver_rows"))
    return counted.select("silver_rows", F.lit(late).cast("long").alias("late_rows"))


@_query(
    "with fed as (select event_id, ts from events union all select -event_id - 1, ts from events),"
    " kept as (select event_id, case when event_id % 11 <> 0 then ts end as ts, case when event_id % 11 = 0 then 'untimed'"
    " when event_id < 0 and ts <= date_trunc('milliseconds', (select max(ts) from events where event_id % 11 <> 0)) - interval '1' day"
    " then 'late' else 'silver' end as kept_in from fed)"
    " select * from kept union all select * from kept where kept_in = 'untimed'"
)
def q_late_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events, every fifth again in a second run, and in a third all of them under new keys; every eleventh comes
    without its time, and twice. Silver, late and untimed rows are all there is, from one read of each delivery."""
    home, own = scratch_dir(spark, "arrivals"), stream_session(spark)
    ts = F.when(F.col("event_id") % 11 != 0, F.col("ts"))
    events, kept = table(spark, sf_dir, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts")), None
    for run in (1, 2, 3):
        keys = F.col("event_id") if run < 3 else -F.col("event_id") - 1
        fed = events.select(keys.alias("event_id"), "ts").withColumns({"ts": ts})
        feed = fed.filter("event_id % 5 = 0 and ts is not null") if run == 2 else fed.unionAll(fed.filter("ts is null"))
        feed.write.parquet(f"{home}/feed/day={run}")
        source = own.readStream.schema(fed.schema).parquet(f"{home}/feed")
        start_arrivals(source.drop("day"), "ts", "1 day", f"{home}/arrivals", f"{home}/cp/arrivals").awaitTermination()
        silver = arrivals_silver_stream(own, f"{home}/arrivals", fed.schema, ["event_id"], "1 day")
        start_events_sink(silver, f"{home}/silver", f"{home}/cp/silver").awaitTermination()
    for kind in ("silver", "late", "untimed"):
        rows = spark.read.parquet(f"{home}/silver") if kind == "silver" else scan_arrivals(spark, f"{home}/arrivals", kind, fed.schema)
        rows = _zoneless(rows).select("event_id", "ts", F.lit(kind).alias("kept_in"))
        kept = rows if kept is None else kept.unionByName(rows)
    return kept


_EVENTS_CSV = TableContract.of("events", "event_id", "event_id long; ts timestamp; user_id long; event_type string; value double")


@_query("select event_id, ts, user_id, event_type, value from events")
def q_csv_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as CSV files, streamed by contract in batches of two files; each comes twice."""
    home, own = scratch_dir(spark, "csv-stream"), stream_session(spark)
    events = table(spark, sf_dir, "events").select(*_EVENTS_CSV.columns).repartition(6, "event_id")
    for copy in ("a", "b"):
        S.write_strings(events, f"{home}/feed/copy={copy}")
    source = scan_stream(own, _EVENTS_CSV, f"{home}/feed/*", max_files_per_trigger=2)
    silver = events_silver_stream(source, ["event_id"], "ts", "31 days")
    start_events_sink(silver, f"{home}/sink", f"{home}/checkpoint").awaitTermination()
    return _zoneless(spark.read.parquet(f"{home}/sink")).select(*_EVENTS_CSV.columns)


# ---- driver contract -------------------------------------------------------------------------------


def entry(spark: SparkSession) -> DataFrame:
    """Flagship query: dirty products conformed to silver, at sf0.001."""
    return q_silver_products(spark, "/root/testdata/sf0.001")


def _text_queries() -> tuple[dict[str, Query], dict[str, str]]:
    """The queries of the text subpackage and of its pipeline, where they are installed."""
    try:
        from siltworks.llm.queries import ORACLES, QUERIES
    except ModuleNotFoundError as missing:
        if missing.name not in ("siltworks.llm", "siltworks.llm.queries"):
            raise
        return {}, {}
    queries, oracles = dict(QUERIES), dict(ORACLES)
    try:
        import corpus_pipeline
    except ModuleNotFoundError as missing:
        if missing.name != "corpus_pipeline":
            raise
        return queries, oracles
    queries["pipeline"] = corpus_pipeline.run
    if corpus_pipeline.ORACLE_SQL:
        oracles["pipeline"] = corpus_pipeline.ORACLE_SQL
    return queries, oracles


def queries() -> dict[str, Query]:
    return _QUERIES | _text_queries()[0]


def oracle_sql() -> dict[str, str]:
    return _ORACLES | _text_queries()[1]
