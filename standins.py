"""Dirty retail tables derived from the driver's parquet tables, for the registry, the tests and the bench.

The driver's tables are clean, so cleaning them would do nothing. These derive padding, NULLs, mixed case,
bad numbers and repeated keys from the row keys. The SQL text is the same for Spark and for the oracle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from siltworks.contracts import TableContract

DIRTY_SQL: dict[str, str] = {
    "products": """
select case when p_partkey % 97 = 0 then null else p_partkey end as id,
       case when p_partkey % 13 = 0 then cast(-1.0 as double) when p_partkey % 17 = 0 then null else p_retailprice * cast(0.6 as double) end as cost,
       case when p_partkey % 23 = 0 then ' ' || p_type else p_type end as category,
       case when p_partkey % 7 = 0 then '  ' || p_name || ' ' when p_partkey % 11 = 0 then null else p_name end as name,
       case when p_partkey % 29 = 0 then p_brand || '  ' else p_brand end as brand,
       case when p_partkey % 19 = 0 then p_retailprice * cast(0.5 as double) when p_partkey % 31 = 0 then null else p_retailprice end as retail_price,
       case when p_size % 2 = 0 then ' Women' else 'Men ' end as department,
       p_partkey % 10 as distribution_center_id
from part
union all
select p_partkey, p_retailprice, p_type, p_name || '!', p_brand, p_retailprice, 'Men', p_partkey % 10
from part where p_partkey % 5 = 0
""",
    "users": """
select case when c_custkey % 89 = 0 then null else c_custkey end as id,
       case when c_custkey % 7 = 0 then ' ' || c_name else c_name end as first_name,
       case when c_custkey % 11 = 0 then null else c_mktsegment || ' ' end as last_name,
       case when c_custkey % 3 = 0 then '  U' || cast(c_custkey as string) || '@Example.COM ' when c_custkey % 5 = 0 then null else 'u' || cast(c_custkey as string) || '@example.com' end as email,
       case when c_custkey % 41 = 0 then null else c_custkey % 80 end as age,
       case when c_nationkey % 2 = 0 then ' City' || cast(c_nationkey as string) else 'City' || cast(c_nationkey as string) end as city,
       case when c_nationkey % 3 = 0 then 'Country ' else 'Country' end as country
from customer
union all
select c_custkey, c_name, c_mktsegment, 'dup@example.com', c_custkey % 80, 'City', 'Country'
from customer where c_custkey % 4 = 0
""",
    "orders": """
select case when o_orderkey % 101 = 0 then null else o_orderkey end as order_id,
       o_custkey as user_id,
       case when o_orderkey % 6 = 0 then ' ' || o_orderstatus || ' ' when o_orderkey % 43 = 0 then null else o_orderstatus end as status,
       case when o_custkey % 2 = 0 then 'F ' else ' M' end as gender,
       o_orderdate as created_at,
       case when o_orderstatus = 'P' then null else o_orderdate + interval '2' day end as shipped_at,
       case when o_orderstatus = 'F' then o_orderdate + interval '5' day else null end as delivered_at,
       case when o_orderkey % 9 = 0 then o_orderdate + interval '9' day else null end as returned_at
from orders
union all
select o_orderkey, o_custkey, 'O', 'F', o_orderdate, null, null, null
from orders where o_orderkey % 8 = 0
""",
    "distribution_centers": """
select case when s_suppkey % 47 = 0 then null else s_suppkey end as id,
       case when s_suppkey % 4 = 0 then ' ' || s_name || ' ' else s_name end as name,
       case when s_suppkey % 37 = 0 then null when s_suppkey % 31 = 0 then cast('NaN' as double) else cast(s_suppkey % 40 as double) * 5 - 95 end as latitude,
       case when s_suppkey % 43 = 0 then null else cast(s_suppkey % 80 as double) * 5 - 190 end as longitude
from supplier
union all
select s_suppkey, s_name || '#2', cast(10 as double), cast(20 as double)
from supplier where s_suppkey % 3 = 0
""",
}

_SOURCE = {"products": "part", "users": "customer", "orders": "orders", "distribution_centers": "supplier"}

# The columns of the dirty tables, with the key types of the tables they derive from.
STANDIN_CONTRACTS: dict[str, TableContract] = {
    c.name: c
    for c in (
        TableContract.of("products", "id", """
            id long required
            cost double
            category string
            name string
            brand string
            retail_price double
            department string
            distribution_center_id long
        """),
        TableContract.of("users", "id", """
            id long required
            first_name string
            last_name string
            email string
            age long
            city string
            country string
        """),
        TableContract.of("orders", "order_id", """
            order_id long required
            user_id long required
            status string
            gender string
            created_at timestamp required
            shipped_at timestamp
            delivered_at timestamp
            returned_at timestamp
        """),
        TableContract.of("distribution_centers", "id", """
            id long required
            name string
            latitude double
            longitude double
        """),
        TableContract.of("order_items", ("l_orderkey", "l_linenumber"), """
            l_orderkey long required
            l_partkey long
            l_suppkey long
            l_linenumber integer required
            l_quantity double
            l_extendedprice double
            l_discount double
            l_tax double
            l_returnflag string
            l_linestatus string
            l_shipdate timestamp
        """),
        TableContract.of("inventory_items", ("l_partkey", "l_suppkey"), """
            l_partkey long required
            l_suppkey long required
            l_quantity double
        """),
    )
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def dirty(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A dirty table of the given scale, as a query over the driver's parquet."""
    source = _SOURCE[name]
    sql = DIRTY_SQL[name].replace(f"from {source}", "from {source}")
    return spark.sql(sql, source=table(spark, sf_dir, source))
