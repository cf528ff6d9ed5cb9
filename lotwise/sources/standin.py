"""Listings made from the TPC-H-like tables.

One listing per order. The text runs unchanged in Spark and in other engines,
so a check query can start from the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

TABLES = ["orders", "customer", "nation", "region"]

LISTINGS_SQL = """
select o_orderkey as id, n_name as region, r_name as state,
  case when o_orderkey % 103 = 0 then 400 when o_orderkey % 107 = 0 then 250000 else
    cast(floor(case when c_mktsegment = 'MACHINERY' then 2000 + o_totalprice / 20
                    else 15000 + o_totalprice / 100 end) as int)
    * (case when o_orderkey % 101 = 0 then 2 else 1 end) end as price,
  case when o_orderkey % 41 = 0 then null when o_orderkey % 43 = 0 then 'abc'
       when o_orderkey % 47 = 0 then '0'
       when o_orderkey % 2 = 0 then cast(year(o_orderdate) + 15 as string) || '.0'
       else cast(year(o_orderdate) + 15 as string) end as year,
  case when o_orderkey % 59 = 0 then null else lower(c_mktsegment) end as manufacturer,
  case when o_orderkey % 997 = 0 then 'Rare-' || cast(o_orderkey as string)
       else lower(o_orderpriority) end as model,
  case when o_orderkey % 17 = 0 then null when o_orderkey % 19 = 0 then 500.0e0
       when o_orderkey % 23 = 0 then 400000.0e0
       else (2025 - (year(o_orderdate) + 15)) * 12000 + floor(o_totalprice / 100) * 1.0e0
       end as odometer,
  case when o_orderkey % 29 = 0 then null when o_orderkey % 31 = 0 then 'short' else
    '1hgcm8263' || substr('abcdefghjklmnprs', year(o_orderdate) - 1995 + 1
                          + (case when o_orderkey % 13 = 0 then 3 else 0 end), 1)
    || lpad(cast(o_orderkey as string), 7, '0') end as vin,
  case when o_orderkey % 11 = 0 then null when o_orderkey % 3 = 0 then 'Clean'
       else 'SALVAGE' end as title_status,
  case when o_orderkey % 37 = 0 then null else 25.0e0 + c_nationkey end as lat,
  c_nationkey * 2.0e0 - 125.0e0 as long,
  o_orderdate as event_time
from {orders} join {customer} on o_custkey = c_custkey
  join {nation} on c_nationkey = n_nationkey join {region} on n_regionkey = r_regionkey
"""


_schemas: dict[str, T.StructType] = {}


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """A parquet table whose schema is looked up once per process."""
    if path not in _schemas:
        _schemas[path] = spark.read.parquet(path).schema
    return spark.read.schema(_schemas[path]).parquet(path)


def standin_listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = {name: read_table(spark, f"{sf_dir}/{name}.parquet") for name in TABLES}
    return spark.sql(LISTINGS_SQL, **tables)
