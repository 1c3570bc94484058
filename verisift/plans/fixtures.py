"""Derived tables that give the defect-free driver tables something to find.

The driver tables hold no NULLs and every natural key joins, so the checks are
exercised on views derived from them by deterministic expressions. The same
definitions exist as DuckDB SQL (``VIEW_SQL``) for the oracle. Every view keeps
all rows of its source; the modulo terms only decide which rows carry a defect
(``region_empty`` is the one deliberately empty table).
"""

from __future__ import annotations

from typing import Dict

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import load_tables

DRIVER_TABLES = (
    "region",
    "nation",
    "customer",
    "supplier",
    "part",
    "orders",
    "lineitem",
    "events",
    "documents",
    "embeddings",
    "pages",
    "benchmark",
    "labels",
    "conversations",
)

# DuckDB text of the derived views (fixed fixture definitions).
VIEW_SQL = {
    "pat": """
select o_orderkey as id,
  case when o_orderkey % 31 = 0 then null else o_orderstatus = 'P' end as is_dummy,
  case when o_orderkey % 11 = 0 then null when o_orderkey % 13 = 0 then ''
       when o_orderkey % 17 = 0 then 'abc' when o_orderkey % 19 = 0 then '1850'
       else cast(year(o_orderdate) as varchar) end as birth_year,
  case when o_orderkey % 23 = 0 then '1990' when o_orderkey % 29 = 0 then null
       when o_orderkey % 5 = 0 then '1998' else '2010' end as death_year,
  case when o_orderkey % 9 = 0 then null when o_orderkey % 10 = 0 then o_custkey + 1000000
       else o_custkey end as practice_id,
  cast(null as varchar) as fax
from orders""",
    "cmap": """
select case when s_suppkey % 10 = 0 then -1 - s_suppkey else s_suppkey end as source_code_id,
  case when s_suppkey % 7 = 0 then s_nationkey + 100 else s_nationkey end as target_code_id
from supplier
union all
select case when s_suppkey % 4 = 1 then s_suppkey else -1 - s_suppkey end as source_code_id,
  s_nationkey as target_code_id
from supplier""",
    "con": """
select n_nationkey as id, case when n_nationkey % 5 = 0 then null else n_name end as display,
  case when n_nationkey % 6 = 0 then null else n_name end as code from nation""",
    "region_empty": "select * from region where r_regionkey < 0",
}


def with_ctes(sql: str, views=("pat", "cmap", "con", "region_empty")) -> str:
    """Prefix a DuckDB query with the derived views it may reference."""
    ctes = ",\n".join(f"{v} as ({VIEW_SQL[v]})" for v in views)
    return f"with {ctes}\n{sql}"


def pat(orders: DataFrame) -> DataFrame:
    k = F.col("o_orderkey")
    birth = (
        F.when(k % 11 == 0, F.lit(None).cast("string"))
        .when(k % 13 == 0, F.lit(""))
        .when(k % 17 == 0, F.lit("abc"))
        .when(k % 19 == 0, F.lit("1850"))
        .otherwise(F.year("o_orderdate").cast("string"))
    )
    death = (
        F.when(k % 23 == 0, F.lit("1990"))
        .when(k % 29 == 0, F.lit(None).cast("string"))
        .when(k % 5 == 0, F.lit("1998"))
        .otherwise(F.lit("2010"))
    )
    practice = (
        F.when(k % 9 == 0, F.lit(None).cast("bigint"))
        .when(k % 10 == 0, F.col("o_custkey") + 1000000)
        .otherwise(F.col("o_custkey"))
    )
    return orders.select(
        k.alias("id"),
        F.when(k % 31 == 0, F.lit(None).cast("boolean"))
        .otherwise(F.col("o_orderstatus") == "P")
        .alias("is_dummy"),
        birth.alias("birth_year"),
        death.alias("death_year"),
        practice.alias("practice_id"),
        F.lit(None).cast("string").alias("fax"),
    )


def cmap(supplier: DataFrame) -> DataFrame:
    """Concept map with gaps, dangling targets and duplicate sources.

    Every supplier row is kept in both halves; a row that should carry no
    mapping gets the source code ``-1 - key``, negative for the non-negative
    keys of the driver tables, so no source column contains it.
    """
    s = F.col("s_suppkey")
    first = supplier.select(
        F.when(s % 10 == 0, F.lit(-1) - s).otherwise(s).alias("source_code_id"),
        F.when(s % 7 == 0, F.col("s_nationkey") + 100)
        .otherwise(F.col("s_nationkey"))
        .alias("target_code_id"),
    )
    dup = supplier.select(
        F.when(s % 4 == 1, s).otherwise(F.lit(-1) - s).alias("source_code_id"),
        F.col("s_nationkey").alias("target_code_id"),
    )
    return first.unionByName(dup)


def con(nation: DataFrame) -> DataFrame:
    k = F.col("n_nationkey")
    return nation.select(
        k.alias("id"),
        F.when(k % 5 == 0, F.lit(None).cast("string")).otherwise(F.col("n_name")).alias("display"),
        F.when(k % 6 == 0, F.lit(None).cast("string")).otherwise(F.col("n_name")).alias("code"),
    )


def fixture_tables(spark: SparkSession, sf_dir: str) -> Dict[str, DataFrame]:
    """Driver tables plus the derived ``pat``, ``cmap``, ``con``, ``region_empty``."""
    t = load_tables(spark, sf_dir, DRIVER_TABLES)
    t["pat"] = pat(t["orders"])
    t["cmap"] = cmap(t["supplier"])
    t["con"] = con(t["nation"])
    t["region_empty"] = t["region"].where(F.col("r_regionkey") < 0)
    # Same data under a backup-style name: the empty-table check must skip it.
    t["orders_BACKUP"] = t["orders"]
    return t


# Columns of the driver tables (fixed values; a test holds them against the files).
DRIVER_COLUMNS = {
    "region": "r_regionkey r_name".split(),
    "nation": "n_nationkey n_name n_regionkey".split(),
    "customer": "c_custkey c_name c_nationkey c_acctbal c_mktsegment".split(),
    "supplier": "s_suppkey s_name s_nationkey s_acctbal".split(),
    "part": "p_partkey p_name p_brand p_type p_size p_retailprice".split(),
    "orders": "o_orderkey o_custkey o_orderstatus o_totalprice o_orderdate o_orderpriority".split(),
    "lineitem": "l_orderkey l_partkey l_suppkey l_linenumber l_quantity l_extendedprice l_discount l_tax l_returnflag l_linestatus l_shipdate".split(),
    "events": "event_id ts user_id event_type value props".split(),
    "documents": "doc_id text lang source n_chars".split(),
    "embeddings": "vec_id embedding label".split(),
    "pages": "page_id url html".split(),
    "benchmark": "item_id text".split(),
    "labels": "doc_id quality toxic".split(),
    "conversations": "conv_id turn role text".split(),
}
