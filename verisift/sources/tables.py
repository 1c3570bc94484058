"""Table scans.

Checks receive a ``{name: DataFrame}`` mapping, so any source Spark can read
works: parquet paths, catalog tables, or derived DataFrames. Nothing is read
here — the scans are lazy and column pruning / filter push-down happen when a
check's plan is optimised.
"""

from __future__ import annotations

import os
from typing import Dict, Iterable, Mapping, Optional

from pyspark.sql import DataFrame, SparkSession


def load_tables(
    spark: SparkSession,
    base_dir: str,
    names: Iterable[str],
    fmt: str = "parquet",
    options: Optional[Mapping[str, str]] = None,
) -> Dict[str, DataFrame]:
    """Lazily open ``{base_dir}/{name}.{fmt}`` (file or directory) for every name."""
    reader = spark.read.options(**(options or {}))
    out: Dict[str, DataFrame] = {}
    for name in names:
        path = os.path.join(base_dir, f"{name}.{fmt}")
        out[name] = reader.format(fmt).load(path)
    return out


def load_catalog_tables(
    spark: SparkSession, names: Iterable[str], database: Optional[str] = None
) -> Dict[str, DataFrame]:
    """Catalog tables (``spark.table``), keyed by their unqualified name."""
    out: Dict[str, DataFrame] = {}
    for name in names:
        qualified = f"{database}.{name}" if database else name
        out[name] = spark.table(qualified)
    return out


def discover_tables(spark: SparkSession, databases: Iterable[str]) -> Dict[str, DataFrame]:
    """Every base table of the given databases, by its name; views are left out.

    A name that two databases share is refused: rules name tables only.
    """
    out: Dict[str, DataFrame] = {}
    for database in databases:
        for t in spark.catalog.listTables(database):
            if t.isTemporary or t.tableType in ("VIEW", "TEMPORARY"):
                continue
            if t.name in out:
                raise ValueError(f"table {t.name} is in more than one of the databases")
            out[t.name] = spark.table(f"`{database}`.`{t.name}`")
    return out


def register_views(tables: Mapping[str, DataFrame]) -> None:
    """Expose the mapping as temp views so SQL checks (Q3) can name the tables."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
