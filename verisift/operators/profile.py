"""Profile checks P1-P4: single-table scans answered by one aggregate each.

Every table is scanned once per check no matter how many columns or rules it
carries: all counts of a table live in one ``agg`` (map-side partial
aggregation, a single-row result), which is then turned into one row per
column/rule with ``inline``. Tables are stacked with ``unionByName``, so a
whole suite is one Spark job.
"""

from __future__ import annotations

import re
from collections import OrderedDict
from typing import Dict, List, Mapping, Optional, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import qcol
from ..functions.columns import sql_ident, sql_str
from ..functions.frames import literal_frame
from ..contract import SUB_RESULT_SCHEMA, to_contract
from ..rules import CompletenessRule

NULL_COLUMNS_SCHEMA = T.StructType(
    [
        T.StructField("table_name", T.StringType()),
        T.StructField("column_name", T.StringType()),
        T.StructField("total_rows", T.LongType()),
        T.StructField("non_null_count", T.LongType()),
        T.StructField("is_all_null", T.BooleanType()),
    ]
)

EMPTY_TABLES_SCHEMA = T.StructType(
    [
        T.StructField("table_name", T.StringType()),
        T.StructField("row_count", T.LongType()),
        T.StructField("is_empty", T.BooleanType()),
    ]
)

COMPLETENESS_SCHEMA = T.StructType(
    [
        T.StructField("table_column", T.StringType()),
        T.StructField("total_rows", T.LongType()),
        T.StructField("non_null_count", T.LongType()),
        T.StructField("completeness_rate", T.DoubleType()),
        T.StructField("min_required", T.DoubleType()),
        T.StructField("missing_rows", T.LongType()),
        T.StructField("passed", T.BooleanType()),
        T.StructField("status", T.StringType()),
    ]
)


def _spark(tables: Mapping[str, DataFrame]) -> SparkSession:
    return next(iter(tables.values())).sparkSession


def _union(frames: List[DataFrame], empty: DataFrame) -> DataFrame:
    out = empty
    for f in frames:
        out = out.unionByName(f)
    return out


def _empty(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return literal_frame(spark, [], schema)


# --------------------------------------------------------------------------- P1


def _table_null_counts(name: str, df: DataFrame, seq0: int = 0) -> Optional[DataFrame]:
    """One scan of ``df``: ``count(*)`` and ``count(c)`` for every column,
    unpivoted to one row per column (``seq`` numbers columns from ``seq0``)."""
    columns = list(df.columns)
    if not columns:
        return None
    counts = ", ".join(f"count({sql_ident(c)})" for c in columns)
    names = ", ".join(sql_str(c) for c in columns)
    # One array of counts, unpivoted by position: a wide table costs a few calls
    # to build, and a projection of a handful of columns, not of one per column.
    one = df.agg(F.expr("count(1) as __rows"), F.expr(f"array({counts}) as __nn"))
    return one.select("__rows", F.expr("posexplode(__nn) as (__at, non_null_count)"), F.expr(f"array({names}) as __names")).select(
        (F.col("__at") + F.lit(seq0)).alias("seq"),
        F.lit(name).alias("table_name"),
        F.get("__names", F.col("__at")).alias("column_name"),
        F.col("__rows").alias("total_rows"),
        "non_null_count",
    )


def _null_counts(tables: Mapping[str, DataFrame], names: Sequence[str]) -> DataFrame:
    frames, seq0 = [], 0
    for n in names:
        if n not in tables:
            continue
        f = _table_null_counts(n, tables[n], seq0)
        if f is not None:
            frames.append(f)
            seq0 += len(tables[n].columns)
    empty = _empty(
        _spark(tables),
        "seq int, table_name string, column_name string, total_rows bigint, non_null_count bigint",
    )
    return _union(frames, empty)


def null_columns(
    tables: Mapping[str, DataFrame], names: Optional[Sequence[str]] = None
) -> DataFrame:
    """``table_name, column_name, total_rows, non_null_count, is_all_null``.

    A column fails iff it has no non-NULL value in a table that has rows, so an
    empty table never flags its columns.
    """
    names = list(names) if names is not None else list(tables)
    return _null_counts(tables, names).select(
        "table_name",
        "column_name",
        "total_rows",
        "non_null_count",
        ((F.col("non_null_count") == 0) & (F.col("total_rows") > 0)).alias("is_all_null"),
    )


def null_columns_sub_results(
    tables: Mapping[str, DataFrame], names: Optional[Sequence[str]] = None
) -> DataFrame:
    """P1 rows in the suite shape: one rule per column, missing tables as ERROR."""
    names = list(names) if names is not None else list(tables)
    spark = _spark(tables)
    all_null = (F.col("non_null_count") == 0) & (F.col("total_rows") > 0)
    ok = _null_counts(tables, names).select(
        F.lit("null_columns").alias("suite"),
        F.col("seq"),
        F.concat_ws(".", "table_name", "column_name").alias("rule"),
        F.col("total_rows").alias("total_tested"),
        (F.col("total_rows") - F.col("non_null_count")).alias("failed_records"),
        F.when(all_null, F.lit("FAIL")).otherwise(F.lit("PASS")).alias("status"),
        F.lit(None).cast("string").alias("reason"),
    )
    n_cols = sum(len(tables[n].columns) for n in names if n in tables)
    missing = [(i, n) for i, n in enumerate(names) if n not in tables]
    if missing:
        err = literal_frame(
            spark,
            [("null_columns", n_cols + i, n, None, None, "ERROR", f"table {n} not found") for i, n in missing],
            SUB_RESULT_SCHEMA,
        )
        ok = ok.unionByName(err)
    return ok


# --------------------------------------------------------------------------- P2


def like_to_regex(pattern: str) -> str:
    """SQL LIKE pattern -> anchored regex (``%`` any run, ``_`` any one char)."""
    out = []
    for ch in pattern:
        if ch == "%":
            out.append(".*")
        elif ch == "_":
            out.append(".")
        else:
            out.append(re.escape(ch))
    return "^" + "".join(out) + "$"


def table_names_excluding(names: Sequence[str], exclude: Sequence[str]) -> List[str]:
    """Drop names matching any LIKE pattern (``_`` stays a wildcard, as in SQL)."""
    regexes = [re.compile(like_to_regex(p), re.DOTALL) for p in exclude]
    return [n for n in names if not any(r.match(n) for r in regexes)]


def empty_tables(
    tables: Mapping[str, DataFrame],
    names: Optional[Sequence[str]] = None,
    exclude: Sequence[str] = ("%_BACKUP", "%_OLD"),
    *,
    existence_only: bool = False,
) -> DataFrame:
    """``table_name, row_count, is_empty`` for every non-excluded table.

    ``count(1)`` reads no column data from parquet (row counts come from the
    row-group metadata). With ``existence_only`` each table is probed with
    ``limit(1)`` instead: the scan stops at the first row, and ``row_count``
    is NULL (not known) unless the table is empty.
    """
    names = list(names) if names is not None else list(tables)
    names = table_names_excluding([n for n in names if n in tables], exclude)

    def probe(df: DataFrame) -> DataFrame:
        return df.limit(1) if existence_only else df

    frames = [
        probe(tables[n]).agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(n).alias("table_name"),
            (F.when(F.col("row_count") == 0, F.lit(0)).cast("bigint") if existence_only else F.col("row_count")).alias("row_count"),
            (F.col("row_count") == 0).alias("is_empty"),
        )
        for n in names
    ]
    return _union(frames, _empty(_spark(tables), EMPTY_TABLES_SCHEMA))


def empty_tables_sub_results(
    tables: Mapping[str, DataFrame],
    names: Optional[Sequence[str]] = None,
    exclude: Sequence[str] = ("%_BACKUP", "%_OLD"),
) -> DataFrame:
    names = list(names) if names is not None else list(tables)
    spark = _spark(tables)
    res = empty_tables(tables, names, exclude)
    kept = table_names_excluding(names, exclude)
    order = literal_frame(
        spark,
        [(n, i) for i, n in enumerate(kept)], "table_name string, seq int"
    )
    ok = res.join(F.broadcast(order), "table_name").select(
        F.lit("empty_tables").alias("suite"),
        F.col("seq"),
        F.col("table_name").alias("rule"),
        F.col("row_count").alias("total_tested"),
        F.when(F.col("is_empty"), F.lit(1)).otherwise(F.lit(0)).cast("bigint").alias(
            "failed_records"
        ),
        F.when(F.col("is_empty"), F.lit("FAIL")).otherwise(F.lit("PASS")).alias("status"),
        F.lit(None).cast("string").alias("reason"),
    )
    missing = [(i, n) for i, n in enumerate(kept) if n not in tables]
    if missing:
        err = literal_frame(
            spark,
            [("empty_tables", i, n, None, None, "ERROR", f"table {n} not found") for i, n in missing],
            SUB_RESULT_SCHEMA,
        )
        ok = ok.unionByName(err)
    return ok


# --------------------------------------------------------------------------- P3


def column_completeness(
    tables: Mapping[str, DataFrame], rules: Sequence[CompletenessRule], *, with_seq: bool = False
) -> DataFrame:
    """Per rule ``completeness_rate = ROUND(non_null / total * 100, 2)``.

    The rounded rate is compared to ``min_pct`` (so 99.996 % passes a 100 %
    rule). An empty table has no rate: the rule is an ERROR failure, not an
    exception. A missing table or column is an ERROR row too.
    """
    spark = _spark(tables)
    by_table: "OrderedDict[str, List[CompletenessRule]]" = OrderedDict()
    errors = []
    seq_of = {}
    for i, r in enumerate(rules):
        seq_of[id(r)] = i
        if r.table not in tables or r.column not in tables[r.table].columns:
            errors.append(r)
        else:
            by_table.setdefault(r.table, []).append(r)
    frames = []
    for table, trs in by_table.items():
        df = tables[table]
        aggs = [F.count(F.lit(1)).alias("__rows")]
        aggs += [F.count(qcol(r.column)).alias(f"__nn{i}") for i, r in enumerate(trs)]
        rows = F.array(
            *[
                F.struct(
                    F.lit(seq_of[id(r)]).alias("seq"),
                    F.lit(r.label).alias("table_column"),
                    F.col("__rows").alias("total_rows"),
                    F.col(f"__nn{i}").alias("non_null_count"),
                    F.lit(float(r.min_pct)).alias("min_required"),
                )
                for i, r in enumerate(trs)
            ]
        )
        frames.append(df.agg(*aggs).select(F.inline(rows)))
    base = _union(
        frames,
        _empty(
            spark,
            T.StructType(
                [
                    T.StructField("seq", T.IntegerType()),
                    T.StructField("table_column", T.StringType()),
                    T.StructField("total_rows", T.LongType()),
                    T.StructField("non_null_count", T.LongType()),
                    T.StructField("min_required", T.DoubleType()),
                ]
            ),
        ),
    )
    total, nn = F.col("total_rows"), F.col("non_null_count")
    rate = F.when(total > 0, F.round(nn.cast("double") / total * F.lit(100.0), 2))
    out = base.select(
        "seq",
        "table_column",
        "total_rows",
        "non_null_count",
        rate.alias("completeness_rate"),
        "min_required",
        (total - nn).alias("missing_rows"),
    )
    passed = F.coalesce(F.col("completeness_rate") >= F.col("min_required"), F.lit(False))
    out = out.select(
        "*",
        passed.alias("passed"),
        F.when(F.col("completeness_rate").isNull(), F.lit("ERROR"))
        .when(passed, F.lit("PASS"))
        .otherwise(F.lit("FAIL"))
        .alias("status"),
    )
    if errors:
        err = literal_frame(
            spark,
            [(seq_of[id(r)], r.label, None, None, None, float(r.min_pct), None, False, "ERROR") for r in errors],
            T.StructType([T.StructField("seq", T.IntegerType())] + COMPLETENESS_SCHEMA.fields),
        )
        out = out.unionByName(err)
    return out if with_seq else out.drop("seq")


def column_completeness_sub_results(
    tables: Mapping[str, DataFrame], rules: Sequence[CompletenessRule]
) -> DataFrame:
    return (
        column_completeness(tables, rules, with_seq=True)
        .select(
            F.lit("column_completeness").alias("suite"),
            F.col("seq"),
            F.col("table_column").alias("rule"),
            F.col("total_rows").alias("total_tested"),
            F.col("missing_rows").alias("failed_records"),
            F.col("status"),
            _completeness_reason(tables, rules).alias("reason"),
        )
    )


def completeness_reason(tables: Mapping[str, DataFrame], rule: CompletenessRule) -> str:
    """Why a rule that is an ERROR has no rate."""
    if rule.table not in tables:
        return f"table {rule.table} not found"
    if rule.column not in tables[rule.table].columns:
        return f"column {rule.table}.{rule.column} not found"
    return f"table {rule.table} is empty"


def _completeness_reason(tables: Mapping[str, DataFrame], rules: Sequence[CompletenessRule]):
    whys = F.lit(None).cast("string")
    for i, r in enumerate(rules):
        whys = F.when(F.col("seq") == i, F.lit(completeness_reason(tables, r))).otherwise(whys)
    return F.when(F.col("status") == "ERROR", whys)


# --------------------------------------------------------------------------- P4


def completeness_threshold(
    df: DataFrame, column: str, *, name: str, min_pct: float = 95.0, description: str = ""
) -> DataFrame:
    """Grade rows of one column; contract row.

    total = rows, failed = NULL rows, an empty table is 100 % complete, the
    threshold is ``100 - min_pct`` and the rate is not rounded before the test.
    """
    stats = df.agg(
        F.count(F.lit(1)).alias("total_tested"), F.count(qcol(column)).alias("non_null")
    )
    total, nn = F.col("total_tested"), F.col("non_null")
    completeness = F.when(total == 0, F.lit(100.0)).otherwise(
        nn.cast("double") / total * F.lit(100.0)
    )
    stats = stats.select(
        "total_tested",
        (total - nn).alias("failed_records"),
        completeness.alias("completeness_rate"),
    )
    ok = F.col("completeness_rate") >= F.lit(float(min_pct))
    return to_contract(
        stats,
        name=F.lit(name),
        description=F.lit(description),
        status=F.when(ok, F.lit("PASS")).otherwise(F.lit("FAIL")),
        threshold=F.lit(100.0 - float(min_pct)),
        failure_rate=F.lit(100.0) - F.col("completeness_rate"),
        details=F.when(
            ok, F.lit("complete enough")
        ).otherwise(F.concat(F.col("failed_records").cast("string"), F.lit(" values missing"))),
    )
