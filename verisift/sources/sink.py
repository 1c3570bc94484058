"""Result sink.

``export_rows`` is the 8-column export projection; ``write_results`` appends
it (plus ``execution_timestamp``) as parquet or CSV, or writes the JSON
document ``{summary, results[]}``. Result frames hold one row per check or per
suite, so the JSON document's ``collect_list`` is bounded by the rule count,
not by the data.
"""

from __future__ import annotations

import re
from typing import Optional

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..contract import success_rate

EXPORT_COLUMNS = (
    "test_name",
    "status",
    "total_tested",
    "failed_records",
    "failure_rate",
    "success_rate",
    "execution_time",
    "failure_details",
)

# Exported status words for contract statuses (fixed values of the export format).
_STATUS_WORDS = {"PASS": "passed", "FAIL": "failed", "ERROR": "error", "SKIPPED": "skipped"}


def _status_word(status):
    expr = F.lit("error")
    for key, word in _STATUS_WORDS.items():
        expr = F.when(F.upper(status) == key, F.lit(word)).otherwise(expr)
    return expr


def export_rows(contract: DataFrame, execution_time: Optional[str] = None) -> DataFrame:
    """Contract rows -> the 8 export columns (rates rounded to 2, seconds to 3).

    ``execution_time`` names a seconds column if the caller measured one;
    otherwise it is a typed NULL, as in a parallel run.
    """
    tot = F.col("total_tested").cast("bigint")
    fail = F.col("failed_records").cast("bigint")
    exec_time = (
        F.round(F.col(execution_time).cast("double"), 3)
        if execution_time
        else F.lit(None).cast("double")
    )
    return contract.select(
        F.col("test_name"),
        _status_word(F.col("pass_fail_status")).alias("status"),
        tot.alias("total_tested"),
        fail.alias("failed_records"),
        F.round(F.col("actual_failure_rate").cast("double"), 2).alias("failure_rate"),
        F.round(success_rate(tot, fail), 2).alias("success_rate"),
        exec_time.alias("execution_time"),
        F.col("failure_details"),
    )


def write_results(
    contract: DataFrame,
    path: str,
    fmt: str = "parquet",
    mode: str = "append",
    execution_time: Optional[str] = None,
    run_id: Optional[str] = None,
) -> None:
    """Write contract rows; parquet/csv rows gain ``execution_timestamp``.

    With ``run_id`` a run has a partition of its own, ``run_id=...`` below ``path``, in every
    format: a run that is written again, after a failure or a retry, replaces what it
    had written and no other run's rows. Without, ``mode`` says what happens to
    what is there. ``fmt`` is parquet, csv, json or table (same as json: the document
    ``{summary, results[]}``, written as one line).
    """
    if fmt not in ("parquet", "csv", "json", "table"):
        raise ValueError(f"unsupported result format {fmt!r}")
    if run_id is not None:
        if not re.fullmatch(r"[A-Za-z0-9_.:+-]+", run_id):
            raise ValueError(f"a run id has letters, digits and _.:+- only, not {run_id!r}")
        path, mode = f"{path.rstrip('/')}/run_id={run_id.replace(':', '%3A')}", "overwrite"
    rows = export_rows(contract, execution_time)
    if fmt in ("json", "table"):  # a table-mode run exports the JSON document
        summary = F.struct(
            F.count(F.lit(1)).alias("total_tests"),
            F.count_if(F.col("status") == "passed").alias("passed"),
            F.count_if(F.col("status").isin("failed", "error")).alias("failed"),
            F.when(
                F.count(F.lit(1)) > 0,
                F.count_if(F.col("status") == "passed") / F.count(F.lit(1)) * 100.0,
            )
            .otherwise(F.lit(0.0))
            .alias("success_rate"),
        )
        doc = rows.agg(
            summary.alias("summary"),
            F.collect_list(F.struct(*[F.col(c) for c in EXPORT_COLUMNS])).alias("results"),
        )
        doc.coalesce(1).write.mode(mode).json(path)
        return
    stamped = rows.withColumn("execution_timestamp", F.current_timestamp())
    writer = stamped.write.mode(mode)
    if fmt == "csv":
        writer.option("header", True).csv(path)
    else:
        writer.parquet(path)
