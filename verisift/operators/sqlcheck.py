"""Query-contract checks Q1-Q3: a user query becomes one contract row."""

from __future__ import annotations

from typing import Any, Mapping, Optional

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..contract import to_contract


def _stack_counts(failures: DataFrame, total: DataFrame) -> DataFrame:
    """One row ``total_tested, failed_records`` from two independent counts.

    Each side is its own single-row aggregate; they are stacked and folded with
    ``max`` rather than joined.
    """
    f = failures.agg(
        F.lit(None).cast("bigint").alias("total_tested"), F.count(F.lit(1)).alias("failed_records")
    )
    t = total.agg(
        F.count(F.lit(1)).alias("total_tested"), F.lit(None).cast("bigint").alias("failed_records")
    )
    return f.unionByName(t).agg(
        F.max("total_tested").alias("total_tested"), F.max("failed_records").alias("failed_records")
    )


def zero_failure(
    name: str, failures: DataFrame, total: DataFrame, description: str = ""
) -> DataFrame:
    """Q1: PASS iff ``failures`` has no rows; total = rows of ``total``.

    Failure rows are counted as rows (a row with NULLs still counts).
    """
    return to_contract(
        _stack_counts(failures, total),
        name=F.lit(name),
        description=F.lit(description),
        threshold=0.0,
    )


def threshold_check(
    name: str,
    metrics: DataFrame,
    threshold: float,
    metric: str = "failure_rate",
    description: str = "",
) -> DataFrame:
    """Q2: PASS iff ``metric <= threshold`` (inclusive); metric is the failure rate.

    ``metrics`` must carry ``total_tested``, ``failed_records`` and ``metric``.
    """
    m = F.col(metric).cast("double")
    ok = m <= F.lit(float(threshold))
    return to_contract(
        metrics,
        name=F.lit(name),
        description=F.lit(description),
        status=F.when(ok, F.lit("PASS")).otherwise(F.lit("FAIL")),
        threshold=F.lit(float(threshold)),
        failure_rate=m,
        details=F.when(ok, F.lit("rate within the threshold")).otherwise(F.lit("rate above the threshold")),
    )


def sql_check(
    spark: SparkSession,
    name: str,
    sql: str,
    args: Optional[Mapping[str, Any]] = None,
    *,
    description: str = "",
    graded: bool = True,
) -> DataFrame:
    """Q3: user SQL returning contract columns -> one normalised contract row.

    Parameters travel as named parameter markers (``:name``), never as text
    substitution. The query must return one row: none, or more than one, is an
    ERROR (an ungraded check passes without a row). ``pass_fail_status`` other
    than PASS/FAIL is ERROR; an ungraded check is PASS whatever it counted.
    """
    user = spark.sql(sql, args=dict(args) if args else None)
    cols = set(user.columns)

    def pick(c, cast, default=None):
        return F.col(c).cast(cast) if c in cols else F.lit(default).cast(cast)

    one = user.select(
        F.struct(
            pick("total_tested", "bigint", 0).alias("total_tested"),
            pick("failed_records", "bigint", 0).alias("failed_records"),
            pick("pass_fail_status", "string").alias("status_in"),
            pick("failure_threshold", "double", 0.0).alias("failure_threshold"),
            pick("actual_failure_rate", "double").alias("actual_failure_rate"),
            pick("failure_details", "string").alias("failure_details"),
        ).alias("r")
    ).limit(2)  # two rows tell one from many; an aggregate always has a row
    row = one.agg(F.count(F.lit(1)).alias("n"), F.first("r").alias("r")).select("n", "r.*")
    own, many = F.col("n") == 1, F.col("n") > 1
    for c in ("total_tested", "failed_records", "failure_threshold", "actual_failure_rate"):
        row = row.withColumn(c, F.when(own, F.col(c)))
    given = F.upper(F.trim("status_in"))
    if graded:
        status = F.when(own & given.isin("PASS", "FAIL"), given).otherwise(F.lit("ERROR"))
    else:
        status = F.when(many, F.lit("ERROR")).otherwise(F.lit("PASS"))
    details = (
        F.when(own, F.col("failure_details"))
        .when(many, F.lit("query returned more than one row"))
        .otherwise(F.lit("query returned no row"))
    )
    return to_contract(
        row,
        name=F.lit(name),
        description=F.lit(description),
        total=F.coalesce(F.col("total_tested"), F.lit(0)),
        failed=F.coalesce(F.col("failed_records"), F.lit(0)),
        status=status,
        threshold=F.coalesce(F.col("failure_threshold"), F.lit(0.0)),
        failure_rate=F.col("actual_failure_rate"),
        details=details,
    )
