"""The result contract every check can be projected onto (A1).

Nine columns, as produced by the reference's SQL checks::

    test_name, test_description, total_tested, failed_records,
    pass_fail_status, failure_threshold, actual_failure_rate,
    failure_details, [execution_timestamp]

``execution_timestamp`` is added only by the sink: it is nondeterministic and
must not leak into results that are compared between engines.
"""

from __future__ import annotations

from typing import Union

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .functions import rate

CONTRACT_COLUMNS = (
    "test_name",
    "test_description",
    "total_tested",
    "failed_records",
    "pass_fail_status",
    "failure_threshold",
    "actual_failure_rate",
    "failure_details",
)

# Per-rule result rows that roll up into suites.
SUB_RESULT_COLUMNS = ("suite", "seq", "rule", "total_tested", "failed_records", "status", "reason")
SUB_RESULT_SCHEMA = (
    "suite string, seq int, rule string, total_tested bigint, failed_records bigint, status string, reason string"
)

STATUSES = ("PASS", "FAIL", "ERROR", "SKIPPED")

ColumnLike = Union[str, Column, int, float, None]


def _col(value: ColumnLike) -> Column:
    if isinstance(value, Column):
        return value
    if isinstance(value, str):
        return F.col(value)
    return F.lit(value)


def normalise_status(status: Column) -> Column:
    """A known status kept (case-insensitive); anything else, NULL included, is ERROR."""
    up = F.upper(F.trim(status))
    return F.when(up.isin(*STATUSES), up).otherwise(F.lit("ERROR"))


def success_rate(total: Column, failed: Column) -> Column:
    """``(total - failed) / total * 100``; 0.0 when nothing was tested."""
    return F.when(total > 0, (total - failed).cast("double") / total * F.lit(100.0)).otherwise(
        F.lit(0.0)
    )


def graded_status(total: Column, failed: Column, threshold: Column) -> Column:
    """PASS iff no failures, or the failure rate is within the threshold."""
    return F.when(
        (failed == 0) | ((total > 0) & (rate(failed, total) <= threshold)), F.lit("PASS")
    ).otherwise(F.lit("FAIL"))


def to_contract(
    df: DataFrame,
    *,
    name: ColumnLike,
    total: ColumnLike = "total_tested",
    failed: ColumnLike = "failed_records",
    description: ColumnLike = "",
    status: ColumnLike = None,
    threshold: ColumnLike = 0.0,
    failure_rate: ColumnLike = None,
    details: ColumnLike = None,
    with_success_rate: bool = False,
) -> DataFrame:
    """Project any per-check frame onto the contract.

    * ``status`` given: the check's own verdict, kept (ERROR and SKIPPED too);
      otherwise graded against ``threshold`` (percent).
    * ``failure_rate`` given: used, but recomputed as failed/total*100 when it
      is 0 and something failed; otherwise computed.
    * ``details`` defaults to the failure count; a ``reason`` column, where the
      frame has one, replaces it on ERROR and SKIPPED rows.
    * ``name`` may be a column name or a Column; ``description`` is literal text
      unless it is a Column.
    """
    tot = _col(total).cast("bigint")
    fail = _col(failed).cast("bigint")
    thr = _col(threshold).cast("double")
    computed = rate(fail, tot)
    if failure_rate is None:
        fr = computed
    else:
        given = _col(failure_rate).cast("double")
        fr = F.when((F.coalesce(given, F.lit(0.0)) == 0.0) & (tot > 0), computed).otherwise(
            F.coalesce(given, computed)
        )
    st = normalise_status(_col(status)) if status is not None else graded_status(tot, fail, thr)
    if details is None:
        det = F.when(fail == 0, F.lit("no failures")).otherwise(F.concat(fail.cast("string"), F.lit(" failed")))
        if "reason" in df.columns:
            det = F.when(st.isin("ERROR", "SKIPPED"), F.col("reason")).otherwise(det)
    else:
        det = _col(details).cast("string")
    cols = [
        _col(name).cast("string").alias("test_name"),
        (description if isinstance(description, Column) else F.lit(description))
        .cast("string")
        .alias("test_description"),
        tot.alias("total_tested"),
        fail.alias("failed_records"),
        st.alias("pass_fail_status"),
        thr.alias("failure_threshold"),
        fr.alias("actual_failure_rate"),
        det.alias("failure_details"),
    ]
    if with_success_rate:
        cols.append(success_rate(tot, fail).alias("success_rate"))
    return df.select(*cols)


def check_contract(df: DataFrame, *, name_col: str = "name", description: str = "") -> DataFrame:
    """A1 over a per-rule check frame (``name, total_tested, failed_records``).

    The check's verdict stands: ``status`` if the frame has it, else ``passed``
    (an informational check passes whatever it counted); only a frame with
    neither is graded from its counts.
    """
    status = None
    if "status" in df.columns:
        status = F.col("status")
    elif "passed" in df.columns:
        status = F.when(F.col("passed"), F.lit("PASS")).when(~F.col("passed"), F.lit("FAIL"))
    return to_contract(
        df,
        name=name_col,
        description=description,
        total="total_tested",
        failed="failed_records",
        status=status,
        with_success_rate=True,
    )
