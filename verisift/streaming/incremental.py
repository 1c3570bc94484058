"""Incremental validation of arriving data (A4 applied to micro-batches).

The checks are batch DataFrame jobs; Structured Streaming only decides which
rows are new. Every micro-batch runs an additive check (row rules, NULL counts,
foreign keys against a static parent) on the batch alone and writes its
per-rule counts into a parquet table partitioned by ``batch_id``. A replayed
batch overwrites its own partition (dynamic partition overwrite), so the table
is exactly-once even when a batch is re-executed after a failure.
``stream_totals`` folds the partials into per-rule totals and re-grades them.

Only checks whose counts add up across disjoint row sets qualify: row rules
(R2-R4), NULL counts (P1, P4), completeness counts and foreign keys checked
against a static parent (J1). Uniqueness and distinct-entity counts do not add
up across batches and are not offered here.
"""

from __future__ import annotations

from typing import Callable, Mapping, Optional

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.joins import referential_integrity
from ..operators.profile import null_columns
from ..operators.rowrules import row_checks

# A batch check: (batch DataFrame) -> rows of
# ``suite, seq, rule, kind, total_tested, failed_records``.
BatchCheck = Callable[[DataFrame], DataFrame]

# How a merged rule is graded from its summed counts.
KIND_ANY_FAILURE = "any_failure"  # FAIL iff failed_records > 0
KIND_ALL_FAILED = "all_failed"  # FAIL iff every tested row failed (all-NULL column)


def row_rule_check(table: str, rules, suite: str = "person_patterns") -> BatchCheck:
    """R2-R4 rules over the batch, which stands in for ``table``."""

    def run(batch: DataFrame) -> DataFrame:
        res = row_checks({table: batch}, rules)
        seq = {r.name: i for i, r in enumerate(rules)}
        order = F.create_map(*[x for k, v in seq.items() for x in (F.lit(k), F.lit(v))])
        return res.select(
            F.lit(suite).alias("suite"),
            order[F.col("name")].alias("seq"),
            F.col("name").alias("rule"),
            F.lit(KIND_ANY_FAILURE).alias("kind"),
            "total_tested",
            "failed_records",
        )

    return run


def null_count_check(table: str, suite: str = "null_columns") -> BatchCheck:
    """P1 counts over the batch: a column fails only if NULL in every row seen."""

    def run(batch: DataFrame) -> DataFrame:
        res = null_columns({table: batch})
        cols = batch.columns
        order = F.create_map(*[x for i, c in enumerate(cols) for x in (F.lit(c), F.lit(i))])
        return res.select(
            F.lit(suite).alias("suite"),
            order[F.col("column_name")].alias("seq"),
            F.concat_ws(".", "table_name", "column_name").alias("rule"),
            F.lit(KIND_ALL_FAILED).alias("kind"),
            F.col("total_rows").alias("total_tested"),
            (F.col("total_rows") - F.col("non_null_count")).alias("failed_records"),
        )

    return run


def foreign_key_check(
    child: str, static_tables: Mapping[str, DataFrame], relationships, suite: str = "referential_integrity"
) -> BatchCheck:
    """J1 of the batch (as ``child``) against static parent tables."""

    def run(batch: DataFrame) -> DataFrame:
        tables = dict(static_tables)
        tables[child] = batch
        res = referential_integrity(tables, relationships, with_reason=True)
        return res.where(F.col("reason").isNull()).select(
            F.lit(suite).alias("suite"),
            F.col("rule_id").alias("seq"),
            F.col("name").alias("rule"),
            F.lit(KIND_ANY_FAILURE).alias("kind"),
            F.col("non_null_fk").alias("total_tested"),
            F.col("violation_count").alias("failed_records"),
        )

    return run


def batch_writer(check: BatchCheck, results_path: str) -> Callable[[DataFrame, int], None]:
    """The ``foreachBatch`` function: partial counts of one batch, written to
    its own ``batch_id`` partition (a replay overwrites it, never duplicates)."""

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        part = check(batch).withColumn("batch_id", F.lit(batch_id).cast("bigint"))
        (
            part.write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("batch_id")
            .parquet(results_path)
        )

    return write_batch


def validate_stream(
    stream: DataFrame,
    check: BatchCheck,
    results_path: str,
    checkpoint_location: str,
    *,
    trigger: Optional[dict] = None,
    query_name: Optional[str] = None,
) -> StreamingQuery:
    """Start a streaming query that writes per-batch partial counts.

    ``results_path`` and ``checkpoint_location`` must be on storage shared by
    the cluster (the checkpoint is what lets the query resume after a driver
    or executor loss).
    """

    writer = stream.writeStream.foreachBatch(batch_writer(check, results_path)).option(
        "checkpointLocation", checkpoint_location
    )
    if trigger:
        writer = writer.trigger(**trigger)
    if query_name:
        writer = writer.queryName(query_name)
    return writer.start()


def stream_totals(spark: SparkSession, results_path: str) -> DataFrame:
    """Per-rule totals over all batches written so far, re-graded from the sums:
    ``suite, seq, rule, total_tested, failed_records, status, batches``."""
    parts = spark.read.parquet(results_path)
    agg = parts.groupBy("suite", "seq", "rule", "kind").agg(
        F.coalesce(F.sum("total_tested"), F.lit(0)).cast("bigint").alias("total_tested"),
        F.coalesce(F.sum("failed_records"), F.lit(0)).cast("bigint").alias("failed_records"),
        F.count_distinct("batch_id").alias("batches"),
    )
    tot, fail = F.col("total_tested"), F.col("failed_records")
    failing = F.when(
        F.col("kind") == KIND_ALL_FAILED, (tot > 0) & (fail == tot)
    ).otherwise(fail > 0)
    return agg.select(
        "suite", "seq", "rule", tot, fail,
        F.when(failing, F.lit("FAIL")).otherwise(F.lit("PASS")).alias("status"),
        "batches",
    )
