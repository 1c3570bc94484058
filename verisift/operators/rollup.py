"""Roll-ups over check results: A2-A6.

Inputs here are check results — one row per rule, per suite or per partial —
so every frame is bounded by the size of the rule catalog, never by the data.
They are still DataFrames so a run stays one lazy plan and can be written by
the sink without passing through the driver.
"""

from __future__ import annotations

from typing import Mapping, Optional, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.frames import literal_frame
from ..functions import pct, rate
from ..rules import Catalog

SUITE_ORDER = (
    "null_columns",
    "empty_tables",
    "column_completeness",
    "referential_integrity",
    "person_patterns",
    "concept_mapping",
)

# Suite -> threshold category (fixed values of the rule format).
SUITE_CATEGORY = {
    "null_columns": "data_quality",
    "empty_tables": "data_quality",
    "column_completeness": "data_quality",
    "referential_integrity": "referential_integrity",
    "concept_mapping": "concept_mapping",
    "person_patterns": "person_patterns",
}

# Failure thresholds in percent (fixed values of the shipped configuration):
# (scope, name, environment, threshold).
DEFAULT_THRESHOLDS = (
    ("category", "data_quality", None, 0.0),
    ("category", "referential_integrity", None, 0.0),
    ("category", "concept_mapping", None, 5.0),
    ("category", "person_patterns", None, 2.0),
    ("test", "null_columns", None, 0.0),
    ("test", "empty_tables", None, 0.0),
    ("test", "column_completeness", None, 5.0),
    ("category", "data_quality", "dev", 10.0),
    ("category", "concept_mapping", "dev", 15.0),
    ("category", "person_patterns", "dev", 10.0),
    ("category", "data_quality", "uat", 2.0),
    ("category", "concept_mapping", "uat", 8.0),
    ("category", "person_patterns", "uat", 5.0),
    ("category", "data_quality", "prod", 0.0),
    ("category", "concept_mapping", "prod", 1.0),
    ("category", "person_patterns", "prod", 1.0),
)

def _order_frame(spark: SparkSession, order: Sequence[str]) -> DataFrame:
    return literal_frame(spark, [(s, i) for i, s in enumerate(order)], "suite string, suite_seq int")


# ----------------------------------------------------------------------------- A3


def suite_rollup(sub_results: DataFrame, order: Sequence[str] = SUITE_ORDER) -> DataFrame:
    """A3: ``suite, suite_seq, total_tested, failed_records, errors, skipped,
    failure_rate, status, reason``.

    total = number of rules, failed = rules that FAILed or ERRORed, rate =
    failed / total * 100 (0 with no rules). Any ERROR rule, or every rule
    SKIPPED, makes the suite ERROR; else any failure makes it FAIL. ``reason``
    is that of the first rule that could not be tested, ERROR before SKIPPED.
    """
    spark = sub_results.sparkSession
    if "reason" not in sub_results.columns:
        sub_results = sub_results.withColumn("reason", F.lit(None).cast("string"))
    st = F.upper(F.col("status"))
    agg = sub_results.groupBy("suite").agg(
        F.count(F.lit(1)).alias("total_tested"),
        F.count_if(st.isin("FAIL", "ERROR")).alias("failed_records"),
        F.count_if(st == "ERROR").alias("errors"),
        F.count_if(st == "SKIPPED").alias("skipped"),
        F.min_by(
            F.concat_ws(": ", "rule", "reason"),
            F.when(st.isin("ERROR", "SKIPPED"), F.struct(st, F.col("seq"), F.col("rule"))),
        ).alias("reason"),
    )
    tot, fail = F.col("total_tested"), F.col("failed_records")
    # The order frame has one row per suite name: bounded by configuration.
    return agg.join(F.broadcast(_order_frame(spark, order)), "suite", "left").select(
        "suite",
        F.coalesce(F.col("suite_seq"), F.lit(len(order))).alias("suite_seq"),
        tot,
        fail,
        "errors",
        "skipped",
        rate(fail, tot).alias("failure_rate"),
        _suite_status(tot, fail).alias("status"),
        "reason",
    )


def _suite_status(total: Column, failed: Column) -> Column:
    return (
        F.when((F.col("errors") > 0) | (F.col("skipped") == total), F.lit("ERROR"))
        .when(failed > 0, F.lit("FAIL"))
        .otherwise(F.lit("PASS"))
    )


# ----------------------------------------------------------------------------- A4


def merge_partials(partials: DataFrame, order: Sequence[str] = SUITE_ORDER) -> DataFrame:
    """A4: combine partial results of a suite (chunks, or incremental runs).

    Counts of rules, failures, errors and skipped rules are summed, and status
    and rate are decided from the sums, so the answer is that of the suite in
    one piece however it was cut.
    """
    spark = partials.sparkSession
    if "errors" not in partials.columns:  # a partial known by its status alone
        own = F.upper(F.col("status")) == "ERROR"
        partials = partials.withColumn("errors", own.cast("int")).withColumn("skipped", F.lit(0))
    agg = partials.groupBy("suite").agg(
        F.coalesce(F.sum("total_tested"), F.lit(0)).cast("bigint").alias("total_tested"),
        F.coalesce(F.sum("failed_records"), F.lit(0)).cast("bigint").alias("failed_records"),
        F.coalesce(F.sum("errors"), F.lit(0)).cast("bigint").alias("errors"),
        F.coalesce(F.sum("skipped"), F.lit(0)).cast("bigint").alias("skipped"),
        F.count(F.lit(1)).alias("partials"),
    )
    tot, fail = F.col("total_tested"), F.col("failed_records")
    return agg.join(F.broadcast(_order_frame(spark, order)), "suite", "left").select(
        "suite",
        F.coalesce(F.col("suite_seq"), F.lit(len(order))).alias("suite_seq"),
        tot,
        fail,
        "errors",
        "skipped",
        rate(fail, tot).alias("failure_rate"),
        _suite_status(tot, fail).alias("status"),
        "partials",
    )


# ----------------------------------------------------------------------------- A5


def run_summary(suite_results: DataFrame) -> DataFrame:
    """A5: ``total, passed, failed, error, skipped, failed_or_error,
    success_rate, data_tests, data_tests_failed`` over suite results
    (``status``, ``total_tested``, ``failed_records``). ``failed`` counts FAIL
    only and ``error`` ERROR (the runner's split); ``failed_or_error`` is the
    display's count, which folds errors into failures.
    """
    st = F.upper(F.col("status"))
    tot, fail = F.col("total_tested"), F.col("failed_records")
    agg = suite_results.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(st == "PASS").alias("passed"),
        F.count_if(st == "FAIL").alias("failed"),
        F.count_if(st == "ERROR").alias("error"),
        F.count_if(st == "SKIPPED").alias("skipped"),
        F.coalesce(F.sum(F.when(tot > 0, tot)), F.lit(0)).cast("bigint").alias("data_tests"),
        F.coalesce(F.sum(F.when(fail > 0, fail)), F.lit(0)).cast("bigint").alias("data_tests_failed"),
    )
    return agg.select(
        "total",
        "passed",
        "failed",
        "error",
        "skipped",
        (F.col("failed") + F.col("error")).alias("failed_or_error"),
        rate(F.col("passed"), F.col("total")).alias("success_rate"),
        "data_tests",
        "data_tests_failed",
    )


# ----------------------------------------------------------------------------- A2


def threshold_table(spark: SparkSession, rows=DEFAULT_THRESHOLDS) -> DataFrame:
    return literal_frame(
        spark,
        list(rows), "scope string, name string, env string, threshold double"
    )


def apply_thresholds(
    results: DataFrame,
    thresholds: DataFrame,
    *,
    env: Optional[str] = None,
    overrides: Optional[Mapping[str, float]] = None,
    category: Optional[Mapping[str, str]] = None,
) -> DataFrame:
    """A2: resolve each result's threshold and grade it by that.

    ``results`` carries ``test_name, total_tested, failed_records`` and
    optionally ``category`` and ``status``. Precedence: explicit override >
    test name > environment category > category > 0.0. PASS iff nothing failed
    or the failure rate is within the threshold; a result whose status is ERROR
    or SKIPPED has not been tested and keeps it. Of several thresholds for one
    name the lowest holds.
    """
    spark = results.sparkSession
    if "status" not in results.columns:
        results = results.withColumn("status", F.lit(None).cast("string"))
    cat_map = dict(SUITE_CATEGORY)
    cat_map.update(category or {})
    if "category" not in results.columns:
        cats = literal_frame(spark, list(cat_map.items()), "test_name string, category string")
        results = results.join(F.broadcast(cats), "test_name", "left")
    th = thresholds

    def one_each(rows: DataFrame, key: str, value: str) -> DataFrame:
        return rows.groupBy(F.col("name").alias(key)).agg(F.min("threshold").alias(value))

    by_test = one_each(th.where((F.col("scope") == "test") & F.col("env").isNull()), "test_name", "__t_test")
    by_cat = one_each(th.where((F.col("scope") == "category") & F.col("env").isNull()), "category", "__t_cat")
    by_env = one_each(th.where((F.col("scope") == "category") & (F.col("env") == F.lit(env))), "category", "__t_env")
    ov = literal_frame(
        spark,
        [(k, float(v)) for k, v in (overrides or {}).items()], "test_name string, __t_override double"
    )
    # Overrides come from the caller's mapping; the threshold frame may be any
    # size, so how to join it is left to its measured size.
    joined = (
        results.join(F.broadcast(ov), "test_name", "left")
        .join(by_test, "test_name", "left")
        .join(by_env, "category", "left")
        .join(by_cat, "category", "left")
    )
    threshold = F.coalesce("__t_override", "__t_test", "__t_env", "__t_cat", F.lit(0.0))
    source = (
        F.when(F.col("__t_override").isNotNull(), F.lit("override"))
        .when(F.col("__t_test").isNotNull(), F.lit("test"))
        .when(F.col("__t_env").isNotNull(), F.lit("environment"))
        .when(F.col("__t_cat").isNotNull(), F.lit("category"))
        .otherwise(F.lit("default"))
    )
    tot, fail = F.col("total_tested"), F.col("failed_records")
    fr = rate(fail, tot)
    return joined.select(
        "test_name",
        "category",
        tot,
        fail,
        fr.alias("actual_failure_rate"),
        threshold.alias("failure_threshold"),
        source.alias("threshold_source"),
        F.when(F.upper("status").isin("ERROR", "SKIPPED"), F.upper("status"))
        .when((fail == 0) | (fr <= threshold), F.lit("PASS"))
        .otherwise(F.lit("FAIL"))
        .alias("pass_fail_status"),
    )


# ----------------------------------------------------------------------------- A6

REPORT_COLUMNS = ("suite", "section", "seq", "of_lines", "item", "failed", "total", "distinct_ids", "pct", "reason")


def failure_report(
    *,
    null_columns: Optional[DataFrame] = None,
    empty_tables: Optional[DataFrame] = None,
    completeness: Optional[DataFrame] = None,
    referential: Optional[DataFrame] = None,
    patterns: Optional[DataFrame] = None,
    concepts: Optional[DataFrame] = None,
    top_null_columns: Optional[int] = None,
    top_completeness: Optional[int] = None,
) -> DataFrame:
    """The failure lines of a run as typed rows.

    Sections: all-NULL columns, empty tables, completeness failures,
    referential violations sorted by child table and FK and the relationships
    that could not be tested (``untested``, with the reason), failed patterns
    in rule order, and concept failures (J4 ``with_sections``), split into
    ``mapping`` (no map entry, no concept, NULL code) and ``data_quality``
    (NULL display): a column can be in both; those not tested are ``untested``. Every line is given unless the
    caller asks for the first ``top_...`` of a section; ``of_lines`` says how
    many a section has.
    """
    parts = []

    def add(frame, cap, order_cols):
        w = Window.partitionBy("suite", "section").orderBy(*order_cols)
        frame = frame if "reason" in frame.columns else frame.withColumn("reason", F.lit(None).cast("string"))
        ranked = frame.withColumn("seq", F.row_number().over(w))
        ranked = ranked.withColumn("of_lines", F.count(F.lit(1)).over(Window.partitionBy("suite", "section")))
        if cap is not None:
            ranked = ranked.where(F.col("seq") <= cap)
        parts.append(ranked.select(*REPORT_COLUMNS))

    if null_columns is not None:
        f = null_columns.select(
            F.lit("null_columns").alias("suite"), F.lit("all_null").alias("section"),
            F.concat_ws(".", "table_name", "column_name").alias("item"),
            F.col("total_rows").cast("bigint").alias("failed"), F.col("total_rows").cast("bigint").alias("total"),
            F.lit(None).cast("bigint").alias("distinct_ids"),
            F.lit(100.0).alias("pct"), "is_all_null",
        ).where("is_all_null")
        add(f, top_null_columns, [F.col("item")])
    if empty_tables is not None:
        f = empty_tables.where("is_empty").select(
            F.lit("empty_tables").alias("suite"), F.lit("empty").alias("section"),
            F.col("table_name").alias("item"), F.lit(0).cast("bigint").alias("failed"),
            F.col("row_count").cast("bigint").alias("total"),
            F.lit(None).cast("bigint").alias("distinct_ids"), F.lit(0.0).alias("pct"),
        )
        add(f, None, [F.col("item")])
    if completeness is not None:
        f = completeness.where(F.col("status") != "PASS").select(
            F.lit("column_completeness").alias("suite"), F.lit("completeness").alias("section"),
            F.col("table_column").alias("item"), F.col("missing_rows").cast("bigint").alias("failed"),
            F.col("total_rows").cast("bigint").alias("total"),
            F.lit(None).cast("bigint").alias("distinct_ids"),
            F.col("completeness_rate").alias("pct"),
            (F.col("seq") if "seq" in completeness.columns else F.lit(0)).alias("__rule_seq"),
        )
        add(f, top_completeness, [F.col("__rule_seq"), F.col("item")])
    if referential is not None:
        why = F.col("reason") if "reason" in referential.columns else F.lit(None).cast("string")
        f = referential.where(F.col("status") != "PASS").select(
            F.lit("referential_integrity").alias("suite"),
            F.when(F.col("status") == "FAIL", F.lit("violations")).otherwise(F.lit("untested")).alias("section"),
            F.col("name").alias("item"), F.col("violation_count").cast("bigint").alias("failed"),
            F.col("non_null_fk").cast("bigint").alias("total"),
            F.lit(None).cast("bigint").alias("distinct_ids"),
            F.col("pct_of_non_null").alias("pct"), why.alias("reason"), "child", "fk",
        )
        add(f, None, [F.col("child"), F.col("fk"), F.col("item")])
    if patterns is not None:
        f = patterns.where(~F.col("passed")).select(
            F.lit("person_patterns").alias("suite"), F.lit("patterns").alias("section"),
            F.col("name").alias("item"), F.col("failed_records").cast("bigint").alias("failed"),
            F.col("total_tested").cast("bigint").alias("total"),
            F.lit(None).cast("bigint").alias("distinct_ids"),
            pct(F.col("failed_records"), F.col("total_tested")).alias("pct"), F.col("seq").alias("__rule_seq"),
        )
        add(f, None, [F.col("__rule_seq")])
    if concepts is not None:
        base = concepts.where(~F.col("passed"))
        seq = F.col("rule_id") if "rule_id" in concepts.columns else F.lit(0)

        def bucket(section, name):
            failed, ids = F.col(f"{name}_records"), F.col(f"{name}_ids")
            return base.where(ids > 0).select(
                F.lit("concept_mapping").alias("suite"), F.lit(section).alias("section"),
                F.col("name").alias("item"), failed.alias("failed"), F.col("total_records").alias("total"),
                ids.alias("distinct_ids"), pct(failed, F.col("total_records")).alias("pct"), seq.alias("__rule_seq"),
            )

        lines = bucket("mapping", "mapping").unionByName(bucket("data_quality", "null_display"))
        if "status" in concepts.columns:
            none = F.lit(None).cast("bigint")
            untested = concepts.where(~F.col("status").isin("PASS", "FAIL")).select(
                F.lit("concept_mapping").alias("suite"), F.lit("untested").alias("section"), F.col("name").alias("item"),
                none.alias("failed"), none.alias("total"), none.alias("distinct_ids"), F.lit(None).cast("double").alias("pct"),
                seq.alias("__rule_seq"), "reason",
            )
            lines = lines.withColumn("reason", F.lit(None).cast("string")).unionByName(untested)
        add(lines, None, [F.col("__rule_seq")])
    if not parts:
        raise ValueError("failure_report needs at least one result frame")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# Sections of the report by suite, for rules that were tested and failed.
_SECTIONS = {
    "null_columns": "all_null",
    "empty_tables": "empty",
    "column_completeness": "completeness",
    "referential_integrity": "violations",
    "person_patterns": "patterns",
    "__concept_mapping": "mapping",
    "__concept_display": "data_quality",
}


def run_report(rows: DataFrame, catalog: Catalog) -> DataFrame:
    """A6 of a whole run: its failure lines, folded from the run's rule rows alone.

    ``rows`` are a run's rule rows with its internal rows, a few per rule, so no table is
    read again. Every rule that failed has a line in its suite's section (a concept column
    one per section it fails in), every rule that is SKIPPED or ERROR one in ``untested`` with
    its reason. An empty table's completeness rule is a line of its section. Columns and
    order of lines are those of ``failure_report``.
    """
    spark = rows.sparkSession
    # Violations are listed by child table and key; everything else by item or rule order.
    places = literal_frame(
        spark,
        [("referential_integrity", i, r.child, r.fk) for i, r in enumerate(catalog.relationships)],
        "suite string, seq int, __child string, __fk string",
    )
    tot, bad, status = F.col("total_tested"), F.col("failed_records"), F.col("status")
    bucket = F.col("suite").startswith("__")
    empty = (F.col("suite") == "column_completeness") & (tot == 0)
    section = F.when(bucket | (status == "FAIL") | empty, F.create_map(*[F.lit(x) for kv in _SECTIONS.items() for x in kv])[F.col("suite")])
    lines = rows.where((bucket & (F.col("reason") != "0")) | (~bucket & (status != "PASS"))).withColumn("section", F.coalesce(section, F.lit("untested")))
    lines = lines.where(~((F.col("suite") == "concept_mapping") & (status == "FAIL"))).join(F.broadcast(places), ["suite", "seq"], "left")
    pct_of = (
        F.when(F.col("section") == "untested", F.lit(None).cast("double"))
        .when(F.col("suite") == "null_columns", F.lit(100.0))
        .when(F.col("suite") == "empty_tables", F.lit(0.0))
        .when(F.col("suite") == "column_completeness", F.when(tot > 0, pct(tot - bad, tot)))
        .otherwise(pct(bad, tot))
    )
    suite = F.when(bucket, F.lit("concept_mapping")).otherwise(F.col("suite"))
    by_item = F.col("suite").isin("null_columns", "empty_tables")
    out = lines.select(
        suite.alias("suite"),
        "section",
        F.col("rule").alias("item"),
        # An empty table has no rows that could fail.
        F.when(F.col("suite") == "empty_tables", F.when(status == "FAIL", F.lit(0))).otherwise(bad).cast("bigint").alias("failed"),
        tot.cast("bigint").alias("total"),
        F.when(bucket, F.col("reason").cast("bigint")).alias("distinct_ids"),
        pct_of.alias("pct"),
        F.when(~bucket, F.col("reason")).alias("reason"),
        F.struct(F.coalesce("__child", F.lit("")), F.coalesce("__fk", F.lit("")), F.when(by_item | F.col("__child").isNotNull(), F.lit(0)).otherwise(F.col("seq"))).alias("__place"),
    )
    w = Window.partitionBy("suite", "section")
    out = out.withColumn("seq", F.row_number().over(w.orderBy("__place", "item"))).withColumn("of_lines", F.count(F.lit(1)).over(w))
    return out.select(*REPORT_COLUMNS)
