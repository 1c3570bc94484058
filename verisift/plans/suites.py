"""A full run: every suite as one lazy plan, rolled up per suite.

``suite_sub_results`` stacks one row per rule from all six suites (null
columns, empty tables, column completeness, referential integrity, person
patterns, concept mapping); ``run_suites`` rolls them up. Nothing is
collected: the caller writes or collects the (catalog-sized) result.
``materialize`` is how a caller that needs several outputs from one run (roll-
up, report, export) avoids recomputing the checks: it checkpoints the small
sub-result table into the session's checkpoint folder, which survives lost
executors.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import replace
from typing import Dict, List, Mapping, Optional, Sequence

from pyspark import inheritable_thread_target
from pyspark.errors import AnalysisException, ParseException, PySparkException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.frames import literal_frame
from ..operators import joins, profile, rowrules
from ..contract import SUB_RESULT_COLUMNS, SUB_RESULT_SCHEMA, to_contract
from ..operators.rollup import SUITE_ORDER, run_report, run_summary, suite_rollup
from ..sources.sink import export_rows, write_results
from ..rules import (
    Catalog,
    FieldComparison,
    GroupCount,
    PatternRule,
    QueryCount,
    RangeCheck,
    ReferenceCheck,
    RelationshipExists,
    RequiredFields,
    Uniqueness,
    UnusableRule,
)
from ..session import ensure_checkpoint_dir
from .shared_scan import join_suites, public_rows, shared_sub_results, single_table_rows

_TYPE_NAMES = {
    Uniqueness: "uniqueness",
    RequiredFields: "completeness",
    RangeCheck: "range_validation",
    FieldComparison: "field_comparison",
    ReferenceCheck: "referential_integrity",
    RelationshipExists: "relationship",
    GroupCount: "count_check",
    QueryCount: "count_check",
}


def pattern_missing(tables: Mapping[str, DataFrame], p: PatternRule) -> Optional[str]:
    """Why a pattern cannot run, from schemas only (no job); None if it can."""
    need = []
    if isinstance(p, Uniqueness):
        need = [(p.table, p.column)]
    elif isinstance(p, RequiredFields):
        need = [(p.table, f) for f in p.fields]
    elif isinstance(p, RangeCheck):
        need = [(p.table, p.field)]
    elif isinstance(p, FieldComparison):
        need = [(p.table, p.field1), (p.table, p.field2)]
    elif isinstance(p, ReferenceCheck):
        need = [(p.child, p.fk), (p.parent, p.key)]
    elif isinstance(p, RelationshipExists):
        need = [(p.base, b) for b, _ in p.on] + [(p.joined, j) for _, j in p.on] or [(p.base, p.entity)]
        if p.within:
            need += [(p.base, p.within.base), (p.joined, p.within.joined)]
        if p.count == "entities":
            need.append((p.base, p.entity))
    elif isinstance(p, QueryCount):
        return None if p.table in tables else f"table {p.table} not found"
    elif isinstance(p, GroupCount):
        need = [(p.base, p.group_key)]
        if p.joined is None:
            need.append((p.base, p.counted))
        else:
            need += [(p.base, b) for b, _ in p.on] + [(p.joined, j) for _, j in p.on] + [(p.joined, p.counted)]
    for table, col in need:
        if table not in tables:
            return f"table {table} not found"
        if col not in tables[table].columns:
            return f"column {table}.{col} not found"
    return None


def person_patterns(
    tables: Mapping[str, DataFrame],
    patterns: Sequence[PatternRule],
    seq_of: Optional[Mapping[str, int]] = None,
) -> DataFrame:
    """All pattern rules: ``seq, name, rule_type, total_tested, failed_records,
    failed_pct, passed``. Row rules of one table share a single scan. Names
    must be unique; ``seq_of`` overrides the rule numbering."""
    spark = next(iter(tables.values())).sparkSession
    names = [p.name for p in patterns]
    if len(set(names)) != len(names):
        raise ValueError("pattern names must be unique")
    seq = dict(seq_of) if seq_of is not None else {p.name: i for i, p in enumerate(patterns)}
    kinds = {p.name: _TYPE_NAMES[type(p)] for p in patterns}
    row_rules = [p for p in patterns if isinstance(p, (Uniqueness, RequiredFields, RangeCheck, FieldComparison))]
    frames: List[DataFrame] = []
    if row_rules:
        frames.append(rowrules.row_checks(tables, row_rules))
    for p in patterns:
        if isinstance(p, ReferenceCheck):
            frames.append(joins.reference_check(tables, p))
        elif isinstance(p, RelationshipExists):
            frames.append(joins.relationship_exists(tables, p))
        elif isinstance(p, (GroupCount, QueryCount)):
            g = rowrules.group_count_check(tables, p)
            frames.append(
                g.select(
                    "name",
                    "total_tested",
                    "failed_records",
                    F.lit(0.0).alias("failed_pct"),
                    F.col("passed"),
                )
            )
    meta = literal_frame(
        spark,
        [(seq[p.name], p.name, kinds[p.name]) for p in patterns], "seq int, name string, rule_type string"
    )
    out = literal_frame(spark, [], "name string, total_tested bigint, failed_records bigint, failed_pct double, passed boolean")
    for f in frames:
        out = out.unionByName(f.select("name", "total_tested", "failed_records", "failed_pct", "passed"))
    # The rule frame has one row per pattern: bounded by configuration.
    return F.broadcast(meta).join(out, "name").select(
        "seq", "name", "rule_type", "total_tested", "failed_records", "failed_pct", "passed"
    )


def pattern_sub_results(
    tables, patterns: Sequence[PatternRule], seq_of: Optional[Mapping[str, int]] = None
) -> DataFrame:
    """Suite rows; a pattern naming a missing table or column is SKIPPED."""
    seq = dict(seq_of) if seq_of is not None else {p.name: i for i, p in enumerate(patterns)}
    lost = [("person_patterns", seq[p.name], p.name, None, None, "ERROR", p.reason) for p in patterns if isinstance(p, UnusableRule)]
    whys = [(p, pattern_missing(tables, p)) for p in patterns if not isinstance(p, UnusableRule)]
    ok = [p for p, why in whys if why is None]
    skipped = lost + [("person_patterns", seq[p.name], p.name, None, None, "SKIPPED", why) for p, why in whys if why]
    spark = next(iter(tables.values())).sparkSession
    out = literal_frame(spark, skipped, SUB_RESULT_SCHEMA)
    if not ok:
        return out
    return out.unionByName(_pattern_rows(tables, ok, seq))


def _pattern_rows(tables, patterns: Sequence[PatternRule], seq_of: Mapping[str, int]) -> DataFrame:
    return person_patterns(tables, patterns, seq_of).select(
        F.lit("person_patterns").alias("suite"),
        "seq",
        F.col("name").alias("rule"),
        "total_tested",
        "failed_records",
        F.when(F.col("passed"), F.lit("PASS")).otherwise(F.lit("FAIL")).alias("status"),
        F.lit(None).cast("string").alias("reason"),
    )


def suite_sub_results(
    tables: Mapping[str, DataFrame], catalog: Catalog, *, shared_scan: bool = True
) -> DataFrame:
    """One row per rule of every suite: ``suite, seq, rule, total_tested, failed_records, status, reason``.

    With ``shared_scan`` (default) every single-table check of a table comes
    from one aggregate over it (see ``shared_scan.py``); otherwise each suite
    plans its own scans.
    """
    if shared_scan:
        return shared_sub_results(tables, catalog)
    parts = [
        profile.null_columns_sub_results(tables, catalog.null_tables),
        profile.empty_tables_sub_results(tables, catalog.empty_tables, catalog.empty_exclude),
        profile.column_completeness_sub_results(tables, catalog.completeness),
        joins.referential_sub_results(tables, catalog.relationships),
        pattern_sub_results(tables, catalog.patterns),
        joins.concept_sub_results(tables, catalog.concepts, catalog.terminology),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def run_suites(
    tables: Mapping[str, DataFrame],
    catalog: Catalog,
    order: Sequence[str] = SUITE_ORDER,
    *,
    shared_scan: bool = True,
) -> DataFrame:
    """A3 over a full run: one row per suite."""
    return suite_rollup(suite_sub_results(tables, catalog, shared_scan=shared_scan), order)


def materialize(df: DataFrame) -> DataFrame:
    """Checkpoint a (small) result into ``spark.checkpoint.dir`` and cut its lineage."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def run(
    tables: Mapping[str, DataFrame],
    catalog: Catalog,
    *,
    order: Sequence[str] = SUITE_ORDER,
    results_path: Optional[str] = None,
    fmt: str = "parquet",
    isolate_errors: bool = True,
    run_id: Optional[str] = None,
) -> Dict[str, DataFrame]:
    """A full run with every output derived from one execution of the checks.

    The checks run as four checkpointed jobs side by side (the shared single-table
    aggregates and the three join-based suites); the rule-level results (one row per
    rule: a few hundred rows, not data) are the union of those checkpoints, and
    the suite roll-up, run summary, failure report and export rows are computed from them, so
    the table scans and joins run exactly once however many outputs are read.
    With ``results_path`` the suite contract rows are written through the sink (S2), with
    ``run_id`` to a partition that a second writing of the same run replaces.

    If a stage fails because an expression of a rule raises (a filter, a cast),
    what has finished is kept, and only that stage's rules are halved until the
    failing ones stand alone as ERROR rows with their reason. Any other failure,
    as of executors or memory, is the caller's.
    """
    rows = staged_sub_results(tables, catalog, isolate_errors=isolate_errors)
    sub = public_rows(rows)
    suites = suite_rollup(sub, order)
    contract = to_contract(suites, name="suite", status="status")
    out = {
        "rules": sub,
        "report": run_report(rows, catalog),
        "suites": suites,
        "summary": run_summary(suites),
        "contract": contract,
        "export": export_rows(contract),
    }
    if results_path:
        write_results(contract, results_path, fmt=fmt, run_id=run_id)
    return out


def rule_error(e: Exception) -> Optional[str]:
    """The first line of an error that a rule's own expression raised; None for any other."""
    if isinstance(e, KeyError):
        return str(e.args[0])
    if not isinstance(e, PySparkException):
        return None
    # Classes of the SQL standard: 22 data exceptions, 42 syntax or access rules.
    state = e.getSqlState() or ""
    if state[:2] in ("22", "42") or isinstance(e, (AnalysisException, ParseException)):
        return str(e).strip().splitlines()[0]
    return None


def _isolated(spark, suite: str, rules: Sequence[tuple], build) -> List[DataFrame]:
    """Checkpointed rows of ``rules`` (``(seq, name, rule)``); ``build(rules)`` plans any of
    them together. A plan that a rule's expression fails is halved: one bad rule
    of n costs about 2 log n more jobs."""
    if not rules:
        return []
    try:
        return [materialize(build(rules).select(*SUB_RESULT_COLUMNS))]
    except Exception as e:
        why = rule_error(e)
        if why is None:
            raise
        if len(rules) == 1:
            seq, name, _ = rules[0]
            return [literal_frame(spark, [(suite, seq, name, None, None, "ERROR", why)], SUB_RESULT_SCHEMA)]
        half = len(rules) // 2
        return _isolated(spark, suite, rules[:half], build) + _isolated(spark, suite, rules[half:], build)


def staged_sub_results(tables: Mapping[str, DataFrame], catalog: Catalog, *, isolate_errors: bool = True) -> DataFrame:
    """Every rule's row (and internal rows, see ``public_rows``): the single-table aggregates
    and each join-based suite as a job of its own, side by side, each checkpointed. See
    ``run`` for what happens when a rule fails."""
    spark = next(iter(tables.values())).sparkSession
    seq_of = {p.name: i for i, p in enumerate(catalog.patterns)}

    def patterns(rules):
        return pattern_sub_results(tables, [p for _, _, p in rules], seq_of)

    def numbered(rules, frame):
        """Rows numbered from 0 in the order of ``rules``, with the numbers that these have."""
        numbers = literal_frame(spark, [(k, seq) for k, (seq, _, _) in enumerate(rules)], "__k int, __seq int")
        return frame.join(F.broadcast(numbers), F.col("seq") == F.col("__k")).withColumn("seq", F.col("__seq"))

    def relationships(rules):
        return numbered(rules, joins.referential_sub_results(tables, [r for _, _, r in rules]))

    def concepts(rules):
        return numbered(rules, joins.concept_sub_results(tables, [c for _, _, c in rules], catalog.terminology, buckets=True))

    named = {
        "person_patterns": [(i, p.name, p) for i, p in enumerate(catalog.patterns)],
        "referential_integrity": [(i, r.label, r) for i, r in enumerate(catalog.relationships)],
        "concept_mapping": [(i, c.label, c) for i, c in enumerate(catalog.concepts)],
    }
    build = {"person_patterns": patterns, "referential_integrity": relationships, "concept_mapping": concepts}

    def tried(frame):
        """The checkpointed rows of ``frame``; None if an expression of a rule raised."""
        try:
            return materialize(frame.select(*SUB_RESULT_COLUMNS))
        except Exception as e:
            if not isolate_errors or rule_error(e) is None:
                raise
            return None

    try:
        single, others = single_table_rows(tables, catalog)
        frames = {"single": single, **join_suites(tables, catalog, others)}
    except Exception as e:  # a rule that can't even be planned
        if not isolate_errors or rule_error(e) is None:
            raise
        frames, others = {}, None
    # The suites depend on nothing but the tables: their jobs are planned and run beside each other.
    with ThreadPoolExecutor(max(1, len(frames))) as pool:
        jobs = {suite: pool.submit(inheritable_thread_target(spark)(tried), frame) for suite, frame in frames.items()}
        done = {suite: job.result() for suite, job in jobs.items()}
    parts = [part for part in done.values() if part is not None]
    left = dict(named)
    if done.get("single") is None:
        # Plain counts hold no expression of a rule; all that does is done rule by rule.
        parts.append(materialize(single_table_rows(tables, replace(catalog, patterns=()))[0].select(*SUB_RESULT_COLUMNS)))
    if others is not None:
        by_scan, by_plan = done["single"] is None, bool(others) and done["person_patterns"] is None
        left["person_patterns"] = [r for r in named["person_patterns"] if (by_plan if r[2] in others else by_scan)]
        left = {suite: rules for suite, rules in left.items() if suite == "person_patterns" or done[suite] is None}
    for suite, rules in left.items():
        parts += _isolated(spark, suite, rules, build[suite])
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
