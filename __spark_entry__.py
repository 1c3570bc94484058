"""

``queries()[name](spark, sf_dir)`` returns a lazy DataFrame over the driver
tables of ``sf_dir`` (plus views derived from them); ``oracle_sql()[name]`` is
the same check written as per-rule DuckDB SQL over the same tables. Every
computed column is aliased identically on both sides.
"""

from __future__ import annotations

import os
import sys
import uuid
from collections.abc import Callable
from dataclasses import replace

_HERE = os.path.dirname(os.path.abspath(__file__))
if _HERE not in sys.path:
    sys.path.insert(0, _HERE)

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from verisift.config import pattern_from_item  # noqa: E402
from verisift.contract import check_contract, to_contract  # noqa: E402
from verisift.operators import joins, profile, rowrules, sqlcheck  # noqa: E402
from verisift.operators.rollup import (  # noqa: E402
    apply_thresholds,
    failure_report,
    merge_partials,
    run_summary,
    suite_rollup,
    threshold_table,
)
from verisift.plans import catalog as C  # noqa: E402
from verisift.plans import oracle as O  # noqa: E402
from verisift.plans.fixtures import fixture_tables  # noqa: E402
from verisift.plans.suites import pattern_sub_results, person_patterns, run, run_suites  # noqa: E402
from verisift.rules import (  # noqa: E402
    FieldComparison,
    GroupCount,
    QueryCount,
    RangeCheck,
    ReferenceCheck,
    Relationship,
    RelationshipExists,
    RequiredFields,
    Uniqueness,
    Within,
)
from verisift.session import ensure_checkpoint_dir  # noqa: E402
from verisift.sources import export_rows, load_catalog_tables, register_views  # noqa: E402
from verisift.streaming import KeyedState  # noqa: E402

# The training-data operators and their pipeline can be taken out as a whole.
LLM_QUERIES: dict = {}
LLM_SQL: dict = {}
try:
    from verisift.llm import queries as _llm
except ModuleNotFoundError as e:
    if e.name != "verisift.llm":
        raise
else:
    LLM_QUERIES |= _llm.QUERIES
    LLM_SQL |= _llm.ORACLE_SQL
try:
    import corpus_pipeline as _pipeline
except ModuleNotFoundError as e:
    if e.name not in ("corpus_pipeline", "verisift.llm"):
        raise
else:
    LLM_QUERIES["pipeline"] = _pipeline.run
    if _pipeline.ORACLE_SQL:
        LLM_SQL["pipeline"] = _pipeline.ORACLE_SQL

SMOKE_DIR = "/root/testdata/sf0.001"

NOT_DUMMY = "is_dummy = false"

# ----------------------------------------------------------------------------- rules per key

UNIQUENESS = (
    Uniqueness("pat_birth_year_unique", "pat", "birth_year"),
    Uniqueness("lineitem_orderkey_unique", "lineitem", "l_orderkey"),
)
UNIQUENESS_NULLS = (Uniqueness("pat_birth_year_unique_nulls", "pat", "birth_year", count_nulls=True),)
REQUIRED = (RequiredFields("pat_has_birth_year", "pat", ("birth_year",), filter=NOT_DUMMY, check_empty=True),)
REQUIRED_MULTI = (
    RequiredFields("pat_has_birth_year_and_practice", "pat", ("birth_year", "practice_id"), filter=NOT_DUMMY),
)
RANGE = (RangeCheck("pat_birth_year_range", "pat", "birth_year", 1900, 2000, filter=NOT_DUMMY),)
RANGE_OPEN = (RangeCheck("pat_birth_year_min", "pat", "birth_year", 1900, None, exclude_nulls=False),)


def _cmp(op: str):
    return (
        FieldComparison(
            f"pat_death_{op}_birth", "pat", "death_year", "birth_year", op, filter="death_year is not null"
        ),
    )


RI_SINGLE = (Relationship("pat", "practice_id", "customer", "c_custkey"),)
RI_FILTERED = ReferenceCheck(
    "pat_practice_exists", "pat", "practice_id", "customer", "c_custkey", filter=NOT_DUMMY, exclude_null_keys=True
)
RI_FILTERED_NULLS = ReferenceCheck(
    "pat_practice_exists_with_nulls", "pat", "practice_id", "customer", "c_custkey", filter=NOT_DUMMY
)
RI_FANOUT = ReferenceCheck("event_user_has_orders", "events", "user_id", "orders", "o_custkey")
EXISTS = RelationshipExists(
    "order_has_lineitems", "orders", "lineitem", (("o_orderkey", "l_orderkey"),), entity="o_orderkey"
)
EXISTS_ROWS = RelationshipExists(
    "customer_has_events", "customer", "events", (("c_custkey", "user_id"),), entity="c_custkey", count="rows"
)
EXISTS_OTHER = RelationshipExists(
    "part_shipped_late", "lineitem", "orders", (("l_orderkey", "o_orderkey"), ("l_shipdate", "o_orderdate")), entity="l_partkey"
)
# Lines of an order, and customers, near in time and in balance.
EXISTS_RANGE = RelationshipExists(
    "order_ships_within_400_days", "orders", "lineitem", (("o_orderkey", "l_orderkey"),), entity="o_orderkey",
    within=Within("o_orderdate", "l_shipdate", 0, "400 days"),
)
EXISTS_NEAR = RelationshipExists(
    "supplier_has_customer_of_like_balance", "supplier", "customer", entity="s_suppkey", count="rows",
    within=Within("s_acctbal", "c_acctbal", -0.5, 0.5, high_open=True),
)
EXISTS_CONDITION = pattern_from_item(
    {
        "name": "customer_has_a_large_early_line", "type": "relationship", "base_table": "orders", "join_table": "lineitem", "entity": "o_custkey",
        "join_condition": """o."o_orderkey" = l."l_orderkey" AND l."l_shipdate" < DATEADD(day, 700, o."o_orderdate") -- "early"
            AND l."l_quantity" > 10 AND o."o_orderpriority" <> 'not "URGENT"' AND l."l_suppkey" <> o."o_custkey" - l."l_linenumber" """,
    }
)
RI_INTEGRITY = ReferenceCheck(
    "pat_practice_integrity", "pat", "practice_id", "customer", "c_custkey", filter=NOT_DUMMY, mode="integrity"
)
RANGE_EXPRESSION = (RangeCheck("pat_birth_year_to_date", "pat", "birth_year", 1900, "year(date '1985-06-30')", filter=NOT_DUMMY),)
UNTESTED = (
    Relationship("pat", "registered_practice_id", "customer", "c_custkey"),
    Relationship("orders", "o_custkey", "customer", "c_customer_id"),
)
# Rules whose counts need keyed state, merged from batches; parents come in other batches than their children.
KEYED = (
    Uniqueness("lineitem_orderkey_unique", "lineitem", "l_orderkey"),
    Uniqueness("pat_birth_year_unique_nulls", "pat", "birth_year", count_nulls=True, filter="id > 10"),
    Relationship("pat", "practice_id", "customer", "c_custkey", name="pat_practice", filter=NOT_DUMMY),
    Relationship("orders", "o_orderkey", "lineitem", "l_orderkey", name="order_lines"),
    Relationship("events", "user_id", "supplier", "s_suppkey", name="event_supplier"),
    C.PATTERNS[-1],
    GroupCount("order_many_parts", "lineitem", "l_orderkey", "l_partkey", min_count=4),
)
KEYED_BATCHES = {"pat": ("id", 0), "orders": ("o_orderkey", 1), "lineitem": ("l_partkey", 2), "events": ("event_id", 0), "customer": ("c_custkey", 1), "supplier": ("s_suppkey", 0)}
UNTESTED_SUITE = "moved_relationships"
# Rules of several tables and types whose values are stacked.
UNIQUE_MANY = (
    *UNIQUENESS,
    *UNIQUENESS_NULLS,
    *(Uniqueness(f"{t}_{c}_unique", t, c) for t, c in (
        ("orders", "o_orderkey"), ("orders", "o_orderdate"), ("customer", "c_name"), ("customer", "c_acctbal"),
        ("part", "p_size"), ("events", "event_type"), ("lineitem", "l_linenumber"),
    )),
    Uniqueness("order_customer_of_open_orders", "orders", "o_custkey", filter="o_orderstatus = 'O'"),
)
SAMPLED = tuple(p for p in C.PATTERNS if isinstance(p, (RequiredFields, RangeCheck, FieldComparison))) + REQUIRED_MULTI + RANGE_OPEN
SAMPLE_KEYS = {"pat": ("id",), "orders": ("o_orderkey",)}
# What a run of the catalog with faults can't test besides relationships and concept columns.
UNTESTED_RULES = (
    ("null_columns", 0, "referrals", "table referrals not found"),
    ("empty_tables", 0, "referrals", "table referrals not found"),
    ("column_completeness", len(C.COMPLETENESS), "pat.postcode", "column pat.postcode not found"),
    ("person_patterns", len(C.PATTERNS), C.UNUSABLE.name, C.UNUSABLE.reason),
    ("person_patterns", len(C.PATTERNS) + 1, "pat_has_postcode", "column pat.postcode not found"),
)
CATALOG_TABLES = ("nation", "region", "region_empty", "supplier")
COUNT_QUERY = QueryCount(
    "customer_many_orders", "customer",
    "select c.c_custkey, count(distinct o.o_orderkey) as n from customer c left join orders o on c.c_custkey = o.o_custkey "
    "and o.o_totalprice > 1000 group by c.c_custkey having count(distinct o.o_orderkey) > 12",
)
GROUP_COUNT = C.PATTERNS[-1]
THRESHOLD_OVERRIDES = {"empty_tables": 10.0}
THRESHOLD_ENV = "uat"
CHUNKS = {"referential_integrity": 5, "concept_mapping": 3, "person_patterns": 2}
TOP_K = 5

SQL_CHECK = """
select count(*) as total_tested,
       count_if(l_quantity > :max_qty) as failed_records,
       case when count_if(l_quantity > :max_qty) = 0 then 'PASS' else 'FAIL' end as pass_fail_status
from lineitem"""
SQL_CHECK_ARGS = {"max_qty": 45}


def _t(spark: SparkSession, sf_dir: str):
    return fixture_tables(spark, sf_dir)


# ----------------------------------------------------------------------------- Spark side


def _late_lines(t):
    li, o = t["lineitem"], t["orders"]
    return li.join(o, li["l_orderkey"] == o["o_orderkey"]).where(li["l_shipdate"] < o["o_orderdate"])


def _acctbal_metrics(t):
    c = t["customer"]
    m = c.agg(F.count(F.lit(1)).alias("total_tested"), F.count_if(F.col("c_acctbal") < 0).alias("failed_records"))
    return m.withColumn(
        "failure_rate",
        F.when(F.col("total_tested") > 0, F.col("failed_records").cast("double") / F.col("total_tested") * 100.0).otherwise(0.0),
    )


def _suites(t):
    return run_suites(t, C.CATALOG)


def _suite_contract(sub: DataFrame) -> DataFrame:
    return to_contract(suite_rollup(sub), name="suite", status="status")


def _chunked_partials(t) -> DataFrame:
    cat = C.CATALOG
    parts = [
        profile.null_columns_sub_results(t, cat.null_tables),
        profile.empty_tables_sub_results(t, cat.empty_tables, cat.empty_exclude),
        profile.column_completeness_sub_results(t, cat.completeness),
    ]
    frames = [suite_rollup(p) for p in parts]

    def chunks(seq, n):
        return [seq[i : i + n] for i in range(0, len(seq), n)]

    for ch in chunks(list(cat.relationships), CHUNKS["referential_integrity"]):
        frames.append(suite_rollup(joins.referential_sub_results(t, ch)))
    for ch in chunks(list(cat.patterns), CHUNKS["person_patterns"]):
        frames.append(suite_rollup(pattern_sub_results(t, ch)))
    for ch in chunks(list(cat.concepts), CHUNKS["concept_mapping"]):
        frames.append(suite_rollup(joins.concept_sub_results(t, ch, cat.terminology)))
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return merge_partials(out)


def _threshold_resolution(t) -> DataFrame:
    suites = _suites(t).withColumnRenamed("suite", "test_name")
    return apply_thresholds(
        suites, threshold_table(t["region"].sparkSession), env=THRESHOLD_ENV, overrides=THRESHOLD_OVERRIDES
    )


def _failure_report(t) -> DataFrame:
    cat = C.CATALOG
    return failure_report(
        null_columns=profile.null_columns(t, cat.null_tables),
        empty_tables=profile.empty_tables(t, cat.empty_tables, cat.empty_exclude),
        completeness=profile.column_completeness(t, cat.completeness, with_seq=True),
        referential=joins.referential_integrity(t, C.RELATIONSHIPS_WITH_MISSING, with_reason=True),
        patterns=person_patterns(t, cat.patterns),
        concepts=joins.concept_mapping_breakdown(t, C.CONCEPTS_WITH_MISSING, cat.terminology, with_sections=True),
    )


def _sql_check(spark, t, graded: bool = True) -> DataFrame:
    register_views(t)
    return sqlcheck.sql_check(spark, "lineitem_quantity_cap", SQL_CHECK, SQL_CHECK_ARGS, graded=graded)


def _catalog_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P2 over tables found by name in the catalog (here: temporary views)."""
    register_views({n: t for n, t in _t(spark, sf_dir).items() if n in CATALOG_TABLES})
    return profile.empty_tables(load_catalog_tables(spark, CATALOG_TABLES), CATALOG_TABLES)


def _merged_keyed_state(spark: SparkSession, t) -> DataFrame:
    """Three batches of new rows, the second first with other rows and then replayed; old ones compacted."""
    state = KeyedState(spark, f"{ensure_checkpoint_dir(spark).rstrip('/')}/keyed-state-{uuid.uuid4().hex}", KEYED)

    def batch(k: int):
        return {n: t[n].where(F.pmod(F.xxhash64(c) + at, F.lit(3)) == k) for n, (c, at) in KEYED_BATCHES.items()}

    state.merge(batch(0), 0, t)
    state.merge({n: df.unionByName(df) for n, df in batch(2).items() if n != "customer"}, 1, t)
    state.merge(batch(1), 1, t)
    state.compact()
    state.merge(batch(2), 2, t)
    return state.totals()


def _error_contract(t) -> DataFrame:
    """The contract, and the thresholds' verdict, of all relationships beside a suite of which none could be tested."""
    lost = joins.referential_sub_results(t, UNTESTED).withColumn("suite", F.lit(UNTESTED_SUITE))
    suites = suite_rollup(joins.referential_sub_results(t, C.RELATIONSHIPS).unionByName(lost))
    contract = export_rows(to_contract(suites, name="suite", status="status"))
    graded = apply_thresholds(suites.withColumnRenamed("suite", "test_name"), threshold_table(t["region"].sparkSession))
    return contract.join(graded.select("test_name", "pass_fail_status"), "test_name")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    cat = C.CATALOG

    def q(fn):
        return lambda spark, sf_dir: fn(_t(spark, sf_dir))

    return {
        # S2
        # S1 through the catalog
        "catalog_tables": _catalog_tables,
        "result_export": q(lambda t: export_rows(to_contract(_suites(t), name="suite", status="status"))),
        # P1-P4
        "null_columns": q(lambda t: profile.null_columns(t, ["pat"])),
        "null_columns_all": q(lambda t: profile.null_columns(t, cat.null_tables)),
        "null_columns_suite": q(lambda t: _suite_contract(profile.null_columns_sub_results(t, cat.null_tables))),
        "empty_tables": q(lambda t: profile.empty_tables(t, cat.empty_tables, cat.empty_exclude)),
        "empty_tables_suite": q(
            lambda t: _suite_contract(profile.empty_tables_sub_results(t, cat.empty_tables, cat.empty_exclude))
        ),
        "column_completeness": q(lambda t: profile.column_completeness(t, cat.completeness)),
        "column_completeness_suite": q(
            lambda t: _suite_contract(profile.column_completeness_sub_results(t, cat.completeness))
        ),
        "completeness_threshold": q(
            lambda t: profile.completeness_threshold(t["pat"], "birth_year", name="pat_birth_year_complete", min_pct=95.0)
        ),
        # R1-R5
        "uniqueness": q(lambda t: rowrules.row_checks(t, UNIQUENESS)),
        "uniqueness_count_nulls": q(lambda t: rowrules.row_checks(t, UNIQUENESS_NULLS)),
        "uniqueness_many": q(lambda t: rowrules.row_checks(t, UNIQUE_MANY)),
        "required_fields": q(lambda t: rowrules.row_checks(t, REQUIRED)),
        "required_fields_multi": q(lambda t: rowrules.row_checks(t, REQUIRED_MULTI)),
        "range_check": q(lambda t: rowrules.row_checks(t, RANGE)),
        "range_check_open": q(lambda t: rowrules.row_checks(t, RANGE_OPEN)),
        "range_check_expression": q(lambda t: rowrules.row_checks(t, RANGE_EXPRESSION)),
        **{f"field_comparison_{op}": q(lambda t, op=op: rowrules.row_checks(t, _cmp(op))) for op in ("gt", "ge", "lt", "le", "eq", "ne")},
        "group_count_check": q(lambda t: rowrules.group_count_check(t, GROUP_COUNT)),
        "group_count_groups": q(lambda t: rowrules.group_counts(t, GROUP_COUNT)),
        "person_patterns": q(lambda t: person_patterns(t, cat.patterns)),
        # J1-J6
        "referential_integrity": q(lambda t: joins.referential_integrity(t, RI_SINGLE)),
        "referential_integrity_all": q(lambda t: joins.referential_integrity(t, cat.relationships)),
        "referential_integrity_status": q(
            lambda t: joins.referential_integrity(t, C.RELATIONSHIPS_WITH_MISSING, with_reason=True).select(
                "name", "total_records", "non_null_fk", "violation_count", "status", "relationship_status", "reason"
            )
        ),
        "ri_filtered": q(lambda t: joins.reference_check(t, RI_FILTERED)),
        "ri_filtered_null_keys": q(lambda t: joins.reference_check(t, RI_FILTERED_NULLS)),
        "ri_filtered_fanout": q(lambda t: joins.reference_check(t, RI_FANOUT)),
        "ri_filtered_integrity": q(lambda t: joins.reference_check(t, RI_INTEGRITY)),
        "relationship_exists": q(lambda t: joins.relationship_exists(t, EXISTS)),
        "relationship_exists_rows": q(lambda t: joins.relationship_exists(t, EXISTS_ROWS)),
        "relationship_exists_other_entity": q(lambda t: joins.relationship_exists(t, EXISTS_OTHER)),
        "relationship_exists_range": q(lambda t: joins.relationship_exists(t, EXISTS_RANGE)),
        "relationship_exists_near": q(lambda t: joins.relationship_exists(t, EXISTS_NEAR)),
        "relationship_exists_condition": q(lambda t: joins.relationship_exists(t, EXISTS_CONDITION)),
        "unrelated_entities_range": q(lambda t: joins.unrelated_entities(t, EXISTS_RANGE)),
        "failing_references": q(lambda t: joins.failing_references(t, RI_FILTERED_NULLS)),
        "unrelated_entities": q(lambda t: joins.unrelated_entities(t, EXISTS_OTHER)),
        "concept_mapping_breakdown": q(lambda t: joins.concept_mapping_breakdown(t, cat.concepts, cat.terminology)),
        "concept_mapping_skipped": q(lambda t: joins.concept_mapping_breakdown(t, C.CONCEPTS_WITH_MISSING, cat.terminology, with_sections=True)),
        "concept_mapping_rates": q(lambda t: joins.concept_mapping_rates(t, cat.concepts, cat.terminology)),
        "failing_keys": q(lambda t: joins.failing_keys(t, cat.relationships)),
        "failing_keys_topk": q(lambda t: joins.failing_keys_topk(t, cat.relationships, TOP_K)),
        "failing_codes": q(lambda t: joins.concept_failing_codes(t, cat.concepts, cat.terminology)),
        "failing_rows": q(lambda t: rowrules.failing_rows(t, REQUIRED_MULTI[0])),
        "failing_samples": q(lambda t: rowrules.failing_samples(t, SAMPLED, TOP_K, SAMPLE_KEYS)),
        "failing_rows_duplicates": q(lambda t: rowrules.failing_rows(t, UNIQUENESS_NULLS[0])),
        # Q1-Q3
        "zero_failure": q(
            lambda t: sqlcheck.zero_failure("late_lineitems", _late_lines(t), t["lineitem"], "Lines shipped before their order date")
        ),
        "threshold_check": q(lambda t: sqlcheck.threshold_check("negative_balance", _acctbal_metrics(t), 5.0)),
        "sql_check": lambda spark, sf_dir: _sql_check(spark, _t(spark, sf_dir)),
        "sql_check_ungraded": lambda spark, sf_dir: _sql_check(spark, _t(spark, sf_dir), graded=False),
        "count_query": q(lambda t: rowrules.group_count_check(t, COUNT_QUERY)),
        # A1-A6
        "contract_error_suite": q(_error_contract),
        "check_contract": q(lambda t: check_contract(person_patterns(t, cat.patterns))),
        "threshold_resolution": q(_threshold_resolution),
        "suite_rollup": q(_suites),
        "merge_partials": q(_chunked_partials),
        "merge_keyed_state": lambda spark, sf_dir: _merged_keyed_state(spark, _t(spark, sf_dir)),
        "run_summary": q(lambda t: run_summary(_suites(t))),
        "failure_report": q(_failure_report),
        "run_failure_report": q(lambda t: run(t, C.CATALOG_WITH_FAULTS)["report"]),
        **LLM_QUERIES,
    }


# ----------------------------------------------------------------------------- DuckDB side


def oracle_sql() -> dict[str, str]:
    cat = C.CATALOG
    W = O.with_views
    suites = O.suite_rollup(cat)
    late = (
        "select count(*) as c from lineitem l join orders o on l.l_orderkey = o.o_orderkey "
        "where l.l_shipdate < o.o_orderdate"
    )
    zero = (
        f"select 'late_lineitems' as test_name, 'Lines shipped before their order date' as test_description, "
        f"t.c as total_tested, f.c as failed_records, case when f.c = 0 then 'PASS' else 'FAIL' end as pass_fail_status, "
        f"cast(0.0 as double) as failure_threshold, {O.rate('f.c', 't.c')} as actual_failure_rate, "
        f"case when f.c = 0 then 'no failures' else cast(f.c as varchar) || ' failed' end as failure_details "
        f"from ({late}) f, (select count(*) as c from lineitem) t"
    )
    fr = "cast(count(case when c_acctbal < 0 then 1 end) as double) / count(*) * 100.0"
    thresh = (
        "select 'negative_balance' as test_name, '' as test_description, total_tested, failed_records, "
        "case when failure_rate <= 5.0 then 'PASS' else 'FAIL' end as pass_fail_status, cast(5.0 as double) as failure_threshold, "
        f"case when failure_rate = 0.0 and total_tested > 0 then {O.rate('failed_records', 'total_tested')} else failure_rate end as actual_failure_rate, "
        "case when failure_rate <= 5.0 then 'rate within the threshold' else 'rate above the threshold' end as failure_details "
        f"from (select count(*) as total_tested, count(case when c_acctbal < 0 then 1 end) as failed_records, "
        f"case when count(*) > 0 then {fr} else 0.0 end as failure_rate from customer)"
    )
    user = SQL_CHECK.replace(":max_qty", str(SQL_CHECK_ARGS["max_qty"]))
    sqlc = (
        "select 'lineitem_quantity_cap' as test_name, '' as test_description, cast(total_tested as bigint) as total_tested, "
        "cast(failed_records as bigint) as failed_records, "
        "case when upper(trim(pass_fail_status)) in ('PASS', 'FAIL') then upper(trim(pass_fail_status)) else 'ERROR' end as pass_fail_status, "
        f"cast(0.0 as double) as failure_threshold, {O.rate('failed_records', 'total_tested')} as actual_failure_rate, "
        f"cast(null as varchar) as failure_details from ({user})"
    )
    contract_patterns = (
        f"select *, {O.rate('total_tested - failed_records', 'total_tested')} as success_rate from ("
        + O.contract_of(
            f"select *, case when passed then 'PASS' else 'FAIL' end as status, '' as reason from ({O.person_patterns(cat.patterns)})", "name"
        )
        + ")"
    )
    faulty = replace(cat, relationships=C.RELATIONSHIPS_WITH_MISSING, concepts=C.CONCEPTS_WITH_MISSING)
    lost = f"select * replace ('{UNTESTED_SUITE}' as suite) from ({O.referential_sub(UNTESTED, _present_columns())})"
    untested = O.suite_rollup_of(O.union([O.referential_sub(C.RELATIONSHIPS), lost]))
    error_contract = (
        f"select e.*, g.pass_fail_status from ({O.result_export(untested)}) e "
        f"join ({O.threshold_resolution(untested, None, {})}) g using (test_name)"
    )
    out = {
        "result_export": O.result_export(suites),
        "catalog_tables": O.empty_tables(CATALOG_TABLES),
        "null_columns": O.null_columns(["pat"]),
        "null_columns_all": O.null_columns(cat.null_tables),
        "null_columns_suite": O.suite_contract(O.null_sub(cat.null_tables)),
        "empty_tables": O.empty_tables(cat.empty_tables, cat.empty_exclude),
        "empty_tables_suite": O.suite_contract(O.empty_sub(cat.empty_tables, cat.empty_exclude)),
        "column_completeness": O.completeness(cat.completeness),
        "column_completeness_suite": O.suite_contract(O.completeness_sub(cat.completeness)),
        "completeness_threshold": O.completeness_threshold("pat", "birth_year", "pat_birth_year_complete", 95.0),
        "uniqueness": O.row_check(UNIQUENESS),
        "uniqueness_count_nulls": O.row_check(UNIQUENESS_NULLS),
        "uniqueness_many": O.row_check(UNIQUE_MANY),
        "required_fields": O.row_check(REQUIRED),
        "required_fields_multi": O.row_check(REQUIRED_MULTI),
        "range_check": O.row_check(RANGE),
        "range_check_open": O.row_check(RANGE_OPEN),
        "range_check_expression": O.row_check(RANGE_EXPRESSION),
        **{f"field_comparison_{op}": O.row_check(_cmp(op)) for op in ("gt", "ge", "lt", "le", "eq", "ne")},
        "group_count_check": O.group_count_check(GROUP_COUNT),
        "group_count_groups": O.group_counts(GROUP_COUNT),
        "person_patterns": O.person_patterns(cat.patterns),
        "referential_integrity": O.referential(RI_SINGLE),
        "referential_integrity_all": O.referential(cat.relationships),
        "referential_integrity_status": (
            "select name, total_records, non_null_fk, violation_count, status, "
            "case status when 'PASS' then 'VALID' when 'FAIL' then 'VIOLATED' else status end as relationship_status, "
            "reason from ("
            + O.referential(C.RELATIONSHIPS_WITH_MISSING, tables_present=_present_columns(), with_reason=True)
            + ")"
        ),
        "ri_filtered": O.reference_check(RI_FILTERED),
        "ri_filtered_null_keys": O.reference_check(RI_FILTERED_NULLS),
        "ri_filtered_fanout": O.reference_check(RI_FANOUT),
        "ri_filtered_integrity": O.reference_check(RI_INTEGRITY),
        "relationship_exists_other_entity": O.relationship_exists(EXISTS_OTHER),
        "relationship_exists_range": O.relationship_exists(EXISTS_RANGE),
        "relationship_exists_near": O.relationship_exists(EXISTS_NEAR),
        "relationship_exists_condition": O.relationship_exists(EXISTS_CONDITION),
        "unrelated_entities_range": O.unrelated_entities(EXISTS_RANGE),
        "failing_references": O.failing_references(RI_FILTERED_NULLS),
        "unrelated_entities": O.unrelated_entities(EXISTS_OTHER),
        "relationship_exists": O.relationship_exists(EXISTS),
        "relationship_exists_rows": O.relationship_exists(EXISTS_ROWS),
        "concept_mapping_breakdown": O.concept_breakdown(cat.concepts, cat.terminology),
        "concept_mapping_skipped": O.concept_breakdown(C.CONCEPTS_WITH_MISSING, cat.terminology, with_sections=True, present=_present_columns()),
        "concept_mapping_rates": O.concept_rates(cat.concepts, cat.terminology),
        "failing_keys": O.failing_keys(cat.relationships),
        "failing_keys_topk": O.failing_keys_topk(cat.relationships, TOP_K),
        "failing_codes": O.concept_failing_codes(cat.concepts, cat.terminology),
        "failing_rows": O.failing_rows(REQUIRED_MULTI[0], O.table_columns("pat")),
        "failing_samples": O.failing_samples(SAMPLED, TOP_K, SAMPLE_KEYS),
        "failing_rows_duplicates": O.failing_rows(UNIQUENESS_NULLS[0], O.table_columns("pat")),
        "zero_failure": zero,
        "threshold_check": thresh,
        "sql_check": sqlc,
        "sql_check_ungraded": f"select * replace ('PASS' as pass_fail_status) from ({sqlc})",
        "count_query": (
            f"select {O.q(COUNT_QUERY.name)} as name, (select count(*) from customer) as total_tested, "
            f"count(*) as failed_records, avg(n) as avg_count, true as passed from ({COUNT_QUERY.query})"
        ),
        "contract_error_suite": error_contract,
        "check_contract": contract_patterns,
        "threshold_resolution": O.threshold_resolution(suites, THRESHOLD_ENV, THRESHOLD_OVERRIDES),
        "suite_rollup": suites,
        "merge_partials": O.merge_partials(cat, CHUNKS),
        "merge_keyed_state": O.keyed_totals(KEYED),
        "run_summary": O.run_summary(suites),
        "failure_report": O.failure_report(faulty, _present_columns()),
        "run_failure_report": O.failure_report(faulty, _present_columns(), UNTESTED_RULES),
    }
    return {k: W(v) for k, v in out.items()} | LLM_SQL


def _present_columns():
    rules = (*C.RELATIONSHIPS_WITH_MISSING, *UNTESTED)
    names = {r.child for r in rules} | {r.parent for r in rules} | {c.table for c in C.CONCEPTS_WITH_MISSING}
    return {n: O.table_columns(n) for n in names}


# ----------------------------------------------------------------------------- smoke


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: the full six-suite run on sf0.001, one row per suite."""
    return _suites(fixture_tables(spark, SMOKE_DIR))
