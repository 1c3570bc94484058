"""Hand-made edge frames: NULL / blank / unparsable / bounds / empty / missing
column / duplicate parents and map rows / roll-up arithmetic."""

from __future__ import annotations

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from verisift.contract import check_contract, to_contract
from verisift.operators import joins, profile, rowrules, sqlcheck
from verisift.operators.rollup import (
    apply_thresholds,
    merge_partials,
    run_summary,
    suite_rollup,
    threshold_table,
)
from verisift.rules import (
    CompletenessRule,
    ConceptColumn,
    FieldComparison,
    RangeCheck,
    ReferenceCheck,
    Relationship,
    RequiredFields,
    Terminology,
    Uniqueness,
)


def rows(df, *cols):
    return [tuple(r[c] for c in cols) for r in df.collect()]


def one(df):
    out = df.collect()
    assert len(out) == 1
    return out[0]


# ----------------------------------------------------------------------------- profile


def test_empty_table_profiles(spark):
    empty = spark.createDataFrame([], "id bigint, name string")
    t = {"e": empty}
    nc = profile.null_columns(t)
    assert rows(nc, "column_name", "is_all_null") == [("id", False), ("name", False)]
    et = one(profile.empty_tables(t))
    assert et["is_empty"] and et["row_count"] == 0
    cc = one(profile.column_completeness(t, [CompletenessRule("e", "name", 100.0)]))
    assert cc["status"] == "ERROR" and cc["passed"] is False and cc["completeness_rate"] is None
    p4 = one(profile.completeness_threshold(empty, "name", name="x"))
    assert p4["pass_fail_status"] == "PASS" and p4["total_tested"] == 0


def test_all_null_column_is_flagged(spark):
    t = {"one": spark.createDataFrame([(1, None)], "id int, v string")}
    res = dict(rows(profile.null_columns(t), "column_name", "is_all_null"))
    assert res == {"id": False, "v": True}


def test_completeness_rounds_before_comparing(spark):
    df = spark.range(100000).select(F.when(F.col("id") < 4, None).otherwise(F.col("id")).alias("v"))
    cc = one(profile.column_completeness({"t": df}, [CompletenessRule("t", "v", 100.0)]))
    assert cc["completeness_rate"] == 100.0 and cc["passed"] and cc["missing_rows"] == 4
    p4 = one(profile.completeness_threshold(df, "v", name="v", min_pct=100.0))
    assert p4["pass_fail_status"] == "FAIL" and p4["failed_records"] == 4


def test_empty_tables_like_exclusion(spark):
    df = spark.range(1)
    t = {"A_BACKUP": df, "XBACKUP": df, "B_OLD": df, "KEEP": df, "OLDER": df}
    names = sorted(r["table_name"] for r in profile.empty_tables(t).collect())
    # "_" is a LIKE wildcard: XBACKUP matches %_BACKUP as well.
    assert names == ["KEEP", "OLDER"]


def test_missing_table_is_error_row(spark):
    t = {"a": spark.range(2)}
    sub = profile.null_columns_sub_results(t, ["a", "ghost"])
    st = dict(rows(sub, "rule", "status"))
    assert st == {"a.id": "PASS", "ghost": "ERROR"}


# ----------------------------------------------------------------------------- row rules


@pytest.fixture()
def blanks(spark):
    data = [(1, None, False), (2, "", False), (3, "  ", False), (4, "x", False), (5, None, None), (6, None, True)]
    return {"p": spark.createDataFrame(data, "id int, f string, is_dummy boolean")}


def test_required_fields_blank_semantics(blanks):
    plain = RequiredFields("plain", "p", ("f",), filter="is_dummy = false")
    empty = RequiredFields("empty", "p", ("f",), filter="is_dummy = false", check_empty=True)
    res = {r["name"]: (r["total_tested"], r["failed_records"]) for r in rowrules.row_checks(blanks, [plain, empty]).collect()}
    # NULL flag and TRUE flag rows are excluded by "is_dummy = false".
    assert res == {"plain": (4, 1), "empty": (4, 3)}


def test_unparsable_and_bounds(spark):
    data = [("abc",), ("",), (" 12 ",), ("1899",), ("1900",), ("2000",), ("2001",), (None,)]
    t = {"p": spark.createDataFrame(data, "y string")}
    r = one(rowrules.range_check(t, RangeCheck("r", "p", "y", 1900, 2000)))
    # eligible: non-NULL and non-blank -> abc, ' 12 ', 1899, 1900, 2000, 2001
    assert (r["total_tested"], r["failed_records"]) == (6, 3)  # ' 12 ' -> 12 < 1900, 1899, 2001
    r2 = one(rowrules.range_check(t, RangeCheck("r2", "p", "y", 10, 13)))
    # only ' 12 ' parses inside [10, 13]; 'abc' is NULL after the cast and never fails
    assert r2["failed_records"] == 4


def test_field_comparison_null_is_unknown(spark):
    data = [("2000", "1990"), ("1980", "1990"), ("abc", "1990"), ("2000", None), ("", "1990")]
    t = {"p": spark.createDataFrame(data, "d string, b string")}
    res = one(rowrules.field_comparison(t, FieldComparison("c", "p", "d", "b", "ge")))
    # ('2000', NULL): TRIM(NULL) <> '' is NULL -> not eligible; ('', ...) excluded as blank
    assert (res["total_tested"], res["failed_records"]) == (3, 1)


def test_unknown_comparison_rejected():
    with pytest.raises(ValueError):
        FieldComparison("c", "p", "a", "b", "between")


def test_uniqueness_null_modes(spark):
    t = {"p": spark.createDataFrame([(1,), (1,), (None,), (None,), (2,)], "k int")}
    ign = one(rowrules.uniqueness(t, Uniqueness("u", "p", "k")))
    cnt = one(rowrules.uniqueness(t, Uniqueness("u", "p", "k", count_nulls=True)))
    assert (ign["total_tested"], ign["failed_records"]) == (3, 1)
    assert (cnt["total_tested"], cnt["failed_records"]) == (5, 3)


# ----------------------------------------------------------------------------- joins


@pytest.fixture()
def rel_tables(spark):
    child = spark.createDataFrame([(1, 10), (2, 10), (3, 11), (4, None), (5, 99)], "id int, fk bigint")
    parent = spark.createDataFrame([(10,), (10,), (11,), (None,)], "id bigint")
    return {"c": child, "p": parent}


def test_ri_duplicate_parent_and_nulls(rel_tables):
    r = one(joins.referential_integrity(rel_tables, [Relationship("c", "fk", "p", "id")]))
    assert (r["total_records"], r["non_null_fk"], r["violation_count"]) == (5, 4, 1)
    assert r["pct_of_table"] == 20.0 and r["pct_of_non_null"] == 25.0 and r["status"] == "FAIL"
    # the row-counting flavour is inflated by the duplicate parent key 10
    j2 = one(joins.reference_check(rel_tables, ReferenceCheck("j2", "c", "fk", "p", "id")))
    assert (j2["total_tested"], j2["failed_records"]) == (7, 2)
    j2x = one(joins.reference_check(rel_tables, ReferenceCheck("j2", "c", "fk", "p", "id", exclude_null_keys=True)))
    assert (j2x["total_tested"], j2x["failed_records"]) == (6, 1)


def test_ri_self_reference(spark):
    org = spark.createDataFrame([(1, None), (2, 1), (3, 7)], "id bigint, parent_id bigint")
    r = one(joins.referential_integrity({"org": org}, [Relationship("org", "parent_id", "org", "id")]))
    assert (r["non_null_fk"], r["violation_count"]) == (2, 1)


def test_ri_missing_column_skipped_and_suite_error(rel_tables):
    rules = [Relationship("c", "fk", "p", "id"), Relationship("c", "nope", "p", "id")]
    res = {r["name"]: (r["status"], r["reason"]) for r in joins.referential_integrity(rel_tables, rules, with_reason=True).collect()}
    assert res["c.nope -> p.id"] == ("SKIPPED", "column c.nope not found")
    assert res["c.fk -> p.id"][0] == "FAIL"
    only_skipped = joins.referential_sub_results(rel_tables, [rules[1]])
    assert one(suite_rollup(only_skipped))["status"] == "ERROR"


def test_ri_fused_equals_per_rule_across_types(spark):
    a = spark.createDataFrame([(1, "x", 5), (2, "y", 6), (3, "zz", 7), (4, None, 5)], "id int, s string, n int")
    b = spark.createDataFrame([("x", 5), ("y", 9)], "code string, num bigint")
    d = spark.createDataFrame([(Decimal("1.0"),), (Decimal("2.5"),)], "v decimal(5,1)")
    e = spark.createDataFrame([(Decimal("1.0"),), (Decimal("3.0"),)], "w decimal(5,1)")
    t = {"a": a, "b": b, "d": d, "e": e}
    rules = [
        Relationship("a", "s", "b", "code"),  # string family
        Relationship("a", "n", "b", "num"),  # integral family (int -> bigint)
        Relationship("d", "v", "e", "w"),  # decimal: per-rule join
    ]
    fused = {r["name"]: (r["non_null_fk"], r["violation_count"]) for r in joins.referential_integrity(t, rules).collect()}
    single = {}
    for rule in rules:
        r = one(joins.referential_integrity(t, [rule]))
        single[r["name"]] = (r["non_null_fk"], r["violation_count"])
    assert fused == single
    assert fused == {"a.s -> b.code": (3, 1), "a.n -> b.num": (4, 2), "d.v -> e.w": (2, 1)}


def test_failing_keys_topk_matches_brute_force(spark):
    # one hot key holding a third of the rows, many light keys
    hot = [(i, 1000) for i in range(3000)]
    light = [(3000 + i, 2000 + (i % 500)) for i in range(6000)]
    child = spark.createDataFrame(hot + light, "id bigint, fk bigint")
    parent = spark.createDataFrame([(2000 + i,) for i in range(0, 500, 2)], "id bigint")
    t = {"c": child, "p": parent}
    rules = [Relationship("c", "fk", "p", "id")]
    got = rows(joins.failing_keys_topk(t, rules, 3).orderBy("seq"), "seq", "key", "n_records")
    counts = {}
    for _, fk in hot + light:
        if not (2000 <= fk < 2500 and (fk - 2000) % 2 == 0):
            counts[str(fk)] = counts.get(str(fk), 0) + 1
    expect = sorted(counts.items(), key=lambda kv: (-kv[1], kv[0]))[:3]
    assert got == [(i + 1, k, n) for i, (k, n) in enumerate(expect)]


def test_concept_duplicate_map_rows_fan_out(spark):
    src = spark.createDataFrame([(1,), (1,), (2,), (3,), (None,)], "code bigint")
    cmap = spark.createDataFrame([(1, 100), (1, 101), (2, 102)], "source_code_id bigint, target_code_id bigint")
    con = spark.createDataFrame([(100, "a", "A"), (101, None, "B")], "id bigint, display string, code string")
    term = Terminology("m", "source_code_id", "target_code_id", "k", "id", "display", "code")
    t = {"s": src, "m": cmap, "k": con}
    b = one(joins.concept_mapping_breakdown(t, [ConceptColumn("s", "code")], term))
    # code 1 twice x two map rows = 4 rows; code 2 -> 1 row (concept missing); code 3 -> no map
    assert b["total_records"] == 6 and b["distinct_ids"] == 3
    assert (b["no_map_records"], b["no_concept_records"], b["null_display_records"]) == (1, 1, 2)
    assert (b["failed_records"], b["failed_ids"]) == (4, 3)
    r = one(joins.concept_mapping_rates(t, [ConceptColumn("s", "code")], term))
    assert (r["total_records"], r["non_null_records"], r["mapping_failures"], r["display_failures"]) == (5, 4, 1, 2)
    assert r["total_failures"] == 4 and r["pct_of_table"] == 80.0


def test_concept_empty_source_passes(spark):
    src = spark.createDataFrame([], "code bigint")
    cmap = spark.createDataFrame([(1, 100)], "source_code_id bigint, target_code_id bigint")
    con = spark.createDataFrame([(100, "a", "A")], "id bigint, display string, code string")
    term = Terminology("m", "source_code_id", "target_code_id", "k", "id", "display", "code")
    r = one(joins.concept_mapping_rates({"s": src, "m": cmap, "k": con}, [ConceptColumn("s", "code")], term))
    assert r["passed"] and r["total_failures"] == 0 and r["pct_of_table"] == 0.0


# ----------------------------------------------------------------------------- contracts and roll-ups


def test_sql_check_edge_statuses(spark):
    ok = one(sqlcheck.sql_check(spark, "q", "select 10 as total_tested, 0 as failed_records, 'pass' as pass_fail_status"))
    assert ok["pass_fail_status"] == "PASS"
    weird = one(sqlcheck.sql_check(spark, "q", "select 10 as total_tested, 1 as failed_records, 'maybe' as pass_fail_status"))
    assert weird["pass_fail_status"] == "ERROR"
    none = one(sqlcheck.sql_check(spark, "q", "select 1 as total_tested where false"))
    assert none["pass_fail_status"] == "ERROR"
    ungraded = one(sqlcheck.sql_check(spark, "q", "select 5 as total_tested, 5 as failed_records, 'FAIL' as pass_fail_status", graded=False))
    assert ungraded["pass_fail_status"] == "PASS"
    param = one(sqlcheck.sql_check(spark, "q", "select :n as total_tested, 0 as failed_records, 'PASS' as pass_fail_status", {"n": 7}))
    assert param["total_tested"] == 7


def test_zero_failure_and_threshold(spark):
    total = spark.range(10)
    fails = spark.createDataFrame([(None,), (None,)], "x string")
    z = one(sqlcheck.zero_failure("z", fails, total))
    assert (z["total_tested"], z["failed_records"], z["pass_fail_status"]) == (10, 2, "FAIL")
    m = spark.createDataFrame([(100, 5, 5.0)], "total_tested bigint, failed_records bigint, failure_rate double")
    assert one(sqlcheck.threshold_check("t", m, 5.0))["pass_fail_status"] == "PASS"
    assert one(sqlcheck.threshold_check("t", m, 4.99))["pass_fail_status"] == "FAIL"


def test_contract_success_rate_zero_total(spark):
    df = spark.createDataFrame([("a", 0, 0), ("b", 4, 1)], "name string, total_tested bigint, failed_records bigint")
    res = {r["test_name"]: (r["success_rate"], r["actual_failure_rate"]) for r in check_contract(df).collect()}
    assert res == {"a": (0.0, 0.0), "b": (75.0, 25.0)}


def test_published_rollup_arithmetic(spark):
    # suites as published: totals / failed / status
    data = [
        ("null_columns", 710, 0, "PASS"),
        ("empty_tables", 28, 2, "FAIL"),
        ("column_completeness", 6, 1, "FAIL"),
        ("referential_integrity", 85, 44, "FAIL"),
        ("person_patterns", 13, 3, "FAIL"),
        ("concept_mapping", 28, 22, "FAIL"),
    ]
    suites = spark.createDataFrame(data, "suite string, total_tested bigint, failed_records bigint, status string")
    s = one(run_summary(suites))
    assert (s["total"], s["passed"], s["failed"]) == (6, 1, 5)
    assert (s["data_tests"], s["data_tests_failed"]) == (870, 72)
    assert round(s["success_rate"], 1) == 16.7
    # 85 relationships, 44 failing -> 48.2 % success
    subs = spark.createDataFrame(
        [("referential_integrity", i, f"r{i}", 1, 1 if i < 44 else 0, "FAIL" if i < 44 else "PASS") for i in range(85)],
        "suite string, seq int, rule string, total_tested bigint, failed_records bigint, status string",
    )
    r = one(suite_rollup(subs))
    assert (r["total_tested"], r["failed_records"]) == (85, 44)
    assert round(100 - r["failure_rate"], 1) == 48.2


def test_merge_partials_precedence(spark):
    parts = spark.createDataFrame(
        [("s", 5, 0, "PASS"), ("s", 5, 2, "FAIL"), ("s", 5, 0, "ERROR"), ("t", 3, 1, "FAIL"), ("t", 2, 0, "PASS")],
        "suite string, total_tested bigint, failed_records bigint, status string",
    )
    res = {r["suite"]: (r["total_tested"], r["failed_records"], r["status"]) for r in merge_partials(parts).collect()}
    assert res == {"s": (15, 2, "ERROR"), "t": (5, 1, "FAIL")}


def test_threshold_precedence(spark):
    res = spark.createDataFrame(
        [
            ("column_completeness", 100, 4),  # test threshold 5.0 -> PASS
            ("concept_mapping", 100, 7),  # env uat 8.0 beats category 5.0 -> PASS
            ("person_patterns", 100, 3),  # override 1.0 -> FAIL
            ("unknown_suite", 100, 1),  # no threshold -> 0.0 -> FAIL
        ],
        "test_name string, total_tested bigint, failed_records bigint",
    )
    out = apply_thresholds(res, threshold_table(spark), env="uat", overrides={"person_patterns": 1.0})
    got = {r["test_name"]: (r["failure_threshold"], r["threshold_source"], r["pass_fail_status"]) for r in out.collect()}
    assert got == {
        "column_completeness": (5.0, "test", "PASS"),
        "concept_mapping": (8.0, "environment", "PASS"),
        "person_patterns": (1.0, "override", "FAIL"),
        "unknown_suite": (0.0, "default", "FAIL"),
    }


def test_to_contract_recomputes_zero_rate(spark):
    df = spark.createDataFrame([(10, 2, 0.0)], "t bigint, f bigint, r double")
    c = one(to_contract(df, name=F.lit("x"), total="t", failed="f", failure_rate="r"))
    assert c["actual_failure_rate"] == 20.0


@pytest.mark.parametrize("pushdown", ["true", "false"])
def test_shared_scan_equals_per_suite_plans(spark, pushdown):
    from verisift.plans import catalog as C
    from verisift.plans.fixtures import fixture_tables
    from verisift.plans.suites import suite_sub_results

    before = spark.conf.get("spark.sql.parquet.aggregatePushdown")
    spark.conf.set("spark.sql.parquet.aggregatePushdown", pushdown)
    try:
        t = fixture_tables(spark, "/root/testdata/sf0.01")
        cols = ["suite", "seq", "rule", "total_tested", "failed_records", "status"]
        shared = sorted(rows(suite_sub_results(t, C.CATALOG, shared_scan=True), *cols), key=str)
        separate = sorted(rows(suite_sub_results(t, C.CATALOG, shared_scan=False), *cols), key=str)
    finally:
        spark.conf.set("spark.sql.parquet.aggregatePushdown", before)
    assert shared == separate and len(shared) == 69 + 15 + 6 + 13 + 13 + 6


def test_empty_tables_existence_probe(spark):
    t = {"full": spark.range(1000), "none": spark.range(0)}
    res = {r["table_name"]: (r["row_count"], r["is_empty"]) for r in profile.empty_tables(t, existence_only=True).collect()}
    assert res == {"full": (None, False), "none": (0, True)}


def test_empty_catalog_and_missing_terminology(spark):
    from verisift.plans.fixtures import fixture_tables
    from verisift.plans.suites import run_suites, suite_sub_results
    from verisift.rules import Catalog

    t = fixture_tables(spark, "/root/testdata/sf0.001")
    for shared in (True, False):
        assert suite_sub_results(t, Catalog(), shared_scan=shared).count() == 0
        assert run_suites(t, Catalog(), shared_scan=shared).count() == 0
    cols = [ConceptColumn("lineitem", "l_suppkey"), ConceptColumn("lineitem", "no_such_column")]
    cat = Catalog(concepts=cols)  # default terminology tables are absent
    st = {r["rule"]: r["status"] for r in suite_sub_results(t, cat).collect()}
    assert st == {"lineitem.l_suppkey": "ERROR", "lineitem.no_such_column": "ERROR"}
    from verisift.plans import catalog as C

    cat = Catalog(concepts=cols, terminology=C.TERMINOLOGY)
    st = {r["rule"]: r["status"] for r in suite_sub_results(t, cat).collect()}
    assert st == {"lineitem.l_suppkey": "FAIL", "lineitem.no_such_column": "SKIPPED"}


def test_pattern_with_missing_column_is_skipped(spark):
    from verisift.plans.fixtures import fixture_tables
    from verisift.plans.suites import suite_sub_results
    from verisift.rules import Catalog

    t = fixture_tables(spark, "/root/testdata/sf0.001")
    pats = [
        RequiredFields("ok", "pat", ("birth_year",)),
        RequiredFields("gone", "pat", ("no_such",)),
        Uniqueness("gone_table", "ghost", "id"),
    ]
    for shared in (True, False):
        st = {r["rule"]: r["status"] for r in suite_sub_results(t, Catalog(patterns=pats), shared_scan=shared).collect()}
        assert st["gone"] == "SKIPPED" and st["gone_table"] == "SKIPPED" and st["ok"] in ("PASS", "FAIL")


def test_staged_equals_single_plan(spark):
    from verisift.plans import catalog as C
    from verisift.plans.fixtures import fixture_tables
    from verisift.plans.shared_scan import public_rows, shared_sub_results
    from verisift.plans.suites import staged_sub_results

    t = fixture_tables(spark, "/root/testdata/sf0.01")
    cols = ["suite", "seq", "rule", "total_tested", "failed_records", "status", "reason"]
    lazy = sorted(rows(shared_sub_results(t, C.CATALOG), *cols), key=str)
    staged = sorted(rows(public_rows(staged_sub_results(t, C.CATALOG)), *cols), key=str)
    assert lazy == staged and not any(r[0].startswith("__") for r in staged)


def test_failure_report_caps_and_order(spark):
    from verisift.operators.rollup import failure_report

    cols = ", ".join(f"c{i:02d} string" for i in range(12))
    wide = spark.createDataFrame([tuple([None] * 12)], cols)
    rules = [CompletenessRule("w", f"c{i:02d}", 100.0) for i in range(5)]
    frames = dict(
        null_columns=profile.null_columns({"w": wide}),
        completeness=profile.column_completeness({"w": wide}, rules, with_seq=True),
    )
    for caps, n, m in (({}, 12, 5), ({"top_null_columns": 10, "top_completeness": 3}, 10, 3)):
        got = {}
        for r in failure_report(**frames, **caps).collect():
            got.setdefault(r["section"], []).append((r["seq"], r["item"], r["of_lines"]))
        assert sorted(got["all_null"]) == [(i + 1, f"w.c{i:02d}", 12) for i in range(n)]
        assert sorted(got["completeness"]) == [(i + 1, f"w.c{i:02d}", 5) for i in range(m)]
