"""Concept checks by arithmetic, columns that can't be tested, and the report of a whole run."""

from verisift.operators import joins
from verisift.plans import catalog as C
from verisift.plans.fixtures import fixture_tables
from verisift.plans.suites import run
from verisift.rules import Catalog, ConceptColumn, Relationship, RequiredFields, Terminology, UnusableRule

TERM = Terminology("cm", "src", "tgt", "con", "id", "display", "code")


def test_many_map_rows_to_one_concept_are_numbers(spark):
    """10^5 map rows of one source and target, and of 10^5 sources to one unknown concept, make no rows."""
    t = {
        "s": spark.createDataFrame([(1,), (1,), (2,), (None,), (9,)], "code long"),
        "cm": spark.range(100_000).selectExpr("1L src", "7L tgt").union(spark.range(100_000).selectExpr("id + 2 src", "8L tgt")),
        "con": spark.createDataFrame([(7, "seven", None), (7, None, "7")], "id long, display string, code string"),
    }
    r = joins.concept_mapping_breakdown(t, [ConceptColumn("s", "code")], TERM).first()
    # Codes 2 and 9 have a map row without concept; each row of code 1 joins 2 x 10^5 rows.
    assert (r.total_records, r.distinct_ids) == (400_002, 3)
    assert (r.no_concept_records, r.no_concept_ids, r.null_display_records, r.null_code_records) == (2, 2, 200_000, 200_000)
    assert (r.failed_records, r.failed_ids, r.no_map_records) == (400_002, 3, 0)
    rates = joins.concept_mapping_rates(t, [ConceptColumn("s", "code")], TERM).first()
    assert (rates.total_records, rates.non_null_records, rates.total_failures, rates.display_failures) == (5, 4, 400_002, 400_000)
    codes = joins.concept_codes(t, [ConceptColumn("s", "code")], TERM)
    assert {x.code: x.fan for x in codes.collect()} == {"1": 200_000, "2": 1, "9": 1, None: 1}


def test_a_missing_column_neither_passes_nor_fails(spark):
    t = {
        "s": spark.createDataFrame([(1,)], "code long"),
        "cm": spark.createDataFrame([(1, 7)], "src long, tgt long"),
        "con": spark.createDataFrame([(7, "a", "b")], "id long, display string, code string"),
    }
    columns = [ConceptColumn("s", "code"), ConceptColumn("s", "gone"), ConceptColumn("lost", "code")]
    for frame in (joins.concept_mapping_breakdown, joins.concept_mapping_rates):
        got = {r["name"]: (r.passed, r.status, r.reason, r.total_records) for r in frame(t, columns, TERM).collect()}
        assert got == {
            "s.code": (True, "PASS", None, 1),
            "s.gone": (None, "SKIPPED", "column s.gone not found", None),
            "lost.code": (None, "SKIPPED", "table lost not found", None),
        }


def test_a_run_s_report_names_everything_that_failed_or_was_not_tested(spark):
    t = fixture_tables(spark, "/root/testdata/sf0.001")
    out = run(t, C.CATALOG_WITH_FAULTS)
    got = {(r.suite, r.item): r.reason for r in out["report"].where("section = 'untested'").collect()}
    assert got == {
        ("null_columns", "referrals"): "table referrals not found",
        ("empty_tables", "referrals"): "table referrals not found",
        ("column_completeness", "pat.postcode"): "column pat.postcode not found",
        ("referential_integrity", "pat.registered_practice_id -> customer.c_custkey"): "column pat.registered_practice_id not found",
        ("person_patterns", "pattern_without_type"): "KeyError: type",
        ("person_patterns", "pat_has_postcode"): "column pat.postcode not found",
        ("concept_mapping", "pat.ethnicity_concept_id"): "column pat.ethnicity_concept_id not found",
    }
    bad = {(r.suite, r.rule) for r in out["rules"].where("status <> 'PASS'").collect()}
    assert {(r.suite, r.item) for r in out["report"].collect()} == bad
    assert out["rules"].where("suite like '\\\\_\\\\_%'").count() == 0


def test_a_rule_that_raises_has_a_line_with_its_whole_reason(spark):
    t = {"a": spark.createDataFrame([(1, "x")], "id long, v string")}
    long = "v = '" + "y" * 700 + "' and nothing_like_it = 1"
    cat = Catalog(
        relationships=[Relationship("a", "id", "a", "id"), Relationship("a", "id", "b", "id")],
        patterns=[RequiredFields("ok", "a", ("id",)), RequiredFields("bad", "a", ("id",), filter=long), UnusableRule("odd", "why")],
    )
    got = {r.item: r.reason for r in run(t, cat)["report"].collect()}
    assert set(got) == {"a.id -> b.id", "bad", "odd"} and "nothing_like_it" in got["bad"]
