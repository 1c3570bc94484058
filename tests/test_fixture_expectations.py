"""The expected counts published for the sf0.01 driver tables (FIXTURES.md B.3, B.4)."""

import os

import pytest

from verisift.operators import joins, profile, rowrules, sqlcheck
from verisift.plans import catalog as C
from verisift.plans.fixtures import fixture_tables
from verisift.rules import (
    CompletenessRule,
    ConceptColumn,
    FieldComparison,
    GroupCount,
    RangeCheck,
    ReferenceCheck,
    Relationship,
    RelationshipExists,
    RequiredFields,
    Uniqueness,
)

SF = "/root/testdata/sf0.01"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


@pytest.fixture(scope="module")
def t(spark):
    return fixture_tables(spark, SF)


def counts(df):
    return {r["name"]: (r["total_tested"], r["failed_records"]) for r in df.collect()}


def test_null_columns_and_completeness(t):
    nn = {r["column_name"]: r["non_null_count"] for r in profile.null_columns(t, ["pat"]).collect()}
    assert nn == {"id": 15000, "is_dummy": 14516, "birth_year": 13636, "death_year": 14505, "practice_id": 13333, "fax": 0}
    c = profile.column_completeness(t, [CompletenessRule("pat", "birth_year", 98.0)]).collect()[0]
    assert (c["total_rows"], c["non_null_count"], c["completeness_rate"]) == (15000, 13636, 90.91)


def test_row_rules(t):
    nd = "is_dummy = false"
    rules = [
        Uniqueness("u_ign", "pat", "birth_year"),
        Uniqueness("u_cnt", "pat", "birth_year", count_nulls=True),
        Uniqueness("u_li", "lineitem", "l_orderkey"),
        RequiredFields("req", "pat", ("birth_year",), filter=nd, check_empty=True),
        RequiredFields("req_multi", "pat", ("birth_year", "practice_id"), filter=nd),
        RangeCheck("range", "pat", "birth_year", 1900, 2000, filter=nd),
        RangeCheck("range_open", "pat", "birth_year", 1900, None),
    ] + [
        FieldComparison(op, "pat", "death_year", "birth_year", op, filter="death_year is not null")
        for op in ("ge", "gt", "le", "lt", "eq", "ne")
    ]
    got = counts(rowrules.row_checks(t, rules))
    assert got["u_ign"][1] == 13626 and got["u_cnt"][1] == 14990 and got["u_li"][1] == 45257
    assert got["req"] == (9591, 1546) and got["req_multi"] == (9591, 1844)
    assert got["range"] == (8045, 1001) and got["range_open"] == (12587, 624)
    assert {op: got[op] for op in ("ge", "gt", "le", "lt", "eq", "ne")} == {
        "ge": (12172, 1300), "gt": (12172, 1617), "le": (12172, 9839),
        "lt": (12172, 10156), "eq": (12172, 11139), "ne": (12172, 317),
    }


def test_joins(t):
    ri = joins.referential_integrity(t, [Relationship("pat", "practice_id", "customer", "c_custkey")]).collect()[0]
    assert (ri["total_records"], ri["non_null_fk"], ri["violation_count"]) == (15000, 13333, 1333)
    nd = "is_dummy = false"
    j2 = [
        ReferenceCheck("excl", "pat", "practice_id", "customer", "c_custkey", filter=nd, exclude_null_keys=True),
        ReferenceCheck("kept", "pat", "practice_id", "customer", "c_custkey", filter=nd),
        ReferenceCheck("fan", "events", "user_id", "orders", "o_custkey"),
    ]
    got = {r.name: tuple(counts(joins.reference_check(t, r))[r.name]) for r in j2}
    assert got == {"excl": (8528, 835), "kept": (9591, 1898), "fan": (95614, 0)}
    ex = joins.relationship_exists(t, RelationshipExists("x", "orders", "lineitem", (("o_orderkey", "l_orderkey"),), entity="o_orderkey"))
    assert counts(ex)["x"] == (15000, 257)


def test_concepts(t):
    b = joins.concept_mapping_breakdown(t, [ConceptColumn("lineitem", "l_suppkey")], C.TERMINOLOGY).collect()[0]
    metrics = [
        "total_records", "distinct_ids", "failed_records", "failed_ids", "no_map_records", "no_map_ids",
        "no_concept_records", "no_concept_ids", "null_display_records", "null_display_ids", "null_code_records", "null_code_ids",
    ]
    assert [b[m] for m in metrics] == [74967, 100, 31992, 44, 6088, 10, 7918, 13, 7274, 9, 11269, 13]
    r = joins.concept_mapping_rates(t, [ConceptColumn("lineitem", "l_suppkey")], C.TERMINOLOGY).collect()[0]
    assert [r[m] for m in (
        "total_records", "non_null_records", "mapping_failures", "distinct_missing_mappings", "display_failures",
        "distinct_display_failures", "total_failures", "distinct_total_failures", "pct_of_table", "pct_of_non_null",
    )] == [60000, 60000, 6088, 10, 17986, 21, 31992, 44, 53.32, 53.32]


def test_group_count_and_contracts(t):
    g = rowrules.group_count_check(t, GroupCount("g", "events", "user_id", "event_type")).collect()[0]
    assert (g["failed_records"], g["avg_count"]) == (150, 5.0)
    li, o = t["lineitem"], t["orders"]
    late = li.join(o, li["l_orderkey"] == o["o_orderkey"]).where(li["l_shipdate"] < o["o_orderdate"])
    z = sqlcheck.zero_failure("late", late, li).collect()[0]
    assert (z["total_tested"], z["failed_records"]) == (60000, 29157)


def test_relationship_table(t):
    expected = {
        ("orders", "o_custkey"): (15000, 0), ("lineitem", "l_orderkey"): (60000, 0),
        ("lineitem", "l_partkey"): (60000, 0), ("lineitem", "l_suppkey"): (60000, 0),
        ("customer", "c_nationkey"): (1500, 0), ("supplier", "s_nationkey"): (100, 0),
        ("nation", "n_regionkey"): (25, 0), ("events", "user_id"): (10000, 0),
        ("orders", "o_orderkey"): (15000, 257), ("documents", "doc_id"): (1000, 601),
        ("pages", "page_id"): (250, 152),
    }
    got = {}
    for r in joins.referential_integrity(t, C.RELATIONSHIPS).collect():
        got.setdefault((r["child"], r["fk"]), []).append((r["parent"], (r["non_null_fk"], r["violation_count"])))
    for key, val in expected.items():
        assert val in [v for _, v in got[key]], key
    assert ("supplier", (10000, 3303)) in got[("events", "user_id")]
