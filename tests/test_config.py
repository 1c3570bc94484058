"""Rule mappings in the source configuration shape load into working rules."""

import datetime as dt

import pytest

from verisift.config import concepts_from_mapping, pattern_from_item, patterns_from_mapping, relationships_from_mapping, spark_filter, spark_sql
from verisift.operators.joins import referential_integrity
from verisift.plans.fixtures import fixture_tables
from verisift.plans.suites import person_patterns
from verisift.rules import UnusableRule, Within

SF = "/root/testdata/sf0.01"

PATTERNS = {
    "core_tests": {
        "tests": [
            {"name": "has_birth_year", "type": "completeness", "table": "pat", "filter": '"is_dummy" = FALSE',
             "required_fields": ["birth_year"], "check_empty_strings": True},
            {"name": "birth_year_range", "type": "range_validation", "table": "pat", "filter": '"is_dummy" = FALSE',
             "field": "birth_year", "cast_to": "INTEGER", "min_value": 1900, "max_value": "YEAR(CURRENT_DATE())",
             "exclude_nulls": True, "exclude_empty": True},
            {"name": "order_has_lines", "type": "relationship", "base_table": "orders", "join_table": "lineitem",
             "join_condition": 'o."o_orderkey" = l."l_orderkey"', "entity": "o_orderkey"},
            {"name": "practice_exists", "type": "referential_integrity", "source_table": "pat",
             "source_key": "practice_id", "reference_table": "customer", "reference_key": "c_custkey",
             "filter": '"is_dummy" = FALSE', "exclude_null_keys": True},
            {"name": "death_vs_birth", "type": "field_comparison", "table": "pat", "field1": "death_year",
             "field2": "birth_year", "comparison": "greater_than_or_equal", "cast_to": "INTEGER",
             "filter": '"death_year" IS NOT NULL'},
        ]
    }
}

RELS = {
    "order_relationships": {
        "description": "x",
        "relationships": [
            {"source_table": "orders", "foreign_key": "o_orderkey", "reference_table": "lineitem", "reference_key": "l_orderkey"},
            {"source_table": "pat", "foreign_key": "practice_id", "reference_table": "customer", "reference_key": "c_custkey"},
        ],
    }
}


def test_spark_filter():
    assert spark_filter('"is_dummy" = FALSE AND "x" IS NULL') == "`is_dummy` = FALSE AND `x` IS NULL"
    assert spark_filter("") is None


def test_loaded_rules_give_known_counts(spark):
    t = fixture_tables(spark, SF)
    pats = patterns_from_mapping(PATTERNS, as_of=dt.date(2000, 6, 30))
    got = {r["name"]: (r["total_tested"], r["failed_records"]) for r in person_patterns(t, pats).collect()}
    assert got == {
        "has_birth_year": (9591, 1546),
        "birth_year_range": (8045, 1001),
        "order_has_lines": (15000, 257),
        "practice_exists": (8528, 835),
        "death_vs_birth": (12172, 1300),
    }
    rels = relationships_from_mapping(RELS)
    ri = {r["name"]: (r["non_null_fk"], r["violation_count"]) for r in referential_integrity(t, rels).collect()}
    assert ri == {"orders.o_orderkey -> lineitem.l_orderkey": (15000, 257), "pat.practice_id -> customer.c_custkey": (13333, 1333)}


def test_concepts_and_unknown_type():
    cols = concepts_from_mapping({"concept_mapping_tests": {"tests": [{"source_table": "A", "concept_field": "c"}]}})
    assert [(c.table, c.column) for c in cols] == [("A", "c")]
    lost, good = patterns_from_mapping({"x": {"tests": [{"name": "n", "type": "no such type"}, {"name": "u", "type": "uniqueness", "table": "T", "unique_column": "id"}]}})
    assert isinstance(lost, UnusableRule) and "no such type" in lost.reason and good.column == "id"
    with pytest.raises(ValueError, match="as_of"):
        pattern_from_item({"name": "r", "type": "range_validation", "table": "T", "field": "y", "max_value": "YEAR(CURRENT_DATE())"})


def _on(condition, base="PERSON", joined="PATIENT_PERSON", **more):
    item = {"name": "r", "type": "relationship", "base_table": base, "join_table": joined, "join_condition": condition, **more}
    return pattern_from_item(item).on


def test_join_conditions_are_read_whole_or_refused():
    assert _on('per."id" = pp."person_id"') == (("id", "person_id"),)
    assert _on('pp."person_id" = per."id"') == (("id", "person_id"),)
    assert _on("p.id = prr.patient_id and prr.x = p.y", "PATIENT", "PATIENT_REGISTERED_PRACTITIONER_IN_ROLE") == (("id", "patient_id"), ("y", "x"))
    assert _on("a.id = b.ref", base_alias="b") == (("ref", "id"),)
    for bad in ("per.id = pp.person_id or per.id = pp.other", "per.id = per.other", "a.id = b.ref", "", "per.id <> pp.person_id", "per.id = pp.person_id and kind = 2", "per.id = pp.person_id and pp.x = 'open"):
        with pytest.raises(ValueError):
            _on(bad)


def test_join_conditions_beyond_equality():
    def read(condition):
        return pattern_from_item({"name": "r", "type": "relationship", "base_table": "PERSON", "join_table": "VISIT", "join_condition": condition})

    r = read("""per."id" = v."person ""id" AND v.at >= per.born /* and per.x = v.x */ AND v.at < DATEADD(day, 30, per.born)
        AND v.kind <> 'a "b" -- and per.c = 1' AND per.ok AND (v.x > per.y OR v.x IS NULL)""")
    assert r.on == (("id", 'person "id'),)
    assert r.within == Within("born", "at", 0, "30 day", high_open=True)
    assert r.joined_on == """(kind <> 'a "b" -- and per.c = 1')""".replace("kind", "`kind`")
    assert r.base_on == "(`ok`)" and r.condition == "(( j.`x` > b.`y` OR j.`x` IS NULL ))"
    with pytest.raises(ValueError):  # two upper bounds are a condition, which needs an equality
        read("per.a + 5 > v.b AND v.b BETWEEN per.a - 2 AND per.a + 9")
    r = read("per.id = v.id AND per.a + 5 > v.b AND v.b BETWEEN per.a - 2 AND per.a + 9")
    assert r.within is None and r.condition == "(b.`a` + 5 > j.`b`) AND (j.`b` BETWEEN b.`a` - 2 AND b.`a` + 9)"
    assert read("v.at BETWEEN per.born - INTERVAL '2 days' AND per.born + INTERVAL 3 HOURS").within == Within("born", "at", "-2 days", "3 HOURS")
    assert read("per.id = v.person + 1").within == Within("id", "person", -1, -1)


def test_literals_and_comments_stay_as_they_are(spark):
    assert spark_filter("name = 'say \"x\" now'") == "name = 'say \"x\" now'"
    assert spark_filter('"a""b" = \'it\'\'s "so"\' -- "c"\n and "d" = 1') == '`a"b` = \'it\'\'s "so"\' -- "c"\n and `d` = 1'
    assert spark_filter("/* \"x\" ' */ \"y\" > 1") == "/* \"x\" ' */ `y` > 1"
    with pytest.raises(ValueError, match="not closed"):
        spark_filter("name = 'open")
    df = spark.createDataFrame([('say "x" now',), ("it's",), ("say `x` now",)], "name string")
    assert df.where(spark_filter("\"name\" = 'say \"x\" now'")).count() == 1
    assert df.where(spark_filter("\"name\" = 'it''s'")).count() == 1


def test_current_time_of_a_query_is_the_run_s(spark):
    text = 'SELECT "a", CURRENT_DATE() d, CURRENT_TIMESTAMP FROM "{db}"."S"."T" t WHERE t."current_date" > CURRENT_TIMESTAMP ( ) AND x = \'CURRENT_DATE\''
    want = "SELECT `a`, DATE '2020-02-03' d, TIMESTAMP '2020-02-03' FROM `T` t WHERE t.`current_date` > TIMESTAMP '2020-02-03' AND x = 'CURRENT_DATE'"
    assert spark_sql(text, dt.date(2020, 2, 3)) == want
    with pytest.raises(ValueError, match="as_of"):
        spark_sql(text)


def test_count_query_of_the_source_format(spark):
    query = (
        'SELECT c."c_custkey", COUNT(DISTINCT o."o_orderkey") as n FROM "{source_db}"."MASKED"."customer" c '
        'LEFT JOIN "{source_db}"."MASKED"."orders" o ON c."c_custkey" = o."o_custkey" AND (o."o_totalprice" IS NULL OR o."o_totalprice" > 1000) '
        'GROUP BY c."c_custkey" HAVING COUNT(DISTINCT o."o_orderkey") > 12'
    )
    items = [{"name": "many", "type": "count_check", "table": "customer", "filter": '"c_acctbal" > 0', "count_query": query}]
    rules = patterns_from_mapping({"x": {"tests": items}})
    t = fixture_tables(spark, SF)
    got = person_patterns(t, rules).collect()[0]
    want = t["orders"].where("o_totalprice > 1000").groupBy("o_custkey").count().where("count > 12").count()
    assert (got["failed_records"], got["passed"]) == (want, True) and want > 0


def test_completeness_mapping():
    from verisift.config import DEFAULT_COMPLETENESS_RULES, completeness_from_mapping

    rules = completeness_from_mapping({"PATIENT.birth_year": 98.0, "PERSON.id": {"min_completeness": 100}})
    assert [(r.table, r.column, r.min_pct) for r in rules] == [("PATIENT", "birth_year", 98.0), ("PERSON", "id", 100.0)]
    assert [r.min_pct for r in DEFAULT_COMPLETENESS_RULES] == [95.0, 98.0, 98.0, 100.0, 100.0, 100.0]
