"""R1 for many rules, sampled failures, queries beside the caller's views, and results written twice."""

import json
import os
import re

from verisift.contract import to_contract
from verisift.operators import rowrules
from verisift.rules import FieldComparison, QueryCount, RangeCheck, RequiredFields, Uniqueness
from verisift.sources import write_results


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_ten_unique_columns_cross_the_network_once_per_type(spark, tmp_path):
    cols = [f"cast(id % {k + 3} as {'int' if k % 2 else 'bigint'}) a{k}" for k in range(6)] + ["cast(id % 7 as string) s1", "nullif(id % 5, 1) n1", "cast(id % 4 as double) * 0 d1"]
    spark.range(1000).selectExpr("id", *cols).write.parquet(str(tmp_path / "t"))
    t = {"t": spark.read.parquet(str(tmp_path / "t")), "u": spark.range(50).selectExpr("id % 9 x")}
    rules = [Uniqueness(f"r{k}", "t", f"a{k}") for k in range(6)] + [
        Uniqueness("s", "t", "s1"), Uniqueness("n", "t", "n1"), Uniqueness("nn", "t", "n1", count_nulls=True),
        Uniqueness("d", "t", "d1"), Uniqueness("x", "u", "x", filter="x > 2"), Uniqueness("none", "t", "a0", filter="id < 0"),
    ]
    df = rowrules.row_checks(t, rules)
    # One grouping by (rule, value) for each of bigint, string and double.
    assert len(re.findall(r"Exchange hashpartitioning\(rule#\d+, value#", plan_of(df))) == 3
    got = {r["name"]: (r.total_tested, r.failed_records) for r in df.collect()}
    assert got == {
        **{f"r{k}": (1000, 1000 - (k + 3)) for k in range(6)},
        "s": (1000, 993), "n": (800, 796), "nn": (1000, 996), "d": (1000, 999), "x": (32, 26), "none": (0, 0),
    }


def test_sampled_failures_are_the_smallest_hashes(spark):
    t = {"a": spark.range(5000).selectExpr("id", "cast(id % 50 as string) v", "cast(id % 3 as string) w"), "b": spark.range(10).selectExpr("id", "cast(null as string) v")}
    rules = [RangeCheck("r", "a", "v", 0, 40), RequiredFields("q", "b", ("v",)), FieldComparison("f", "a", "v", "w", "ge"), RequiredFields("fine", "a", ("id",))]
    df = rowrules.failing_samples(t, rules, 7, {"a": ("id",)})
    assert plan_of(df).count("WindowGroupLimit") >= 2  # before the shuffle and after
    rows = {}
    for r in df.collect():
        rows.setdefault(r.rule, []).append((r.seq, r.place, r.record))
    import hashlib

    bad = sorted((hashlib.md5(x.encode()).hexdigest(), x) for x in (json.dumps({"id": i}, separators=(",", ":")) for i in range(5000) if i % 50 > 40))
    assert sorted(rows["r"]) == [(k + 1, *x) for k, x in enumerate(bad[:7])]
    assert len(rows["q"]) == 7 and all(json.loads(x[2])["v"] is None for x in rows["q"]) and len(rows["f"]) == 7 and "fine" not in rows


def test_a_count_query_leaves_the_caller_s_views_alone(spark):
    t = {"region": spark.range(6).selectExpr("id k", "id % 2 g"), "other": spark.range(3).selectExpr("id k")}
    spark.range(1).createOrReplaceTempView("region")
    try:
        q = "with r as (select * from Region) select g, count(*) n from r left join `other` o on r.k = o.k and '\"other\"' <> 'x' group by g order by 1;"
        assert sorted(rowrules.query_groups(t, QueryCount("c", "region", q)).collect()) == [(0, 3), (1, 3)]
        assert spark.table("region").columns == ["id"]
        assert not [v.name for v in spark.catalog.listTables() if v.name.startswith("verisift_")]
    finally:
        spark.catalog.dropTempView("region")


def test_a_run_written_twice_is_there_once(spark, tmp_path):
    contract = to_contract(spark.createDataFrame([("a", 10, 0), ("b", 4, 1)], "suite string, total_tested bigint, failed_records bigint"), name="suite")
    for fmt in ("parquet", "csv", "json"):
        path = str(tmp_path / fmt)
        for run in ("2024-05-01T10:00", "2024-05-01T10:00", "next"):
            write_results(contract, path, fmt=fmt, run_id=run)
        assert sorted(os.listdir(path)) == ["run_id=2024-05-01T10%3A00", "run_id=next"]
        back = spark.read.option("header", True).format(fmt).load(path)
        assert back.count() == (2 if fmt == "json" else 4) and {r.run_id for r in back.collect()} == {"2024-05-01T10:00", "next"}


def test_groups_joined_on_other_columns_than_their_key(spark):
    import random

    from verisift.rules import GroupCount

    rng = random.Random(6)
    base = [(rng.choice([None, rng.randrange(25)]), rng.choice([None, 1, 1, 1, rng.randrange(6)]), rng.randrange(2)) for _ in range(60)] + [(100, 1, 0), (101, 1, 0), (102, 99, 0)]
    joined = [(rng.choice([None, 1, 1, rng.randrange(6)]), rng.randrange(2), rng.choice([None, rng.randrange(9)])) for _ in range(80)]
    t = {"b": spark.createDataFrame(base, "g int, k int, m int"), "j": spark.createDataFrame(joined, "k int, m int, v int")}
    for least in (-1, 0, 2, 4):
        rule = GroupCount("r", "b", "g", "v", joined="j", on=(("k", "k"), ("m", "m")), min_count=least)
        want = {}
        for g, k, m in base:
            want.setdefault(g, set()).update(v for a, b, v in joined if v is not None and k is not None and (a, b) == (k, m))
        got = {r.group_key: r.n for r in rowrules.group_counts(t, rule).collect()}
        assert got == {g: len(v) for g, v in want.items() if len(v) > least}
