"""J3 with ranges and conditions against plain loops; hot keys, odd values, and the plan."""

import datetime as dt
import random

import pytest

from verisift.operators.joins import relationship_exists, unrelated_entities
from verisift.rules import RelationshipExists, Within

SCHEMA_B = "id long, k long, x double, d timestamp, j string, `b c` int"
SCHEMA_J = "k long, x double, d timestamp, b string, n int"


def rows(seed, n, m, hot=0.4):
    rng = random.Random(seed)
    day = dt.datetime(2024, 3, 30)

    def some(maker, nulls=0.05):
        return None if rng.random() < nulls else maker()

    def key():
        return 7 if rng.random() < hot else rng.randrange(12)

    def x():
        return rng.choice([rng.randrange(-40, 40) / 2, rng.uniform(-20, 20)])

    def when():
        return day + dt.timedelta(seconds=rng.choice([rng.randrange(-20 * 86400, 20 * 86400), 86400 * rng.randrange(-9, 9)]))

    base = [(rng.randrange(n // 2), some(key), some(x), some(when), rng.choice("pq"), some(lambda: rng.randrange(5))) for _ in range(n)]
    joined = [(some(key), some(x), some(when), rng.choice("pqr"), some(lambda: rng.randrange(9))) for _ in range(m)]
    return base, joined


def plain(base, joined, match, count="entities", keep=lambda r: True):
    base = [r for r in base if keep(r)]
    lone = [r for r in base if not any(match(r, j) for j in joined)]
    if count == "rows":
        return len(base), len(lone)
    return len({r[0] for r in base}), len({r[0] for r in lone})


def inside(v, low, high, low_open=False, high_open=False):
    return (low is None or (v > low if low_open else v >= low)) and (high is None or (v < high if high_open else v <= high))


def run(spark, base, joined, rule):
    t = {"b": spark.createDataFrame(base, SCHEMA_B), "j": spark.createDataFrame(joined, SCHEMA_J)}
    out = relationship_exists(t, rule)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    r = out.first()
    if rule.count == "entities":
        assert unrelated_entities(t, rule).count() == r.failed_records
    return r.total_tested, r.failed_records


@pytest.mark.parametrize("count", ["entities", "rows"])
@pytest.mark.parametrize("low, high, low_open, high_open", [(-0.5, 0.5, False, True), (0, 3, True, False), (2, None, False, False), (None, -15, False, True), (0, 0, False, False)])
@pytest.mark.parametrize("keys", [(), (("k", "k"),)])
def test_numbers(spark, count, low, high, low_open, high_open, keys):
    base, joined = rows(1, 300, 60)
    w = Within("x", "x", low, high, low_open, high_open)

    def match(b, j):
        if None in (b[2], j[1]) or keys and (b[1] is None or b[1] != j[0]):
            return False
        return inside(j[1], None if low is None else b[2] + low, None if high is None else b[2] + high, low_open, high_open)

    rule = RelationshipExists("r", "b", "j", keys, count=count, within=w)
    assert run(spark, base, joined, rule) == plain(base, joined, match, count)


@pytest.mark.parametrize("zone", ["UTC", "Europe/Berlin"])
@pytest.mark.parametrize("low, high", [(0, "2 days"), ("-3 hours", "5 hours"), ("-1 weeks", 0), ("90 minutes", None)])
def test_times_over_a_clock_change(spark, zone, low, high):
    base, joined = rows(2, 300, 120)
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        t = {"b": spark.createDataFrame(base, SCHEMA_B), "j": spark.createDataFrame(joined, SCHEMA_J)}
        rule = RelationshipExists("r", "b", "j", (("k", "k"),), within=Within("d", "d", low, high, high_open=True))
        got = relationship_exists(t, rule).first()
        t["b"].createOrReplaceTempView("range_b")
        t["j"].createOrReplaceTempView("range_j")

        def moved(offset):
            return f"bb.d + interval '{offset.split()[0]}' {offset.split()[1].rstrip('s')}" if offset else "bb.d"

        terms = ["bb.k = jj.k"] + [f"jj.d >= {moved(low)}"] + ([f"jj.d < {moved(high)}"] if high is not None else [])
        want = spark.sql(f"select count(distinct id) n from range_b bb where not exists (select 1 from range_j jj where {' and '.join(terms)})").first().n
        assert got.failed_records == want and 0 < want < got.total_tested
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
        spark.catalog.dropTempView("range_b")
        spark.catalog.dropTempView("range_j")


@pytest.mark.parametrize("count", ["entities", "rows"])
@pytest.mark.parametrize("ranged", [False, True])
def test_conditions_and_sides(spark, count, ranged):
    base, joined = rows(3, 300, 80)
    rule = RelationshipExists(
        "r", "b", "j", (("k", "k"),), filter="x is not null", count=count, base_on="j = 'p'", joined_on="n > 3 or n is null",
        condition="(j.b <> b.j or b.`b c` is null) and j.n is distinct from b.`b c`", within=Within("x", "x", -9, 9) if ranged else None,
    )

    def match(b, j):
        if b[1] is None or b[1] != j[0] or b[4] != "p" or not (j[4] is None or j[4] > 3):
            return False
        if ranged and (j[1] is None or not -9 <= j[1] - b[2] <= 9):
            return False
        return (j[3] != b[4] or b[5] is None) and j[4] != b[5]

    assert run(spark, base, joined, rule) == plain(base, joined, match, count, lambda r: r[2] is not None)


def test_empty_sides_and_bad_ranges(spark):
    base, joined = rows(4, 40, 20)
    rule = RelationshipExists("r", "b", "j", within=Within("x", "x", 0, 1))
    assert run(spark, base, [], rule) == (len({r[0] for r in base}),) * 2
    assert run(spark, [], joined, rule) == (0, 0)
    for low, high, column in ((3, 2, "x"), ("1 days", "23 hours", "d"), (0, "1 days", "x"), (0, 5, "d")):
        with pytest.raises(ValueError):
            run(spark, base, joined, RelationshipExists("r", "b", "j", within=Within(column, column, low, high)))
    for bad in (dict(), dict(within=Within("x", "x", 0, 1), condition="b.k <> j.k")):
        with pytest.raises(ValueError):
            RelationshipExists("r", "b", "j", **bad)
    with pytest.raises(ValueError):
        Within("x", "x")


def test_one_key_on_every_row_is_spread(spark):
    """With one key, and bases in one bucket, the join is still dealt into SALTS parts."""
    base = spark.range(40_000).selectExpr("id", "7L k", "id x")
    joined = spark.range(20_000).selectExpr("7L k", "id + 10000 x")
    rule = RelationshipExists("r", "b", "j", (("k", "k"),), within=Within("x", "x", 0, 1000))
    r = relationship_exists({"b": base, "j": joined}, rule).first()
    # Matched: from 10,000 - 1,000 on to the last joined value.
    assert (r.total_tested, r.failed_records) == (40_000, 9_000 + 40_000 - 30_000)
