"""What is shuffled stays near the input; hot keys are still dealt into parts."""

import pytest

from verisift.operators import joins
from verisift.rules import RelationshipExists, Within


def shuffled(df):
    """Rows written to all shuffles of ``df``'s run."""
    df.collect()

    def walk(p):
        if p.nodeName() == "AdaptiveSparkPlan":
            return walk(p.executedPlan())
        if p.nodeName().endswith("QueryStage"):
            return walk(p.plan())
        if p.nodeName() == "ReusedExchange":
            return 0
        own = p.metrics().get("shuffleRecordsWritten")
        below = p.children()
        return (own.get().value() if own.isDefined() else 0) + sum(walk(below.apply(i)) for i in range(below.size()))

    return walk(df._jdf.queryExecution().executedPlan())


RULES = {
    "range": RelationshipExists("r", "b", "j", (("k", "k"),), entity="k", within=Within("x", "x", 0, 10)),
    "range_other_entity": RelationshipExists("r", "b", "j", (("k", "k"),), entity="e", within=Within("x", "x", 0, 10)),
    "condition": RelationshipExists("r", "b", "j", (("k", "k"),), entity="e", condition="b.x + j.x > 10"),
    "other_entity": RelationshipExists("r", "b", "j", (("k", "k"), ("x", "y")), entity="e"),
}


@pytest.mark.parametrize("name", RULES)
@pytest.mark.parametrize("report", [joins.relationship_exists, joins.unrelated_entities])
def test_many_keys_are_not_copied(spark, name, report):
    n = 20_000
    base = spark.range(n).selectExpr("id k", "id % 40 x", "id + 5 e")
    joined = spark.range(n).selectExpr("id + 1000 k", "id % 40 x", "(id + 7) % 40 y")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = report({"b": base, "j": joined}, RULES[name])
        assert shuffled(out) < 12 * 2 * n
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_only_hot_keys_have_parts(spark):
    left = spark.range(60_000).selectExpr("if(id % 3 = 0, 7, id) k", "id e", "cast(id % 5 as double) x")
    right = spark.range(30_000).selectExpr("cast(id as int) j", "cast(id % 5 as float) y", "-0.0D z")
    own, theirs = joins._dealt(left, right, [("k", "j")], ["e"])
    assert {r["__part"] for r in own.where("k = 7").collect()} == set(range(joins.SALTS))
    assert theirs.where("j = 7").count() == joins.SALTS and theirs.count() < 1.2 * 30_000
    assert own.count() == 60_000
    met = own.join(theirs, (own["k"] == theirs["j"]) & (own["__part"] == theirs["__salt"])).count()
    assert met == left.join(right, left["k"] == right["j"]).count()
    # Types that may hash apart: parts for all. Both zeros are one key.
    assert joins._dealt(left, right, [("x", "y")], ["e"])[1].count() == 30_000 * joins.SALTS
    own, theirs = joins._dealt(left.selectExpr("0.0D a", "e"), right, [("a", "z")], ["e"])
    assert theirs.count() == 30_000 * joins.SALTS and own.select("__part").distinct().count() == joins.SALTS
