"""Keyed state: batches merged, replayed and compacted give the whole tables' counts."""

import random

import pytest

from verisift.operators.joins import referential_integrity
from verisift.operators.rowrules import group_count_check, row_checks
from verisift.rules import FieldComparison, GroupCount, Relationship, Uniqueness
from verisift.streaming import KeyedState

RULES = (
    Uniqueness("u", "child", "v"),
    Uniqueness("un", "child", "v", count_nulls=True, filter="fk > 2 or fk is null"),
    Relationship("child", "fk", "parent", "id", name="f"),
    Relationship("child", "v", "parent", "code", name="g", filter="v <> 3.5"),
    GroupCount("c", "child", "fk", "v", min_count=2),
    GroupCount("j", "parent", "id", "v", joined="child", on=(("id", "fk"),), join_filter="v > 0", min_count=1),
)


def made(seed, n):
    rng = random.Random(seed)
    child = [(rng.choice([None, 1, 1, 1, rng.randrange(12)]), rng.choice([None, 0.0, -0.0, rng.randrange(8) / 2])) for _ in range(n)]
    parent = [(rng.choice([None, rng.randrange(12)]), rng.choice([None, float(rng.randrange(4))])) for _ in range(n // 4)]
    return child, parent


def frames(spark, child, parent):
    return {"child": spark.createDataFrame(child, "fk int, v double"), "parent": spark.createDataFrame(parent, "id long, code double")}


def whole(t):
    out = {r["name"]: (r.total_tested, r.failed_records) for r in row_checks(t, RULES[:2]).collect()}
    # A filter is part of a rule's rows.
    for r in referential_integrity(t, RULES[2:4]).collect():
        out[r["name"]] = (r.non_null_fk, r.violation_count)
    for rule in RULES[4:]:
        r = group_count_check(t, rule).first()
        out[rule.name] = (r.total_tested, r.failed_records)
    return out


def totals(state):
    return {r.rule: (r.total_tested, r.failed_records) for r in state.totals().collect()}


def test_batches_replays_and_compaction(spark, tmp_path):
    parts = [made(k, 60) for k in range(4)]
    none = frames(spark, [], [])
    state = KeyedState(spark, str(tmp_path / "s"), RULES)
    assert totals(state) == {r: (0, 0) for r in ("u", "un", "f", "g", "c", "j")}

    def union(ks):
        return frames(spark, sum((parts[k][0] for k in ks), []), sum((parts[k][1] for k in ks), []))

    state.merge(frames(spark, *parts[0]), 0)
    state.merge(frames(spark, *parts[1]), 1)
    assert totals(state) == whole(union([0, 1]))
    state.merge(frames(spark, *parts[1]), 1)  # the same rows again
    assert totals(state) == whole(union([0, 1]))
    state.merge(frames(spark, *parts[2]), 0)  # an older batch, with other rows
    assert totals(state) == whole(union([2, 1]))
    state.compact()
    assert totals(state) == whole(union([2, 1]))
    state.merge(frames(spark, *parts[3]), 1)  # the last one can still be replayed
    state.merge({"parent": frames(spark, *parts[0])["parent"]}, 2, none)  # late parents alone
    late = union([2, 3])
    late["parent"] = union([2, 3, 0])["parent"]
    assert totals(state) == whole(late)
    with pytest.raises(ValueError, match="compacted"):
        state.merge(frames(spark, *parts[0]), 0)
    # A run that died before its commit has left an attempt that nobody reads.
    frames(spark, *parts[0])["child"].selectExpr("0 rule", "'x' key", "'y' sub", "1L n", "0L parent").write.parquet(state._delta_at(3, "dead"))
    assert totals(KeyedState(spark, str(tmp_path / "s"), RULES)) == whole(late)


def test_a_stream_of_rows(spark, tmp_path):
    child, parent = made(9, 90)
    t = frames(spark, child, parent)
    for k in range(3):
        t["child"].where(f"pmod(hash(v), 3) = {k}").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    state = KeyedState(spark, str(tmp_path / "s"), RULES)
    state.merge({"parent": t["parent"]}, 0, t)

    def write(batch, batch_id):
        state.merge({"child": batch}, batch_id + 1, t)

    stream = spark.readStream.schema("fk int, v double").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    stream.writeStream.foreachBatch(write).option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start().awaitTermination()
    assert totals(state) == whole(t)


def test_rules_that_need_no_keys_are_refused(spark, tmp_path):
    for bad in (FieldComparison("x", "t", "a", "b", "gt"),):
        with pytest.raises(TypeError):
            KeyedState(spark, str(tmp_path), [bad])
    with pytest.raises(ValueError):
        KeyedState(spark, str(tmp_path), [GroupCount("x", "a", "k", "v", joined="b", on=(("z", "k"),))])


def test_large_changes_meet_the_state_without_a_join(spark, tmp_path, monkeypatch):
    """Every key of a large change is grouped once with the state; a small change picks its keys from it first."""
    plans, old = [], KeyedState._differences

    def noted(self, *args):
        out = old(self, *args)
        plans.append(out._jdf.queryExecution().executedPlan().toString())
        return out

    monkeypatch.setattr(KeyedState, "_differences", noted)
    state = KeyedState(spark, str(tmp_path / "s"), [Uniqueness("u", "t", "v")])
    for k, some in enumerate([spark.range(1000), spark.range(500, 1500), spark.range(5)]):
        state.merge({"t": some.selectExpr("id v")}, k)
    assert ["LeftSemi" in p for p in plans] == [False, False, True]
    assert totals(state) == {"u": (2005, 505)}
