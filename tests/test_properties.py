"""Pre-aggregated / fused join plans equal brute force on random small frames."""

from collections import Counter

from hypothesis import given, settings
from hypothesis import strategies as st

from verisift.operators import joins
from verisift.rules import ConceptColumn, ReferenceCheck, Relationship, Terminology

keys = st.one_of(st.none(), st.integers(0, 6))
SETTINGS = settings(max_examples=12, deadline=None)


@SETTINGS
@given(
    st.lists(st.tuples(keys, keys), min_size=0, max_size=40),
    st.lists(keys, min_size=0, max_size=10),
    st.lists(keys, min_size=0, max_size=10),
)
def test_fused_ri_matches_brute_force(spark, child, parent_a, parent_b):
    c = spark.createDataFrame(child, "fa bigint, fb int")
    pa = spark.createDataFrame([(k,) for k in parent_a], "id bigint")
    pb = spark.createDataFrame([(k,) for k in parent_b], "id int")
    t = {"c": c, "pa": pa, "pb": pb}
    rules = [Relationship("c", "fa", "pa", "id"), Relationship("c", "fb", "pb", "id"), Relationship("c", "fa", "pb", "id")]
    got = {r["name"]: (r["total_records"], r["non_null_fk"], r["violation_count"]) for r in joins.referential_integrity(t, rules).collect()}

    def brute(idx, parent):
        vals = [row[idx] for row in child]
        nn = [v for v in vals if v is not None]
        ok = {p for p in parent if p is not None}
        return (len(child), len(nn), sum(1 for v in nn if v not in ok))

    assert got == {
        "c.fa -> pa.id": brute(0, parent_a),
        "c.fb -> pb.id": brute(1, parent_b),
        "c.fa -> pb.id": brute(0, parent_b),
    }
    orphans = Counter()
    for row in child:
        if row[0] is not None and row[0] not in {p for p in parent_a if p is not None}:
            orphans[str(row[0])] += 1
    fk = {(r["key"], r["n_records"]) for r in joins.failing_keys(t, rules[:1]).collect()}
    assert fk == set(orphans.items())


@SETTINGS
@given(st.lists(keys, min_size=0, max_size=40), st.lists(keys, min_size=0, max_size=12), st.booleans())
def test_reference_check_rows_matches_left_join(spark, child, parent, exclude_nulls):
    t = {
        "c": spark.createDataFrame([(k,) for k in child], "fk bigint"),
        "p": spark.createDataFrame([(k,) for k in parent], "id bigint"),
    }
    r = joins.reference_check(t, ReferenceCheck("x", "c", "fk", "p", "id", exclude_null_keys=exclude_nulls)).collect()[0]
    total = failed = 0
    for k in child:
        if exclude_nulls and k is None:
            continue
        m = sum(1 for p in parent if p is not None and k is not None and p == k)
        total += max(m, 1)
        failed += m == 0
    assert (r["total_tested"], r["failed_records"]) == (total, failed)


@SETTINGS
@given(
    st.lists(keys, min_size=0, max_size=40),
    st.lists(st.tuples(st.integers(0, 6), st.integers(0, 4)), min_size=0, max_size=12),
    st.lists(st.tuples(st.integers(0, 4), st.booleans(), st.booleans()), min_size=0, max_size=5, unique_by=lambda x: x[0]),
)
def test_concept_breakdown_matches_naive_join(spark, codes, cmap, concepts):
    t = {
        "s": spark.createDataFrame([(k,) for k in codes], "code bigint"),
        "m": spark.createDataFrame(cmap, "source_code_id bigint, target_code_id bigint"),
        "k": spark.createDataFrame(
            [(i, None if nd else "d", None if nc else "c") for i, nd, nc in concepts], "id bigint, display string, code string"
        ),
    }
    term = Terminology("m", "source_code_id", "target_code_id", "k", "id", "display", "code")
    got = joins.concept_mapping_breakdown(t, [ConceptColumn("s", "code")], term).collect()[0]
    concept = {i: (nd, nc) for i, nd, nc in concepts}
    rows = []  # naive fanned left join, one tuple per joined row
    for c in codes:
        if c is None:
            continue
        maps = [tgt for src, tgt in cmap if src == c]
        if not maps:
            rows.append((c, True, False, None))
            continue
        for tgt in maps:
            rows.append((c, False, tgt not in concept, concept.get(tgt)))
    def bucket(pred):
        hit = [r for r in rows if pred(r)]
        return len(hit), len({r[0] for r in hit})
    no_map = bucket(lambda r: r[1])
    no_concept = bucket(lambda r: not r[1] and r[2])
    null_display = bucket(lambda r: r[3] is not None and r[3][0])
    null_code = bucket(lambda r: r[3] is not None and r[3][1])
    failed = bucket(lambda r: r[1] or r[2] or r[3][0] or r[3][1])
    assert (got["total_records"], got["distinct_ids"]) == (len(rows), len({r[0] for r in rows}))
    assert (got["failed_records"], got["failed_ids"]) == failed
    assert (got["no_map_records"], got["no_map_ids"]) == no_map
    assert (got["no_concept_records"], got["no_concept_ids"]) == no_concept
    assert (got["null_display_records"], got["null_display_ids"]) == null_display
    assert (got["null_code_records"], got["null_code_ids"]) == null_code
