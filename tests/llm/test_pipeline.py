"""The pipeline's stages against plain versions, each on what the one before kept."""

import hashlib

import pytest

import corpus_pipeline
from verisift.llm import pii, quality

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    from verisift.llm.common import fresh_path, table

    at, out = table(spark, SF, "documents"), [table(spark, SF, "documents")]
    for name, stage in corpus_pipeline.STAGES:
        path = fresh_path(spark, f"test-{name}")
        stage(spark, at, SF).write.parquet(path)
        at = spark.read.parquet(path)
        out.append(at)
    return out


def rows(df):
    return {r.doc_id: r for r in df.collect()}


def test_all_but_the_last_keep_the_columns(stages):
    assert all(s.columns == stages[0].columns for s in stages[:-1])


def test_quality_drops_what_the_classifier_rejects(spark, stages):
    scored = quality.classify(stages[0], spark.read.parquet(f"{SF}/labels.parquet")).collect()
    assert set(rows(stages[1])) == {r.doc_id for r in scored if r.score >= 0.3}


def test_one_of_each_group_stays(stages):
    texts = {i: r.text or "" for i, r in rows(stages[1]).items()}
    sets = {}
    for i, t in texts.items():
        w = t.encode().lower().split()
        sets[i] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
    up = {i: i for i in sets}

    def find(i):
        while up[i] != i:
            i = up[i]
        return i

    for a in sets:
        for b in sets:
            if b < a and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                up[max(x, y)] = min(x, y)
    assert set(rows(stages[2])) == {i for i in sets if find(i) == i}


def test_documents_with_benchmark_items_go(spark, stages):
    def shingles(t):
        w = (t or "").lower().split()
        return {" ".join(w[k : k + 5]) for k in range(len(w) - 4)}

    items = [shingles(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    before = rows(stages[2])
    bad = {i for i, r in before.items() if any(s and 100 * len(s & shingles(r.text)) >= 80 * len(s) for s in items)}
    assert bad and set(rows(stages[3])) == set(before) - bad


def test_personal_data_is_masked(stages):
    before, after = rows(stages[3]), rows(stages[4])
    assert {i: r.text for i, r in after.items()} == {i: pii.masked(r.text) for i, r in before.items()}
    assert all(not pii.find(r.text)[0] for r in after.values())


def test_tokens_decode_to_the_masked_texts(spark, stages):
    before, after = rows(stages[4]), rows(stages[5])
    assert {i: r.decoded_sha256 for i, r in after.items()} == {i: hashlib.sha256((r.text or "").encode()).hexdigest() for i, r in before.items()}
    assert all(r.n_tokens == len(r.ids) for r in after.values())
    assert corpus_pipeline.run(spark, SF).count() == len(after)
