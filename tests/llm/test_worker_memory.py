"""What a Python worker holds at a time while the pipeline encodes texts."""

import random
import tracemalloc

import numpy as np

import pyarrow as pa
import pytest

import corpus_pipeline
from verisift.llm import bpe, phrases


def test_runs_of_texts_expand_as_one():
    rng = np.random.default_rng(3)
    counts = rng.integers(0, 4, 50)
    values = rng.integers(0, 1000, counts.sum()).astype(np.uint32)
    for sizes in ([], [0, 0], [0, 200_000, 0, 3, 0], rng.integers(0, 90_000, 12).tolist()):
        sizes = np.array(sizes, np.int64)
        seq = rng.integers(0, 50, sizes.sum()).astype(np.uint32)
        want, want_sizes = bpe.expand(seq, sizes, values, counts)
        got_sizes, got = bpe.expand_runs(seq, sizes, values, counts)
        assert (got == want).all() and got.dtype == want.dtype and (got_sizes == want_sizes).all() and len(got_sizes) == len(sizes)


def test_splitting_needs_a_few_times_the_room_of_the_texts():
    rng = random.Random(7)
    words = ["".join(rng.choices("abcdefghij", k=rng.randint(1, 9))) for _ in range(5000)]
    texts = [" ".join(rng.choices(words, k=500)) for _ in range(1500)]
    _, pattern = bpe.default_vocabulary()
    bpe.pre_tokens(texts[:1], pattern)
    tracemalloc.start()
    try:
        lengths, seq, _ = bpe.pre_tokens(texts, pattern)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert lengths.sum() == len(seq) == 750_000
    assert peak < 4 * sum(map(len, texts))


def test_the_last_stage_decodes_what_is_written(spark):
    docs = spark.createDataFrame([(1, "one two"), (2, None)], "doc_id long, text string")
    out = corpus_pipeline.tokens_stage(spark, docs, "")
    plan = out._jdf.queryExecution().executedPlan().toString()
    # One Python step in a task: ids are not put together and decoded by two workers at once.
    assert plan.count("MapInArrow") == 1 and "CoGroups" not in plan
    assert {r.doc_id: (r.n_tokens, len(r.ids)) for r in out.collect()} == {1: (2, 2), 2: (0, 0)}


def counting(monkeypatch, longest, now=None, before=None):
    """What a task of the passes over the documents does with its batches."""
    monkeypatch.setattr(phrases, "packed", lambda df, fn, schema: fn)
    monkeypatch.setattr(phrases, "_texts", lambda docs: docs)
    monkeypatch.setattr(phrases, "shuffle_width", lambda spark: 5)
    docs = type("Docs", (), {"sparkSession": None})()
    held = [bits and type("Sent", (), {"value": bits})() for bits in (now, before)]
    return phrases._counts(docs, longest, *held)


def everything():
    return phrases.Proposals(np.full(1 << 10, 255, np.uint8))


@pytest.mark.parametrize("proposed, most_mb", [(False, 100), (True, 40)])
def test_counting_phrases_needs_room_for_one_block(monkeypatch, proposed, most_mb):
    rng = random.Random(5)
    words = ["".join(rng.choices("abcdefghij", k=rng.randint(2, 9))) for _ in range(3000)]
    texts = [" ".join(rng.choices(words, k=500)) for _ in range(8000)]
    batch = pa.RecordBatch.from_pydict({"lang": ["en"] * len(texts), "text": texts})
    del texts
    # A tenth of the bitmap's bits: a hundredth of the phrases are counted by their text.
    bits = np.packbits(np.random.default_rng(1).random(1 << 20) < 0.1)
    run = counting(monkeypatch, 3, phrases.Proposals(bits) if proposed else None)
    tracemalloc.start()
    try:
        assert {r["bucket"][0] for r in run(iter([batch]))} == set(range(20))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < most_mb << 20


@pytest.mark.parametrize("longest", [3, 24])  # of 24, numbers of words don't fit 64 bits together
def test_phrases_are_counted_over_blocks_and_languages(monkeypatch, longest):
    rng = random.Random(11)
    rows = [(rng.choice(["en", "fr", "und"]), " ".join(rng.choices(["a", "B", "c\t", "é", "日本.", "x\n", ",", ""], k=rng.randrange(40)))) for _ in range(300)]
    rows += [("fr", " ".join(rng.choices("aBdefghijé", k=60))) for _ in range(3)]
    monkeypatch.setattr(phrases, "BLOCK_BYTES", 700)
    batches = [pa.RecordBatch.from_pydict({"lang": [r[0] for r in part], "text": [r[1] for r in part]}) for part in (rows[:1], rows[1:170], rows[170:])]
    want, total = {}, {}
    for lang, text in rows:
        for piece in text.replace(",", ".").replace("\n", ".").split("."):
            w = [x.lower() if x.isascii() else x for x in piece.replace("\t", " ").split(" ") if x]
            total[lang] = total.get(lang, 0) + len(w)
            for m in range(1, longest + 1):
                for k in range(len(w) - m + 1):
                    key = f"{lang}\n{' '.join(w[k : k + m])}".encode()
                    want[key] = want.get(key, 0) + 1
    got, blocks = {}, 0
    for r in counting(monkeypatch, longest, everything())(iter(batches)):
        blocks += r["bucket"] == [0]
        for k, n in zip(phrases.unpack_words(r["phrases"][0]), phrases.unpack_ints(r["n"][0]).tolist()):
            got[k] = got.get(k, 0) + n
    assert got == want | {f"{lang}\n".encode(): n for lang, n in total.items()} and blocks > 5
    # In the sample all are counted by hash.
    n = 0
    for r in counting(monkeypatch, longest)(iter(batches)):
        assert not phrases.unpack_words(r["phrases"][0])
        n += int(np.frombuffer(phrases.unsqueeze(r["counts"][0]), "<u4").sum())
    assert n == sum(want.values())
    # What a pass before has counted is left out.
    assert not list(counting(monkeypatch, longest, everything(), everything())(iter(batches)))
