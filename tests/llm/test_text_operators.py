"""Operators 1, 5, 8, 9 and 10 against plain versions, with nulls, ties, long texts and clashing names."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest

from verisift.llm import blocks, bpe, pii, quality, suffix_tree_lm, token_binary

NAMES = "doc_id long, text string, ids string, kind string, block string, size string, spans string, score string, n string, x string"
TEXTS = [
    None,
    "",
    " ",
    "\n",
    "  two  spaces  ",
    "a b\n\n c\t d e 　 f",
    "don't we've I'M 12345 x.y@z.example <|endoftext|>",
    "日本語 テスト 🙂🙂 Ünïcödé ﬁ é ́ x",
    "the same text the same text",
    "the same text the same text",
    "z" * 3000,
    " ".join(f"w{k % 977} of" for k in range(20_000)),
]


def frame(spark, texts=TEXTS, ids=None):
    ids = ids or [*range(len(texts) - 1), len(texts) - 2]  # the last id is there twice
    return spark.createDataFrame([(i, t, *["clash"] * 8) for i, t in zip(ids, texts)], NAMES).repartition(3)


def pairs(rows):
    return sorted(rows, key=str)


def test_bpe_encodes_as_the_library_and_decodes_to_the_text(spark):
    import tiktoken

    path, pattern = bpe.default_vocabulary()
    e = tiktoken.Encoding("t", pat_str=pattern, mergeable_ranks=bpe.ranks(path), special_tokens={})
    docs = frame(spark)
    encoded = bpe.encode(docs, path, pattern)
    got = [(r.doc_id, r.ids, bytes(r.decoded)) for r in bpe.decode(encoded, path).collect()]
    want = [(r.doc_id, e.encode_ordinary(r.text or ""), (r.text or "").encode()) for r in docs.collect()]
    assert pairs(got) == pairs(want)
    digests = [(r.doc_id, r.n_tokens, r.ids_sha256) for r in bpe.digests(encoded, path).collect()]
    assert pairs(digests) == pairs((i, len(x), hashlib.sha256(",".join(map(str, x)).encode()).hexdigest()) for i, x, _ in want)
    assert bpe.encode(docs.where("doc_id < 0"), path, pattern).count() == 0


def test_bpe_with_a_null_id(spark):
    path, pattern = bpe.default_vocabulary()
    docs = spark.createDataFrame([(None, "one two"), (3, None)], "doc_id long, text string")
    assert pairs((r.doc_id, len(r.ids)) for r in bpe.encode(docs, path, pattern).collect()) == pairs([(None, 2), (3, 0)])


def test_packing_of_numbers_and_words():
    rng = np.random.default_rng(1)
    for n in (0, 1, 5, 1000):
        a = (rng.integers(0, 2**32, n) >> rng.integers(0, 32, n)).astype(np.uint32)
        assert (blocks.unpack_ints(blocks.pack_ints(a)) == a).all()
        words = [bytes(rng.integers(0, 256, k % 7, np.uint8)) for k in range(n)]
        assert blocks.unpack_words(blocks.pack_words(words)) == words
        control, data = token_binary.pack_ranks(a)
        assert (token_binary.unpack_ranks(control, data, n) == a).all()
    assert list(blocks.runs(np.array([0, 5, 5, 9, 30, 31]), 6)) == [(0, 2), (2, 3), (3, 4), (4, 5)]
    assert blocks.unpack_ids(blocks.pack_ids([5, None, -1])) == [5, None, -1]


def test_token_files_round_trip(spark):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    t = Tokenizer.from_file(path)
    docs = frame(spark, [*TEXTS, "end <|endoftext|> of<|startoftext|>it <|endoftext|><|endoftext|>x <|end"])
    rows = sorted(((r.doc_id, t.encode(r.text or "", add_special_tokens=False).ids + [1]) for r in docs.collect()), key=lambda r: r[0])
    got = sorted((r.doc_id, r.n_tokens, np.frombuffer(bytes(r.ids), "<u4").tolist()) for r in token_binary.round_trip(docs, path).collect())
    assert got == sorted((i, len(x), x) for i, x in rows)
    starts = sorted((r.start, r.doc_id, r.n_tokens) for r in token_binary.round_trip(docs, path).collect())
    assert [i for _, i, _ in starts] == sorted(i for i, _ in rows)
    at = 0
    for start, _, n in starts:
        assert start == at
        at += n
    assert token_binary.round_trip(docs.where("doc_id < 0"), path).count() == 0


def test_words_encoded_by_their_parts_are_as_the_library_encodes_them():
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    t = Tokenizer.from_file(path)
    rng = random.Random(8)
    texts = [f"{c} a{c}b {c}{c}x' {c}'s{c}1{c}A" for c in map(chr, [*range(0x180), 0x300, 0x301, 0x345, 0x3A3, 0x3C2, 0x130, 0x1E9E, 0x2028, 0x3000, 0xFB01, 0x1F642])]
    alphabet = ["a", "B", "é", "É", "E\u0301", "'", "s", "RE", "ll", "1", "½", " ", "\n", "\t", ",", "--", "ß", "Σ", "ς", "\xa0", "\x85", "<|endoftext|>", "<", "|", "日"]
    texts += ["".join(rng.choices(alphabet, k=rng.randrange(25))) for _ in range(3000)]
    got = token_binary.Encoder(path).encode(texts, None)
    for text, ids in zip(texts, got):
        assert np.frombuffer(ids, "<u4").tolist() == t.encode(text, add_special_tokens=False).ids, repr(text)


def test_token_files_in_several_shards_and_with_null_ids(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(token_binary, "SHARD_IDS", 5)
    docs = spark.createDataFrame([(None, "x y"), *((k, "word " * (k % 9)) for k in range(60))], "doc_id long, text string")
    got = sorted(token_binary.round_trip(docs, public_tokenizers.path("word_bpe_49k.json")).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == [None, *range(60)]
    assert [r.n_tokens for r in got] == [3, *(k % 9 + 1 for k in range(60))]


# ------------------------------------------------------------------ personal data


def luhn(s):
    return sum(sum(divmod(int(c) * (1 + k % 2), 10)) for k, c in enumerate(reversed(s))) % 10 == 0


def base_spans(t):
    out = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(x) <= 255 for x in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        d = re.sub("[^0-9]", "", m[0])
        if 12 <= len(d) <= 19 and luhn(d):
            out.append((m.start(), 2, m.end()))
    out += [(m.start(), 3, m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return sorted(out)


def test_base_spans_are_those_of_the_patterns():
    rng = random.Random(5)
    for alphabet in ("0123456789.", "0123456789 -", "ab1@.-+%_é", "+0123456789 ().-", "01.@+- ()aZ:/\n%é"):
        for _ in range(3000):
            t = "".join(rng.choice(alphabet) for _ in range(rng.randrange(60)))
            assert pii.find(t)[0] == base_spans(t), t
    long = "1" * 20_000 + " " + "1.2." * 9000 + "a@" * 5000 + "+1" * 5000
    assert pii.find(long)[0] == base_spans(long)


def test_spans_that_anchors_add():
    def added(t):
        return [(pii.KINDS[k], t[a:z]) for a, k, z in pii.find(t)[1]]

    assert added("see https://ann:pw1@host.example/x now") == [("url", "https://ann:pw1@host.example/x")]
    assert added("IBAN: DE89 3704 0044 0532 0130 00, thanks") == [("account", "DE89 3704 0044 0532 0130 00")]
    assert added("account number 12345678") == [("account", "12345678")]
    assert added('token = "87e15d78b9d8ef29b6c1"') == [("account", "87e15d78b9d8ef29b6c1")]
    assert added("mail josé@exämple.de!") == [("email", "josé@exämple.de")]
    assert added("on account of 12 accountants; the token was taken; https://host.example/a?b=c") == []


@pytest.mark.parametrize("cue", ["API key", "Api key", "apiKey", "ApiKey", "API_key", "api_Key", "passWord", "PassWD", "sSN", "Access_Key", "pASSport"])
def test_cues_in_any_case(cue):
    for before in ("", "İ日 ", "K "):  # offsets hold where lower case is longer, and the Kelvin sign is no k
        text = f"{before}{cue}: 9F8e7d6c5b."
        at = text.index("9F8e")
        assert pii.find(text) == ([], [(at, 5, at + 10)])
        assert pii.masked(text) == f"{before}{cue}: [ACCOUNT]."
    assert pii.find("to\u212aen: 9f8e7d6c5b") == ([], [])


def test_pii_rows_and_masking(spark):
    docs = frame(spark, [*TEXTS[:-1], "ann@a.example and 10.0.0.1, +1 (377) 555-0271 x 4111 1111 1111 1111"])
    got = {r.doc_id: [(s.kind, s.start, s.end, s.base) for s in r.spans] for r in pii.detect(docs).collect()}
    assert got[10] == [("email", 0, 13, True), ("ip", 18, 26, True), ("phone", 28, 45, True), ("card", 48, 67, True)]
    assert got[0] == [] and got[1] == []
    masked = pii.redact(docs)
    assert masked.columns == docs.columns
    texts = [r.text for r in masked.collect()]
    assert "[EMAIL] and [IP], [PHONE] x [CARD]" in texts and None in texts and len(texts) == len(TEXTS)
    assert pii.redact(docs.where("doc_id < 0")).count() == 0


# ------------------------------------------------------------------ quality


def test_quality_learns_held_out_documents(spark):
    rng = random.Random(3)
    rows = []
    for k in range(600):
        words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randrange(2, 9))) for _ in range(rng.randrange(20, 90))]
        bad = k % 3 == 0
        rows.append((k, " | ".join(words) if bad else " ".join(words) + ".", int(not bad)))
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2], 0) for r in rows] + [(None, 1, 0), (5, None, 0), (9999, 1, 1)], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r.score for r in quality.classify(docs, labels).collect()}
    held = [(got[k], y) for k, _, y in rows if zlib.crc32(str(k).encode()) % 5 == 0]
    assert len(held) > 60 and all((s >= 0.3) == bool(y) for s, y in held)
    kept = {r.doc_id for r in quality.keep(docs, labels).collect()}
    assert kept == {k for k, s in got.items() if s >= 0.3}


def test_quality_of_odd_rows_and_without_labels(spark):
    docs = frame(spark)
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {round(r.score, 6) for r in quality.classify(docs, none).collect()} == {0.5}
    assert quality.keep(docs, none).columns == docs.columns
    assert quality.classify(docs.where("doc_id < 0"), none).count() == 0
    assert np.isfinite(quality.features(TEXTS)).all()


# ------------------------------------------------------------------ suffix tree


def test_suffix_tree_base_and_columns(spark):
    docs = frame(spark)
    texts = [(r.doc_id, r.text) for r in docs.collect()]
    counts = Counter()
    for i, t in texts:
        if zlib.crc32(str(i).encode()) % 7 != 2:
            counts.update([*(t or "").encode().lower().split(), "end"])
    n, v = sum(counts.values()), len(counts)
    want = []
    for i, t in texts:
        tokens = [*(t or "").encode().lower().split(), "end"]
        base = sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in tokens)
        want.append((i, zlib.crc32(str(i).encode()) % 7 == 2, len(tokens), sum(counts[w] > 0 for w in tokens), n, round(base, 5)))
    got = suffix_tree_lm.score(docs).collect()
    assert pairs(tuple(r)[:5] + (round(r.base_score, 5),) for r in got) == pairs(want)
    assert all(r.score < 0 for r in got)
    assert suffix_tree_lm.score(docs.where("doc_id < 0")).count() == 0


def model_of(texts, p_min=1e-3):
    g, n = suffix_tree_lm.grams(texts)
    out, total = [], n.sum()
    for d in range(suffix_tree_lm.DEPTH, -1, -1):
        g, back = np.unique(g & np.uint64((1 << 8 * (d + 1)) - 1), return_inverse=True)
        n = np.bincount(back, n).astype(np.int64)
        context, at = np.unique(g >> np.uint64(8), return_inverse=True)
        good = np.bincount(at, n)[at] >= max(2, p_min * total)
        out.append((g[good].astype(np.int64), n[good]))
    return suffix_tree_lm.build(out[::-1])


def test_suffix_tree_distributions_and_states():
    rng = random.Random(2)
    words = ["ab", "abc", "bca", "cab", "d", "abcd"]
    texts = [suffix_tree_lm.spelled([rng.choice(words).encode() for _ in range(rng.randrange(0, 30))]) for _ in range(200)]
    model = model_of(texts)
    probs = 10.0 ** model["log10"].astype(float)
    by_byte = probs[:, model["classes"]] * 10.0 ** model["rare"].astype(float)
    assert np.allclose(by_byte.sum(1), 1, atol=1e-4)
    # Stripes side by side give what one walk from the start gives.
    raw, _, _ = suffix_tree_lm.stream(texts * 5)
    state, want = 0, []
    for b in [10] * suffix_tree_lm.DEPTH:
        state = model["moves"][state, model["classes"][b]]
    for b in raw.tolist():
        k = model["classes"][b]
        want.append(model["log10"][state, k] + model["rare"][b])
        state = model["moves"][state, k]
    assert np.allclose(suffix_tree_lm.symbol_scores(model, raw), want, atol=1e-6)


def test_suffix_tree_beats_words_of_no_order():
    ordered = [b"one two three four "] * 200
    model = model_of(ordered)

    def score(text):
        raw, starts, ends = suffix_tree_lm.stream([text])
        return suffix_tree_lm.symbol_scores(model, raw)[starts[0] : ends[0] + 1].sum()

    assert score(b"one two three four ") > score(b"four three two one ") > score(b"xq zzv jjk wwpl ")
    assert model["retained"] > 5


@pytest.mark.parametrize("texts", [[], [b""], [b"", b""]])
def test_suffix_tree_of_nothing(texts):
    model = model_of(texts) if texts else suffix_tree_lm.build([(np.zeros(0, np.int64), np.zeros(0, np.int64))] * (suffix_tree_lm.DEPTH + 1))
    raw, _, _ = suffix_tree_lm.stream([b"ab "])
    assert np.isfinite(suffix_tree_lm.symbol_scores(model, raw)).all()


def test_suffix_tree_long_unseen_words(spark):
    rng = random.Random(5)
    texts = ["one two three four five"] * 60 + ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz0123456789") for _ in range(n)) for n in (5_000, 10_000)]
    held = [k for k in range(1000) if zlib.crc32(str(k).encode()) % 7 == 2]
    taught = [k for k in range(1000) if zlib.crc32(str(k).encode()) % 7 != 2]
    docs = spark.createDataFrame(list(zip(taught[:60] + held[:2], texts)), "doc_id long, text string")
    short, long = (next(r.score for r in suffix_tree_lm.score(docs.where(f"doc_id in ({k}) or doc_id in ({','.join(map(str, taught[:60]))})")).collect() if r.doc_id == k) for k in held[:2])
    assert short < -5_000 and long < -10_000
    assert abs(long / short - 2) < 0.1


def test_suffix_tree_learns_rare_contexts_of_a_larger_text(spark):
    rng = random.Random(8)
    words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randrange(2, 8))) for _ in range(4_000)]
    texts = [" ".join(rng.choices(words, k=rng.randrange(0, 400))) for _ in range(400)]
    rows = [(k if k % 50 else None, t) for k, t in enumerate(texts)]
    seqs = [suffix_tree_lm.tokens(t) for _, t in rows]
    taught = [suffix_tree_lm.learned(i) for i, _ in rows]
    model = model_of([suffix_tree_lm.spelled(s) for s, own in zip(seqs, taught) if own], 0)
    counts, n_ends = Counter(w for s, own in zip(seqs, taught) if own for w in s), sum(taught)
    total = sum(counts.values()) + n_ends
    number = {w: k for k, w in enumerate(sorted({w for s in seqs for w in s}))}
    want = suffix_tree_lm.text_scores(
        lambda raw, starts, ends: suffix_tree_lm.symbol_scores(model, raw),
        list(number),
        np.array([number[w] for s in seqs for w in s]),
        np.array([len(s) for s in seqs]),
        np.array([counts[w] / total for w in number]),
        n_ends / total,
        suffix_tree_lm.SHARE_WEIGHT,
    )
    got = suffix_tree_lm.score(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    assert np.allclose(sorted(r.score for r in got), np.sort(want), rtol=1e-5, atol=1e-3)
