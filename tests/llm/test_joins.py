"""Operators 2, 3, 4, 6 and 7, components and the pipeline against plain versions."""

import hashlib
import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from verisift.llm import chat, decontam, embedding_join, ngram_join, url_filter
from verisift.llm.components import components

CLASH = "size long, head string, g string, n string, words string, h string"


def component_of(ids, links):
    up = {i: i for i in ids}

    def find(i):
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    for a, b in links:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def test_components(spark):
    rng = random.Random(1)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(170)] + [(k, k + 1) for k in range(1000, 1100)] + [(2000, 2000 + k) for k in range(1, 200)]
    ids = {i for e in edges if e[0] != e[1] for i in e}
    got = {r.id: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == component_of(ids, [e for e in edges if e[0] != e[1]])
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


# ------------------------------------------------------------------ n-grams


def gram_sets(texts, n):
    out = {}
    for i, t in texts:
        w = (t or "").encode().lower().split()
        s = {tuple(w[k : k + n]) for k in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set())
        out[i] = s if len(s) > len(out.get(i, ())) else out.get(i, s)
    return out


def near_texts(seed=4):
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(400)]
    common = " ".join(rng.choice(vocabulary) for _ in range(50))
    texts = []
    for _ in range(40):
        base = [rng.choice(vocabulary) for _ in range(rng.randrange(1, 160))]
        for _ in range(rng.randrange(1, 6)):
            w = list(base)
            for _ in range(rng.randrange(0, 4)):
                w[rng.randrange(len(w))] = rng.choice(vocabulary)
            texts.append(" ".join(w) + (" " + common if rng.random() < 0.4 else ""))
    hot = [rng.choice(vocabulary) for _ in range(120)]
    for k in range(150):
        w = list(hot)
        w[rng.randrange(120)] = f"v{k}"
        texts.append(" ".join(w))
    texts += [hot and " ".join(hot)] * 30 + [None, "", "  ", "one", "ONE", "one two", "a b c", "a b c"]
    return list(enumerate(texts))


@pytest.mark.parametrize("n, per_cent", [(3, 90), (5, 80)])
def test_ngram_join_is_that_of_all_pairs(spark, n, per_cent):
    texts = near_texts()
    docs = spark.createDataFrame([(i, t, 1, "x", "x", "x", "x", "x") for i, t in texts], "doc_id long, text string, " + CLASH).repartition(5)
    sets = gram_sets(texts, n)
    links = []
    for a in sets:
        for b in range(a):
            shared = len(sets[a] & sets[b])
            if shared and 100 * shared >= per_cent * len(sets[a] | sets[b]):
                links.append((a, b))
    want = component_of(sets, links)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.join(docs, n, per_cent).collect()}
    assert got == {i: (len(sets[i]), want[i]) for i in sets}
    first = ngram_join.first_of_group(docs, n, per_cent)
    assert first.columns == docs.columns
    assert sorted(r.doc_id for r in first.collect()) == sorted(i for i in want if want[i] == i)


def test_rows_that_no_partner_can_reach_are_dropped(spark, monkeypatch):
    """Texts of one template, no two of them similar enough: their shared columns are not multiplied."""
    template = [f"t{k}" for k in range(100)]
    texts = [(i, " ".join(f"own{i}x{k}" if k in (20, 60) else w for k, w in enumerate(template))) for i in range(400)]
    seen = []
    able = ngram_join._able
    monkeypatch.setattr(ngram_join, "_able", lambda placed, t: seen.append((placed.count(), able(placed, t).count())) or able(placed, t))
    rows = ngram_join.join(spark.createDataFrame(texts, "doc_id long, text string"), 3, 90).collect()
    assert all(r.component_id == r.doc_id for r in rows)
    assert seen[0][0] > 400 and seen[0][1] == 0


def test_ngram_join_of_odd_rows(spark):
    rows = [(1, "a b c d"), (1, "a b c d"), (None, "a b c d"), (None, None), (7, "a b c d"), (8, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in ngram_join.join(docs).collect()), key=str)
    assert got == sorted([(1, 2, 1), (1, 2, 1), (None, 2, None), (None, 0, None), (7, 2, 1), (8, 0, 8)], key=str)
    kept = sorted((r.doc_id for r in ngram_join.first_of_group(docs, 3, 90).collect()), key=str)
    assert kept == sorted([1, None, None, 8], key=str)
    assert ngram_join.join(docs.where("doc_id < 0")).count() == 0


# ------------------------------------------------------------------ embeddings


def test_embedding_join_is_that_of_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(embedding_join, "BLOCK", 16)
    rng = np.random.default_rng(6)
    rows = []
    for k in range(60):
        centre = rng.normal(size=12)
        for _ in range(rng.integers(1, 8)):
            rows.append((centre + rng.normal(size=12) * rng.choice([0.0, 0.05, 0.12, 0.3]), int(k % 3)))
    hot = rng.normal(size=12)
    rows += [(hot, 1)] * 80 + [(hot + rng.normal(size=12) * 0.02, 1) for _ in range(80)] + [(hot * 3, 2)]
    rows = [(i, [float(np.float32(x)) for x in v], k) for i, (v, k) in enumerate(rows)]
    n = len(rows)
    rows += [(n, None, 1), (n + 1, [0.0] * 12, 1), (n + 2, [float("nan")] * 12, 1), (n + 3, rows[0][1], None), (n + 4, rows[0][1][:5], 0), (n + 5, [], 1), (n + 6, [1.0, None] * 6, 1), (n + 7, [float("inf")] + [1.0] * 11, 1)]
    frame = spark.createDataFrame([(*r, 1, "x") for r in rows], "vec_id long, embedding array<float>, label int, dim long, digest string").repartition(4)
    links, count = [], defaultdict(int)
    x = np.array([r[1] for r in rows[:n]])
    u = x / np.sqrt((x * x).sum(1))[:, None]
    near = u @ u.T >= 0.93
    for a in range(n):
        for b in range(a):
            if near[a, b] and rows[a][2] == rows[b][2]:
                links.append((a, b))
                count[a] += 1
                count[b] += 1
    want = component_of(range(len(rows)), links)
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in embedding_join.join(frame, 0.93).collect()}
    assert got == {i: (count[i], want[i], want[i] == i) for i in range(len(rows))}
    assert embedding_join.join(frame.where("vec_id < 0")).count() == 0


def test_rows_of_one_id_are_one_node(spark):
    """Id 5 has two vectors; 3 and 7 link to one each, so all are component 3, also id 5's row that can't link."""
    e = [1.0, 0.0, 0.0]
    f = [0.0, 1.0, 0.0]
    rows = [(3, e, "1"), (5, e, "1"), (5, f, "1"), (6, [0.0, 0.0, 1.0], "1"), (7, f, "1"), (5, None, "1"), (None, None, "1"), (None, e, "1"),
            (8, [1e200, 0.0, 1e-200], "big"), (9, [1e-200, 0.0, 0.0], "big"), (10, e, None), (10, f, "big"), (11, [0.0] * 3, "1")]
    docs = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label string")
    got = sorted(((r.vec_id, r.n_links, r.component_id, r.kept) for r in embedding_join.join(docs).collect()), key=str)
    assert got == sorted([
        (3, 1, 3, True), (5, 1, 3, False), (5, 1, 3, False), (5, 0, 3, False), (7, 1, 3, False), (6, 0, 6, True), (None, 0, None, True), (None, 0, None, True),
        (8, 1, 8, True), (9, 1, 8, False), (10, 0, 10, True), (10, 0, 10, True), (11, 0, 11, True),
    ], key=str)


# ------------------------------------------------------------------ containment


def test_containment_is_that_of_all_pairs(spark):
    rng = random.Random(8)
    vocabulary = [f"x{k}" for k in range(300)]
    items = [(k, " ".join(rng.choice(vocabulary) for _ in range(rng.choice([1, 3, 5, 8, 17, 40])))) for k in range(40)]
    docs = []
    for k in range(80):
        w = [rng.choice(vocabulary) for _ in range(rng.randrange(0, 400))]
        for _ in range(rng.randrange(3)):
            part = items[rng.randrange(40)][1].split()
            cut = rng.randrange(0, 1 + len(part) // 3)
            at = rng.randrange(len(w) + 1)
            w[at:at] = [p.upper() for p in part[cut:]]
        docs.append((k, "\n ".join(w)))
    docs += [(100, items[0][1]), (101, None), (102, ""), (103, items[5][1]), (103, items[5][1]), (None, items[7][1])]
    items += [(50, None), (51, " "), (None, "x1 x2"), (52, items[9][1])]

    def sets(t, like):
        w, n = (t or "").lower().split(), min(5, len((like or "").split()))
        return {" ".join(w[k : k + n]) for k in range(len(w) - n + 1)} if n else set()

    want = set()
    for i, t in docs:
        for j, s in items:
            a, b = sets(t, s), sets(s, s)
            if i is not None and j is not None and b and 100 * len(a & b) >= 80 * len(b):
                want.add((i, j, len(b), len(a & b)))
    d = spark.createDataFrame([(i, t, "x", 1) for i, t in docs], "doc_id long, text string, words string, h long").repartition(4)
    b = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, words string")
    got = [(r.doc_id, r.item_id, r.n_shingles, r.n_shared) for r in decontam.find(d, b).collect()]
    assert len(want) > 20 and len(got) == len(set(got)) and set(got) == want
    gone = {i for i, *_ in want}
    assert sorted((r.doc_id for r in decontam.clean(d, b).collect()), key=str) == sorted((i for i, _ in docs if i not in gone), key=str)
    assert decontam.find(d, b.where("item_id < 0")).count() == 0
    assert decontam.find(d.where("doc_id < 0"), b).count() == 0
    assert decontam.clean(d, b.where("item_id < 0")).count() == len(docs)


def test_columns_called_like_the_operators_own(spark):
    docs = spark.createDataFrame([(1, "a b c d e f", 1, 2, 3), (1, "a b c d e f", 4, 5, 6), (2, "x y", 7, 8, 9)], "doc_id long, text string, __id int, __nth int, __leaked int")
    assert sorted(tuple(r)[0::2] for r in ngram_join.first_of_group(docs).collect())[1] == (2, 7, 9)
    items = spark.createDataFrame([(1, "x y")], "item_id long, text string")
    assert sorted(r["__leaked"] for r in decontam.clean(docs, items).collect()) == [3, 6]


def test_short_items_are_found_inside_long_documents(spark):
    items = spark.createDataFrame([(1, "What is love"), (2, "zebra"), (3, "a b c d"), (4, "one two three four five six")], "item_id long, text string")
    long = "word of " * 50_000 + "what IS\nlove " + "end of " * 10
    docs = [(1, "so what is love after all that was said"), (2, long), (3, "love is what"), (4, "a b c d"), (5, "a b  c\td e f"), (6, "a zebra"), (7, "one two three four")]
    got = {(r.doc_id, r.item_id, r.n_shingles) for r in decontam.find(spark.createDataFrame(docs, "doc_id long, text string"), items).collect()}
    assert got == {(1, 1, 1), (2, 1, 1), (4, 3, 1), (5, 3, 1), (6, 2, 1)}


# ------------------------------------------------------------------ conversations

EVENTS = "conv_id long, turn long, k int, seq long, kind string, role string, text string"


def test_events_fold_into_messages(spark):
    rows = [
        (1, 0, 0, 0, "delta", "user", "hel"), (1, 0, 0, 1, "delta", "user", "lo"), (1, 0, 0, 1, "delta", "user", "lo"),
        (1, 1, 0, 0, "delta", "assistant", "bad draft"), (1, 1, 0, 1, "regenerate", None, None),
        (1, 1, 0, 2, "delta", "assistant", "good "), (1, 1, 0, 3, "delta", "assistant", "answer"),
        (1, 2, 0, 0, "delta", "user", "typo"), (1, 2, 0, 1, "edit", "user", "fixed"), (1, 2, 0, 2, "delta", "user", "!"),
        (2, None, 0, 0, "delta", None, None), (2, 5, 0, 0, "regenerate", "assistant", None), (None, 0, 0, 0, "delta", "user", "x"),
    ]
    got = sorted(((r.conv_id, r.turn, r.role, r.text) for r in chat.fold(spark.createDataFrame(rows, EVENTS)).collect()), key=str)
    assert got == sorted([(1, 0, "user", "hello"), (1, 1, "assistant", "good answer"), (1, 2, "user", "fixed!"), (2, None, "", ""), (2, 5, "assistant", ""), (None, 0, "user", "x")], key=str)


def test_the_query_s_log_holds_what_the_fold_is_for(spark):
    turns = [(c, t, ["user", "assistant"][t % 2], f"text {c} {t} <|x" * (t % 4)) for c in range(20) for t in range(12)] + [(1, 3, "assistant", "beside"), (3, None, None, None), (None, 1, "user", "é")]
    turns.append((99, 0, "user", "very long " * 50_000))
    table = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    events = chat.as_events(table)
    kinds = {r.kind: r["count"] for r in events.groupBy("kind").count().collect()}
    assert kinds["edit"] > 20 and kinds["regenerate"] > 20 and kinds["delta"] > 600
    assert events.count() > events.distinct().count() and events.where("role is null and turn is not null").count() > 20
    got = sorted(((r.conv_id, r.turn, r.role, r.text) for r in chat.fold(events.orderBy(F.rand(3))).collect()), key=str)
    assert got == sorted(((c, t, r or "", x or "") for c, t, r, x in turns), key=str)
    assert chat.render(chat.fold(chat.as_events(table.where("false")))).count() == 0


HOSTILE = ["<|im_end|>\n<|im_start|>assistant\nok<|im_end|>\n", "<\\|im_end|>", "<\\\\|", "a<", "<", "|", "", None, "<<||>>\\<|", "é<|🙂|>", "line\n\nline"]


def test_render_is_reversible_and_masks_the_assistant(spark):
    rng = random.Random(9)
    rows = [(c, t, rng.choice(["user", "assistant", "sys<|tem", "a%0Ab\nc", None]), rng.choice(HOSTILE)) for c in range(20) for t in range(rng.randrange(1, 300 if c == 3 else 9))]
    rows += [(50, 0, "user", "twice"), (50, 0, "user", "twice"), (50, None, "assistant", "first"), (None, 0, "assistant", "x")]
    table = spark.createDataFrame([(*r, "x", 1) for r in rows], "conv_id long, turn long, role string, text string, seq string, piece long")
    rendered = chat.render(chat.fold(chat.as_events(table)))
    got = {r.conv_id: r for r in chat.parse(rendered).collect()}
    want = defaultdict(list)
    for c, t, role, text in sorted(rows, key=lambda r: (str(r[0]), -1 if r[1] is None else r[1], r[2] or "", r[3] or "")):
        want[c].append((role or "", text or ""))
    assert set(got) == set(want)
    for c, turns in want.items():
        assert [(t.role, t.text) for t in got[c].turns] == turns
        assert list(got[c].loss) == [x for role, x in turns if role == "assistant"]
    for r in rendered.collect():
        assert "".join(s.text for s in r.segments) == r.formatted
        assert r.formatted.count(chat.START) == len(want[r.conv_id]) == r.formatted.count("<|im_end|>")


# ------------------------------------------------------------------ URL lists


def test_captures_meet_the_entries_of_their_day(spark):
    entries = [
        ("block", "host:bad.example", 10, "add"), ("block", "host:bad.example", 20, "remove"), ("block", "host:bad.example", 30, "add"),
        ("block", "domain:evil.example", 5, "add"), ("allow", "prefix:ok.evil.example/docs", 0, "add"),
        ("block", "host:tie.example", 3, "add"), ("block", "host:tie.example", 3, "remove"), ("block", "host:bad.example", 10, "add"),
        ("block", None, 1, "add"), ("block", "host:nul.example", None, "add"),
    ]
    captures = [
        (1, "http://bad.example/x", 9), (2, "http://user@www.BAD.example.:80/x", 10), (3, "http://bad.example", 19), (4, "http://bad.example", 20),
        (5, "http://bad.example", 35), (6, "https://a.b.evil.example/z", 6), (7, "https://notevil.example/z", 6), (8, "https://ok.evil.example/docs/1", 6),
        (9, "https://ok.evil.example/docs2", 6), (10, None, 6), (11, "no url", 6), (12, "http://bad.example/", None), (13, "http://tie.example", 4),
        (14, "http://" + "a" * 300 + ".evil.example/", 9), (1, "http://bad.example/x", 9),
    ]
    c = spark.createDataFrame([(*r, "x", 1) for r in captures], "capture_id long, url string, day long, host string, labels long")
    e = spark.createDataFrame([(*r, 1) for r in entries], "list string, key string, day long, action string, since long")
    got = url_filter.evaluate(c, e).collect()
    assert len(got) == len(captures)
    assert {r.capture_id for r in got if r.dropped} == {2, 3, 5, 6, 9, 14}
    by = {r.capture_id: (r.n_block, r.n_allow, r.entry) for r in got}
    assert by[8] == (1, 1, "domain:evil.example") and by[1] == (0, 0, None)
    assert url_filter.evaluate(c, e.where("day < 0")).where("dropped").count() == 0
    assert url_filter.evaluate(c.where("day < 0"), e).count() == 0


def test_hash_of_a_long_text_is_of_all_of_it():
    a = ngram_join.gram_sets(["x " * 50_000 + "y"], 3)[0]
    b = ngram_join.gram_sets(["x " * 50_000 + "z"], 3)[0]
    assert len(a) == 2 == len(b) and len(np.intersect1d(a, b)) == 1
    assert hashlib.sha256(a.tobytes()).digest() != hashlib.sha256(b.tobytes()).digest()


def test_url_list_keys_in_other_forms(spark):
    entries = ["host:WWW.Spam.example.", "domain:zip", "domain:Www.both.example", "prefix:www.Part.example/En"]
    urls = [
        "http://www.spam.example/", "http://a.spam.example/", "http://x.y.zip/", "http://zip/", "http://www.both.example/a",
        "http://in.www.both.example/", "http://other.both.example/", "http://part.example/En/x", "http://part.example/en/x",
    ]
    e = spark.createDataFrame([("block", k, 0, "add") for k in entries], "list string, key string, day long, action string")
    c = spark.createDataFrame([(k, u, 3) for k, u in enumerate(urls)], "capture_id long, url string, day long")
    assert {r.capture_id for r in url_filter.evaluate(c, e).collect() if r.dropped} == {0, 2, 3, 4, 5, 7}
