"""Operator 13 against plain edit neighbourhoods."""

import random
import re
import zlib
from collections import Counter

import pytest

from verisift.llm import spelling as S

UPPER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
LETTERS = [chr(c) for c in [*range(0x61, 0x7B), *range(0xC0, 0x100)]]


def plain(rows, shortest=6, least=5, times=5, noise=0):
    n = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(UPPER)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if noise and h % noise == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            n[run] += 1
    n = {w: k for w, k in n.items() if len(w) >= shortest and k >= least}
    near = {w: set() for w in n}
    for w in n:
        for k in range(len(w) + 1):
            some = [w[:k] + w[k + 1 :]] if k < len(w) else []
            some += [w[:k] + c + w[k + 1 :] for c in LETTERS if k < len(w)] + [w[:k] + c + w[k:] for c in LETTERS]
            near[w] |= {x for x in some if x != w and x in n}
    form = {}
    for w in n:
        best = min(near[w], key=lambda x: (-n[x], x), default=None)
        form[w] = best if best and n[best] >= times * n[w] else None

    def root(w):
        return w if form[w] is None else root(form[w])

    return sorted((w, form[w], root(w), n[w], len(near[w]), form[w] and n[form[w]]) for w in n), n


def made(seed, n=300):
    rng = random.Random(seed)
    roots = ["colour", "letter", "straße", "élément", "ÀÉÎõü÷×", "aaaaaaa", "bookkeeper", "documents", "recommend", "missisippi", "zzzzzzzzzz" * 5]
    out = []
    for i in range(n):
        words = []
        for _ in range(rng.randrange(80)):
            w = rng.choice(roots)
            while rng.random() < 0.3:
                k = rng.randrange(len(w))
                w = w[:k] + rng.choice(["", w[k] * 2, rng.choice("abéÿ")]) + w[k + 1 :]
            words.append(rng.choice([w, w, w.title(), w.upper() if w.isascii() else w]))
        out.append((i, "".join(x + rng.choice([" ", "-", "1", "_", ". ", "\n", "Ā"]) for x in words)))
    return out + [(n, None), (n + 1, ""), (n + 1, "colour " * 3000 + "12 \t"), (None, "colour coloor"), (None, "x" * 20_000), (n, "x" * 20_000 + " ") ]


def frame(spark, rows):
    names = "doc_id long, text string, word string, n string, form string, root string, near string"
    return spark.createDataFrame([(i, t, *["clash"] * 5) for i, t in rows], names).repartition(4)


def got(df):
    return sorted((tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect()), key=str)


@pytest.mark.parametrize("seed, limit, noise", [(1, S.FILTER_BYTES, 0), (2, 64, 7)])
def test_as_plain_neighbourhoods(spark, seed, limit, noise):
    rows = made(seed)
    want, _ = plain(rows, noise=noise)
    # With 64 bytes of filters nearly every edit is a false positive.
    assert got(S.group(frame(spark, rows), noise=noise, limit=limit)) == sorted(want, key=str)
    assert any(r[1] and r[2] != r[1] for r in want)


def test_long_words_and_other_bounds(spark):
    rows = made(3, 40)
    want, n = plain(rows, 1, 1, 2)
    assert max(map(len, n)) >= 20_000
    assert got(S.group(frame(spark, rows), 1, 1, 2)) == sorted(want, key=str)


def test_filters_hold_every_word(spark):
    words = sorted({w for _, t in made(4) for w in S.read_runs(0, t, 0) if len(w) < 100})
    known = S.filters(spark.createDataFrame([(w,) for w in words], "word string"), 1 << 12)
    assert sum(b.nbytes for b in known.blocks.values()) <= (1 << 12) + 8 * len(known.blocks)
    for length, some in S._by_length(words):
        assert known.may_hold(length, S._sums(S._codes(some, length))[:, -1]).all()


def test_a_chain_of_forms_and_empty_tables(spark):
    texts = ["abcdef " * 5, "abcdefg " * 25, "abcdefgh " * 125, "abcdefghi " * 625, "abcdefghij " * 3125, "lonely " * 9]
    rows = got(S.group(frame(spark, list(enumerate(texts)))))
    assert [(r[0], r[2]) for r in rows] == [(w.split()[0], "abcdefghij" if w[0] == "a" else "lonely") for w in texts]
    assert S.group(frame(spark, [(1, "abcdef")]).where("false")).count() == 0
    assert S.group(frame(spark, [(1, None), (2, "abc")])).count() == 0
