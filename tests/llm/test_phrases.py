"""Operator 12 against plain counting."""

import random
import re
from collections import Counter

import pytest

from verisift.llm import phrases as P

UPPER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def plain(rows, longest=3, least=10, inside=50, top=2000):
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(UPPER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            f.update((lang, *w[k : k + m]) for m in range(1, longest + 1) for k in range(len(w) - m + 1))
    cand = {p: a for p, a in f.items() if len(p) > 2 and a >= least}
    gone = set()
    for p, a in cand.items():
        w = p[1:]
        for m in range(2, len(w)):
            for k in range(len(w) - m + 1):
                q = (p[0], *w[k : k + m])
                if 100 * a >= inside * cand[q]:
                    gone.add(q)
    out = {}
    for p, a in cand.items():
        if p in gone:
            continue
        lang, w = p[0], p[1:]
        cuts = []
        for k in range(1, len(w)):
            l, r = f[(lang, *w[:k])], f[(lang, *w[k:])]
            cuts.append((1_000_000 * a * a // (l * r), k, l, r))
        score, _, l, r = min(cuts)
        out.setdefault(lang, []).append((-score, -a, " ".join(w).encode(), l, r))
    return sorted(
        (lang, k, p.decode(), -a, l, r, n[lang], -s)
        for lang, rows in out.items() for k, (s, a, p, l, r) in enumerate(sorted(rows)[:top], 1)
    )


def made(seed, n=220):
    rng = random.Random(seed)
    words = ["the", "of", "New", "york", "é", "a\x0bb", "x\xa0y", "日本", "z\x00", "THE", "Ünder", "o'er"] + [f"w{k}" for k in range(30)]
    out = []
    for k in range(n):
        text = ""
        for _ in range(rng.randrange(120)):
            text += rng.choice(words[: rng.randrange(3, len(words))]) + rng.choice([" ", " ", " ", "  ", "\t", ". ", ",", "\n", "!?"])
        out.append((rng.choice(["en", "en", "en", "fr", None, "und", ""]), text))
    return out + [("en", None), (None, ""), ("fr", " . \t!"), ("en", "the same copy of it. " * 40), ("en", "the same copy of it. " * 40), ("xx", "far " * 30_000)]


def frame(spark, rows, ids=None):
    names = "doc_id long, lang string, text string, phrase string, n string, length string, a string, w string"
    rows = [(i, lang, text, *["clash"] * 5) for i, (lang, text) in zip(ids or range(len(rows)), rows)]
    return spark.createDataFrame(rows, names).repartition(4)


def got(df):
    return sorted(tuple(r) for r in df.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


@pytest.mark.parametrize("longest, least, top, sample", [(3, 10, 2000, 8), (2, 3, 7, 2), (4, 5, 50, 3)])
def test_as_plain_counting_gives(spark, longest, least, top, sample):
    rows = made(longest)
    assert got(P.collocations(frame(spark, rows), longest, least, 50, top, sample)) == plain(rows, longest, least, 50, top)


def test_border_failures_are_counted_by_further_passes(spark):
    rows = made(5)
    want = plain(rows)
    # All ids null: the sample is empty, so each length fails once, and the last pass finds no more.
    docs = frame(spark, rows, [None] * len(rows))
    counts, passes = P.frequent(docs, 3, 10)
    assert passes == 4
    assert got(P.collocations(docs)) == want
    # A sample of everything has no failure, and a crowded bitmap only counts more.
    counts, passes = P.frequent(frame(spark, rows), 3, 10, sample=1, bits=1 << 10)
    assert passes == 1
    all_, _ = P.frequent(frame(spark, rows, [None] * len(rows)), 3, 10)
    assert sorted(counts.collect()) == sorted(all_.collect())


def test_products_beyond_64_bits(spark):
    from decimal import Decimal

    big = 5_000_000_000
    rows = spark.createDataFrame([(big, 2 * big, 3 * big)], "a long, l long, r long")
    square = (P._numbers(rows.a) * P._numbers(rows.a)).cast("decimal(38,0)") * P._numbers(P.F.lit(1_000_000))
    out = rows.select(square.cast("decimal(38,0)").alias("s"), (P._numbers(rows.l) * P._numbers(rows.r)).cast("decimal(38,0)").alias("p"))
    r = out.selectExpr("s", "p", "s div p as d").first()
    assert (r.s, r.p, r.d) == (Decimal(1_000_000 * big * big), Decimal(6 * big * big), 166_666)


def test_empty_and_wordless_tables(spark):
    assert P.collocations(frame(spark, made(1)).where("false")).count() == 0
    assert P.collocations(frame(spark, [("en", None), (None, ".,;")])).count() == 0
