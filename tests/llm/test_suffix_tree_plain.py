"""Operator 9 against the definition, with Python dictionaries and fractions of counts."""

import math
import random
import zlib
from collections import Counter, defaultdict

import pytest

from verisift.llm import suffix_tree_lm as T


def words_of(text):
    return "".join(c.lower() if c.isascii() else c for c in text or "").encode().split()


class Plain:
    def __init__(self, taught):
        self.after = defaultdict(Counter)  # by context: the bytes that follow
        for words in taught:
            for at, raw in self.places(words):
                for d in range(T.DEPTH + 1):
                    self.after[raw[at - d : at]][raw[at]] += 1
        self.root = {s: (1 + self.after[b""][s]) / (256 + sum(self.after[b""].values())) for s in range(256)}
        self.kept = set()
        for c, follow in self.after.items():
            m = sum(follow.values())
            if not c or m < T.LEAST:
                continue
            divergence = 0.0
            for s, n in follow.items():
                behind = self.after[c[1:]]
                q = self.root[s] if len(c) == 1 else behind[s] / sum(behind.values())
                divergence += n * math.log(n / m / q)
            if divergence * T.TIE >= 0.5 * len(follow) * math.log(max(m, 2)):
                self.kept.update(c[k:] for k in range(len(c)))
        self.tokens = Counter(w for words in taught for w in [*words, None])

    @staticmethod
    def places(words):
        raw = b"\n" * T.DEPTH + b"".join(w + b" " for w in words) + b"\n"
        return [(at, raw) for at in range(T.DEPTH, len(raw))]

    def prob(self, context, s):
        if not context:
            return self.root[s]
        shorter = self.prob(context[1:], s)
        if context not in self.kept:
            return shorter
        follow = self.after[context]
        return (follow[s] + len(follow) * shorter) / (sum(follow.values()) + len(follow))

    def score(self, words):
        n = sum(self.tokens.values())
        places, out, k = self.places(words), 0.0, 0
        for token in [*words, None]:
            size = 1 if token is None else len(token) + 1
            spelling = math.prod(self.prob(raw[at - T.DEPTH : at], raw[at]) for at, raw in places[k : k + size])
            k += size
            share = T.SHARE_WEIGHT if n else 0.0
            out += math.log10(share * (self.tokens[token] / n if n else 0.0) + (1 - share) * spelling)
        return out


def made(seed, n):
    rng = random.Random(seed)
    words = ["the", "The", "cat", "sat", "on", "mat", "été", "日本", "x1", "aaaa", "aab", "abba"]
    texts = [" ".join(rng.choices(words, k=rng.randrange(14))) + rng.choice(["", " ", "\n", " zzq"]) for _ in range(n)]
    return [*texts, None, "", "the cat sat", "the cat sat", "never seen wörds " * 3, "a" * 40]


@pytest.mark.parametrize("seed, ids", [(1, None), (2, None), (3, [2, 13])])
def test_scores_are_those_of_the_definition(spark, seed, ids):
    rows = list(enumerate(made(seed, 50)))
    if ids:  # nothing to learn from: held out, or without an id
        held = [i for i in range(500) if zlib.crc32(str(i).encode()) % 7 == 2]
        rows = [(held[k] if k % 2 else None, t) for k, (_, t) in enumerate(rows[:12])]
    plain = Plain([words_of(t) for i, t in rows if i is not None and zlib.crc32(str(i).encode()) % 7 != 2])
    got = T.score(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    want = sorted(((str(i), plain.score(words_of(t))) for i, t in rows), key=str)
    found = sorted(((str(r.doc_id), r.score) for r in got), key=str)
    assert [i for i, _ in found] == [i for i, _ in want]
    for (_, a), (_, b) in zip(sorted(found), sorted(want)):
        assert a == pytest.approx(b, rel=1e-4, abs=1e-4)
