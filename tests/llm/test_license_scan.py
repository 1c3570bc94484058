"""Operator 11 against the plain phrases, and against the edit bound on whole texts."""

import random
import re

import pytest

from verisift.llm import license_scan as L

UPPER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
LONG = "permission is hereby granted free of charge to any person obtaining a copy of this software"
TEXTS = [
    None,
    "",
    " .,- \n",
    "Apache License, GNU-General\nPublic/License; apache LICENSE apache license license",
    "cc by cc by cc-by-sa ccby cc by",
    "the commit license of mit licenses; MIT License mit\tlicense",
    "É mit license é日本 cc by",
    "Licensed under the Apche License, version 2.0",
    "x Permision is hereby granted, free of charge, to any person obtaining a copy of this sofware! y " + LONG + " " + LONG[:-4],
    "permission is hereby revoked",
    "the same mit license",
    "the same mit license",
    "of " * 30_000 + "GNU general publik license " + "mit license " * 2_000,
]


def plain_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(UPPER))


def plain_base(text):
    words, out = plain_words(text), []
    for phrase, label in L.BASE:
        p = phrase.split()
        out += [(k, label) for k in range(len(words)) if words[k : k + len(p)] == p]
    return sorted(out)


def within_edits(words, phrase, k):
    """Whether some run of whole words is within ``k`` edits of ``phrase`` (plain dynamic programme from every word)."""
    whole = " ".join(words)
    starts = [0, *(j + 1 for j, c in enumerate(whole) if c == " ")] if words else []
    for at in starts:
        row = list(range(len(phrase) + 1))
        for j, c in enumerate(whole[at : at + len(phrase) + k + 1] + " "):
            if c == " " and j and row[-1] <= k:
                return True
            new = [row[0] + 1]
            for i, p in enumerate(phrase):
                new.append(min(row[i] + (p != c), row[i + 1] + 1, new[i] + 1))
            row = new
    return False


def frame(spark, texts, ids=None):
    names = "doc_id long, text string, label string, matches string, n_words string, base string, kind string"
    rows = [(i, t, *["clash"] * 5) for i, t in zip(ids or range(len(texts)), texts)]
    return spark.createDataFrame(rows, names).repartition(3)


def test_base_phrases_are_where_their_words_stand(spark):
    got = {r.doc_id: r for r in L.scan(frame(spark, TEXTS)).collect()}
    for i, t in enumerate(TEXTS):
        assert got[i].n_words == len(plain_words(t))
        assert sorted((m["first"], m["label"]) for m in got[i].matches if m["base"]) == plain_base(t)
        for m in got[i].matches:
            assert plain_words(t[m["start"] : m["end"]]) == plain_words(t)[m["first"] : m["after"]]
            assert m["edits"] or plain_words(t)[m["first"] : m["after"]] == m["notice"].split()


def test_changed_notices_are_found_and_other_texts_are_not(spark):
    got = {r.doc_id: {m["label"] for m in r.matches} for r in L.scan(frame(spark, TEXTS)).collect()}
    assert got[7] == {"apache"} and "mit" in got[8] and got[9] == set() and got[12] == {"gpl", "mit"}
    changed = [m for m in L.Scanner().find(L.as_words(TEXTS[8])) if L.NOTICES[0][0] == L.Scanner().notices[m.notice][0]]
    assert sorted(m.edits for m in changed) == [0, 2, 4]


def test_no_notice_within_its_bound_is_missed():
    rng = random.Random(7)
    scanner = L.Scanner()
    vocabulary = sorted({w for p in scanner.notices for w in p[0].split()})
    for trial in range(60):
        i = rng.randrange(len(scanner.notices))
        phrase, k = scanner.notices[i][0], scanner.edits[i]
        chars = list(phrase)
        for _ in range(rng.randrange(k + 3)):
            j, kind = rng.randrange(len(chars)), rng.randrange(3)
            chars[j : j + (kind != 0)] = [rng.choice("abcdefgh ")] if kind != 1 else []
        around = [" ".join(rng.choices(vocabulary, k=rng.randrange(12))) for _ in range(2)]
        text = f"{around[0]} {''.join(chars)} {around[1]}"
        found = {m.notice for m in scanner.find(L.as_words(text))}
        want = {n for n, (p, _) in enumerate(scanner.notices) if within_edits(plain_words(text), p, scanner.edits[n])}
        assert found == want, text


def test_digest_and_odd_rows(spark, tmp_path):
    rows = frame(spark, TEXTS, [*range(len(TEXTS) - 1), None])
    rows.write.parquet(f"{tmp_path}/documents.parquet")
    got = L.op11(spark, str(tmp_path)).collect()
    assert len(got) == len(TEXTS) and sum(r.doc_id is None for r in got) == 1
    by_id = {r.doc_id: r for r in got}
    for i, t in enumerate(TEXTS[:-1]):
        base = plain_base(t)
        r = by_id[i]
        assert (r.n_base, r.first_word, r.last_word) == (len(base), min(base)[0] if base else None, max(base)[0] if base else None)
        assert r.base_labels == ",".join(sorted({x for _, x in base}))
        assert set(filter(None, r.base_labels.split(","))) <= set(filter(None, r.labels.split(",")))
        assert 0 <= r.score <= 1 and (r.score > 0) == bool(r.labels)
    assert by_id[10][1:] == by_id[11][1:]
    assert L.scan(rows.where("false")).count() == 0


@pytest.mark.parametrize("edits", [0, 3])
def test_own_notices(spark, edits):
    own = (("all of this text belongs to nobody in particular", "none"),)
    text = "All of this txt belongs, to nobody; in particular."
    got = L.scan(frame(spark, [text]), own, 1, 16 if edits else 1000).first().matches
    assert [m["edits"] for m in got] == ([1] if edits else [])
