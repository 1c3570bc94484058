"""Operator 11: license notices found with a bounded number of edits.

Texts and notices are read as words: A-Z lower-cased, anything of ASCII but
letters and digits separates words, and one space stands between two. A notice
of ``L`` characters may differ by up to ``k = L // EDIT_EVERY`` inserted,
deleted or replaced characters, and starts and ends where words do.

1. Pigeonhole: a notice is cut into ``k + 2`` pieces. ``k`` edits leave at least
   two of them whole, at places that agree on where the notice starts within
   ``k`` characters. (A notice that allows no edit is one piece.) One Aho-Corasick
   automaton finds the pieces of all notices in one pass over a text.
2. Where two different pieces of a notice agree, its window is a candidate. An
   unchanged notice is there as it is; around it, the regex library's
   bounded-error matching verifies the window, counts the edits and gives the span.

Every text is scanned whole and by itself, so there is no shuffle and a hot
source is like any other. Spans come as words (``first``, ``after``, from 0) and
as code points of the text as it was given (``start``, ``end``, end exclusive).

Null, empty and wordless texts have no words and no spans. Repeated rows repeat,
an empty table gives no rows, a null id stays null; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import packed, small_pieces, table

# The phrases of the contract and their labels.
BASE = (
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
)
# First lines and names of public licenses, as words, and their labels.
NOTICES = (
    ("permission is hereby granted free of charge to any person obtaining a copy of this software", "mit"),
    ("the above copyright notice and this permission notice shall be included in all copies", "mit"),
    ("released under the mit license", "mit"),
    ("redistribution and use in source and binary forms with or without modification are permitted", "bsd"),
    ("redistributions of source code must retain the above copyright notice", "bsd"),
    ("licensed under the apache license version 2 0", "apache"),
    ("unless required by applicable law or agreed to in writing software", "apache"),
    ("this program is free software you can redistribute it and or modify", "gpl"),
    ("gnu lesser general public license", "lgpl"),
    ("gnu affero general public license", "agpl"),
    ("subject to the terms of the mozilla public license", "mpl"),
    ("mozilla public license", "mpl"),
    ("eclipse public license", "epl"),
    ("permission to use copy modify and or distribute this software for any purpose", "isc"),
    ("this is free and unencumbered software released into the public domain", "unlicense"),
    ("boost software license", "bsl"),
    ("licensed under a creative commons attribution", "cc-by"),
    ("creative commons attribution 4 0 international license", "cc-by"),
    ("creative commons attribution sharealike", "cc-by-sa"),
    ("cc by sa", "cc-by-sa"),
    ("cc0 1 0 universal", "cc0"),
    ("spdx license identifier", "spdx"),
)
#: One edit is allowed for so many characters of a notice.
EDIT_EVERY = 14
PIECE_BYTES = 2 << 20

_SEPARATORS = bytes(range(0x30)) + bytes(range(0x3A, 0x41)) + bytes(range(0x5B, 0x61)) + bytes(range(0x7B, 0x80))
_READ = bytes.maketrans(
    _SEPARATORS + bytes(range(0x41, 0x5B)), b" " * len(_SEPARATORS) + bytes(range(0x61, 0x7B))
)
# A word of the text as given: what _READ keeps, capitals too.
_WORD = re.compile("[0-9A-Za-z\u0080-\U0010ffff]+")


def as_words(text: str | None) -> str:
    """The words of ``text``, with a space before, between and after them."""
    words = (text or "").encode("utf-8", "surrogatepass").translate(_READ).split()
    return b" ".join([b"", *words, b""]).decode("utf-8", "surrogatepass")


@dataclass(frozen=True)
class Match:
    notice: int
    first: int
    after: int
    edits: int


class Scanner:
    """The notices (phrase, label), cut into pieces, ready to scan texts."""

    def __init__(self, notices=(*BASE, *NOTICES), edit_every: int = EDIT_EVERY):
        import ahocorasick
        import regex

        self.notices = tuple(notices)
        self.padded, self.edits, self.patterns = [], [], []
        pieces: dict[str, list[tuple[int, int]]] = {}
        for i, (phrase, _) in enumerate(self.notices):
            whole, k = f" {phrase} ", len(phrase) // edit_every
            self.padded.append(whole)
            self.edits.append(k)
            self.patterns.append(regex.compile(f"(?e)(?<= )(?:{regex.escape(phrase, literal_spaces=True)}){{e<={k}}}(?= )"))
            # Pieces of the phrase and the spaces around it; where no edit is allowed, the whole of it.
            parts = k + 2 if k else 1
            at = [j * len(whole) // parts for j in range(parts + 1)]
            for a, z in zip(at, at[1:]):
                # Spaces at the ends may be those of other words: a piece is inside the phrase.
                a, z = (max(a, 1), min(z, len(whole) - 1)) if k else (a, z)
                pieces.setdefault(whole[a:z], []).append((i, a))
        self.seeds = ahocorasick.Automaton()
        for piece, places in pieces.items():
            self.seeds.add_word(piece, (len(piece), places))
        self.seeds.make_automaton()

    def find(self, words: str) -> list[Match]:
        """Matches in ``words`` (as ``as_words`` gives them), by place and notice."""
        hits: dict[int, list[tuple[int, int]]] = {}
        for end, (size, places) in self.seeds.iter(words):
            at = end + 1 - size
            for i, offset in places:
                hits.setdefault(i, []).append((at - offset, offset))
        found = [(i, a, z, e) for i, seen in hits.items() for a, z, e in self._verify(words, i, seen)]
        if not found:
            return []
        spaces = np.flatnonzero(np.frombuffer(words.encode("utf-32-le", "surrogatepass"), "<u4") == 32)
        # A match goes from the space before its first word to the one after its last.
        return sorted(
            (Match(i, int(np.searchsorted(spaces, a)), int(np.searchsorted(spaces, z)), e) for i, a, z, e in found),
            key=lambda m: (m.first, m.after, m.notice),
        )

    def _verify(self, words: str, i: int, seen: list[tuple[int, int]]) -> Iterator[tuple[int, int, int]]:
        whole, k = self.padded[i], self.edits[i]
        size = len(whole) - 1
        exact = sorted(at for at in {at for at, _ in seen} if at >= 0 and words.startswith(whole, at))
        for at in exact:
            yield at, at + size, 0
        if not k:
            return
        here = 0
        for a, z in _windows(seen, size, k, len(words)):
            while here < len(exact) and exact[here] < a:
                here += 1
            # Between the unchanged ones, each with the spaces at its ends.
            while a < z:
                stop = exact[here] if here < len(exact) and exact[here] < z else z
                if stop + 1 - a >= size - k:
                    for m in self.patterns[i].finditer(words, a, stop + 1):
                        yield m.start() - 1, m.end(), sum(m.fuzzy_counts)
                a = stop + size if stop < z else z
                here += stop < z


def _windows(seen: list[tuple[int, int]], size: int, k: int, limit: int) -> Iterator[tuple[int, int]]:
    """From where to where two different pieces agree on a start; overlapping windows are one."""
    seen = sorted(set(seen))
    start = stop = -1
    for j, (at, offset) in enumerate(seen):
        top, more = None, j + 1
        while more < len(seen) and seen[more][0] - at <= k:
            if seen[more][1] != offset:
                top = seen[more][0]
            more += 1
        if top is None:
            continue
        a, z = max(0, at - k), min(limit, top + size + k + 1)
        if a > stop >= 0:
            yield start, stop
            start = a
        elif stop < 0:
            start = a
        stop = max(stop, z)
    if stop >= 0:
        yield start, stop


SPAN = "struct<label: string, base: boolean, notice: string, start: int, end: int, first: int, after: int, edits: int, similarity: double>"
FOUND = f"doc_id long, n_words long, matches array<{SPAN}>"


def scan(docs: DataFrame, notices=(*BASE, *NOTICES), n_base: int = len(BASE), edit_every: int = EDIT_EVERY) -> DataFrame:
    """(doc_id, n_words, matches) of every row. A match is ``base`` when it is one of the
    first ``n_base`` notices, unchanged; ``similarity`` is 1 - edits / length of the notice."""
    notices = tuple(notices)

    def run(batches: Iterator[pa.RecordBatch]):
        scanner = Scanner(notices, edit_every)
        for b in small_pieces(batches, "text", PIECE_BYTES):
            counts, found = [], []
            for text in b.column("text").to_pylist():
                words = as_words(text)
                counts.append(max(0, words.count(" ") - 1))
                matches = scanner.find(words)
                places = [m.span() for m in _WORD.finditer(text)] if matches else ()
                found.append([
                    {
                        "label": notices[m.notice][1], "base": m.notice < n_base and not m.edits, "notice": notices[m.notice][0],
                        "start": places[m.first][0], "end": places[m.after - 1][1], "first": m.first, "after": m.after,
                        "edits": m.edits, "similarity": 1 - m.edits / len(notices[m.notice][0]),
                    }
                    for m in matches
                ])
            yield {"doc_id": b.column("doc_id"), "n_words": counts, "matches": found}

    return packed(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), run, FOUND)


def op11(spark, sf_dir: str) -> DataFrame:
    found = scan(table(spark, sf_dir, "documents"))
    base = F.filter("matches", lambda m: m["base"])
    first = F.transform(base, lambda m: m["first"])

    def names(matches):
        return F.array_join(F.array_sort(F.array_distinct(F.transform(matches, lambda m: m["label"]))), ",")

    return found.select(
        "doc_id",
        "n_words",
        F.size(base).cast("long").alias("n_base"),
        F.array_min(first).cast("long").alias("first_word"),
        F.array_max(first).cast("long").alias("last_word"),
        names(base).alias("base_labels"),
        names(F.col("matches")).alias("labels"),
        F.coalesce(F.array_max(F.transform("matches", lambda m: m["similarity"])), F.lit(0.0)).alias("score"),
    )
