"""Operator 13: spelling variants grouped under their most frequent form.

Words are maximal runs of ``[A-Za-z\\u00C0-\\u00FF]``, with A-Z lower-cased. Two words are
near if one inserted, deleted or replaced code point makes one of the other.

1. A task counts the words of its documents; the counts are added by word. The vocabulary
   is of words of at least ``shortest`` code points and ``least`` occurrences.
2. The vocabulary goes into blocked Bloom filters, one per word length, with a 64-bit
   block and ``PROBES`` bits of it per word. They are broadcast: ``FILTER_BYTES`` in all
   at most, however large the vocabulary. A fuller filter costs false positives, no word.
3. Each word's edits are probed by numpy: all deletions, against the filter of the
   words one shorter, and all replacements by a larger character, against its own
   length's. Insertions are the deletions of the longer word, smaller replacements
   those of the other word, so each near pair is generated once. Hashes of edits come
   from sums of prefixes and suffixes; only positives are written out.
4. Positives are shuffled to an exact join with the vocabulary, which drops the false
   ones. A word's near ones, both ways, are aggregated before they meet it: a count and the
   near word of largest count.

A word's form is its near word of largest count (ties: the smallest in code-point order),
if that count is ``times`` its own or more. Counts grow along forms, so these end; roots
are found by doubling, and rounds are checkpointed.

A planted misspelling (``noise``) is part of the reading: where ``noise`` divides the crc32
of ``<doc_id>:<run>``, one code point of the run is deleted. A null id is written as
nothing. Null and empty texts have no runs; repeated rows count again; an empty table
gives no words; other columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blocks import squeeze, unsqueeze
from .common import cut, packed, shuffle_width, small_pieces, table

#: All filters together, and bits of a filter per word while there is room.
FILTER_BYTES = 64 << 20
BITS_A_WORD = 16
PROBES = 4
PIECE_BYTES = 2 << 20
#: Distinct words that a task holds before it hands on what it has counted.
HELD_WORDS = 400_000
#: Edits that are probed at once.
EDITS_AT_ONCE = 1 << 20
#: Parts that the words with one form are dealt into.
SALTS = 8

_RUN = re.compile("[A-Za-zÀ-ÿ]+")
_LOWER = bytes.maketrans(bytes(range(0x41, 0x5B)), bytes(range(0x61, 0x7B)))
# Characters of lower-cased runs.
_ALPHABET = np.array([*range(0x61, 0x7B), *range(0xC0, 0x100)], np.int64)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


_BASE = np.uint64(0x9E3779B97F4A7C15)
# A value per character: edits of one word must not cancel out.
_VALUE = _mix(np.arange(1, 0x101, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))


# ------------------------------------------------------------------ the vocabulary


def read_runs(doc_id: int | None, text: str | None, noise: int) -> Counter:
    """How often each word is read in a text, planted deletions applied."""
    runs = Counter(_RUN.findall((text or "").encode("utf-8", "surrogatepass").translate(_LOWER).decode("utf-8", "surrogatepass")))
    if not noise:
        return runs
    out: Counter = Counter()
    start = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
    for run, n in runs.items():
        h = zlib.crc32(run.encode(), start)
        if h % noise == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1 :]
        out[run] += n
    return out


def vocabulary(docs: DataFrame, shortest: int = 6, least: int = 5, noise: int = 0) -> DataFrame:
    """(word, n) of the words of at least ``shortest`` code points and ``least`` occurrences."""

    def run(batches: Iterator[pa.RecordBatch]):
        held: Counter = Counter()
        for b in small_pieces(batches, "text", PIECE_BYTES):
            for i, text in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist()):
                held.update(read_runs(i, text, noise))
            if len(held) >= HELD_WORDS:
                yield _long_enough(held, shortest)
                held = Counter()
        yield _long_enough(held, shortest)

    words = packed(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), run, "word string, n long")
    return words.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least)


def _long_enough(held: Counter, shortest: int) -> dict:
    words = [w for w in held if len(w) >= shortest]
    return {"word": words, "n": [held[w] for w in words]}


# ------------------------------------------------------------------ filters


def _codes(words: list[str], length: int) -> np.ndarray:
    """Code points, a row per word of ``length``."""
    return np.frombuffer("".join(words).encode("utf-32-le"), "<u4").reshape(-1, length).astype(np.int64)


def _powers(length: int) -> np.ndarray:
    out = np.ones(length + 1, np.uint64)
    for k in range(1, length + 1):
        out[k] = out[k - 1] * _BASE
    return out


def _sums(codes: np.ndarray) -> np.ndarray:
    """Hashes, before mixing, of every word's prefixes: column ``k`` is of the first ``k`` characters."""
    out = np.zeros((codes.shape[0], codes.shape[1] + 1), np.uint64)
    for k in range(codes.shape[1]):
        out[:, k + 1] = out[:, k] * _BASE + _VALUE[codes[:, k]]
    return out


def _places(h: np.ndarray, blocks: int) -> tuple[np.ndarray, np.ndarray]:
    """The block of each hash, and the bits of it."""
    h = _mix(h)
    block = ((h >> np.uint64(32)) * np.uint64(blocks)) >> np.uint64(32)
    bits = np.zeros(len(h), np.uint64)
    for k in range(PROBES):
        bits |= np.uint64(1) << ((h >> np.uint64(6 * k)) & np.uint64(63))
    return block.astype(np.int64), bits


class Filters:
    """Blocked Bloom filters by word length."""

    def __init__(self, blocks: dict[int, np.ndarray]):
        self.blocks = blocks

    def may_hold(self, length: int, h: np.ndarray) -> np.ndarray:
        own = self.blocks.get(length)
        if own is None:
            return np.zeros(len(h), bool)
        block, bits = _places(h, len(own))
        return own[block] & bits == bits


def _by_length(words: list[str]) -> Iterator[tuple[int, list[str]]]:
    groups: dict[int, list[str]] = {}
    for w in words:
        groups.setdefault(len(w), []).append(w)
    yield from groups.items()


def filters(words: DataFrame, limit: int = FILTER_BYTES) -> Filters:
    """Filters of all ``words``: bits are merged block by block in a shuffle, and the blocks,
    ``limit`` bytes together at most, are gathered."""
    by_length = words.groupBy(F.length("word").alias("length")).count().collect()  # a row per word length
    total = sum(r["count"] for r in by_length)
    room = min(BITS_A_WORD * total // 8, limit)
    blocks = {r["length"]: max(1, room // 8 * r["count"] // total) for r in by_length}

    def place(batches):
        for b in batches:
            for length, group in _by_length(b.column("word").to_pylist()):
                at, bits = _places(_sums(_codes(group, length))[:, -1], blocks[length])
                yield {"length": [length] * len(group), "at": at, "bits": bits.view(np.int64)}

    def pack(batches):
        for b in batches:
            lengths, at, bits = (b.column(c).to_numpy() for c in ("length", "at", "bits"))
            for length in np.unique(lengths).tolist():
                mine = lengths == length
                yield {"length": [length], "at": [squeeze(at[mine].tobytes())], "bits": [squeeze(bits[mine].tobytes())]}

    merged = packed(words.select("word"), place, "length int, at long, bits long").groupBy("length", "at").agg(F.bit_or("bits").alias("bits"))
    out = {k: np.zeros(n, np.uint64) for k, n in blocks.items()}
    for r in packed(merged, pack, "length int, at binary, bits binary").collect():
        out[r.length][np.frombuffer(unsqueeze(r.at), np.int64)] |= np.frombuffer(unsqueeze(r.bits), np.uint64)
    return Filters(out)


# ------------------------------------------------------------------ neighbourhoods


def probe(words: list[str], known: Filters) -> Iterator[tuple[list[int], list[str]]]:
    """Numbers of words, and an edit of each that the filters may hold. Of two near words of
    one length only the smaller gives the other, of two lengths only the longer."""
    numbers: dict[int, list[int]] = {}
    for i, w in enumerate(words):
        numbers.setdefault(len(w), []).append(i)
    for length, own in numbers.items():
        step = max(1, EDITS_AT_ONCE // max(len(_ALPHABET), length))
        power = _powers(length)
        for a in range(0, len(own), step):
            some = own[a : a + step]
            codes = _codes([words[i] for i in some], length)
            sums = _sums(codes)
            whole = sums[:, -1]
            for at in range(length):
                here, scale = codes[:, at], power[length - 1 - at]
                # Deleting either of two equal neighbours gives one word.
                new = np.ones(len(some), bool) if at == 0 else here != codes[:, at - 1]
                rest = whole[new] - sums[new, at + 1] * scale
                found = np.flatnonzero(new)[known.may_hold(length - 1, sums[new, at] * scale + rest)]
                if len(found):
                    yield [some[j] for j in found], [words[some[j]][:at] + words[some[j]][at + 1 :] for j in found.tolist()]
                j, c = np.nonzero(_ALPHABET[None, :] > here[:, None])
                h = whole[j] + (_VALUE[_ALPHABET[c]] - _VALUE[here[j]]) * scale
                found = known.may_hold(length, h)
                if found.any():
                    hits = list(zip(j[found].tolist(), _ALPHABET[c[found]].tolist()))
                    yield [some[j] for j, _ in hits], [words[some[j]][:at] + chr(c) + words[some[j]][at + 1 :] for j, c in hits]


def near_pairs(words: DataFrame, limit: int = FILTER_BYTES) -> DataFrame:
    """(word, near, n): every near pair of ``words`` (word, n), both ways, ``n`` that of ``near``."""
    spark = words.sparkSession
    known = spark.sparkContext.broadcast(filters(words, limit))

    def run(batches):
        for b in batches:
            some, n = b.column("word").to_pylist(), b.column("n").to_numpy()
            for own, edits in probe(some, known.value):
                yield {"word": [some[i] for i in own], "own": n[own], "near": edits}

    # Probing takes far longer than reading: dealt to all tasks, however few bytes there are.
    positive = packed(words.repartition(shuffle_width(spark), "word"), run, "word string, own long, near string")
    met = positive.join(words.select(F.col("word").alias("near"), "n"), "near")
    return met.select(
        F.explode(F.array(F.struct("word", "near", "n"), F.struct(F.col("near").alias("word"), F.col("word").alias("near"), F.col("own").alias("n")))).alias("p")
    ).select("p.*")


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) of every row of ``forms`` (word, form): forms of forms, by doubling."""
    at = cut(forms.select("word", F.col("form").alias("next")))
    while True:
        # Many words can have one form: it is there SALTS times.
        of = at.select(F.col("word").alias("form"), F.col("next").alias("after"), F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
        step = at.withColumn("form", F.col("next")).withColumn("salt", F.pmod(F.xxhash64("word"), F.lit(SALTS)).cast("int"))
        moved = cut(step.join(of, ["form", "salt"], "left").select("word", F.coalesce("after", "next").alias("next"), F.col("after").isNotNull().alias("more")))
        at = moved.select("word", "next")
        if moved.where("more").isEmpty():
            return at.select("word", F.col("next").alias("root"))


def group(docs: DataFrame, shortest: int = 6, least: int = 5, times: int = 5, noise: int = 0, limit: int = FILTER_BYTES) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word of the vocabulary."""
    if shortest < 1:
        raise ValueError("shortest is 1 at least")
    words = cut(vocabulary(docs, shortest, least, noise))
    near = near_pairs(words, limit).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("n")).alias("m"), F.col("near").alias("w"))).alias("best"))
    best = F.col("best")
    large = -best["m"] >= times * F.col("n")
    placed = cut(
        words.join(near, "word", "left").select(
            "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(large, best["w"]).alias("form"), F.when(large, -best["m"]).alias("form_n"),
        )
    )
    roots = _roots(placed.where("form is not null"))
    return placed.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op13(spark, sf_dir: str) -> DataFrame:
    return group(table(spark, sf_dir, "documents"), 6, 5, 5, 199)
