"""Operator 12: collocations by Toivonen's sampling.

A language's text is cut into pieces at ``[.,;:!?]`` and line ends, pieces into words at
spaces and tabs; A-Z is lower-cased. Phrases are runs of up to ``longest`` words within
a piece, counted with overlaps. A phrase is frequent from ``least`` occurrences on, and
then so is every phrase inside it.

1. Sample: the documents of one residue of a hash of their ids. What is frequent in
   them, at a lowered bound, is proposed.
2. Full pass over all documents. It counts the proposed phrases and their negative
   border: phrases that are not proposed, but all of whose parts are. Words are always
   counted: their parts are empty. Proposed phrases are counted by their text. Of the
   border only its frequent part matters, so it is counted by 64-bit hashes: two phrases
   that share one can only add to each other.
3. Border failures, frequent on the border, join the proposed phrases. Another full pass
   counts them by their text, and what they add to the border, and so on until a pass
   finds no failure. Then every frequent phrase has been counted exactly: one that was
   not would hold a shortest one that was not, which is on the border.

Proposals travel as a bitmap of fixed size (``BITS``), with ``PROBES`` bits a phrase: a
phrase that is taken for proposed is only counted without need. A task counts blocks of
text with numpy and packs what it has counted into a row per block and bucket, by hash; a
bucket is merged from these. So a phrase crosses the network once per block at most, a hot
word is one entry of each, and what one merge holds is bounded by the number of buckets,
which follows the width of the shuffle. Scores and the parts inside longer phrases are
joins on the frequent phrases, the parts of many phrases salted; ranks are top-k in two
steps. Numbers are exact: decimals where products pass 64 bits.

Null texts are empty; a null language is ``und``. Null and repeated ids are documents
like any other (a null id is in no sample). Empty and wordless tables give no rows. Other
columns are ignored.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from verisift.functions import top_k_per_group

from .blocks import pack_ints, pack_octets, squeeze, unpack_ints, unpack_words, unsqueeze
from .common import cut, fold, give_back, packed, shuffle_width, small_pieces, table

#: One document in so many is sampled, and this share of the expected count proposes.
SAMPLE = 4
LOWERED = 0.8
#: The bitmap of proposals, 16 MB, a power of two; and the bits of a phrase in it.
BITS = 1 << 27
PROBES = 2
SLICES = 64
#: Text of a block and of the pieces it is put together from, and places in the bitmap of a row.
#: A worker has some 25 times a block's text, beside a batch of Spark's.
BLOCK_BYTES = 4 << 20
PIECE_BYTES = 1 << 20
PLACES = 1 << 20
#: Buckets for each partition of a shuffle.
BUCKETS = 4
#: Parts that the candidates sharing one part of theirs are dealt into.
SALTS = 8

_BREAKS = b".,;:!?\x0a\x0b\x0c\x0d"
_READ = bytes.maketrans(
    _BREAKS + b"\t" + bytes(range(0x41, 0x5B)), b"\n" * len(_BREAKS) + b" " + bytes(range(0x61, 0x7B))
)
_BREAK = b"."  # no word holds it
_PRIME = np.uint64(0x9E3779B97F4A7C15)


def _mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(30))
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def _word_hashes(lang: str, words: list[bytes]) -> np.ndarray:
    import xxhash

    seed = xxhash.xxh3_64_intdigest(lang.encode("utf-8", "surrogatepass"))
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words, itertools.repeat(seed)), np.uint64, len(words))


def _longer(h: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Hashes of phrases: of those without their last words, and of these."""
    h = h * _PRIME
    h += last
    return _mix(h)


class Proposals:
    """A set of hashes that may hold more than was put in, never less."""

    def __init__(self, bits: np.ndarray):
        self.bits = bits

    @staticmethod
    def place(h: np.ndarray, probe: int, size: int) -> np.ndarray:
        """In a bitmap whose size is a power of two."""
        return (_mix(h + np.uint64(probe)) & np.uint64(size - 1)).view(np.int64)

    @classmethod
    def places(cls, h: np.ndarray, size: int) -> list[np.ndarray]:
        return [cls.place(h, j, size) for j in range(PROBES)]

    def has(self, h: np.ndarray) -> np.ndarray:
        out = self._hit(h, 0)
        for j in range(1, PROBES):
            left = np.flatnonzero(out)
            out[left] = self._hit(h[left], j)
        return out

    def _hit(self, h: np.ndarray, probe: int) -> np.ndarray:
        at = self.place(h, probe, len(self.bits) * 8)
        bit = (at & 7).astype(np.uint8)
        at >>= 3
        return (self.bits[at] >> bit & np.uint8(1)).astype(bool)


class _Tokens:
    """The words of one language in a block: numbers in order, 0 for a break, and their hashes."""

    def __init__(self, lang: str, texts: list[str]):
        raw = "\n".join(texts).encode("utf-8", "surrogatepass").translate(_READ).replace(b"\n", b" . ")
        whole = pa.LargeStringArray.from_buffers(1, pa.py_buffer(np.array([0, len(raw)]).tobytes()), pa.py_buffer(raw))
        # Splits at white space of ASCII; there is none left but spaces.
        found = pc.ascii_split_whitespace(whole).flatten().dictionary_encode()
        del raw, whole
        # Breaks are 0, words from 1 on; the ends of the text may have given an empty one.
        distinct = found.dictionary.cast(pa.large_binary())
        breaks, empty = (distinct.index(_scalar(w)).as_py() for w in (_BREAK, b""))
        is_word = np.ones(len(distinct), bool)
        is_word[[k for k in (breaks, empty) if k >= 0]] = False
        number = np.where(is_word, np.cumsum(is_word), -1)
        if breaks >= 0:
            number[breaks] = 0
        seq = number[found.indices.to_numpy()]
        self.seq = seq[seq >= 0] if empty >= 0 else seq
        self.words = pa.concat_arrays([_octets([_BREAK]), distinct.filter(pa.array(is_word))])
        del found, distinct, seq
        _, ends, octets = self.words.buffers()
        ends, octets = np.frombuffer(ends, np.int64, len(self.words) + 1).tolist(), octets.to_pybytes()
        self.hashes = _word_hashes(lang, [octets[a:z] for a, z in zip(ends, ends[1:])])
        # Keys of phrases start with the language's line: no phrase holds a line break.
        self.lang = lang.encode("utf-8", "surrogatepass")

    def counted(self, longest: int, now: Proposals | None, before: Proposals | None):
        """For each length: the hashes and counts of distinct phrases on the border, and the
        hashes, counts and keys of the proposed ones, leaving out what a pass with the
        proposals ``before`` has counted. Without proposals, all are on the border.

        What a phrase is follows from its place: its hash from those of the phrase without
        its last word and of that word, whether it is proposed from the phrases without
        its last and without its first word. Only what is counted is sorted.
        """
        seq = self.seq
        nothing = np.zeros(0, np.uint64), np.zeros(0, np.int64), _octets([])
        inside = seq > 0
        # Of the phrase that starts at a place: its hash, whether it is (was) proposed.
        h = self.hashes[seq]
        if now is None:
            new, old = inside, np.zeros(len(seq), bool)
            n = np.bincount(seq, minlength=len(self.words))[1:]
            yield self.hashes[1:][n > 0], n[n > 0].astype(np.uint32), *nothing
        else:
            own = now.has(self.hashes)
            was = own & before.has(self.hashes) if before is not None else np.zeros(len(own), bool)
            own[0] = was[0] = False
            n = np.bincount(seq, minlength=len(own))
            # Words are all counted in the first pass, by their text or as border.
            border = ~own if before is None else np.zeros(len(own), bool)
            border[0] = False
            text = np.flatnonzero(own & ~was)
            yield self.hashes[border], n[border].astype(np.uint32), self.hashes[text], n[text], self._keys([text])
            del n, text
            new, old = own[seq], was[seq]
        for length in range(2, longest + 1):
            at = np.flatnonzero(new[:-1] & new[1:])
            if now is None and length > 2:
                at = at[inside[at + length - 1]]
            longer = _longer(h[at], self.hashes[seq[at + length - 1]])
            h = None
            if now is None:
                yield *_totals(longer), *nothing
                own, was = np.ones(len(at), bool), np.zeros(len(at), bool)
            else:
                done = old[at] & old[at + 1]
                own = now.has(longer)
                was = done & own
                if before is not None:
                    was[was] = before.has(longer[was])
                text = own & ~was
                yield *_totals(longer[~own & ~done]), *self._by_text(at[text], length)
            if length == longest:
                break
            h, new, old = np.zeros(len(seq), np.uint64), np.zeros(len(seq), bool), np.zeros(len(seq), bool)
            h[at], new[at], old[at] = longer, own, was
            del at, longer

    def _by_text(self, at: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, pa.Array]:
        """Hashes, counts and keys of the distinct phrases at some places."""
        wide = len(self.words)
        if wide**length < 1 << 63:
            key = self.seq[at]
            for j in range(1, length):
                key *= np.int64(wide)
                key += self.seq[at + j]
            key, n = np.unique(key, return_counts=True)
            rows = []
            for _ in range(length):
                key, word = np.divmod(key, np.int64(wide))
                rows.insert(0, word)
        else:
            rows, n = np.unique(self.seq[at[:, None] + np.arange(length)], axis=0, return_counts=True)
            rows = list(rows.T)
        h = self.hashes[rows[0]]
        for word in rows[1:]:
            h = _longer(h, self.hashes[word])
        return h, n, self._keys(rows)

    def _keys(self, rows: list[np.ndarray]) -> pa.Array:
        """Of phrases given by their first words, second words, ..."""
        phrases = pc.binary_join_element_wise(*(self.words.take(pa.array(word)) for word in rows), _scalar(b" "))
        return pc.binary_join_element_wise(_scalar(self.lang), phrases, _scalar(b"\n"))


def _octets(values: list[bytes]) -> pa.Array:
    return pa.array(values, pa.large_binary())


def _scalar(value: bytes) -> pa.Scalar:
    return pa.scalar(value, pa.large_binary())


def _totals(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    h, n = np.unique(h, return_counts=True)
    return h, n.astype(np.uint32)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, list[str]]]:
    """Texts of about ``BLOCK_BYTES``, by language; who gets a block may empty it."""
    held: dict[str, list[str]] = {}
    size = 0
    for b in small_pieces(batches, "text", min(PIECE_BYTES, BLOCK_BYTES)):
        for lang, text in zip(b.column("lang").to_pylist(), b.column("text").to_pylist()):
            held.setdefault(lang, []).append(text)
        del text
        size += b.column("text").nbytes
        if size >= BLOCK_BYTES:
            yield held
            held, size = {}, 0
    if held:
        yield held


def _texts(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    return docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), text)


PACKED = "bucket int, hashes binary, counts binary, phrases binary, n binary"


def _counts(docs: DataFrame, longest: int, now=None, before=None) -> DataFrame:
    """A row per block and bucket: counts of its border by hash, and of its proposed phrases by key."""
    buckets = BUCKETS * shuffle_width(docs.sparkSession)

    def run(batches):
        for block in _blocks(batches):
            found = []
            # One language at a time: only what is counted of the others is held.
            while block:
                tokens = _Tokens(*block.popitem())
                found += tokens.counted(longest, now and now.value, before and before.value)
                if before is None and now is not None:
                    # How many words there are of the language, as a phrase of none.
                    n = np.array([np.count_nonzero(tokens.seq)])
                    found.append((np.zeros(0, np.uint64), np.zeros(0, np.uint32), _word_hashes("", [tokens.lang + b"\n"]), n, _octets([tokens.lang + b"\n"])))
                del tokens
            yield from _by_bucket(found, buckets)
        give_back()

    return packed(_texts(docs), run, PACKED)


def _by_bucket(found: list[tuple], buckets: int) -> Iterator[dict]:
    """A row per bucket of what a block's languages have; ``found`` is emptied."""
    border, border_n, text, text_n = (np.concatenate(x) for x in list(zip(*found))[:4])
    keys = pa.concat_arrays([x[4] for x in found])
    found.clear()
    b_order, b_ends = _dealt(border, buckets)
    t_order, t_ends = _dealt(text, buckets)
    keys, text_n = keys.take(pa.array(t_order)), text_n[t_order]
    _, ends, octets = keys.buffers()
    # Nothing but empty arrays may have no buffers.
    ends = np.frombuffer(ends, np.int64, len(keys) + 1) if len(keys) else np.zeros(1, np.int64)
    for k in range(buckets):
        b, t = b_order[b_ends[k] : b_ends[k + 1]], slice(t_ends[k], t_ends[k + 1])
        if len(b) or t.start < t.stop:
            to = ends[t.start : t.stop + 1]
            yield {
                "bucket": [k], "hashes": [border[b].tobytes()], "counts": [squeeze(border_n[b].astype("<u4").tobytes())],
                "phrases": [pack_octets(to, octets)], "n": [pack_ints(text_n[t])],
            }


def _dealt(h: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of hashes, bucket by bucket, and where each bucket starts."""
    # Numbers of 16 bits are sorted by their digits.
    at = (h % np.uint64(buckets)).astype(np.uint16 if buckets <= 1 << 16 else np.int64)
    return np.argsort(at, kind="stable"), np.concatenate([[0], np.cumsum(np.bincount(at, minlength=buckets))])


MERGED = "lang string, length int, phrase string, n long, hashes binary"


def _merged(rows: DataFrame, least: int) -> DataFrame:
    """The phrases counted ``least`` times or more over all blocks (and the numbers of words,
    as length 0), and, as ``hashes``, those of the border."""

    def totals(hashes: list[np.ndarray], counts: list[np.ndarray]) -> np.ndarray:
        h = np.concatenate(hashes)
        order = np.argsort(h, kind="stable")
        h, n = h[order], np.concatenate(counts)[order].astype(np.int64)
        del order
        starts = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
        return h[starts][np.add.reduceat(n, starts) >= least] if len(h) else h

    def finish(hashes, counts, text) -> Iterator[dict]:
        keys = [k for k, n in text.items() if n >= least or k.endswith(b"\n")]
        split = [k.rpartition(b"\n") for k in keys]
        yield {
            "lang": [lang.decode("utf-8", "surrogatepass") for lang, _, _ in split],
            "length": [p.count(b" ") + 1 if p else 0 for _, _, p in split],
            "phrase": [p.decode("utf-8", "surrogatepass") for _, _, p in split],
            "n": [text[k] for k in keys], "hashes": [None] * len(keys),
        }
        some = totals(hashes, counts) if hashes else ()
        if len(some):
            yield {"lang": [None], "length": [None], "phrase": [None], "n": [None], "hashes": [some.tobytes()]}

    def run(batches):
        bucket, hashes, counts, text = None, [], [], {}
        for b in batches:
            # Row by row, the hashes where the batch has them.
            for r in zip(*(b.column(name) for name in ("bucket", "hashes", "counts", "phrases", "n"))):
                if r[0].as_py() != bucket:
                    if bucket is not None:
                        yield from finish(hashes, counts, text)
                    bucket, hashes, counts, text = r[0].as_py(), [], [], {}
                hashes.append(np.frombuffer(r[1].as_buffer(), "<u8"))
                counts.append(np.frombuffer(unsqueeze(r[2].as_py()), "<u4"))
                for k, n in zip(unpack_words(r[3].as_py()), unpack_ints(r[4].as_py()).tolist()):
                    text[k] = text.get(k, 0) + n
        if bucket is not None:
            yield from finish(hashes, counts, text)
        hashes = counts = text = b = r = None
        give_back()

    dealt = rows.repartition(shuffle_width(rows.sparkSession), "bucket").sortWithinPartitions("bucket")
    return cut(packed(dealt, run, MERGED))


def _propose(merged: DataFrame, size: int) -> Proposals:
    """The bitmap of the hashes in ``merged``, built slice by slice and gathered: ``size`` bits."""
    per = size // SLICES

    def place(batches):
        def rows(held):
            at = np.sort(np.concatenate([x for h in held for x in Proposals.places(h, size)]))
            ends = np.searchsorted(at, np.arange(SLICES + 1) * per)
            for k in np.flatnonzero(np.diff(ends)).tolist():
                yield {"slice": [k], "at": [squeeze((at[ends[k] : ends[k + 1]] - k * per).astype("<u4").tobytes())]}

        held, n = [], 0
        for b in batches:
            for raw in b.column("hashes"):
                held.append(np.frombuffer(raw.as_py(), "<u8"))
                n += len(held[-1])
                if n >= PLACES:
                    yield from rows(held)
                    held, n = [], 0
        if held:
            yield from rows(held)

    def fill(batches):
        slices: dict[int, np.ndarray] = {}
        for b in batches:
            for k, raw in zip(b.column("slice").to_pylist(), b.column("at").to_pylist()):
                bits, at = slices.setdefault(k, np.zeros(per // 8, np.uint8)), np.frombuffer(unsqueeze(raw), "<u4")
                np.bitwise_or.at(bits, at >> 3, np.uint8(1) << (at & 7).astype(np.uint8))
        yield {"slice": list(slices), "bits": [squeeze(v.tobytes()) for v in slices.values()]}

    dealt = packed(merged.where("hashes is not null").select("hashes"), place, "slice int, at binary").repartition(SLICES, "slice")
    out = np.zeros((SLICES, per // 8), np.uint8)
    for r in packed(dealt, fill, "slice int, bits binary").collect():
        out[r.slice] = np.frombuffer(unsqueeze(r.bits), np.uint8)
    return Proposals(out.reshape(-1))


def frequent(docs: DataFrame, longest: int = 3, least: int = 10, sample: int = SAMPLE, bits: int = BITS) -> tuple[DataFrame, int]:
    """(lang, length, phrase, n) of every phrase of up to ``longest`` words with ``least``
    occurrences, exactly; and of all words, as length 0. Also the number of full passes."""
    if longest < 2 or least < 1:
        raise ValueError("longest is 2 at least, least is 1 at least")
    sc = docs.sparkSession.sparkContext
    sampled = docs.where(fold(F.col("doc_id"), sample) == 0)
    proposed = _propose(_merged(_counts(sampled, longest), max(1, int(LOWERED * least / sample))), bits)
    now, before = sc.broadcast(proposed), None
    found = []
    while True:
        merged = _merged(_counts(docs, longest, now, before), least)
        found.append(merged.where("hashes is null").drop("hashes"))
        failed = _propose(merged, bits)
        if not failed.bits.any():
            break
        proposed = Proposals(proposed.bits | failed.bits)
        before, now = now, sc.broadcast(proposed)
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out, len(found)


def _numbers(x):
    return x.cast("decimal(38,0)")


def collocations(docs: DataFrame, longest: int = 3, least: int = 10, inside_pct: int = 50, top: int = 2000, sample: int = SAMPLE) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's first ``top`` phrases of 2 to ``longest`` words.

    The score is the least, over the cuts of the phrase into two, of 1,000,000 a a / (l r),
    rounded down. Phrases inside a longer frequent one with ``inside_pct`` per cent of their
    occurrences are left out.
    """
    counts, _ = frequent(docs, longest, least, sample)
    known = counts.where("length > 0").select("lang", "phrase", "n")
    words = F.split("phrase", " ", -1)
    candidates = counts.where("length > 1").select("lang", "phrase", "length", F.col("n").alias("a"), words.alias("w"))

    def part(start, size):
        return F.array_join(F.slice("w", start, size), " ")

    inner = candidates.where("length > 2").select(
        "lang", "a", F.explode(F.expr(
            "flatten(transform(sequence(2, length - 1), m -> transform(sequence(1, length - m + 1), s -> array_join(slice(w, s, m), ' '))))"
        )).alias("phrase"),
    )
    longer = inner.groupBy("lang", "phrase").agg(F.max("a").alias("most"))
    left = candidates.join(longer, ["lang", "phrase"], "left").where(
        F.col("most").isNull() | (100 * _numbers(F.col("most")) < inside_pct * _numbers(F.col("a")))
    )
    # One part may be a part of a third of all phrases: it is there SALTS times.
    salt = F.pmod(F.xxhash64("phrase"), F.lit(SALTS)).cast("int")
    cuts = left.select("lang", "phrase", "w", "a", F.explode(F.sequence(F.lit(1), F.col("length") - 1)).alias("k"), salt.alias("salt"))
    cuts = cuts.select(
        "lang", "phrase", "a", "k", "salt", part(F.lit(1), F.col("k")).alias("p"), part(F.col("k") + 1, F.size("w") - F.col("k")).alias("q")
    )
    parts = known.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    heads = parts.select("lang", F.col("phrase").alias("p"), F.col("n").alias("l"), "salt")
    tails = parts.select("lang", F.col("phrase").alias("q"), F.col("n").alias("r"), "salt")
    scored = cuts.join(heads, ["lang", "p", "salt"]).join(tails, ["lang", "q", "salt"])
    product = _numbers(F.col("l")) * _numbers(F.col("r"))
    square = (_numbers(F.col("a")) * _numbers(F.col("a"))).cast("decimal(38,0)") * _numbers(F.lit(1_000_000))
    scored = scored.withColumn("square", square.cast("decimal(38,0)")).withColumn("product", product.cast("decimal(38,0)"))
    scored = scored.withColumn("score", F.expr("square div product"))
    best = scored.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("b")).select("lang", "phrase", "a", "b.score", "b.l", "b.r")
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase").asc()]
    ranked = top_k_per_group(best, ["lang"], order, top, salt_cols=["phrase"], salt_buckets=16, rank_col="rank")
    # A row per language.
    all_words = counts.where("length = 0").select("lang", "n")
    return ranked.join(all_words, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def op12(spark, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"), 3, 10, 50, 2000)


SQL = r"""
with cleaned as (
  select coalesce(lang, 'und') as lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as t from documents
),
pieces as (
  select lang, row_number() over () as piece, p from (select lang, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) as p from cleaned)
),
words as (
  select lang, piece, regexp_split_to_array(p, '[ \t]+') as w from pieces
),
placed as (
  select * from (select lang, piece, unnest(w) as x, generate_subscripts(w, 1) as pos from words) where x <> ''
),
runs as (
  select lang, x, lead(x) over o as y, lead(x, 2) over o as z from placed window o as (partition by piece order by pos)
),
grams as (
  select lang, x as phrase, 1 as m from runs
  union all select lang, x || ' ' || y, 2 from runs where y is not null
  union all select lang, x || ' ' || y || ' ' || z, 3 from runs where z is not null
),
f as (select lang, phrase, m, count(*) as n from grams group by all),
cand as (select lang, phrase, m, n as a, string_split(phrase, ' ') as w from f where m > 1 and n >= 10),
inner_ as (
  select lang, w[1] || ' ' || w[2] as phrase, a from cand where m = 3
  union all select lang, w[2] || ' ' || w[3], a from cand where m = 3
),
longer as (select lang, phrase, max(a) as most from inner_ group by all),
kept as (
  select c.* from cand c left join longer g on c.lang = g.lang and c.phrase = g.phrase and c.m = 2
  where g.most is null or 100 * g.most < 50 * c.a
),
cuts as (
  select lang, phrase, a, 1 as k, w[1] as p, array_to_string(w[2:], ' ') as q from kept
  union all select lang, phrase, a, 2, w[1] || ' ' || w[2], w[3] from kept where m = 3
),
scored as (
  select c.lang, c.phrase, c.a, c.k, p.n as l, q.n as r, (1000000::hugeint * c.a * c.a) // (p.n::hugeint * q.n) as score
  from cuts c join f p on p.lang = c.lang and p.phrase = c.p join f q on q.lang = c.lang and q.phrase = c.q
),
best as (select *, row_number() over (partition by lang, phrase order by score, k) as i from scored),
ranked as (select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank from best where i = 1)
select r.lang, cast(rank as bigint) as rank, phrase, cast(a as bigint) as a, cast(l as bigint) as l, cast(r as bigint) as r, cast(n as bigint) as n, cast(score as bigint) as score
from ranked r join (select lang, count(*) as n from placed group by lang) using (lang) where rank <= 2000
"""
