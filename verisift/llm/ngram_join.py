"""Operator 4: documents whose sets of word n-grams have a Jaccard similarity of a threshold or more.

The documents' n-gram incidence is a sparse matrix with a row per document; a
product with its transpose holds, for each pair, the n-grams they share. Only
as much of it is computed as the sizes leave open:

1. Documents with the same set are one class, represented by one of them.
2. N-grams get one order for all documents, rare ones first. Two sets of sizes
   ``a`` and ``b`` that reach the threshold share an n-gram among the first
   ``a - ceil(t a) + 1`` of the one and the first ``b - ceil(t b) + 1`` of the other (their heads),
   so only the columns of heads are multiplied. The order comes from a fixed-size
   table of counts over all documents; any order gives the same result.
3. Each document is first compared with the smallest id among those it shares
   most of its head with. These few pairs join most of each group of near copies.
4. Rows of a column whose document can't reach the threshold with any size met there are
   dropped. The product of the others: per n-gram, the documents outside its first document's component
   meet all others of its block from other components, where what may follow in
   both heads, and what the sizes leave beyond these, can still reach the
   threshold. Pairs whose heads' whole overlap can't reach it are dropped, and
   the rest are verified on their whole sets.
5. Components of the links found are those of all links: what was not compared
   was in one component already, or could not reach the threshold.

A set is of 64-bit hashes of n-grams. A text with fewer words than n has its whole
sequence as the only n-gram; null, empty and blank texts have an empty set and no links.
Each row keeps its row; rows with one id are one node, compared by the largest of their
sets. A null id has no links and no component. Empty tables give no rows. Other
columns are ignored, or kept by ``first_of_group``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .blocks import squeeze, unsqueeze
from .common import cut, free_name, give_back, packed, small_pieces, table
from .components import components

PIECE_BYTES = 1 << 20
#: Entries of the table of counts that orders n-grams, four bytes each when it is broadcast.
COUNTERS = 1 << 22
SLICES = 64
#: Parts that the pairs of one document are dealt into.
SALTS = 16
#: Ids up to which a set of candidates is sent to every executor; beyond it, both sides are shuffled.
BROADCAST_IDS = 1_000_000


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def gram_sets(texts: list[str | None], n: int) -> list[np.ndarray]:
    """The distinct hashes of each text's n-grams, ascending."""
    import xxhash

    digest, known, out = xxhash.xxh3_64_intdigest, {}, []
    split = [t.encode("utf-8", "surrogatepass").lower().split() if t else [] for t in texts]
    for w in set().union(*split) if split else ():
        known[w] = digest(w)
    for words in split:
        h = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        k = min(n, len(h))
        if not k:
            out.append(h)
            continue
        g = np.full(len(h) - k + 1, k, np.uint64)
        for j in range(k):
            g = _mix(g * np.uint64(0x9E3779B97F4A7C15) + h[j : len(h) - k + 1 + j])
        out.append(np.unique(g))
    return out


def _pieces(batches: Iterator[pa.RecordBatch], n: int) -> Iterator[tuple[pa.Array, list[np.ndarray]]]:
    for b in small_pieces(batches, "text", PIECE_BYTES):
        yield b.column("doc_id"), gram_sets(b.column("text").to_pylist(), n)
    give_back()


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))


def summaries(docs: DataFrame, n: int) -> DataFrame:
    """A row per document: its set's size and a digest of the set; and, with a null
    ``n_grams``, the task's counts of n-grams by hash, a row per slice of the counters."""

    def run(batches):
        import hashlib

        counts = np.zeros(COUNTERS, np.uint32)
        for ids, sets in _pieces(batches, n):
            h = np.concatenate(sets) & np.uint64(COUNTERS - 1)
            np.add.at(counts, h.astype(np.int64), np.uint32(1))
            digests = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets]
            m = len(sets)
            yield {"doc_id": ids, "n_grams": [len(s) for s in sets], "digest": digests, "slice": [None] * m, "counts": [None] * m}
        some = [k for k, c in enumerate(counts.reshape(SLICES, -1)) if c.any()]
        none = [None] * len(some)
        yield {"doc_id": none, "n_grams": none, "digest": none, "slice": some, "counts": [squeeze(counts.reshape(SLICES, -1)[k].tobytes()) for k in some]}

    return packed(_texts(docs), run, "doc_id long, n_grams long, digest binary, slice int, counts binary")


def _counters(rows: DataFrame):
    """The sum of all tasks' counts: COUNTERS numbers, whatever the corpus is."""

    def add(batches):
        total: dict[int, np.ndarray] = {}
        for b in batches:
            for k, c in zip(b.column("slice").to_pylist(), b.column("counts").to_pylist()):
                one = np.frombuffer(unsqueeze(c), np.uint32)
                total[k] = total[k] + one if k in total else one.astype(np.uint64)
        yield {"slice": list(total), "counts": [np.minimum(v, 0xFFFFFFFF).astype("<u4").tobytes() for v in total.values()]}

    dealt = rows.where("slice is not null").select("slice", "counts").repartition(SLICES, "slice")
    out = np.zeros((SLICES, COUNTERS // SLICES), np.uint32)
    for r in packed(dealt, add, "slice int, counts binary").collect():
        out[r.slice] = np.frombuffer(r.counts, "<u4")
    return out.reshape(-1)


HEADS = "doc_id long, size long, last_c long, last_g long, head array<long>"


def heads(docs: DataFrame, n: int, per_cent: int, counters: np.ndarray) -> DataFrame:
    """The first n-grams of each set in the order of (count, hash), and the last of these in that order."""
    order = docs.sparkSession.sparkContext.broadcast(counters)

    def run(batches):
        count_of = order.value
        for ids, sets in _pieces(batches, n):
            gs, sizes = [], []
            last = np.zeros((2, len(sets)), np.int64)
            for i, s in enumerate(sets):
                c = count_of[(s & np.uint64(COUNTERS - 1)).astype(np.int64)]
                size = len(s)
                k = size - -(-per_cent * size // 100) + 1 if size else 0
                if 2 * k < size:
                    near = np.flatnonzero(c <= np.partition(c, k - 1)[k - 1])
                    s, c = s[near], c[near]
                g = s.view(np.int64)
                first = np.lexsort((g, c))[:k]
                gs.append(g[first])
                sizes.append(k)
                if k:
                    last[:, i] = c[first[-1]], g[first[-1]]
            offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32))
            head = pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(gs)))
            yield {"doc_id": ids, "size": [len(s) for s in sets], "last_c": last[0], "last_g": last[1], "head": head}

    return packed(_texts(docs), run, HEADS)


def _verified(pairs: DataFrame, docs: DataFrame, n: int, per_cent: int) -> DataFrame:
    """The pairs (a, b) whose whole sets reach the threshold."""
    pairs = cut(pairs)
    ids = _limited(pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct())

    def run(batches):
        for doc_ids, sets in _pieces(batches, n):
            yield {"doc_id": doc_ids, "grams": [s.tobytes() for s in sets]}

    sets = packed(_texts(docs).join(ids, "doc_id", "left_semi"), run, "doc_id long, grams binary")
    sets = cut(sets.groupBy("doc_id").agg(F.max(F.struct(F.length("grams").alias("n"), "grams")).alias("s")).select("doc_id", "s.grams"))
    # A hub is in many pairs: its set is there once per part of these.
    dealt = pairs.withColumn("part", F.pmod(F.xxhash64("b"), F.lit(SALTS)).cast("int"))
    parts = dealt.select("a", "part").distinct().join(sets.toDF("a", "x"), "a")
    both = dealt.join(sets.toDF("b", "y"), "b").join(parts, ["a", "part"]).select("a", "b", "x", "y")

    def compare(batches):
        for b in small_pieces(batches, "x", PIECE_BYTES):
            good = []
            for x, y in zip(b.column("x").to_pylist(), b.column("y").to_pylist()):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                shared = len(np.intersect1d(x, y, assume_unique=True))
                good.append(100 * shared >= per_cent * (len(x) + len(y) - shared))
            b = b.filter(pa.array(good))
            yield {"a": b.column("a"), "b": b.column("b")}
        give_back()

    return packed(both, compare, "a long, b long")


def _able(placed: DataFrame, per_cent: int) -> DataFrame:
    """The rows whose document can reach the threshold with any of the sizes met in their column.

    What a pair must share in its heads from here on, ``due`` of ``join``, is least either
    with the smallest partner, if this document's head ends first, or with the largest,
    if the partner's does; ``left`` is the most that this document can share.
    """
    t = F.lit(per_cent)
    ends = placed.groupBy("g").agg(F.min("size").alias("least"), F.max("size").alias("most"))
    low = F.greatest("least", F.ceil(t * F.col("size") / 100).cast("long"))
    high = F.least("most", F.floor(F.lit(100) * F.col("size") / t).cast("long"))
    own_first = t * (F.col("size") + F.col("low")) - (100 + t) * (F.col("size") - F.col("k"))
    # The partner's head leaves ceil(t s / 100) - 1 n-grams of s behind it, less than t s / 100.
    other_first = 100 * t * F.col("size") - t * t * F.col("high")
    rows = placed.join(ends, "g").withColumn("low", low).withColumn("high", high)
    reach = (100 + t) * F.col("left")
    return rows.where((reach >= own_first) | (100 * reach >= other_first)).select(*placed.columns)


def join(docs: DataFrame, n: int = 3, per_cent: int = 90) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row."""
    summary = cut(summaries(docs, n))
    rows = summary.where("slice is null").select("doc_id", "n_grams", "digest")
    classes = cut(rows.where("digest is not null and doc_id is not null").groupBy("digest").agg(F.min("doc_id").alias("first")))
    firsts = classes.select(F.col("first").alias("doc_id")).distinct()
    head = heads(docs, n, per_cent, _counters(summary)).where("size > 0").join(firsts, "doc_id", "left_semi")
    head = cut(head.groupBy("doc_id").agg(F.max(F.struct("size", "last_c", "last_g", "head")).alias("h")).select("doc_id", "h.*"))
    sizes = head.select("doc_id", "size", F.size("head").cast("long").alias("k"), "last_c", "last_g")
    entries = head.select("doc_id", F.posexplode("head").alias("at", "g"))
    columns = entries.groupBy("g").agg(F.count("*").alias("n"), F.min("doc_id").alias("hub")).where("n > 1")
    shared = cut(entries.join(columns.select("g", "hub"), "g").join(sizes, "doc_id"))

    most = (
        shared.where("doc_id <> hub").groupBy("doc_id", "hub").agg(F.count("*").alias("n"), F.first("k").alias("k"))
        .where("2 * n >= k").groupBy("doc_id").agg(F.max_by("hub", F.struct("n", -F.col("hub"))).alias("hub"))
    )
    links = cut(_verified(most.select(F.col("hub").alias("a"), F.col("doc_id").alias("b")), docs, n, per_cent))
    at = cut(components(links))

    of_doc, of_hub = at.toDF("doc_id", "own"), at.toDF("hub", "hubs")
    placed = (
        shared.join(of_doc, "doc_id", "left").join(of_hub, "hub", "left")
        .withColumn("left", F.row_number().over(Window.partitionBy("doc_id").orderBy(F.desc("at"))))
        .select("g", "doc_id", "size", "k", "last_c", "last_g", "left", F.coalesce("own", "doc_id").alias("own"), F.coalesce("hubs", "hub").alias("hubs"))
    )
    placed = cut(_able(placed, per_cent))
    stray = placed.where("own <> hubs")
    x, y = stray.alias("x"), placed.alias("y")
    ends_first = F.when(F.struct("x.last_c", "x.last_g") <= F.struct("y.last_c", "y.last_g"), F.col("x.size") - F.col("x.k")).otherwise(F.col("y.size") - F.col("y.k"))
    # Of sizes s, a pair that reaches t per cent shares at least t s / (100 + t); this
    # many times 100 + t must be shared in the heads.
    due = per_cent * (F.col("x.size") + F.col("y.size")) - (100 + per_cent) * ends_first
    met = x.join(y, F.col("x.g") == F.col("y.g")).where(
        (F.col("x.own") != F.col("y.own"))
        # Two strays meet once.
        & ((F.col("y.own") == F.col("y.hubs")) | (F.col("x.doc_id") < F.col("y.doc_id")))
        & (100 * F.least("x.size", "y.size") >= per_cent * F.greatest("x.size", "y.size"))
        # The first n-gram that two heads share is followed, in both, by the others
        # that they must share: so far back, a pair has met before, or is none.
        & ((100 + per_cent) * F.least("x.left", "y.left") >= due)
    )
    pairs = cut(
        met.select(F.least("x.doc_id", "y.doc_id").alias("a"), F.greatest("x.doc_id", "y.doc_id").alias("b"), due.alias("due")).distinct()
    )
    whole_heads = head.select("doc_id", "head")
    open_ = (
        pairs.join(whole_heads.toDF("a", "x"), "a").join(whole_heads.toDF("b", "y"), "b")
        .where((100 + per_cent) * F.size(F.array_intersect("x", "y")) >= F.col("due")).select("a", "b").distinct()
    )
    more = _verified(open_, docs, n, per_cent)
    same = at.select(F.col("component").alias("a"), F.col("id").alias("b"))
    whole = components(same.unionByName(more))
    # Copies follow their class; one id with several sets ties these together.
    in_class = classes.join(whole, classes["first"] == whole["id"], "left").select("digest", F.coalesce("component", "first").alias("component"))
    # A class is there once per part of its copies; documents without n-grams are in none.
    part = F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int").alias("part")
    parts = in_class.select("*", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("part"))
    found = rows.where("digest is not null").select("*", part).join(parts, ["digest", "part"], "left").select("doc_id", "n_grams", "component")
    alone = rows.where("digest is null").select("doc_id", "n_grams", F.lit(None).cast("long").alias("component"))
    return found.unionByName(alone).select(
        "doc_id",
        F.col("n_grams").alias("n_shingles"),
        F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).alias("component_id"),
    )


def first_of_group(docs: DataFrame, n: int = 5, per_cent: int = 80) -> DataFrame:
    """The rows, with all their columns, that are the first of their component. Of rows
    with one id, the one with the smallest text stays; rows with a null id all stay."""
    at = cut(join(docs, n, per_cent))
    id_, nth = free_name(docs, "__id"), free_name(docs, "__nth")
    gone = _limited(at.where("doc_id <> component_id").select(F.col("doc_id").alias(id_)).distinct())
    on = F.col("doc_id") == F.col(id_)
    kept = docs.join(gone, on, "left_anti")
    again = cut(at.groupBy("doc_id").count().where("doc_id is not null and count > 1").select(F.col("doc_id").alias(id_)))
    if again.isEmpty():
        return kept
    order = F.row_number().over(Window.partitionBy("doc_id").orderBy("text", F.xxhash64(*docs.columns)))
    one = kept.join(_limited(again), on, "left_semi").withColumn(nth, order).where(F.col(nth) == 1).drop(nth)
    return kept.join(_limited(again), on, "left_anti").unionByName(one)


def _limited(ids: DataFrame) -> DataFrame:
    ids = cut(ids)
    return F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids


def op4(spark, sf_dir: str) -> DataFrame:
    return join(table(spark, sf_dir, "documents"), 3, 90)
