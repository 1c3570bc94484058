"""Operator 9: scoring by a probabilistic suffix tree, beside a unigram base.

Tokens are the words of a text between white space, A-Z in lower case, then one end.
The tree spells the same tokens symbol by symbol: the bytes of a word and a space, or
a line feed as the end (words hold neither), so words never seen have a
probability too. A token's probability is that of its spelling behind the longest
retained contexts, smoothed with a tenth of the token's own share of the training tokens.

Training counts which byte follows each context of up to ``DEPTH`` bytes. A context
is a candidate from ``LEAST`` occurrences on, so more text teaches the tree more
contexts, and it is retained if its next-symbol
distribution diverges from that of its suffix: count times Kullback-Leibler
divergence over half the distinct next symbols times the logarithm of the count.
Suffixes of a retained context are retained. Distributions are
interpolated with those of the suffix (Witten-Bell), the root's with one more of every
byte.

The tree is never in one place. Contexts that share their last ``NEAR`` bytes are in one
bucket, so that depths above NEAR need nothing from elsewhere; depths up to NEAR are
counted there, finished by last byte, and sent back to the buckets. A block
gets the probabilities of its own contexts and symbols only. ``build`` and ``symbol_scores`` are
the same tree as one automaton, for small texts.

Null and empty texts are an end alone. A document with a null id is scored, not
learned, and not held out. Without training documents every symbol has 1/256.
Repeated rows count as often as they come. An empty table gives no rows. Extra
columns are ignored.
"""

from __future__ import annotations

import itertools
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import blocks as B
from .common import bucketed, cut, packed, ship, shuffle_width, table

DEPTH = 6
#: Occurrences that make a context a candidate.
LEAST = 2
#: Last bytes of a context that name its bucket.
NEAR = 3
#: Divergences that equal their bound count as reaching it, however their sum was rounded.
TIE = 1 + 1e-9
#: Weight of a token's own share of the training tokens against its spelling.
SHARE_WEIGHT = 0.1
STRIPE = 512
#: Bytes of text whose contexts are counted at a time.
GRAM_BYTES = 2 << 20
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def tokens(text: str | None) -> list[bytes]:
    """Words in lower case (A-Z only), between white space as ASCII has it."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def learned(doc_id: int | None) -> bool:
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 7 != 2


def spelled(words) -> bytes:
    text = b" ".join(words)
    return text + b" " if text else text


def stream(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Texts one after the other, each behind DEPTH line feeds (the first of them
    is the end of the text before); where each starts, and where its end symbol is."""
    gap = b"\n" * DEPTH
    raw = np.frombuffer(gap + gap.join(texts) + gap, np.uint8)
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    starts = DEPTH + np.cumsum(sizes + DEPTH) - sizes - DEPTH
    return raw, starts, starts + sizes


def grams(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct contexts with the symbol that follows, as DEPTH + 1 bytes in a number, and
    their counts; counted in runs of texts of some GRAM_BYTES, then summed."""
    runs = list(B.runs(np.concatenate([[0], np.cumsum([len(t) + DEPTH for t in texts], dtype=np.int64)]), GRAM_BYTES))
    got = [_grams(texts[a:z]) for a, z in runs]
    if not got:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    g, back = np.unique(np.concatenate([g for g, _ in got]), return_inverse=True)
    return g, np.bincount(back, np.concatenate([n for _, n in got])).astype(np.int64)


def _grams(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    return np.unique(predictions(*stream(texts))[1], return_counts=True)


def taught_and_other(taught: list[bytes], others: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """``grams`` of both, with their counts in ``taught`` (0 where only the others have them)."""
    g, n = grams(taught)
    more = np.setdiff1d(grams(others)[0], g, assume_unique=True)
    g, n = np.concatenate([g, more]), np.concatenate([n, np.zeros(len(more), np.int64)])
    order = np.argsort(g, kind="stable")
    return g[order], n[order]


def predictions(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of a stream's symbols that are predicted, and the number of each with its context."""
    predicted = np.zeros(len(raw) + 1, np.int8)
    predicted[starts] += 1
    predicted[ends + 1] -= 1
    at = np.flatnonzero(np.cumsum(predicted[:-1], dtype=np.int8))
    g = np.zeros(len(raw) - DEPTH, np.uint64)
    for k in range(DEPTH + 1):
        g = (g << np.uint64(8)) | raw[k : len(raw) - DEPTH + k]
    return at, g[at - DEPTH]


def _pack_longs(a: np.ndarray) -> bytes:
    return B.squeeze(np.ascontiguousarray(np.diff(a, prepend=np.uint64(0)).astype("<u8").view(np.uint8).reshape(-1, 8).T).tobytes())


def _unpack_longs(raw: bytes) -> np.ndarray:
    return np.cumsum(np.ascontiguousarray(np.frombuffer(B.unsqueeze(raw), np.uint8).reshape(8, -1).T).reshape(-1).view("<u8"), dtype=np.uint64)


def gram_rows(block: int, g: np.ndarray, n: np.ndarray, buckets: int) -> dict | None:
    if not len(g):
        return None
    near = (g >> np.uint64(8)) & np.uint64((1 << 8 * NEAR) - 1)
    at = ((near * _GOLDEN) >> np.uint64(40)) % np.uint64(buckets)
    order = np.argsort(at, kind="stable")
    found, first = np.unique(at[order], return_index=True)
    groups = np.split(order, first[1:])
    none = [None] * len(found)
    return {
        "kind": ["g"] * len(found), "block": [block] * len(found), "bucket": found.astype(np.int32), "doc_ids": none,
        "lengths": [B.pack_ints(n[k]) for k in groups], "body": [_pack_longs(g[k]) for k in groups], "more": none,
    }


def split(docs: DataFrame) -> DataFrame:
    """Documents, words and contexts of each block (see ``blocks``)."""
    buckets = 2 * shuffle_width(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]):
        for block, ids, texts in B.cut_blocks(batches):
            number: defaultdict = defaultdict(itertools.count().__next__)
            seqs, lengths, plain, other = [], np.zeros(len(texts), np.uint32), [], []
            for k, t in enumerate(texts):
                words = tokens(t)
                lengths[k] = len(words)
                seqs.append(np.fromiter(map(number.__getitem__, words), np.uint32, len(words)))
                (plain if learned(ids[k]) else other).append(spelled(words))
            seq, words, _ = B.by_frequency(np.concatenate(seqs), list(number))
            taught = np.repeat(np.fromiter(map(learned, ids), bool, len(ids)), lengths)
            yield B.document_row(block, ids, lengths, seq)
            if rows := B.word_rows(block, words, buckets, np.bincount(seq[taught], minlength=len(words))):
                yield rows
            if rows := gram_rows(block, *taught_and_other(plain, other), buckets):
                yield rows

    return bucketed(packed(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), run, B.ROWS), "kind", "block")


# ------------------------------------------------------------------ the model


def merged(t: pa.Table) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """A bucket's distinct contexts with symbol, their counts over all blocks, and each row's places among them."""
    each = [_unpack_longs(x.as_py()) for x in t.column("body")]
    n = np.concatenate([B.unpack_ints(x.as_py()) for x in t.column("lengths")])
    g, back = np.unique(np.concatenate(each), return_inverse=True)
    return g, np.bincount(back, n, len(g)), np.split(back, np.cumsum([len(x) for x in each])[:-1])


def levels(g: np.ndarray, n: np.ndarray, top: int, low: int) -> dict:
    """Depths ``top`` to ``low`` of sorted contexts of depth ``top`` with symbol: by ``gram`` its count ``n``,
    its context ``row`` and ``up``, its place one depth less; by context ``m``, ``kinds`` and ``shorter``."""
    out: dict = {}
    for d in range(top, low - 1, -1):
        if d < top:
            g, up = np.unique(g & np.uint64((1 << 8 * (d + 1)) - 1), return_inverse=True)
            n = np.bincount(up, n, len(g))
            out[d + 1]["up"] = up
        new = np.diff(g >> np.uint64(8), prepend=np.uint64((1 << 64) - 1)) != 0
        row = np.cumsum(new) - 1
        out[d] = {"gram": g, "n": n, "row": row, "first": np.flatnonzero(new), "m": np.bincount(row, n), "kinds": np.maximum(1, np.bincount(row, n > 0))}
        if d < top:
            out[d + 1]["shorter"] = row[up[out[d + 1]["first"]]]
    return out


def diverging(level: dict, below: np.ndarray) -> np.ndarray:
    """Which contexts of a depth are candidates that diverge from their suffix; ``below``: each symbol's share there."""
    n, m, row = level["n"], level["m"], level["row"]
    seen = np.flatnonzero(n > 0)
    gain = np.bincount(row[seen], n[seen] * np.log(n[seen] / m[row[seen]] / below[seen]), len(m))
    return (m >= LEAST) & (gain * TIE >= 0.5 * level["kinds"] * np.log(np.maximum(m, 2)))


def shares_below(level: dict, shorter: dict) -> np.ndarray:
    return (shorter["n"] / np.maximum(shorter["m"], 1)[shorter["row"]])[level["up"]]


def retained(by_depth: dict, low: int) -> dict:
    """The retained contexts of the depths above ``low``, and at ``low`` the suffixes of those."""
    top = max(by_depth)
    keep = {d: diverging(by_depth[d], shares_below(by_depth[d], by_depth[d - 1])) for d in range(low + 1, top + 1)}
    keep[low] = np.zeros(len(by_depth[low]["m"]), bool)
    for d in range(top, low, -1):
        keep[d - 1][by_depth[d]["shorter"][keep[d]]] = True
    return keep


def smoothed(level: dict, keep: np.ndarray, below: np.ndarray) -> np.ndarray:
    """Probability of each symbol behind its context; ``below``: behind the suffix."""
    row, kinds = level["row"], level["kinds"]
    own = (level["n"] + kinds[row] * below) / (level["m"] + kinds)[row]
    return np.where(keep[row], own, below)


def gram_logs(parts: DataFrame) -> DataFrame:
    """A row per block and bucket: log10 probability of each of its contexts with symbol, in the order of the block's row."""
    rows = parts.where("kind = 'g'").select("block", "bucket", "body", "lengths")

    def near(t: pa.Table) -> pa.Table:
        by_depth = levels(*merged(t)[:2], DEPTH, NEAR)
        low, keep = by_depth[NEAR], retained(by_depth, NEAR)[NEAR]
        tail = ((low["gram"] >> np.uint64(8)) & np.uint64(255)).astype(np.int32)
        order = np.argsort(tail, kind="stable")
        found, first = np.unique(tail[order], return_index=True)
        groups = np.split(order, first[1:])
        sums = np.bincount((low["gram"] & np.uint64(255)).astype(np.int64), low["n"], 256).astype(np.int64)
        return pa.table({
            "bucket": pa.array([t.column("bucket")[0].as_py()] * (len(found) + 1), pa.int32()),
            "tail": pa.array([*found.tolist(), None], pa.int32()),
            "grams": pa.array([*(_pack_longs(low["gram"][k]) for k in groups), None], pa.binary()),
            "counts": pa.array([*(B.squeeze(low["n"][k].astype("<i8").tobytes()) for k in groups), None], pa.binary()),
            "kept": pa.array([*(B.squeeze(keep[low["row"][k]].tobytes()) for k in groups), None], pa.binary()),
            "sums": pa.array([None] * len(found) + [sums.tolist()], pa.list_(pa.int64())),
        })

    ship(parts.sparkSession)
    counted = cut(rows.groupBy("bucket").applyInArrow(near, "bucket int, tail int, grams binary, counts binary, kept binary, sums array<long>"))
    root = np.ones(256)
    for r in counted.select(F.posexplode("sums").alias("byte", "n")).groupBy("byte").agg(F.sum("n").alias("n")).collect():
        root[r.byte] += r.n
    root /= root.sum()

    def shallow(t: pa.Table) -> pa.Table:
        each = [_unpack_longs(x.as_py()) for x in t.column("grams")]
        g = np.concatenate(each)
        n = np.concatenate([np.frombuffer(B.unsqueeze(x.as_py()), "<i8") for x in t.column("counts")])
        kept = np.concatenate([np.frombuffer(B.unsqueeze(x.as_py()), bool) for x in t.column("kept")])
        order = np.argsort(g, kind="stable")
        by_depth = levels(g[order], n[order], NEAR, 1)
        keep = retained(by_depth, 1)
        p = root[(by_depth[1]["gram"] & np.uint64(255)).astype(np.int64)]
        keep[1] |= diverging(by_depth[1], p)
        longer = kept[order][by_depth[NEAR]["first"]]
        for d in range(NEAR, 0, -1):
            keep[d] |= longer
            if d > 1:
                longer = np.zeros(len(keep[d - 1]), bool)
                longer[by_depth[d]["shorter"][keep[d]]] = True
        for d in range(1, NEAR + 1):
            p = smoothed(by_depth[d], keep[d], p if d == 1 else p[by_depth[d]["up"]])
        back = np.empty(len(g))
        back[order] = p
        p_each = np.split(back, np.cumsum([len(x) for x in each])[:-1])
        return pa.table({"bucket": t.column("bucket"), "grams": t.column("grams"), "p": pa.array([B.squeeze(x.tobytes()) for x in p_each], pa.binary())})

    def deep(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return _LOGS
        g, n, places = merged(left)
        by_depth = levels(g, n, DEPTH, NEAR)
        keep = retained(by_depth, NEAR)
        known = np.concatenate([_unpack_longs(x.as_py()) for x in right.column("grams")])
        p = np.concatenate([np.frombuffer(B.unsqueeze(x.as_py())) for x in right.column("p")])[np.argsort(known)]
        for d in range(NEAR + 1, DEPTH + 1):
            p = smoothed(by_depth[d], keep[d], p[by_depth[d]["up"]])
        logs = np.log10(p).astype("<f4")
        return pa.table({
            "block": left.column("block").cast(pa.int64()), "bucket": left.column("bucket").cast(pa.int32()),
            "logs": pa.array([B.squeeze(np.ascontiguousarray(logs[k].view(np.uint8).reshape(-1, 4).T).tobytes()) for k in places], pa.binary()),
        })

    finished = counted.where("tail is not null").groupBy("tail").applyInArrow(shallow, "bucket int, grams binary, p binary")
    return rows.groupBy("bucket").cogroup(finished.groupBy("bucket")).applyInArrow(deep, "block long, bucket int, logs binary")


_LOGS = pa.schema([("block", pa.int64()), ("bucket", pa.int32()), ("logs", pa.binary())]).empty_table()


def _unpack_logs(raw: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(B.unsqueeze(raw), np.uint8).reshape(4, -1).T).reshape(-1).view("<f4")


def by_gram(g: np.ndarray, logs: np.ndarray):
    """A function of a stream: log10 probability of each predicted symbol, all of which are in ``g`` with their contexts."""
    shift = np.uint64(63 - len(g).bit_length())
    hashed = (g * _GOLDEN) >> shift
    order = np.argsort(hashed)
    hashed, g, logs = hashed[order], g[order], logs[order]
    begin = np.searchsorted(hashed, np.arange(1 << (64 - int(shift)), dtype=np.uint64)).astype(np.int32)

    def symbols(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        at, wanted = predictions(raw, starts, ends)
        place = begin[((wanted * _GOLDEN) >> shift).astype(np.int64)]
        left = np.flatnonzero(g[place] != wanted)
        while len(left):
            place[left] += 1
            left = left[g[place[left]] != wanted[left]]
        out = np.zeros(len(raw), np.float32)
        out[at] = logs[place]
        return out

    return symbols


def build(counts: list) -> dict:
    """Transitions and log10 probabilities by state and symbol class; log10 of the root's by byte."""
    root = np.ones(256)
    np.add.at(root, counts[0][0], counts[0][1])
    root /= root.sum()
    # Symbols in a candidate context, or after one, have a class each; class 0 is all others.
    used = np.unique(np.concatenate([c & 255 for c, _ in counts[1:]] + [(c >> 8) & 255 for c, _ in counts[1:]] + [np.zeros(0, np.int64)]))
    classes = np.zeros(256, np.uint8)
    classes[used] = np.arange(1, len(used) + 1) if len(used) < 256 else np.arange(256)
    width = len(used) + 1 if len(used) < 256 else 256
    by_class = np.zeros(width)
    by_class[classes[used]] = root[used]
    lone = width == 256 and len(used) == 256
    if not lone:
        by_class[0] = 1.0  # times the byte's own probability at the root
    contexts, begin, moves = [np.zeros(1, np.int64)], [0], [np.zeros((1, width), np.int32)]
    levels: list = [None]
    share, keep = [by_class[None, :]], [np.ones(1, bool)]
    for d in range(1, DEPTH + 1):
        gram, n = counts[d]
        ctx, first = np.unique(gram >> 8, return_index=True)
        row = np.repeat(np.arange(len(ctx)), np.diff(np.append(first, len(gram))))
        follow = np.zeros((len(ctx), width))
        follow[row, classes[gram & 255]] = n
        m, kinds = follow.sum(1, dtype=np.float64), np.maximum(1, (follow > 0).sum(1))
        shorter = np.searchsorted(contexts[d - 1], ctx & ((1 << 8 * (d - 1)) - 1))
        share.append(follow / np.maximum(m, 1)[:, None])
        with np.errstate(divide="ignore", invalid="ignore"):
            gain = np.where(follow > 0, share[d] * np.log(share[d] / share[d - 1][shorter]), 0).sum(1) * m
        share[d - 1] = None
        keep.append(gain * TIE >= 0.5 * kinds * np.log(np.maximum(m, 2)))
        levels.append((follow, m, kinds, shorter))
        # A symbol leads to the context that it completes; where there is none, to where it leads from the suffix.
        begin.append(begin[-1] + len(contexts[-1]))
        moves[d - 1][np.searchsorted(contexts[d - 1], ctx >> 8), classes[ctx & 255]] = begin[d] + np.arange(len(ctx))
        moves.append(moves[d - 1][shorter])
        contexts.append(ctx)
    for d in range(DEPTH, 1, -1):
        keep[d - 1][levels[d][3][keep[d]]] = True
    probs = [by_class[None, :]]
    for d in range(1, DEPTH + 1):
        follow, m, kinds, shorter = levels[d]
        smooth = (follow + kinds[:, None] * probs[d - 1][shorter]) / (m + kinds)[:, None]
        probs.append(np.where(keep[d][:, None], smooth, probs[d - 1][shorter]))
        levels[d] = None
    return {
        "classes": classes,
        "moves": np.concatenate(moves).astype(np.int32),
        "log10": np.log10(np.concatenate(probs)).astype(np.float32),
        "rare": np.where((classes == 0) & (not lone), np.log10(root), 0).astype(np.float32),
        "retained": int(sum(k.sum() for k in keep)),
    }


def symbol_scores(model: dict, raw: np.ndarray) -> np.ndarray:
    """log10 probability of each symbol of a stream, in stripes side by side: the
    state behind DEPTH symbols does not depend on what came before them."""
    n = len(raw)
    classes, moves, log10 = model["classes"], model["moves"], model["log10"]
    width = moves.shape[1]
    flat_moves, flat_log10 = moves.reshape(-1), log10.reshape(-1)
    rows = -(-n // STRIPE)
    sym = np.full(rows * STRIPE, classes[10], np.uint8)
    sym[:n] = classes[raw]
    by_step = np.ascontiguousarray(sym.reshape(rows, STRIPE).T)
    state = np.zeros(rows, np.int64)
    before = np.full(rows, classes[10], np.uint8)
    for k in range(STRIPE - DEPTH, STRIPE):
        before[1:] = by_step[k, :-1]
        state = flat_moves[state * width + before].astype(np.int64)
    out = np.empty((STRIPE, rows), np.float32)
    for k in range(STRIPE):
        at = state * width + by_step[k]
        out[k] = flat_log10[at]
        state = flat_moves[at].astype(np.int64)
    return np.ascontiguousarray(out.T).reshape(-1)[:n] + model["rare"][raw]


def text_scores(symbols, words: list[bytes], seq: np.ndarray, lengths: np.ndarray, share: np.ndarray, end_share: float, weight: float) -> np.ndarray:
    """log10 probability of each text. ``symbols``: that of each symbol of a stream (see ``by_gram``). ``seq`` numbers the texts' ``words``, ``lengths`` per
    text; ``share``: of the training tokens, per word; ``weight``: of the share against the spelling."""
    stops = np.cumsum(lengths)
    of, numbers = words.__getitem__, seq.tolist()
    streamed = stream([spelled(map(of, numbers[a:z])) for a, z in zip((stops - lengths).tolist(), stops.tolist())])
    total = np.concatenate([[0.0], np.cumsum(symbols(*streamed), dtype=np.float64)])
    # Tokens, each text's end among them: where they are in the stream, and how long.
    sizes = np.insert(np.fromiter(map(len, words), np.int64, len(words))[seq] + 1, stops, 1)
    own = np.insert(share[seq], stops, end_share)
    ends = np.cumsum(sizes) + DEPTH + np.repeat(np.arange(len(lengths)), lengths + 1) * (DEPTH - 1)
    spelling = np.log(10.0) * (total[ends] - total[ends - sizes])
    with np.errstate(divide="ignore"):
        either = np.logaddexp(np.log(weight) + np.log(own), np.log1p(-weight) + spelling)  # in logarithms: long words are below any double
    logs = np.concatenate([[0.0], np.cumsum(either / np.log(10.0))])
    last = np.cumsum(lengths + 1)
    return logs[last] - logs[last - lengths - 1]


# ------------------------------------------------------------------ scoring


def word_counts(parts: DataFrame) -> DataFrame:
    """A row per block and bucket: its words with their training counts over all blocks;
    and one per bucket, with null block, that holds the sums ``n`` and ``v``."""

    def add(t: pa.Table) -> pa.Table:
        got = [(B.unpack_words(r["body"]), B.unpack_ints(r["lengths"]).tolist()) for r in t.select(["body", "lengths"]).to_pylist()]
        total: defaultdict = defaultdict(int)
        for words, counts in got:
            for w, c in zip(words, counts):
                total[w] += c
        of = total.__getitem__
        return pa.table({
            "block": pa.concat_arrays([*t.column("block").chunks, pa.array([None], pa.int64())]),
            "words": pa.concat_arrays([*t.column("body").cast(pa.binary()).chunks, pa.array([None], pa.binary())]),
            "numbers": pa.concat_arrays([*t.column("more").cast(pa.binary()).chunks, pa.array([None], pa.binary())]),
            "counts": pa.array([_pack_counts(list(map(of, words))) for words, _ in got] + [None], pa.binary()),
            "n": pa.array([None] * len(got) + [sum(total.values())], pa.int64()),
            "v": pa.array([None] * len(got) + [sum(c > 0 for c in total.values())], pa.int64()),
        })

    ship(parts.sparkSession)
    words = parts.where("kind = 'w'").select("block", "bucket", "body", "more", "lengths")
    return cut(words.groupBy("bucket").applyInArrow(add, "block long, words binary, numbers binary, counts binary, n long, v long"))


def _pack_counts(counts: list[int]) -> bytes:
    return B.squeeze(np.array(counts, "<i8").tobytes())


def score(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row."""
    parts = split(docs)
    documents = parts.where("kind in ('d', 'g')").select("kind", "block", "bucket", "doc_ids", "lengths", "body")
    counted = word_counts(parts)

    def ends(batches):
        for b in batches:
            yield {"n": [sum(map(learned, B.unpack_ids(x.as_py()))) for x in b.column("doc_ids")]}

    n_ends = packed(documents.where("kind = 'd'").select("doc_ids"), ends, "n long").agg(F.sum("n")).first()[0] or 0
    sums = counted.agg(F.sum("n").alias("n"), F.sum("v").alias("v")).first()
    n_train, n_kinds = (sums.n or 0) + n_ends, (sums.v or 0) + (n_ends > 0)
    divisor = float(np.log10(n_train + n_kinds + 1))
    weight = SHARE_WEIGHT if n_train else 0.0

    def assemble(left: pa.Table, right: pa.Table) -> pa.Table:
        logs = {r["bucket"]: r["logs"] for r in right.select(["bucket", "logs"]).to_pylist() if r["logs"] is not None}
        contexts = left.filter(pc.equal(left.column("kind"), "g")).select(["bucket", "body"]).to_pylist()
        symbols = by_gram(np.concatenate([_unpack_longs(r["body"]) for r in contexts]), np.concatenate([_unpack_logs(logs[r["bucket"]]) for r in contexts]))
        rows = right.filter(pc.is_valid(right.column("words"))).to_pylist()
        number = np.concatenate([*(B.unpack_ints(r["numbers"]) for r in rows), np.zeros(0, np.uint32)])
        words = [w for r in rows for w in B.unpack_words(r["words"])]
        counts = np.concatenate([*(np.frombuffer(B.unsqueeze(r["counts"]), "<i8") for r in rows), np.zeros(0, np.int64)])
        order = np.argsort(number, kind="stable")
        words = [words[k] for k in order.tolist()]
        counts = counts[order]
        log_share = np.log10(counts + 1.0) - divisor
        out = []
        for r in left.filter(pc.equal(left.column("kind"), "d")).to_pylist():
            ids, seq = B.unpack_ids(r["doc_ids"]), B.unpack_ints(r["body"])
            lengths = B.unpack_ints(r["lengths"]).astype(np.int64)
            stops = np.concatenate([[0], np.cumsum(lengths)])
            for a, z in B.runs(stops, 1 << 18):
                own, n = seq[stops[a] : stops[z]], lengths[a:z]
                cuts = stops[a : z + 1] - stops[a]
                base = np.concatenate([[0.0], np.cumsum(log_share[own])])[cuts]
                known = np.concatenate([[0], np.cumsum(counts[own] > 0)])[cuts]
                scores = text_scores(symbols, words, own, n, counts / max(1, n_train), n_ends / max(1, n_train), weight)
                out.append(pa.table({
                    "doc_id": pa.array(ids[a:z], pa.int64()),
                    "held_out": pa.array([i is not None and not learned(i) for i in ids[a:z]], pa.bool_()),
                    "n_tokens": pa.array(n + 1, pa.int64()),
                    "n_known": pa.array(np.diff(known) + (n_ends > 0), pa.int64()),
                    "train_tokens": pa.array(np.full(len(n), n_train), pa.int64()),
                    "base_score": pa.array(np.diff(base) + float(np.log10(n_ends + 1.0)) - divisor, pa.float64()),
                    "score": pa.array(scores, pa.float64()),
                }))
        return pa.concat_tables(out) if out else _EMPTY

    by_block = counted.where("block is not null").select("block", "words", "numbers", "counts").unionByName(gram_logs(parts), allowMissingColumns=True)
    return documents.groupBy("block").cogroup(by_block.groupBy("block")).applyInArrow(assemble, SCORED)


SCORED = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
_EMPTY = pa.schema([
    ("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()),
    ("train_tokens", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64()),
]).empty_table()


def op9(spark, sf_dir: str) -> DataFrame:
    return score(table(spark, sf_dir, "documents"))
