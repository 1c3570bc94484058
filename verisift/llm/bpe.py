"""Operator 1: byte-level BPE over a corpus, each distinct word encoded once.

Texts are split by the tokenizer's pattern into pre-tokens. Documents keep their
pre-tokens by position, as numbers into the dictionary of their block (``blocks``);
distinct pre-tokens are shuffled by hash, so each is merged in one place, once;
the ids are joined back to the block, and texts are put together by position.
Decoding joins the token-byte table, which has a row per id and is broadcast.

Null and empty texts have no tokens and decode to no bytes. Repeated rows are
encoded as often; an empty table gives none. Extra columns are ignored. Texts of
any length are encoded whole. Control strings in a text are plain text.
"""

from __future__ import annotations

import base64
import hashlib
import itertools
import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import blocks as B
from .common import bucketed, give_back, packed, ship, shuffle_width, small_pieces, table

_LOADED: dict = {}


def ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def _encoding(path: str, pattern: str):
    if (path, pattern) not in _LOADED:
        import tiktoken

        _LOADED[path, pattern] = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks(path), special_tokens={})
    return _LOADED[path, pattern]


def _release() -> None:
    """Freed memory given back, and the tokenizer, which only merging needs."""
    _LOADED.clear()
    give_back()


# White space next to a space: there the pattern's pieces may reach over a split at spaces.
_WIDE_SPACE = re.compile(r"\s | \s")


def pre_tokens(texts: list[str], pattern: str) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """Pre-tokens per text, their numbers in order, and the distinct ones as bytes.

    A text is split at single spaces, and the pattern runs once per distinct
    part (with its space); a text with wider white space is split as a whole.
    """
    import regex

    find = regex.compile(pattern).findall
    part_no: defaultdict = defaultdict(itertools.count().__next__)
    numbers, sizes = [], np.zeros(len(texts), np.int64)
    for k, t in enumerate(texts):
        if not t:
            continue
        if _WIDE_SPACE.search(t):
            keys = [(piece, None) for piece in find(t)]  # each is a pre-token
        else:
            keys = t.split(" ")
            keys[0] = (keys[0],)  # no space before it
        numbers.append(np.fromiter(map(part_no.__getitem__, keys), np.uint32, len(keys)))
        sizes[k] = len(keys)
    piece_no: defaultdict = defaultdict(itertools.count().__next__)
    own, counts = [], np.zeros(len(part_no), np.int64)
    for k, key in enumerate(part_no):
        pieces = find(" " + key) if isinstance(key, str) else [key[0]] if len(key) == 2 else find(key[0])
        counts[k] = len(pieces)
        own += map(piece_no.__getitem__, pieces)
    words = [p.encode("utf-8", "surrogatepass") for p in piece_no]
    del part_no, piece_no
    parts = np.concatenate([*numbers, np.zeros(0, np.uint32)])
    del numbers
    return *expand_runs(parts, sizes, np.array(own, np.uint32), counts), words


def expand(seq: np.ndarray, sizes: np.ndarray, values: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each number of ``seq`` replaced by its run of ``values``; runs are one after the other, ``counts`` long.
    ``sizes`` cuts ``seq`` into texts; returned with the sizes that they have then."""
    starts = np.cumsum(counts) - counts
    n = counts[seq]
    ends = np.cumsum(n)
    at = np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - n - starts[seq], n)
    bounds = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])]
    return values[at], np.diff(bounds)


def expand_runs(seq: np.ndarray, sizes: np.ndarray, values: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(sizes, sequence) as ``expand`` has them, some texts at a time: it needs many times the room of its input."""
    stops = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
    got = [expand(seq[stops[a] : stops[z]], sizes[a:z], values, counts) for a, z in B.runs(stops, 1 << 17)]
    return np.concatenate([*(n for _, n in got), np.zeros(0, np.int64)]), np.concatenate([*(s for s, _ in got), np.zeros(0, np.uint32)])


def block_rows(block: int, ids: list, texts: list[str], pattern: str, buckets: int) -> list[dict]:
    """The rows of a block: its documents, and its words by bucket."""
    lengths, seq, words = pre_tokens(texts, pattern)
    seq, words, _ = B.by_frequency(seq, words)
    return [r for r in (B.document_row(block, ids, lengths, seq), B.word_rows(block, words, buckets)) if r]


def encode(docs: DataFrame, path: str, pattern: str, block_bytes: int = B.BLOCK_BYTES) -> DataFrame:
    """(doc_id, ids) of every row: the ids of its whole text. ``block_bytes`` of text are held
    by a task at a time; smaller blocks send more tokens twice."""
    spark = docs.sparkSession
    buckets = 2 * shuffle_width(spark)

    def split(batches: Iterator[pa.RecordBatch]):
        for block, ids, texts in B.cut_blocks(batches, block_bytes):
            yield from block_rows(block, ids, texts, pattern, buckets)
            del ids, texts
            give_back()  # before the next block

    parts = bucketed(packed(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), split, B.ROWS), "kind", "block")

    def merge(batches: Iterator[pa.RecordBatch]):
        one, known = _encoding(path, pattern)._encode_single_piece, {}
        for b in batches:
            for r in b.select(["block", "body", "more"]).to_pylist():
                words = B.unpack_words(r["body"])
                for w in words:
                    if w not in known:
                        known[w] = np.array(one(w), "<u4").tobytes()
                got = [known[w] for w in words]
                yield {
                    "block": [r["block"]],
                    "numbers": [r["more"]],
                    "counts": [B.pack_ints(np.fromiter(map(len, got), np.uint32, len(got)) // 4)],
                    "ids": [B.pack_ints(np.frombuffer(b"".join(got), "<u4"))],
                }
        known.clear()
        give_back()

    words = parts.where("kind = 'w'").select("block", "bucket", "body", "more").repartition(buckets, "bucket")
    merged = packed(words.drop("bucket").select("block", "body", "more"), merge, "block long, numbers binary, counts binary, ids binary")
    documents = parts.where("kind = 'd'").select("block", "doc_ids", "lengths", "body")

    def assemble(left: pa.Table, right: pa.Table) -> pa.Table:
        _release()  # also of the block before
        out = []
        numbers = [B.unpack_ints(x.as_py()) for x in right.column("numbers")]
        counts = [B.unpack_ints(x.as_py()) for x in right.column("counts")]
        values = [B.unpack_ints(x.as_py()) for x in right.column("ids")]
        # The block's words in the order of their numbers.
        number = np.concatenate([*numbers, np.zeros(0, np.uint32)])
        count = np.zeros(len(number), np.int64)
        count[number] = np.concatenate([*counts, np.zeros(0, np.uint32)])
        order = np.argsort(number, kind="stable").astype(np.int64)
        gathered = np.concatenate([*counts, np.zeros(0, np.uint32)]).astype(np.int64)
        flat, _ = expand(order, np.zeros(0, np.int64), np.concatenate([*values, np.zeros(0, np.uint32)]), gathered)
        for r in left.to_pylist():
            doc_ids, seq = B.unpack_ids(r["doc_ids"]), B.unpack_ints(r["body"])
            stops = np.concatenate([[0], np.cumsum(B.unpack_ints(r["lengths"]), dtype=np.int64)])
            for a, z in B.runs(stops, 1 << 18):
                ids, n = expand(seq[stops[a] : stops[z]], np.diff(stops[a : z + 1]), flat, count)
                offsets = pa.array(np.concatenate([[0], np.cumsum(n)]).astype(np.int32))
                lists = pa.ListArray.from_arrays(offsets, pa.array(ids.astype(np.int32)))
                out.append(pa.Table.from_arrays([pa.array(doc_ids[a:z], pa.int64()), lists], ["doc_id", "ids"]))
        return pa.concat_tables(out) if out else pa.table({"doc_id": pa.array([], pa.int64()), "ids": pa.array([], pa.list_(pa.int32()))})

    ship(spark)
    return documents.groupBy("block").cogroup(merged.groupBy("block")).applyInArrow(assemble, "doc_id long, ids array<int>")


def token_bytes(spark, path: str):
    """The token-byte table, a row per id, broadcast."""
    table_ = ranks(path)
    out = [b""] * (max(table_.values()) + 1)
    for token, k in table_.items():
        out[k] = token
    return spark.sparkContext.broadcast(out)


def id_lists(column: pa.ListArray) -> list[list[int]]:
    """The lists of a column, its numbers made Python's in one go."""
    stops = column.offsets.to_numpy()
    flat = column.values.to_numpy(zero_copy_only=False)[stops[0] : stops[-1]].tolist()
    stops = (stops - stops[0]).tolist()
    return [flat[a:z] for a, z in zip(stops, stops[1:])]


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """(doc_id, ids, decoded): the bytes that the ids stand for."""
    tokens = token_bytes(encoded.sparkSession, path)

    def run(batches: Iterator[pa.RecordBatch]):
        of = tokens.value.__getitem__
        for b in small_pieces(batches, "ids", 1 << 20):
            yield {"doc_id": b.column("doc_id"), "ids": b.column("ids"), "decoded": [b"".join(map(of, x)) for x in id_lists(b.column("ids"))]}

    return packed(encoded.select("doc_id", "ids"), run, "doc_id long, ids array<int>, decoded binary")


def digests(encoded: DataFrame, path: str, keep_ids: bool = False) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) and, if wanted, the ids, decoding in the same pass."""
    tokens = token_bytes(encoded.sparkSession, path)

    def run(batches: Iterator[pa.RecordBatch]):
        _release()
        names = [b"%d" % k for k in range(len(tokens.value))]
        name, of = names.__getitem__, tokens.value.__getitem__
        sha = hashlib.sha256
        for b in small_pieces(batches, "ids", 1 << 20):
            got = id_lists(b.column("ids"))
            yield {
                "doc_id": b.column("doc_id"),
                "ids": b.column("ids"),
                "n_tokens": [len(x) for x in got],
                "ids_sha256": [sha(b",".join(map(name, x))).hexdigest() for x in got],
                "decoded_sha256": [sha(b"".join(map(of, x))).hexdigest() for x in got],
            }
        give_back()

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * keep_ids
    return packed(encoded.select("doc_id", "ids"), run, schema)


def default_vocabulary() -> tuple[str, str]:
    """Rank file and pattern of the queries."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN


def op1(spark, sf_dir: str) -> DataFrame:
    path, pattern = default_vocabulary()
    return digests(encode(table(spark, sf_dir, "documents"), path, pattern), path)
