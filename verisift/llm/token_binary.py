"""Operator 8: token ids written as frequency-ranked, byte-aligned variable-length integers.

Every text is encoded once. The corpus-wide frequency of each id gives it a
rank; ranks are written in one to four bytes each (a two-bit length per id in a
separate control stream, four to a control byte) and read back by numpy table
lookup.

File format, a Parquet folder with two tables that any Spark reader opens:

``ids``    one row per shard: ``part`` (ranges of doc_id in ascending order),
           ``seq`` (shards of a part in order), ``start_in_part`` (ids of the
           part before this shard), ``doc_ids`` (int64), ``null_ids`` (a byte
           each, 1: the id is null), ``lengths`` (uint32, ids per document),
           ``control``, ``data``; all numbers little-endian.
``ranks``  ``rank``, ``token_id``: the vocabulary in use, most frequent first.

Nulls and empty texts are documents of the end id alone. A null doc_id sorts
first. Equal doc_ids are kept and sort by their ids. An empty table gives empty
files. Extra columns are ignored. Texts are encoded as the library encodes them, its
special tokens in a text included.
"""

from __future__ import annotations

import json
import os
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, fresh_path, packed, shuffle_width, small_pieces

# Bounds of memory in a Python worker, not of the work.
CACHE_WORDS = 700_000
PIECE_BYTES = 4 << 20
SHARD_IDS = 2 << 20

_LOADED: dict[str, "Encoder"] = {}

# Normalising and splitting of the vocabularies that words are encoded for by their parts (fixed values of their files).
_NORMAL = ["NFC", {"Regex": "\\s+"}, "Lowercase"]
_SPLIT = {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}


class _Parts(dict):
    """uint32 ids of the parts of words, as bytes, merged by the model when first asked for."""

    def __init__(self, model):
        super().__init__()
        self.tokenize = model.tokenize
        # Byte-level alphabets write visible Latin-1 characters as they are, other bytes from U+0100 on.
        visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        hidden = [b for b in range(256) if b not in set(visible)]
        self.written = {b: 0x100 + k for k, b in enumerate(hidden)}

    def __missing__(self, part: str) -> bytes:
        shown = part if part.isascii() and part.isprintable() else part.encode().decode("latin-1").translate(self.written)
        ids = self[part] = array("I", [t.id for t in self.tokenize(shown)]).tobytes()
        return ids


class Encoder:
    """A tokenizer, and what it has made of the words it has met.

    The vocabularies meant here drop white space before they merge, so a text may be cut
    at spaces and line breaks, and each word encoded once. Where the file says that words
    are lower-cased and split by a pattern, whose parts are merged on their own, each
    part is merged once: words that differ by case or by a comma share theirs.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            shape = json.load(f)
        self.special = [t["content"] for t in shape.get("added_tokens", ())]
        self.words: dict[str, bytes] = {}
        self.parts = _Parts(self.tokenizer.model)
        self.find = self._finder(shape)

    @staticmethod
    def _finder(shape: dict):
        """Finds a word's parts; None if the file does not say that words are made of these."""
        import regex

        normal = (shape.get("normalizer") or {}).get("normalizers", ())
        steps = (shape.get("pre_tokenizer") or {}).get("pretokenizers", ({},))
        if [n.get("pattern", n["type"]) for n in normal] != _NORMAL or [x.get("type") for x in steps] != ["Split", "ByteLevel"]:
            return None
        split, level = steps
        if not split.get("invert") or split.get("behavior") != "Removed" or split.get("pattern") != _SPLIT or level.get("use_regex") or level.get("add_prefix_space"):
            return None
        return regex.compile(_SPLIT["Regex"]).findall

    def _encode_whole(self, words: list[str]) -> None:
        """Words hold no space; many are joined by spaces for one call, and the tokens'
        offsets tell which word each belongs to."""
        for at in range(0, len(words), 500):
            some = words[at : at + 500]
            e = self.tokenizer.encode(" ".join(some), add_special_tokens=False)
            ids = np.array(e.ids, np.uint32)
            begins = np.fromiter((o[0] for o in e.offsets), np.int64, len(ids))
            starts = np.zeros(len(some) + 1, np.int64)
            np.cumsum(np.fromiter((len(w) + 1 for w in some), np.int64, len(some)), out=starts[1:])
            cuts = np.searchsorted(begins, starts)
            raw = ids.tobytes()
            self.words.update(zip(some, (raw[4 * a : 4 * b] for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()))))

    def _learn(self, new: set[str]) -> None:
        whole, words, parts, find = [], self.words, self.parts, self.find
        for w in new:
            # Up to U+00FF a word is its own normal form, and lower case goes by single characters.
            if find is None or not (w.isascii() or max(w) < "\u0100") or "<" in w and any(x in w for x in self.special):
                whole.append(w)
                continue
            low = w.lower()
            core = low.rstrip(".,;:!?")
            if core.isalpha():  # letters are one part, marks after them another
                words[w] = parts[core] if len(core) == len(low) else parts[core] + parts[low[len(core) :]]
            else:
                words[w] = b"".join(map(parts.__getitem__, find(low)))
        self._encode_whole(whole)

    def encode(self, texts: list[str | None], end_id: int | None) -> list[bytes]:
        """uint32 ids of each text, as little-endian bytes."""
        cut_ = [t.replace("\n", " ").split(" ") if t else [] for t in texts]
        met = set().union(*cut_)
        met.discard("")
        if len(self.words) + len(met) > CACHE_WORDS:
            self.words = {w: self.words[w] for w in met & self.words.keys()}
        if len(self.parts) > CACHE_WORDS:
            self.parts.clear()
        self._learn(met - self.words.keys())
        self.words[""] = b""
        end = b"" if end_id is None else int(end_id).to_bytes(4, "little")
        get = self.words.__getitem__
        return [b"".join(map(get, w)) + end for w in cut_]


def encode_texts(path: str, texts: list[str | None], end_id: int | None) -> list[bytes]:
    if path not in _LOADED:
        _LOADED[path] = Encoder(path)
    return _LOADED[path].encode(texts, end_id)


ENCODED = "doc_id long, ids binary, counts array<long>"


def encode(docs: DataFrame, tokenizer_path: str, end_id: int | None = 1, vocab_size: int = 1 << 16) -> DataFrame:
    """(doc_id, ids, counts): ids as little-endian uint32; and one row per task with
    null ids that holds how often the task met each id."""

    def run(batches: Iterator[pa.RecordBatch]):
        counts = np.zeros(vocab_size, np.int64)
        for b in small_pieces(batches, "text", PIECE_BYTES):
            ids = encode_texts(tokenizer_path, b.column("text").to_pylist(), end_id)
            n = np.bincount(np.frombuffer(b"".join(ids), "<u4"), minlength=vocab_size)
            if len(n) > len(counts):
                counts = np.pad(counts, (0, len(n) - len(counts)))
            counts[: len(n)] += n
            yield {"doc_id": b.column("doc_id"), "ids": [_narrow(x) for x in ids], "counts": [None] * b.num_rows}
        yield {"doc_id": [None], "ids": [None], "counts": [counts]}

    return packed(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), run, ENCODED)


def _narrow(raw: bytes) -> bytes:
    """Ids below 65,536 in two bytes each behind a 2, or all in four behind a 4."""
    a = np.frombuffer(raw, "<u4")
    return b"\x02" + a.astype("<u2").tobytes() if not len(a) or a.max() < 65536 else b"\x04" + raw


def _wide(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, "<u2" if raw[:1] == b"\x02" else "<u4", offset=1).astype(np.uint32)


# ------------------------------------------------------------------ the byte code

_LENGTHS = (np.arange(256)[:, None] >> np.array([0, 2, 4, 6])) % 4 + 1  # by control byte, of its four ids


def pack_ranks(ranks: np.ndarray) -> tuple[bytes, bytes]:
    """Control bytes and data bytes of uint32 ranks."""
    n = len(ranks)
    size = 1 + (ranks > 0xFF).astype(np.uint8) + (ranks > 0xFFFF) + (ranks > 0xFFFFFF)
    slots = np.zeros(-(-n // 4) * 4, np.uint8)
    slots[:n] = size - 1
    control = (slots.reshape(-1, 4) << np.array([0, 2, 4, 6], np.uint8)).sum(axis=1, dtype=np.uint8)
    octets = ranks.astype("<u4").view(np.uint8).reshape(-1, 4)
    return control.tobytes(), octets[np.arange(4) < size[:, None]].tobytes()


def unpack_ranks(control: bytes, data: bytes, n: int) -> np.ndarray:
    size = _LENGTHS[np.frombuffer(control, np.uint8)].reshape(-1)[:n]
    ends = np.cumsum(size)
    at = ends - size
    octets = np.frombuffer(data, np.uint8)
    out = octets[at].astype(np.uint32) if n else np.zeros(0, np.uint32)
    for k in (1, 2, 3):
        more = np.flatnonzero(size > k)
        out[more] |= octets[at[more] + k].astype(np.uint32) << np.uint32(8 * k)
    return out


# ------------------------------------------------------------------ files

SHARD = "part long, seq long, start_in_part long, doc_ids binary, null_ids binary, lengths binary, control binary, data binary"


def write(docs: DataFrame, tokenizer_path: str, path: str, end_id: int | None = 1, vocab_size: int = 1 << 16) -> None:
    """Encode ``docs`` and write the two tables of the file format below ``path``."""
    spark = docs.sparkSession
    encoded = cut(encode(docs, tokenizer_path, end_id, vocab_size))
    counts = (
        encoded.where("ids is null")
        .select(F.posexplode("counts").alias("token_id", "n"))
        .groupBy("token_id")
        .agg(F.sum("n").alias("n"))
        .where("n > 0")
        .collect()  # a row per vocabulary entry at most
    )
    by_rank = np.array([r.token_id for r in sorted(counts, key=lambda r: (-r.n, r.token_id))], np.uint32)
    spark.createDataFrame(pa.table({"rank": np.arange(len(by_rank)), "token_id": by_rank.astype(np.int64)})).coalesce(1).write.parquet(f"{path}/ranks")
    rank_of = np.zeros(int(by_rank.max()) + 1 if len(by_rank) else 1, np.uint32)
    rank_of[by_rank] = np.arange(len(by_rank), dtype=np.uint32)
    table = spark.sparkContext.broadcast(rank_of)

    def shards(batches: Iterator[pa.RecordBatch]):
        from pyspark import TaskContext

        part, seq, start = TaskContext.get().partitionId(), 0, 0
        held: list[tuple[int | None, np.ndarray]] = []
        size = 0

        def row():
            nonlocal held, size, seq, start
            ranks = table.value[np.concatenate([x for _, x in held])]
            control, data = pack_ranks(ranks)
            out = {
                "part": [part], "seq": [seq], "start_in_part": [start],
                "doc_ids": [np.array([i or 0 for i, _ in held], "<i8").tobytes()],
                "null_ids": [bytes(i is None for i, _ in held)],
                "lengths": [np.array([len(x) for _, x in held], "<u4").tobytes()],
                "control": [control], "data": [data],
            }
            seq, start, held, size = seq + 1, start + size, [], 0
            return out

        for b in batches:
            for i, raw in zip(b.column("doc_id").to_pylist(), b.column("ids")):
                held.append((i, _wide(raw.as_py())))
                size += len(held[-1][1])
                if size >= SHARD_IDS:
                    yield row()
        if held:
            yield row()

    ordered = (
        encoded.where("ids is not null").select("doc_id", "ids")
        .repartitionByRange(shuffle_width(spark), "doc_id")
        .sortWithinPartitions("doc_id", "ids")
    )
    packed(ordered, shards, SHARD).write.option("compression", "none").parquet(f"{path}/ids")


DECODED = "doc_id long, start long, n_tokens long, ids binary"


def read(spark, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids as little-endian uint32) of every document in the files."""
    ranks = spark.read.parquet(f"{path}/ranks").collect()  # the vocabulary
    by_rank = np.zeros(max(1, len(ranks)), np.uint32)
    for r in ranks:
        by_rank[r["rank"]] = r.token_id
    table = spark.sparkContext.broadcast(by_rank)
    shards = spark.read.schema(SHARD).parquet(f"{path}/ids")
    # One row per part: as many as the shuffle that wrote them had partitions.
    sizes = shards.select("part", F.expr("start_in_part").alias("s"), "lengths")

    def total(batches):
        for b in batches:
            yield {"part": b.column("part"), "n": [s + int(np.frombuffer(x, "<u4").sum(dtype=np.int64)) for s, x in zip(b.column("s").to_pylist(), b.column("lengths").to_pylist())]}

    parts = sorted(packed(sizes, total, "part long, n long").groupBy("part").agg(F.max("n").alias("n")).collect())
    before, at = {}, 0
    for r in parts:
        before[r.part] = at
        at += r.n

    def rows(batches):
        for b in batches:
            for r in b.to_pylist():
                lengths = np.frombuffer(r["lengths"], "<u4").astype(np.int64)
                ids = table.value[unpack_ranks(r["control"], r["data"], int(lengths.sum()))].astype("<u4")
                ends = np.cumsum(lengths)
                starts = ends - lengths
                doc_ids = np.frombuffer(r["doc_ids"], "<i8").tolist()
                yield {
                    "doc_id": [None if z else i for i, z in zip(doc_ids, r["null_ids"])],
                    "start": starts + before[r["part"]] + r["start_in_part"],
                    "n_tokens": lengths,
                    "ids": [ids[a:z].tobytes() for a, z in zip(starts.tolist(), ends.tolist())],
                }

    return packed(shards, rows, DECODED)


def round_trip(docs: DataFrame, tokenizer_path: str, end_id: int | None = 1) -> DataFrame:
    """Write ``docs`` to the shared folder and read them back."""
    path = fresh_path(docs.sparkSession, "token-ids")
    write(docs, tokenizer_path, path, end_id)
    return read(docs.sparkSession, path)


def op8(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from .common import table

    back = round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), 1)
    return back.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
