"""Blocks of documents with a dictionary each, for operators that look up every token of a corpus.

A task cuts the documents it reads into blocks. In a block each distinct token gets
a number; documents become sequences of these numbers, and the block's tokens go to
buckets by their hash. So a token crosses the network once per block that holds it,
not once per occurrence, and what is found for it comes back to the block. A hot
token is one entry of a bucket per block.

Rows (``ROWS``): kind ``d`` has a block's documents, kind ``w`` its tokens of one bucket;
operators may add kinds of their own.
"""

from __future__ import annotations

import itertools
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from .common import small_pieces

ROWS = "kind string, block long, bucket int, doc_ids binary, lengths binary, body binary, more binary"
#: Bytes of text of a block; a longer text is a block by itself.
BLOCK_BYTES = 16 << 20


def squeeze(raw: bytes) -> bytes:
    import zstandard

    return zstandard.ZstdCompressor(level=1).compress(raw)


def unsqueeze(raw: bytes) -> bytes:
    import zstandard

    return zstandard.ZstdDecompressor().decompress(raw)


def pack_ints(a: np.ndarray) -> bytes:
    """Numbers below 2**32, as byte planes, with as many planes as the largest needs."""
    a = a.astype("<u4")
    width = max(1, (int(a.max()).bit_length() + 7) // 8) if len(a) else 1
    return bytes([width]) + squeeze(np.ascontiguousarray(a.view(np.uint8).reshape(-1, 4).T[:width]).tobytes())


def unpack_ints(raw: bytes) -> np.ndarray:
    planes = np.frombuffer(unsqueeze(raw[1:]), np.uint8).reshape(raw[0], -1)
    out = np.zeros((planes.shape[1], 4), np.uint8)
    out[:, : raw[0]] = planes.T
    return out.reshape(-1).view("<u4")


def pack_words(words: list[bytes]) -> bytes:
    lengths = np.fromiter(map(len, words), "<u4", len(words))
    return squeeze(len(words).to_bytes(4, "little") + lengths.tobytes() + b"".join(words))


def pack_octets(ends: np.ndarray, octets) -> bytes:
    """As ``pack_words``, of words that lie one after another in a buffer: from one of ``ends`` to the next."""
    body = memoryview(octets)[int(ends[0]) : int(ends[-1])] if len(ends) > 1 else b""
    return squeeze(b"".join([(len(ends) - 1).to_bytes(4, "little"), np.diff(ends).astype("<u4").tobytes(), body]))


def unpack_words(raw: bytes) -> list[bytes]:
    raw = unsqueeze(raw)
    n = int.from_bytes(raw[:4], "little")
    ends = 4 + 4 * n + np.cumsum(np.frombuffer(raw, "<u4", n, 4), dtype=np.int64)
    starts = [4 + 4 * n, *ends[:-1].tolist()] if n else []
    return [raw[a:z] for a, z in zip(starts, ends.tolist())]


def pack_ids(ids: list[int | None]) -> bytes:
    """int64 ids behind a flag for each that is null."""
    return bytes(i is None for i in ids) + np.array([i or 0 for i in ids], "<i8").tobytes()


def unpack_ids(raw: bytes) -> list[int | None]:
    n = len(raw) // 9
    return [None if z else i for z, i in zip(raw[:n], np.frombuffer(raw, "<i8", n, n).tolist())]


def runs(stops: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Neighbouring documents, from one to another, of about ``limit`` tokens together; at least one."""
    at, n = 0, len(stops) - 1
    while at < n:
        to = max(at + 1, int(np.searchsorted(stops, stops[at] + limit, side="right")) - 1)
        yield at, min(to, n)
        at = to


def cut_blocks(batches: Iterator[pa.RecordBatch], limit: int = BLOCK_BYTES) -> Iterator[tuple[int, list, list]]:
    """(block, doc_ids, texts); a block's number holds that of its task."""
    from pyspark import TaskContext

    numbers = itertools.count(TaskContext.get().partitionId() << 32)
    ids, texts, size = [], [], 0
    for b in small_pieces(batches, "text", 2 << 20):
        for i, t in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist()):
            ids.append(i)
            texts.append(t or "")
            size += len(texts[-1])
            if size >= limit:
                yield next(numbers), ids, texts
                ids, texts, size = [], [], 0
    if ids:
        yield next(numbers), ids, texts


def by_frequency(seq: np.ndarray, words: list) -> tuple[np.ndarray, list, np.ndarray]:
    """Sequence and words renumbered, the most frequent first; and the frequencies."""
    n = np.bincount(seq, minlength=len(words))
    order = np.argsort(-n, kind="stable")
    place = np.empty(len(words), np.uint32)
    place[order] = np.arange(len(words), dtype=np.uint32)
    return place[seq], [words[k] for k in order.tolist()], n[order]


def document_row(block: int, ids: list, lengths: np.ndarray, seq: np.ndarray) -> dict:
    return {"kind": ["d"], "block": [block], "bucket": [None], "doc_ids": [pack_ids(ids)], "lengths": [pack_ints(lengths)], "body": [pack_ints(seq)], "more": [None]}


def word_rows(block: int, words: list[bytes], buckets: int, counts: np.ndarray | None = None) -> dict | None:
    """A row per bucket: the words, and (as ``more``) their numbers and, if given, counts."""
    if not words:
        return None
    at = np.fromiter((zlib.crc32(w) % buckets for w in words), np.int64, len(words))
    order = np.argsort(at, kind="stable")
    found, first = np.unique(at[order], return_index=True)
    groups = np.split(order, first[1:])
    n = len(found)
    return {
        "kind": ["w"] * n, "block": [block] * n, "bucket": found.astype(np.int32),
        "doc_ids": [None] * n, "lengths": [None if counts is None else pack_ints(counts[g]) for g in groups],
        "body": [pack_words([words[k] for k in g.tolist()]) for g in groups],
        "more": [pack_ints(g) for g in groups],
    }
