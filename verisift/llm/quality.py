"""Operator 5: text quality by a generalised additive model with pairwise interactions.

The model is a sum of lookup tables: one per feature over its bins, and one per
chosen pair of features over a coarser grid. Training boosts cyclically: in
turn, each feature gets a tree of at most three leaves over its histogram of
residuals, added to its table with a small learning rate; then the pairs with
the largest gain get trees of four quadrants the same way. Scoring adds one
table entry per feature and pair, vectorised over all rows.

Inputs of the score are counts over the text alone. A null text scores as an
empty one; a document without labels only gets a score; labels that are null
or of documents not present are not learned; without any usable label every
score is 0.5. Repeated rows are scored (and, if labelled, learned) repeatedly.
Extra columns are ignored, or kept by ``keep``.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, fold, give_back, packed, pickled, small_pieces, table

#: Most labelled rows that the model is fitted on, taken by a hash of the id.
TRAIN_ROWS = 20_000
PIECE_BYTES = 1 << 20
THRESHOLD = 0.3

FEATURES = (
    "bytes", "words", "lines", "word_bytes", "longest_word", "upper", "lower", "digit", "comma", "full_stop",
    "bar", "symbol", "bang", "beyond_ascii", "symbol_runs", "upper_words", "distinct_words", "distinct_lines",
    "line_bytes", "words_per_stop",
)

_CLASS = np.full(256, 9, np.uint8)  # by byte; 9: other symbols
for _k, _of in enumerate((range(65, 91), range(97, 123), range(48, 58), b" \t\r\x0b\x0c", b"\n", b",;:", b".", b"|", b"!?")):
    _CLASS[list(_of)] = _k
_CLASS[128:] = 10
_CLASS[list(b"'\"()-")] = 11


def features(texts: list[str | None]) -> np.ndarray:
    """One row per text, one column per name in FEATURES."""
    out = np.zeros((len(texts), len(FEATURES)), np.float32)
    for i, t in enumerate(texts):
        if not t:
            continue
        raw = t.encode("utf-8", "surrogatepass")
        kinds = _CLASS[np.frombuffer(raw, np.uint8)]
        n = len(raw)
        c = np.bincount(kinds, minlength=12)
        words, lines = raw.split(), raw.split(b"\n")
        w = max(1, len(words))
        odd = (kinds == 9) | (kinds == 8)
        out[i] = (
            np.log1p(n), np.log1p(len(words)), np.log1p(len(lines)), (n - c[3] - c[4]) / w, np.log1p(max(map(len, words), default=0)),
            c[0] / n, c[1] / n, c[2] / n, c[5] / w, c[6] / w, c[7] / w, c[9] / w, c[8] / w, c[10] / n,
            (odd[1:] & odd[:-1]).sum() / w, sum(map(bytes.isupper, words)) / w, len(set(words)) / w, len(set(lines)) / len(lines),
            np.log1p(n / len(lines)), np.log1p(len(words) / (1 + c[6] + c[8])),
        )
    return out


FEATURE_ROWS = "doc_id long, x binary"


def featurize(docs: DataFrame) -> DataFrame:
    """(doc_id, x): the features as little-endian float32."""

    def run(batches: Iterator[pa.RecordBatch]):
        for b in small_pieces(batches, "text", PIECE_BYTES):
            x = features(b.column("text").to_pylist())
            yield {"doc_id": b.column("doc_id"), "x": [r.astype("<f4").tobytes() for r in x]}

    return packed(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), run, FEATURE_ROWS)


# ------------------------------------------------------------------ the model


def _edges(x: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(x, np.arange(1, bins) / bins)) if len(x) else np.zeros(0)


def _digits(x: np.ndarray, edges: np.ndarray) -> np.ndarray:
    return np.searchsorted(edges, x, side="right")


def _gain(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    return g * g / (h + 1.0)


def _tree(g: np.ndarray, h: np.ndarray, leaves: int = 3) -> np.ndarray:
    """Value of each bin by the best tree of at most ``leaves`` leaves, split greedily."""
    parts = [(0, len(g))]
    while len(parts) < leaves:
        best = (1e-9, None, 0)
        for a, z in parts:
            if z - a < 2:
                continue
            cg, ch = np.cumsum(g[a:z]), np.cumsum(h[a:z])
            gain = _gain(cg[:-1], ch[:-1]) + _gain(cg[-1] - cg[:-1], ch[-1] - ch[:-1]) - _gain(cg[-1], ch[-1])
            k = int(gain.argmax())
            if gain[k] > best[0]:
                best = (gain[k], (a, z), a + k + 1)
        if best[1] is None:
            break
        parts.remove(best[1])
        parts += [(best[1][0], best[2]), (best[2], best[1][1])]
    out = np.zeros(len(g))
    for a, z in parts:
        out[a:z] = g[a:z].sum() / (h[a:z].sum() + 1.0)
    return out


def _quadrants(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """Gain and values of the best cut of a grid by one split of each axis."""
    cg, ch = (np.pad(a.cumsum(0).cumsum(1), ((1, 0), (1, 0))) for a in (g, h))
    i, j = np.meshgrid(np.arange(1, g.shape[0]), np.arange(1, g.shape[1]), indexing="ij")
    if not i.size:
        return 0.0, np.zeros_like(g)

    def four(c):
        a, top, left, all_ = c[i, j], c[i, -1], c[-1, j], c[-1, -1]
        return a, top - a, left - a, all_ - top - left + a

    gq, hq = four(cg), four(ch)
    gain = sum(_gain(a, b) for a, b in zip(gq, hq)) - _gain(cg[-1, -1], ch[-1, -1])
    k = np.unravel_index(int(gain.argmax()), gain.shape)
    v = [a[k] / (b[k] + 1.0) for a, b in zip(gq, hq)]
    x, y = int(i[k]), int(j[k])
    out = np.empty_like(g)
    out[:x, :y], out[:x, y:], out[x:, :y], out[x:, y:] = v
    return float(gain[k]), out


def fit(x: np.ndarray, y: np.ndarray, bins: int = 48, grid: int = 10, rounds: int = 120, pairs: int = 8, rate: float = 0.15) -> dict:
    """The model's intercept, bin edges and tables."""
    n, m = x.shape
    if n == 0 or y.min() == y.max():
        return {"base": 0.0 if n == 0 else (4.0 if y[0] else -4.0), "edges": [], "tables": [], "grid": [], "pairs": []}
    edges = [_edges(x[:, k], bins) for k in range(m)]
    at = [_digits(x[:, k], edges[k]) for k in range(m)]
    tables = [np.zeros(len(e) + 1) for e in edges]
    p = y.mean()
    base = float(np.log(p / (1 - p)))
    f = np.full(n, base)

    def residuals():
        q = 1 / (1 + np.exp(-f))
        return y - q, q * (1 - q)

    for _ in range(rounds):
        for k in range(m):
            g, h = residuals()
            step = rate * _tree(np.bincount(at[k], g, len(tables[k])), np.bincount(at[k], h, len(tables[k])))
            tables[k] += step
            f += step[at[k]]
    coarse = [_edges(x[:, k], grid) for k in range(m)]
    cell = [_digits(x[:, k], coarse[k]) for k in range(m)]
    side = [len(e) + 1 for e in coarse]

    def on_grid(a, b, v):
        return np.bincount(cell[a] * side[b] + cell[b], v, side[a] * side[b]).reshape(side[a], side[b])

    g, h = residuals()
    ranked = sorted(((_quadrants(on_grid(a, b, g), on_grid(a, b, h))[0], a, b) for a in range(m) for b in range(a)), reverse=True)
    chosen = [(a, b) for gain, a, b in ranked[:pairs] if gain > 0]
    grids = {ab: np.zeros((side[ab[0]], side[ab[1]])) for ab in chosen}
    for _ in range(rounds // 3):
        for a, b in chosen:
            g, h = residuals()
            step = rate * _quadrants(on_grid(a, b, g), on_grid(a, b, h))[1]
            grids[a, b] += step
            f += step[cell[a], cell[b]]
    return {"base": base, "edges": edges, "tables": tables, "grid": coarse, "pairs": [(a, b, grids[a, b]) for a, b in chosen]}


def score(model: dict, x: np.ndarray) -> np.ndarray:
    """Probability of label 1, by adding table entries."""
    f = np.full(len(x), model["base"])
    for k, (edges, values) in enumerate(zip(model["edges"], model["tables"])):
        f += values[_digits(x[:, k], edges)]
    if model["pairs"]:
        cell = [_digits(x[:, k], e) for k, e in enumerate(model["grid"])]
        for a, b, values in model["pairs"]:
            f += values[cell[a], cell[b]]
    return 1 / (1 + np.exp(-f))


def _matrix(rows: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(rows), "<f4").reshape(-1, len(FEATURES)).astype(np.float64)


def train(feature_rows: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> dict:
    """Fit on the ``rows`` first labelled documents outside the held-out fold, in the order of a hash of the id."""
    known = labels.select(F.col("doc_id").cast("long"), F.col("quality").cast("int").alias("y")).where("y in (0, 1)").where(fold(F.col("doc_id"), 5) > 0)
    sample = feature_rows.join(known, "doc_id").orderBy(F.xxhash64("doc_id"), "doc_id", "y", "x").limit(rows).select("x", "y")

    def run(batches):
        got = [(b.column("x").to_pylist(), b.column("y").to_numpy()) for b in batches]
        x = _matrix([v for xs, _ in got for v in xs])
        y = np.concatenate([v for _, v in got]) if got else np.zeros(0)
        yield {"model": [pickled(fit(x, y.astype(np.float64)))]}

    found = packed(sample.repartition(1), run, "model binary").collect()  # a few tables of some tens of entries
    return pickle.loads(found[0].model) if found else fit(np.zeros((0, len(FEATURES))), np.zeros(0))


SCORED = "doc_id long, score double"


def score_rows(feature_rows: DataFrame, model: dict) -> DataFrame:
    def run(batches):
        for b in batches:
            yield {"doc_id": b.column("doc_id"), "score": score(model, _matrix(b.column("x").to_pylist()))}
        give_back()

    return packed(feature_rows, run, SCORED)


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, score) of every row."""
    x = cut(featurize(docs))
    return score_rows(x, train(x, labels))


def keep(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows, with all their columns, whose score reaches ``threshold``."""
    # Features are cheap enough to count again here: joining scores back would shuffle the texts.
    model = train(featurize(docs), labels)
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]):
        for b in small_pieces(batches, "text", PIECE_BYTES):
            good = score(model, features(b.column("text").to_pylist()).astype(np.float64)) >= threshold
            b = b.filter(pa.array(good))
            yield {n: b.column(n) for n in names}
        give_back()

    return packed(docs, run, docs.schema)


def op5(spark, sf_dir: str) -> DataFrame:
    scored = classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return scored.select(
        "doc_id",
        (fold(F.col("doc_id"), 5) == 0).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
