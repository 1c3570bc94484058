"""Operator 3: near-duplicate vectors by an epsilon grid order join.

Unit vectors with a cosine of ``t`` or more are at most ``eps = sqrt(2 - 2 t)`` apart, and
so are their projections on any axes. Vectors are projected on the leading
principal axes of all vectors, sorted by their cells of width eps in that space
(label first), and the sequence is cut into blocks. Intervals of the sequence (all
blocks of a range, eight neighbouring ranges, eight of those, ...) are joined
recursively from the widest down: a pair of intervals whose bounding boxes are
further than eps apart is skipped with all it holds. Block pairs that remain are
multiplied in double precision.

Equal vectors of a label are one class from the start and are compared once; a class
counts with its size. A block pair reports, for each vector, how many it links to, and a
spanning forest of its links, so a dense group of ``k`` vectors gives some ``k`` rows, not ``k * k``.

Vectors link only within a label and a length. Vectors that are null or empty, have norm
zero or a null or non-finite component, or whose label or id is null, link with nothing
and are their own component. Rows with one id are one node: all it links to is one
component, also for a row of it that links with nothing; each row is a vector for the
counts. A label that is no number counts by its hash. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, packed, table
from .components import components

#: Leading principal axes of the grid, and of how many coordinates the axes are made.
AXES, COORDINATES = 6, 256
BLOCK = 2048
FAN = 8
TILE = 512
#: Parts that the copies of one vector are dealt into.
SALTS = 16

PREPARED = "vec_id long, digest binary, label long, dim int, vec binary"


def prepare(vectors: DataFrame) -> DataFrame:
    """Each row with its label, and (if it can link) its vector in doubles and a digest of label and vector."""

    def run(batches):
        for b in batches:
            ids, labels, digests, raws, dims = [], [], [], [], []
            for i, e, k in zip(b.column("vec_id").to_pylist(), b.column("embedding"), b.column("label").to_pylist()):
                raw = digest = None
                v = e.values
                if i is not None and k is not None and v is not None and len(v) and not v.null_count:
                    x = np.asarray(v.to_numpy(zero_copy_only=False), np.float64) + 0.0
                    largest = float(np.abs(x).max()) if np.isfinite(x).all() else 0.0
                    if largest > 0:
                        # By its largest component, where squares would leave the range of doubles.
                        x = x if 1e-100 < largest < 1e100 else x / largest
                        raw = x.astype("<f8").tobytes()
                        digest = hashlib.blake2b(b"%d:" % k + raw, digest_size=16).digest()
                ids.append(i)
                labels.append(k)
                digests.append(digest)
                raws.append(raw)
                dims.append(len(raw) // 8 if raw else None)
            yield {"vec_id": ids, "digest": digests, "label": labels, "dim": dims, "vec": raws}

    # A label that is no number is one of its own by its hash; vectors of one label are compared.
    label = F.col("label").try_cast("long") if dict(vectors.dtypes)["label"] != "string" else F.when(F.col("label").isNotNull(), F.coalesce(F.col("label").try_cast("long"), F.xxhash64("label")))
    rows = vectors.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>"), label.alias("label"))
    return packed(rows, run, PREPARED)


def _units(raws: list[bytes], dim: int) -> np.ndarray:
    x = np.frombuffer(b"".join(raws), "<f8").reshape(-1, dim)
    return x / np.sqrt((x * x).sum(1))[:, None]


def axes(classes: DataFrame) -> dict[int, np.ndarray]:
    """By length of vectors: leading principal axes of all unit vectors, as columns."""

    def moments(batches):
        sums: dict[int, list] = {}
        for b in batches:
            dims, raws = b.column("dim").to_numpy(), b.column("vec").to_pylist()
            for d in np.unique(dims).tolist():
                u = _units([raws[k] for k in np.flatnonzero(dims == d)], d)[:, :COORDINATES]
                s = sums.setdefault(d, [0, 0.0, 0.0])
                s[0] += len(u)
                s[1] = s[1] + u.sum(0)
                s[2] = s[2] + u.T @ u
        for d, (n, one, two) in sums.items():
            yield {"dim": [d], "n": [n], "one": [one.tobytes()], "two": [two.tobytes()]}

    def add(t: pa.Table) -> pa.Table:
        rows = t.to_pylist()
        d = rows[0]["dim"]
        one = sum(np.frombuffer(r["one"]) for r in rows)
        two = sum(np.frombuffer(r["two"]) for r in rows)
        return pa.table({"dim": pa.array([d], pa.int32()), "n": pa.array([sum(r["n"] for r in rows)], pa.int64()), "one": pa.array([one.tobytes()]), "two": pa.array([two.tobytes()])})

    schema = "dim int, n long, one binary, two binary"
    # A matrix per task and length, added in two steps; at the end one for each length.
    tasks = packed(classes.select("dim", "vec"), moments, schema).withColumn("some", F.spark_partition_id() % 64)
    some = tasks.groupBy("dim", "some").applyInArrow(add, schema)
    out = {}
    for r in some.groupBy("dim").applyInArrow(add, schema).collect():
        c = min(r.dim, COORDINATES)
        mean, square = np.frombuffer(r.one) / r.n, np.frombuffer(r.two).reshape(c, c) / r.n
        _, vectors = np.linalg.eigh(square - np.outer(mean, mean))
        out[r.dim] = np.ascontiguousarray(vectors[:, ::-1][:, :AXES])
    return out


BLOCKS = "block long, place long, label long, dim int, lo array<double>, hi array<double>, ids binary, sizes binary, vecs binary"


def blocks(classes: DataFrame, eps: float, n_classes: int) -> DataFrame:
    """The classes in grid order, cut into blocks with their bounding boxes."""
    basis = axes(classes)
    width = max(1, -(-n_classes // BLOCK))

    def project(batches):
        for b in batches:
            dims, raws = b.column("dim").to_numpy(), b.column("vec").to_pylist()
            cells = np.zeros((len(raws), AXES), np.int32)
            for d in np.unique(dims).tolist():
                at = np.flatnonzero(dims == d)
                w = basis[d]
                cells[at, : w.shape[1]] = np.floor(_units([raws[k] for k in at], d)[:, : len(w)] @ w / eps)
            yield {"label": b.column("label"), "dim": b.column("dim"), "cells": list(cells), "first": b.column("first"), "n": b.column("n"), "vec": b.column("vec")}

    def cut_(batches):
        from pyspark import TaskContext

        place = TaskContext.get().partitionId()
        held, seq = [], 0

        def row():
            nonlocal held, seq
            label, d = held[0][0]
            vecs = [r[3] for r in held]
            w = basis[d]
            y = _units(vecs, d)[:, : len(w)] @ w
            out = {
                "block": [(place << 32) + seq], "place": [place], "label": [label], "dim": [d],
                "lo": [y.min(0)], "hi": [y.max(0)],
                "ids": [np.array([r[1] for r in held], "<i8").tobytes()],
                "sizes": [np.array([r[2] for r in held], "<i8").tobytes()], "vecs": [b"".join(vecs)],
            }
            held, seq = [], seq + 1
            return out

        for b in batches:
            for label, d, i, n, v in zip(*(b.column(c).to_pylist() for c in ("label", "dim", "first", "n", "vec"))):
                if held and (held[0][0] != (label, d) or len(held) >= BLOCK):
                    yield row()
                held.append(((label, d), i, n, v))
        if held:
            yield row()

    order = ["label", "dim", "cells", "first"]
    gridded = packed(classes.select("label", "dim", "first", "n", "vec"), project, "label long, dim int, cells array<int>, first long, n long, vec binary")
    return cut(packed(gridded.repartitionByRange(width, *order).sortWithinPartitions(*order), cut_, BLOCKS))


def close_blocks(found: DataFrame, eps: float) -> DataFrame:
    """Pairs (i, j), i <= j, of blocks that may hold a link, by descent through wider and wider intervals."""
    leaf = found.select("label", "dim", "place", F.col("block").alias("node"), "lo", "hi")
    levels = [leaf]
    top = found.agg(F.max("place")).first()[0] or 0
    step = 1
    while True:
        at = F.floor(F.col("place") / F.lit(step)).cast("long")
        n = F.size(F.first("lo"))
        lo = [F.min(F.get("lo", F.lit(k))) for k in range(AXES)]
        hi = [F.max(F.get("hi", F.lit(k))) for k in range(AXES)]
        wider = leaf.groupBy("label", "dim", at.alias("node")).agg(F.slice(F.array(*lo), F.lit(1), n).alias("lo"), F.slice(F.array(*hi), F.lit(1), n).alias("hi"))
        levels.append(wider)
        if top // step == 0:
            break
        step *= FAN
    levels = levels[::-1]

    def near(x: str, y: str):
        gap = f"greatest({x}.lo[k] - {y}.hi[k], {y}.lo[k] - {x}.hi[k], 0D)"
        return F.expr(f"aggregate(transform(sequence(0, size({x}.lo) - 1), k -> {gap} * {gap}), 0D, (a, b) -> a + b)") <= eps * eps * (1 + 1e-9)

    pairs = levels[0].select("label", "dim", F.col("node").alias("i"), F.col("node").alias("j"))
    for depth, level in enumerate(levels[1:], 1):
        if depth == len(levels) - 1:
            kids = level.withColumn("parent", F.col("place"))
        else:
            kids = level.withColumn("parent", F.floor(F.col("node") / F.lit(FAN)).cast("long"))
        x, y = kids.alias("x"), kids.alias("y")
        p = pairs.alias("p")
        pairs = (
            p.join(x, (F.col("p.label") == F.col("x.label")) & (F.col("p.dim") == F.col("x.dim")) & (F.col("p.i") == F.col("x.parent")))
            .join(y, (F.col("p.label") == F.col("y.label")) & (F.col("p.dim") == F.col("y.dim")) & (F.col("p.j") == F.col("y.parent")))
            .where((F.col("x.node") <= F.col("y.node")) & near("x", "y"))
            .select("x.label", "x.dim", F.col("x.node").alias("i"), F.col("y.node").alias("j"))
        )
    return pairs.select("i", "j")


def _forest(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Join the trees of ``label`` that links (a, b) connect; each label is a vertex of the same tree, the smallest."""
    while True:
        x, y = label[a], label[b]
        apart = x != y
        if not apart.any():
            return
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
        while True:
            up = label[label]
            if (up == label).all():
                break
            label[:] = up


def links_of(ids: list[np.ndarray], sizes: list[np.ndarray], units: list[np.ndarray], t: float, same: bool):
    """For the vectors of one or two blocks: how many each links to (itself left out), and
    the edges of a spanning forest of the links, as places in the blocks put together."""
    n = len(ids[0])
    total = [np.zeros(len(i), np.int64) for i in ids]
    label = np.arange(n if same else n + len(ids[1]))
    right = units[-1]
    for at in range(0, n, TILE):
        linked = units[0][at : at + TILE] @ right.T >= t
        if same:
            linked[np.arange(len(linked)), at + np.arange(len(linked))] = False
        if not linked.any():
            continue
        total[0][at : at + TILE] += linked @ sizes[-1]
        if not same:
            total[1] += sizes[0][at : at + TILE] @ linked
        r, c = np.nonzero(linked)
        _forest(label, r + at, c if same else c + n)
    child = np.flatnonzero(label != np.arange(len(label)))
    return total, np.stack([label[child], child])


LINKS = "id long, n long, other long"


def links(found: DataFrame, pairs: DataFrame, t: float) -> DataFrame:
    """Rows (id, n): links found for a vector in a block pair; and (id, null, other): edges."""

    def run(batches):
        for b in batches:
            for k in range(b.num_rows):
                r = b.slice(k, 1).to_pylist()[0]
                same = r["i"] == r["j"]
                d = r["dim"]
                sides = ["x"] if same else ["x", "y"]
                ids = [np.frombuffer(r[f"{s}_ids"], "<i8") for s in sides]
                sizes = [np.frombuffer(r[f"{s}_sizes"], "<i8") for s in sides]
                units = []
                for s in sides:
                    x = np.frombuffer(r[f"{s}_vecs"], "<f8").reshape(-1, d)
                    units.append(x / np.sqrt((x * x).sum(1))[:, None])
                total, edges = links_of(ids, sizes, units, t, same)
                all_ids = np.concatenate(ids)
                n = np.concatenate(total)
                some = np.flatnonzero(n)
                a, z = all_ids[edges[0]], all_ids[edges[1]]
                yield {
                    "id": np.concatenate([all_ids[some], a]),
                    "n": pa.concat_arrays([pa.array(n[some], pa.int64()), pa.nulls(len(a), pa.int64())]),
                    "other": pa.concat_arrays([pa.nulls(len(some), pa.int64()), pa.array(z, pa.int64())]),
                }

    body = ["ids", "sizes", "vecs"]
    x = found.select(F.col("block").alias("i"), "dim", *(F.col(c).alias(f"x_{c}") for c in body))
    y = found.select(F.col("block").alias("j"), *(F.col(c).alias(f"y_{c}") for c in body))
    # Only one side of a pair travels with it; a block paired with itself needs no second copy.
    own, other = pairs.where("i = j"), pairs.where("i < j")
    alone = own.join(x, "i").select("i", "j", "dim", *(f"x_{c}" for c in body), *(F.lit(None).cast("binary").alias(f"y_{c}") for c in body))
    both = other.join(y, "j").join(x, "i").select("i", "j", "dim", *(f"{s}_{c}" for s in "xy" for c in body))
    return packed(alone.unionByName(both), run, LINKS)


def join(vectors: DataFrame, cosine: float = 0.93) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row."""
    eps = float(np.sqrt(max(0.0, 2 - 2 * cosine)))
    rows = cut(prepare(vectors))
    some = rows.where("digest is not null")
    # A class goes by a number of its own: classes can share their least id.
    classes = cut(
        some.groupBy("digest")
        .agg(F.min("vec_id").alias("least"), F.count("*").alias("n"), F.first("label").alias("label"), F.first("dim").alias("dim"), F.first("vec").alias("vec"))
        .withColumn("first", F.monotonically_increasing_id())
    )
    n_classes = classes.count()
    found = blocks(classes, eps, n_classes)
    got = cut(links(found, cut(close_blocks(found, eps)), cosine))
    counts = got.where("n is not null").groupBy(F.col("id").alias("first")).agg(F.sum("n").alias("others"))
    # Rows of one id are one node, so what they link to hangs together.
    numbered = classes.select("digest", "first")
    of_ids = cut(
        some.select("vec_id", "digest").distinct().join(numbered, "digest")
        .groupBy("vec_id").agg(F.min("first").alias("a"), F.count(F.lit(1)).alias("k")).where("k > 1")
    )
    ties = some.join(of_ids, "vec_id").select("digest", "a").distinct().join(numbered, "digest").select("a", F.col("first").alias("b"))
    whole = components(got.where("other is not null").select(F.col("id").alias("a"), F.col("other").alias("b")).unionByName(ties))
    placed = cut(classes.join(whole, F.col("first") == F.col("id"), "left").select("digest", "first", "least", "n", F.coalesce("component", "first").alias("group")))
    smallest = placed.groupBy("group").agg(F.min("least").alias("component_id"))
    per_class = (
        placed.join(counts, "first", "left").join(smallest, "group")
        .select("digest", (F.coalesce("others", F.lit(0)) + F.col("n") - 1).alias("n_links"), "component_id")
    )
    # A class is there once per part of its copies.
    part = F.pmod(F.xxhash64("vec_id"), F.lit(SALTS)).cast("int").alias("part")
    parts = per_class.select("*", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("part"))
    linked = cut(some.select("vec_id", "digest", part).join(parts, ["digest", "part"]).select("vec_id", "n_links", "component_id"))
    # Vectors that can't link are alone, unless another row of their id does.
    alone = rows.where("digest is null").select("vec_id")
    known = linked.select(F.col("vec_id").alias("id"), F.col("component_id").alias("other")).join(alone.distinct(), F.col("id") == F.col("vec_id"), "left_semi").distinct()
    rest = alone.where("vec_id is not null").join(known, F.col("vec_id") == F.col("id"), "left")
    out = linked.unionByName(rest.select("vec_id", F.lit(0).alias("n_links"), F.coalesce("other", "vec_id").alias("component_id")))
    out = out.unionByName(alone.where("vec_id is null").select("vec_id", F.lit(0).alias("n_links"), "vec_id").toDF("vec_id", "n_links", "component_id"))
    return out.select("vec_id", F.col("n_links").cast("long").alias("n_links"), "component_id", F.coalesce(F.col("component_id") == F.col("vec_id"), F.lit(True)).alias("kept"))


def op3(spark, sf_dir: str) -> DataFrame:
    return join(table(spark, sf_dir, "embeddings"), 0.93)
