"""Operator 5's boosting against plain loops over the definition."""

import math
import random

import numpy as np
import pytest

from verisift.llm import quality


def bins_of(values, bins):
    """Cut points at the quantiles k / bins, linear between neighbours, each once."""
    s = sorted(values)
    out = []
    for k in range(1, bins):
        at = (len(s) - 1) * k / bins
        low = math.floor(at)
        high = min(low + 1, len(s) - 1)
        out.append(s[low] + (s[high] - s[low]) * (at - low))
    return sorted(set(out))


def bin_at(edges, v):
    return sum(e <= v for e in edges)


def gain(g, h):
    return g * g / (h + 1)


def best_tree(g, h, leaves=3):
    """Parts of the bins by the split of largest gain, time after time; each part's value."""
    parts = [(0, len(g))]
    while len(parts) < leaves:
        found = []
        for a, z in parts:
            for c in range(a + 1, z):
                more = gain(sum(g[a:c]), sum(h[a:c])) + gain(sum(g[c:z]), sum(h[c:z])) - gain(sum(g[a:z]), sum(h[a:z]))
                found.append((more, a, c, z))
        if not found or max(found)[0] <= 1e-9:
            break
        _, a, c, z = max(found)
        parts = [p for p in parts if p != (a, z)] + [(a, c), (c, z)]
    out = [0.0] * len(g)
    for a, z in parts:
        for k in range(a, z):
            out[k] = sum(g[a:z]) / (sum(h[a:z]) + 1)
    return out


def best_quadrants(g, h):
    n, m = len(g), len(g[0])

    def total(v, rows, cols):
        return sum(v[i][j] for i in rows for j in cols)

    best = (-math.inf, None)
    whole = gain(total(g, range(n), range(m)), total(h, range(n), range(m)))
    for x in range(1, n):
        for y in range(1, m):
            four = [(rows, cols) for rows in (range(x), range(x, n)) for cols in (range(y), range(y, m))]
            value = sum(gain(total(g, *q), total(h, *q)) for q in four) - whole
            if value > best[0]:
                best = (value, four)
    out = [[0.0] * m for _ in range(n)]
    for rows, cols in best[1] or ():
        for i in rows:
            for j in cols:
                out[i][j] = total(g, rows, cols) / (total(h, rows, cols) + 1)
    return max(best[0], 0.0) if best[1] else 0.0, out


def plain_fit(x, y, bins, grid, rounds, pairs, rate):
    n, m = len(x), len(x[0])
    p = sum(y) / n
    f = [math.log(p / (1 - p))] * n
    edges = [bins_of([r[k] for r in x], bins) for k in range(m)]
    tables = [[0.0] * (len(e) + 1) for e in edges]

    def residual(i):
        q = 1 / (1 + math.exp(-f[i]))
        return y[i] - q, q * (1 - q)

    for _ in range(rounds):
        for k in range(m):
            g, h = [0.0] * len(tables[k]), [0.0] * len(tables[k])
            for i in range(n):
                a, b = residual(i)
                g[bin_at(edges[k], x[i][k])] += a
                h[bin_at(edges[k], x[i][k])] += b
            step = best_tree(g, h)
            for c, v in enumerate(step):
                tables[k][c] += rate * v
            for i in range(n):
                f[i] += rate * step[bin_at(edges[k], x[i][k])]
    coarse = [bins_of([r[k] for r in x], grid) for k in range(m)]

    def cells(a, b):
        g = [[0.0] * (len(coarse[b]) + 1) for _ in range(len(coarse[a]) + 1)]
        h = [list(r) for r in g]
        for i in range(n):
            u, v = residual(i)
            g[bin_at(coarse[a], x[i][a])][bin_at(coarse[b], x[i][b])] += u
            h[bin_at(coarse[a], x[i][a])][bin_at(coarse[b], x[i][b])] += v
        return g, h

    ranked = sorted(((best_quadrants(*cells(a, b))[0], a, b) for a in range(m) for b in range(a)), reverse=True)
    chosen = [(a, b) for value, a, b in ranked[:pairs] if value > 0]
    grids = {ab: [[0.0] * (len(coarse[ab[1]]) + 1) for _ in range(len(coarse[ab[0]]) + 1)] for ab in chosen}
    for _ in range(rounds // 3):
        for a, b in chosen:
            step = best_quadrants(*cells(a, b))[1]
            for i, row in enumerate(step):
                for j, v in enumerate(row):
                    grids[a, b][i][j] += rate * v
            for i in range(n):
                f[i] += rate * step[bin_at(coarse[a], x[i][a])][bin_at(coarse[b], x[i][b])]
    return tables, grids, f


@pytest.mark.parametrize("seed", [1, 2])
def test_tables_are_those_of_plain_boosting(seed):
    rng = random.Random(seed)
    # Ties and repeated rows among them.
    x = [[rng.choice([rng.gauss(0, 1), 0.5]), rng.randrange(4) / 4, rng.gauss(0, 1)] for _ in range(50)]
    x += x[:10]
    y = [float(r[0] + r[1] * r[2] + rng.gauss(0, 0.7) > 0.2) for r in x]
    size = dict(bins=7, grid=4, rounds=9, pairs=2, rate=0.15)
    model = quality.fit(np.array(x), np.array(y), **size)
    tables, grids, f = plain_fit(x, y, **size)
    for got, want in zip(model["tables"], tables):
        assert np.allclose(got, want, atol=1e-9)
    assert [(a, b) for a, b, _ in model["pairs"]] == list(grids)
    for a, b, got in model["pairs"]:
        assert np.allclose(got, grids[a, b], atol=1e-9)
    assert np.allclose(quality.score(model, np.array(x)), [1 / (1 + math.exp(-v)) for v in f], atol=1e-9)
