"""Whitening against a plain fit with Python's integers and numpy, with odd rows."""

import math
import random
from fractions import Fraction

import numpy as np
import pytest

from packetloom.llm import queries, whitening

COLUMNS = "vec_id long, embedding array<double>, x string, n int, component string"


def plain(rows, grid=256, top=4):
    """(vec_id, component) -> deviation, |whitened|, explained of a list of (id, vector)."""
    kept = [(i, [math.floor(grid * c) for c in v]) for i, v in rows
            if v and len(v) == 5 and all(c is not None and math.isfinite(c) for c in v)]
    distinct = sorted({tuple(x) for _, x in kept})
    n, d = len(distinct), 5
    sums = [sum(x[k] for x in distinct) for k in range(d)]
    centred = [[n * x[k] - sums[k] for k in range(d)] for x in distinct]
    v = np.array([[float(Fraction(sum(y[i] * y[j] for y in centred), n**3)) for j in range(d)] for i in range(d)])
    e, w = np.linalg.eigh(v)
    order = np.argsort(-e)[:top]
    out = []
    for i, x in kept:
        y = [n * x[k] - sums[k] for k in range(d)]
        for c, k in enumerate(order, 1):
            score = sum(y[j] / n * w[j, k] for j in range(d)) / math.sqrt(e[k])
            out.append((i, c, n, sum(t * t for t in y), score, e[k] / v.trace()))
    return out


def vectors(scale=1.0):
    rng = random.Random(3)
    rows = [(i, [rng.gauss(0, 1 + k) * scale + k for k in range(5)]) for i in range(300)]
    rows += [(i, [0.25, 0.5, -1.0, 0.0, 2.0]) for i in range(1000, 1150)]  # a third are one vector
    rows += [(7, rows[7][1]), (None, rows[8][1]), (2000, None), (2001, []), (2002, [1.0, 2.0]), (2003, [1.0, None, 0.0, 0.0, 0.0])]
    return rows + [(2004, [float("nan"), 0.0, 0.0, 0.0, 0.0]), (2005, [float("inf"), 0.0, 0.0, 0.0, 0.0])]


@pytest.mark.parametrize("scale,parts", [(1.0, 3), (1.0, 7), (1e9, 2), (1e15, 2)])
def test_whitening_equals_brute_force(spark, scale, parts):
    rows = vectors(scale)
    table = spark.createDataFrame([(i, v, "x", 1, "c") for i, v in rows], COLUMNS).repartition(parts)
    model = whitening.fit(table)
    got = sorted(whitening.whiten(table, model).collect(), key=lambda r: (r.vec_id is not None, r.vec_id or 0, r.component))
    want = sorted(plain(rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    assert [(r.vec_id, r.component, r.n, r.deviation) for r in got] == [(*r[:3], r[3] if r[3] < 10**38 else None) for r in want]
    signs = {}
    for r, w in zip(got, want):
        sign = signs.setdefault(r.component, 1 if (r.whitened > 0) == (w[4] > 0) else -1)
        assert r.whitened * sign == pytest.approx(w[4], rel=1e-6, abs=1e-7)
        assert r.explained == pytest.approx(w[5], rel=1e-9)
        assert r.identity_error < 1e-9


def test_sums_of_squares_are_exact_at_every_size():
    rng = random.Random(5)
    for bits in (3, 20, 31, 40, 55, 59, 61):
        values = [[rng.randint(-(1 << bits), 1 << bits) for _ in range(3)] for _ in range(50)]
        assert whitening.square_sums(np.array(values)) == [sum(v[k] ** 2 for v in values) for k in range(3)]
    assert whitening.square_sums(np.zeros((0, 2), dtype=np.int64)) == [0, 0]


def test_directions_without_spread_are_left_out(spark):
    flat = spark.createDataFrame([(i, [float(i), 2.0 * i, 5.0, 0.0, 0.0]) for i in range(20)], "vec_id long, embedding array<double>")
    rows = whitening.whiten(flat, whitening.fit(flat)).collect()
    assert {r.component for r in rows} == {1} and len(rows) == 20 and rows[0].explained == pytest.approx(1.0)
    same = spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0])], "vec_id long, embedding array<double>")
    assert whitening.whiten(same, whitening.fit(same)).count() == 0
    none = same.limit(0)
    assert whitening.fit(none) is None and whitening.whiten(none, None).columns[:2] == ["vec_id", "component"]


def test_query_over_the_whole_table(spark):
    folder = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{folder}/embeddings.parquet").collect()
    x = {r.vec_id: [math.floor(256 * float(c)) for c in r.embedding] for r in rows}
    distinct = np.array(sorted({tuple(v) for v in x.values()}))
    v = np.cov(distinct.T, bias=True)
    e = np.linalg.eigvalsh(v)[::-1]
    got = queries.QUERIES["op13_whitening"](spark, folder).collect()
    assert len(got) == 4 * len(rows)
    for r in got:
        assert r.deviation == int(((len(distinct) * np.array(x[r.vec_id]) - distinct.sum(0)) ** 2).sum())
        assert r.explained == pytest.approx(e[r.component - 1] / v.trace(), rel=1e-9) and r.identity_error < 1e-9
