"""Whitening against numpy on the whole table, a singular table, edge rows and exact integer sums."""

import numpy as np
import pytest
from conftest import SF_SMALL

from retailmart.llm import queries, whitening


def plain(vectors, k=16):
    """(sums, n, components with variances, by falling variance) of the distinct rows, from the rows themselves."""
    distinct = np.array(sorted(set(map(tuple, vectors))), dtype=object)
    n, sums = len(distinct), distinct.sum(axis=0)
    a = np.array([[(n * v - s) / n for v, s in zip(row, sums)] for row in distinct], float)
    _, s, w = np.linalg.svd(a, full_matrices=False)
    live = s > 1e-9 * s[0]
    return sums, n, w[live][:k].T, (s[live][:k] ** 2) / n, (s**2).sum() / n


def check(rows, vectors, tolerance=1e-9):
    """``rows`` by id against ``vectors`` (whole numbers by id)."""
    sums, n, w, e, total = plain(vectors.values())
    by = {}
    for r in rows:
        by.setdefault(r.vec_id, {})[r.component] = r
    assert set(by) == set(vectors) and all(sorted(x) == list(range(1, len(e) + 1)) for x in by.values())
    ids = sorted(vectors)
    z = np.array([[(n * v - s) / n for v, s in zip(vectors[i], sums)] for i in ids], float) @ w / np.sqrt(e)
    got = np.array([[by[i][c + 1].whitened for c in range(len(e))] for i in ids])
    assert np.abs(got * np.sign((got * z).sum(axis=0)) - z).max() < tolerance * np.abs(z).max()
    for i in ids:
        exact = sum((n * int(v) - int(s)) ** 2 for v, s in zip(vectors[i], sums))
        for c, r in by[i].items():
            assert (r.n, r.deviation) == (n, exact if exact < 1 << 63 else None)
            assert abs(r.explained - e[c - 1] / total) <= 1e-9 * r.explained and r.identity_error < 1e-9


def test_table(spark):
    df = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet")
    vectors = {r.vec_id: tuple(int(np.floor(64 * c)) + 1000000 for c in r.embedding) for r in df.collect()}
    check(queries.op11_whitening(spark, SF_SMALL).collect(), vectors)


SCHEMA = "vec_id long, embedding array<double>, x string, dim int, component string, n int"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, "k", 3, "c", 1) for i, v in rows], SCHEMA)


@pytest.mark.parametrize("spread", [1.0, 1e-3])
def test_ill_conditioned(spark, spread):
    """Directions whose deviations differ by up to a million, and more components asked than there are."""
    rng = np.random.default_rng(7)
    x = rng.standard_normal((900, 6)) * np.array([1e5, 3e4, 1e3, 1e2, 10, 1]) * spread * 1000 @ np.linalg.qr(rng.standard_normal((6, 6)))[0]
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    vectors = {i: tuple(int(np.floor(64 * c)) + 1000000 for c in v) for i, v in rows}
    check(whitening.whitened(frame(spark, rows)).collect(), vectors, 1e-6)


def test_edge_rows(spark):
    rng = np.random.default_rng(8)
    base = [rng.integers(-9, 9, 3) / 4 for _ in range(40)]
    singular = [[*v, v[0], 2.0, v[1] + v[2]] for v in map(np.ndarray.tolist, base)]  # equal, constant and dependent entries
    rows = list(enumerate(singular)) + [(100 + i, singular[0]) for i in range(50)]
    bad = [(200, None), (201, []), (202, [None] * 6), (203, [float("nan")] * 6), (204, [float("inf")] + [0.0] * 5), (205, [1.0, 2.0]), (206, [0.0] * 5 + [None])]
    got = whitening.whitened(frame(spark, rows + bad)).collect()
    vectors = {i: tuple(int(np.floor(64 * c)) + 1000000 for c in v) for i, v in rows}
    check(got, vectors)
    assert max(r.component for r in got) == 3
    twice = whitening.whitened(frame(spark, [(None, v) for _, v in rows] + [(5, singular[5])])).collect()
    assert len(twice) == 3 * (len(rows) + 1) and sum(r.vec_id == 5 for r in twice) == 3


def test_large_entries(spark):
    rows = [(i, [1e30 if i == 3 else i * 1e15, -1e17 * i, float(i % 5)]) for i in range(9)]
    clip = lambda c: int(max(-(2.0**62), min(2.0**62, np.floor(64 * c)))) + 1000000
    got = whitening.whitened(frame(spark, rows)).collect()
    vectors = {i: tuple(clip(c) for c in v) for i, v in rows}
    sums, n, _, e, _ = plain(vectors.values())
    for r in got:
        exact = sum((n * v - s) ** 2 for v, s in zip(vectors[r.vec_id], sums))
        assert r.deviation == (exact if exact < 1 << 63 else None) and r.identity_error < 1e-6


def test_without_variance(spark):
    assert whitening.whitened(frame(spark, [])).collect() == []
    assert whitening.whitened(frame(spark, [(1, None), (2, [])])).collect() == []
    assert whitening.whitened(frame(spark, [(1, [0.5, 0.25]), (2, [0.5, 0.25])])).collect() == []
    assert whitening.whitened(frame(spark, [(1, [0.5, 0.25]), (2, [0.5, 0.75])]), k=5).count() == 2


def test_triangular_solve():
    rng = np.random.default_rng(9)
    r = np.triu(rng.standard_normal((7, 7))) + 3 * np.eye(7)
    a = rng.standard_normal((20, 7))
    assert np.abs(whitening.solved(a, r) @ r - a).max() < 1e-12
