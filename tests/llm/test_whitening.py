"""Whitening against numpy in one process, and the eigenvector steps on their own."""

import math

import numpy as np
import pyarrow.parquet as pq
import pytest

from logspark.llm.queries import QUERIES
from logspark.llm.symmetric import count_below, leading_eigenvectors, leading_values, tridiagonal
from logspark.llm.whitening import whiten

DDL = "vec_id long, embedding array<float>"


def plain(rows):
    """vec_id, n, deviation, whitened (rows x components), explained, by numpy and Python integers."""
    kept = [(i, v) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    x = [[math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v] for _, v in kept]
    distinct = [list(v) for v in sorted({tuple(v) for v in x})]
    n, sums = len(distinct), [sum(c) for c in zip(*distinct)]
    y = np.array([[n * a - s for a, s in zip(v, sums)] for v in distinct], float) / n
    e, u = np.linalg.eigh(y.T @ y / n)
    e, u = e[::-1], u[:, ::-1]
    deviation = [sum((n * a - s) ** 2 for a, s in zip(v, sums)) for v in x]
    every = np.array([[n * a - s for a, s in zip(v, sums)] for v in x], float) / n
    return [i for i, _ in kept], n, deviation, every @ u[:, :16] / np.sqrt(e[:16]), e[:16] / e.sum()


def assert_whitened(got, rows):
    ids, n, deviation, whitened, explained = plain(rows)
    assert len(got) == len(ids) * whitened.shape[1]
    by_id = {}
    for r in got:
        assert r.n == n and r.identity_error <= 1e-4
        assert abs(r.explained - explained[r.component - 1]) <= 1e-9 * r.explained
        by_id.setdefault(r.vec_id, {}).setdefault(r.component, []).append((r.whitened, r.deviation))
    table = np.array([[by_id[i][k + 1][0][0] for k in range(whitened.shape[1])] for i in ids])
    assert [by_id[i][1][0][1] for i in ids] == deviation
    signs = np.sign((table * whitened).sum(0))
    assert np.abs(table * signs - whitened).max() < 1e-8


def test_whole_table_against_numpy(spark, sf_small):
    t = pq.read_table(f"{sf_small}/embeddings.parquet")
    rows = list(zip(t["vec_id"].to_pylist(), t["embedding"].to_pylist()))
    assert_whitened(QUERIES["op12_embedding_whitening"](spark, sf_small).collect(), rows)


def test_nulls_copies_and_clashing_columns(spark):
    random = np.random.default_rng(3)
    rows = [(i, random.standard_normal(8).tolist()) for i in range(40)]
    rows += [(100 + i, rows[0][1]) for i in range(30)]
    bad = [(200, None), (201, []), (202, [None] * 8), (203, [float("nan")] * 8), (204, [float("inf")] + [0.0] * 7)]
    odd = [(205, [1.0, 2.0])]
    got = whiten(spark.createDataFrame(
        [(*r, 1, 2.0, 3) for r in rows + bad + odd], f"{DDL}, n int, x double, component int"))
    assert_whitened(got.collect(), rows)
    again = whiten(spark.createDataFrame(rows + rows[:5], DDL)).collect()
    assert len(again) == 8 * (len(rows) + 5) and {r.n for r in again} == {40}
    unnamed = whiten(spark.createDataFrame(rows[:20] + [(None, rows[21][1])], DDL)).collect()
    assert sum(r.vec_id is None for r in unnamed) == 8


def test_no_variance_no_rows(spark):
    assert whiten(spark.createDataFrame([], DDL)).collect() == []
    assert whiten(spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0])], DDL)).collect() == []
    flat = whiten(spark.createDataFrame([(i, [float(i), 1.0, 2.0 * i]) for i in range(9)], DDL)).collect()
    assert {r.component for r in flat} == {1} and all(abs(r.explained - 1) < 1e-12 for r in flat)
    large = whiten(spark.createDataFrame([(i, [3e38 * (-1) ** i, float(i)]) for i in range(6)], DDL)).collect()
    assert len(large) == 6 * len({r.component for r in large}) and all(r.deviation is None for r in large)


def spectra():
    random = np.random.default_rng(0)
    for trial in range(30):
        d = int(random.integers(1, 60))
        close = random.choice([0, 1, 1, 1, 2, 5, 5 + 1e-9, 100, 67.43, 67.41, 1e-6], d)
        e = np.sort(close if trial % 2 else random.random(d) * 100)[::-1]
        q, _ = np.linalg.qr(random.standard_normal((d, d)))
        yield np.diag(e) if trial % 5 == 0 else (q * e) @ q.T


@pytest.mark.parametrize("a", list(spectra()), ids=lambda a: f"{len(a)}")
def test_eigenvectors(a):
    a = (a + a.T) / 2
    k = min(16, len(a))
    values, vectors = leading_eigenvectors(a, k)
    size = max(1, np.abs(a).max())
    assert np.abs(values - np.linalg.eigvalsh(a)[::-1][:k]).max() < 1e-12 * size * len(a)
    assert np.abs(vectors.T @ vectors - np.eye(k)).max() < 1e-11
    assert np.abs(a @ vectors - vectors * values).max() < 1e-11 * size


def test_tridiagonal_form_and_counts():
    random = np.random.default_rng(1)
    a = random.standard_normal((12, 12))
    a = a + a.T
    diagonal, off, _ = tridiagonal(a)
    t = np.diag(diagonal) + np.diag(off, 1) + np.diag(off, -1)
    want = np.linalg.eigvalsh(a)
    assert np.allclose(np.linalg.eigvalsh(t), want)
    assert count_below(diagonal, off, (want[1:] + want[:-1]) / 2).tolist() == list(range(1, 12))
    assert np.allclose(leading_values(diagonal, off, 3), want[::-1][:3])
