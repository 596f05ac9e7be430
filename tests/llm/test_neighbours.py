"""Nearest neighbours against brute force; the steps of the search on their own."""

import math

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from logspark.llm import neighbours as nn
from logspark.llm.queries import QUERIES

DDL = "vec_id long, embedding array<double>"


def brute(rows, k=5, divisor=50):
    """query_id -> [(score, vec_id)] of all other rows, nearest first."""
    rows = {i: v for i, v in rows if i is not None and v and all(c is not None and math.isfinite(c) for c in v) and any(v)}
    ids = np.array(list(rows))
    u = np.array([rows[i] for i in ids], float)
    u /= np.linalg.norm(u, axis=1)[:, None]
    out = {}
    for at in np.flatnonzero(ids % divisor == 0):
        score = u @ u[at]
        order = [j for j in np.lexsort((ids, -score.round(12))) if j != at][:k]
        out[int(ids[at])] = [(float(score[j]), int(ids[j])) for j in order]
    return out


def search(spark, rows, divisor=50, ddl=DDL, **options):
    got = nn.nearest_neighbours(spark.createDataFrame(rows, ddl), F.col("vec_id") % divisor == 0, **options).collect()
    out = {}
    for r in sorted(got, key=lambda r: (r.query_id, r["rank"])):
        out.setdefault(r.query_id, []).append((r.score, r.vec_id))
        assert r["rank"] == len(out[r.query_id])
    return out


def recall(got, want):
    assert set(got) == set(want) and all(len(got[q]) == len(want[q]) for q in want)
    return np.mean([len({i for _, i in got[q]} & {i for _, i in want[q]}) / max(1, len(want[q])) for q in want])


@pytest.mark.parametrize("size", ["sf_small", "sf_check"])
def test_whole_table_against_brute_force(spark, request, size):
    sf_dir = request.getfixturevalue(size)
    t = pq.read_table(f"{sf_dir}/embeddings.parquet")
    rows = dict(zip(t["vec_id"].to_pylist(), t["embedding"].to_pylist()))
    got = {}
    for r in sorted(QUERIES["op11_nearest_neighbours"](spark, sf_dir).collect(), key=lambda r: (r.query_id, r["rank"])):
        got.setdefault(r.query_id, []).append((r.score, r.vec_id))
        a, b = np.array(rows[r.query_id]), np.array(rows[r.vec_id])
        assert abs(r.score - a @ b / np.linalg.norm(a) / np.linalg.norm(b)) < 1e-12
    assert all(f == sorted(f, key=lambda x: (-x[0], x[1])) for f in got.values())
    assert recall(got, brute(rows.items())) >= 0.95


def test_a_surer_test_misses_nothing(spark):
    """Clusters, a hot vector with a third of all rows, several cells per region."""
    random = np.random.default_rng(2)
    centres = random.standard_normal((20, 12))
    rows = [(i, (centres[i % 20] + 0.3 * random.standard_normal(12)).tolist()) for i in range(1200)]
    rows += [(5000 + i, rows[7][1]) for i in range(600)]
    want = brute(rows)
    got = search(spark, rows, sure=0.999999, cell=64)
    assert recall(got, want) > 0.995
    hot = [q for q in want if q >= 5000]
    assert len(hot) == 12
    for q in hot:
        least = [i for i in (7, *range(5000, 5007)) if i != q][:5]
        assert [i for _, i in got[q]] == least and all(abs(s - 1) < 1e-12 for s, _ in got[q])


def test_defined_cases(spark):
    good = [(0, [1.0, 0.0, 0.0]), (50, [0.9, 0.1, 0.0]), (3, [0.0, 1.0, 0.0]), (4, [2.0, 0.0, 0.0]), (5, [1e200, 1e190, 0.0])]
    bad = [(100, None), (150, []), (200, [0.0, 0.0, 0.0]), (250, [None, 1.0, 0.0]), (300, [float("nan"), 1.0, 0.0]),
           (350, [float("inf"), 1.0, 0.0]), (400, [1.0, 2.0]), (None, [1.0, 0.0, 0.0])]
    rows = [(*r, 7, 1.0, "x", 2) for r in good + bad + good[:2]]
    got = search(spark, rows, ddl=f"{DDL}, query_id int, score double, region string, rank int")
    assert [i for _, i in got[0]] == [4, 5, 50, 3] and [i for _, i in got[50]] == [5, 0, 4, 3]
    assert set(got) == {0, 50}
    assert got[0][0][0] == 1.0 and got[0][3][0] == 0.0
    assert search(spark, []) == {}
    assert search(spark, [(50, [1.0, 2.0])]) == {}
    assert search(spark, [(1, [1.0, 2.0])]) == {}


def test_chi_square_and_projections():
    # Table values of the distribution.
    assert abs(nn.chi_square_quantile(0.95, 8) - 15.507) < 1e-3
    assert abs(nn.chi_square_quantile(0.95, 16) - 26.296) < 1e-3
    random = np.random.default_rng(0)
    a, b = random.standard_normal((2, 4000, 64))
    a, b = (x / np.linalg.norm(x, axis=1)[:, None] for x in (a, b))
    apart = ((nn.projected(a) - nn.projected(b)) ** 2).sum(1) / ((a - b) ** 2).sum(1)
    share = np.mean(apart <= nn.chi_square_quantile(0.9, nn.DIRECTIONS))
    assert abs(share - 0.9) < 0.05


def test_trees_hold_every_point_once():
    random = np.random.default_rng(0)
    points = np.concatenate((random.standard_normal((700, 5)), np.zeros((300, 5))))
    order, starts = nn.leaf_order(points, 32)
    assert sorted(order.tolist()) == list(range(1000)) and max(np.diff([*starts, 1000])) <= 32
    dims, values = nn.median_tree(points, 16)
    region = nn.region_of(points, dims, values)
    assert set(region) <= set(range(16)) and np.bincount(region[:700]).max() < 150


def test_search_stops_early_but_not_before_the_test_holds():
    random = np.random.default_rng(4)
    vectors = random.standard_normal((2000, 64))
    order, starts = nn.leaf_order(nn.projected(vectors))
    rows, length = nn.scaled(vectors[order])
    points = nn.projected(vectors[order])
    cell = nn.Cell([[int(i)] for i in order], rows, length, points, np.array(starts))
    seen = []
    cell.ids = type("Ids", (list,), {"__getitem__": lambda self, i: seen.append(i) or list.__getitem__(self, i)})(cell.ids)
    factor = nn.chi_square_quantile(0.97, nn.DIRECTIONS)
    best = cell.search(-1, rows[0], length[0], points[0], 5, 4.0, factor)
    assert best[0][1] == order[0] and abs(best[0][0] + 1) < 1e-12
    apart = ((points - points[0]) ** 2).sum(1)
    limit = factor * (2 + 2 * best[-1][0])
    inside = np.flatnonzero(apart <= limit)
    exact = sorted((-float(s), int(order[i])) for i, s in zip(inside, rows[inside] @ rows[0] / length[inside] / length[0]))[:5]
    assert [i for _, i in best] == [i for _, i in exact]
