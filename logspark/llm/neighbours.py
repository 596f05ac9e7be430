"""Approximate nearest neighbours by cosine: stable projections, a kd-tree, and a chi-square stopping test.

Unit vectors are multiplied by a few Gaussian (2-stable) directions. Of two points at distance r, the squared
projected distance divided by r * r is chi-square distributed with as many degrees of freedom as there are
directions. A search takes points in the order of projected distance and computes their true
nearness; it stops when a point as near as the k-th best found would have shown up by now with
probability ``SURE``: when the next projected distance is beyond the ``SURE`` quantile times that distance.

The kd-tree has two levels. Its top is cut in medians of a bounded sample (``SAMPLE`` rows by hash of
the id) into ``REGIONS`` leaves; every row goes to its leaf. A leaf's rows are dealt by hash into cells of about
``CELL`` rows, so that a leaf that holds a third of all rows is many cells, and each cell is a tree
of its own, kept as one row of a Parquet table: vectors, ids and the boxes of the tree's leaves.
Equal vectors are one point with the k + 1 least ids, which are all that any answer can hold, so
a group of copies weighs as much as one row. The index holds every usable row and is read twice:

1. each query searches its own region, which bounds its k-th distance;
2. each query goes to the other regions, but only to those whose box the test does not rule out.

Queries meet cells in a join on region and cell number, in packs of about ``PACK`` queries, so neither queries
nor rows are broadcast or gathered. Broadcast are the region boxes only, of which there are ``REGIONS``.

Defined cases: vectors that are null, empty, zero or hold null or non-finite entries, and those of another
length than the most frequent one take no part, neither as query nor as candidate; a null
vec_id neither. Rows that share a vec_id are one, with the least vector. Scores are sums of products in double precision
of the vectors scaled by powers of two, so large entries do not overflow. Ties go to the smaller
vec_id. Fewer candidates than k give fewer rows; an empty table gives none. Further columns are dropped.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from logspark.llm.common import saved
from logspark.llm.vectors import matrix, usable_vectors

DIRECTIONS = 16
SURE = 0.97
REGIONS, CELL, LEAF = 64, 2048, 32
SAMPLE = 20_000
PACK = 512
SEED = 11
#: Shares of a vector's copies whose least ids are found before those of all.
SPREAD = 16
#: Rounding allowed for in squared distances.
SLACK = 1e-9


@lru_cache(maxsize=4)
def directions(d: int, count: int = DIRECTIONS) -> np.ndarray:
    return np.random.Generator(np.random.PCG64([SEED, d])).standard_normal((d, count))


def chi_square_share(x: float, freedom: int) -> float:
    """Share of the chi-square distribution (an even number of degrees of freedom) up to x."""
    term = total = 1.0
    for i in range(1, freedom // 2):
        term *= x / 2 / i
        total += term
    return 1 - math.exp(-x / 2) * total


def chi_square_quantile(share: float, freedom: int) -> float:
    low, high = 0.0, 1.0
    while chi_square_share(high, freedom) < share:
        high *= 2
    for _ in range(100):
        middle = (low + high) / 2
        low, high = (middle, high) if chi_square_share(middle, freedom) < share else (low, middle)
    return high


def scaled(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows scaled by a power of two, so that the largest entry is about one, and their lengths."""
    _, exponent = np.frexp(np.abs(vectors).max(1))
    rows = np.ldexp(vectors, -exponent[:, None])
    return rows, np.sqrt((rows * rows).sum(1))


def projected(vectors: np.ndarray) -> np.ndarray:
    rows, length = scaled(vectors)
    return (rows / length[:, None]) @ directions(vectors.shape[1])


def box_distance(low: np.ndarray, high: np.ndarray, point: np.ndarray) -> np.ndarray:
    """Squared distance from a point to each box."""
    apart = np.maximum(np.maximum(low - point, point - high), 0)
    return (apart * apart).sum(1)


def median_tree(points: np.ndarray, leaves: int) -> tuple[np.ndarray, np.ndarray]:
    """Dimension and value of the cuts of a complete kd-tree, in heap order; a point goes right if it is at least the value."""
    dims, values = np.zeros(leaves - 1, np.int64), np.zeros(leaves - 1)
    parts = {0: points}
    for node in range(leaves - 1):
        part = parts.pop(node)
        if len(part):
            dims[node] = np.argmax(part.max(0) - part.min(0))
            column = part[:, dims[node]]
            values[node] = np.median(column)
            right = column >= values[node]
            parts[2 * node + 1], parts[2 * node + 2] = part[~right], part[right]
        else:
            parts[2 * node + 1] = parts[2 * node + 2] = part
    return dims, values


def region_of(points: np.ndarray, dims: np.ndarray, values: np.ndarray) -> np.ndarray:
    node, inner = np.zeros(len(points), np.int64), len(dims)
    while inner and node[0] < inner:
        node = 2 * node + 1 + (points[np.arange(len(points)), dims[node]] >= values[node])
    return node - inner


def leaf_order(points: np.ndarray, size: int = LEAF) -> tuple[np.ndarray, list[int]]:
    """The points in the order of the leaves of a kd-tree (median of the widest dimension), and where leaves begin."""
    order, starts, open_ = [], [], [np.arange(len(points))]
    while open_:
        rows = open_.pop()
        if len(rows) <= size:
            starts.append(sum(map(len, order)) if not starts else starts[-1] + len(order[-1]))
            order.append(rows)
            continue
        part = points[rows]
        column = part[:, np.argmax(part.max(0) - part.min(0))]
        by = np.argpartition(column, len(rows) // 2)
        open_ += [rows[by[len(rows) // 2 :]], rows[by[: len(rows) // 2]]]
    return np.concatenate(order), starts


@dataclass
class Cell:
    """Points of one cell in leaf order: ids of each, vectors, projections, and the boxes of the leaves."""

    ids: list[list[int]]
    rows: np.ndarray
    length: np.ndarray
    points: np.ndarray
    starts: np.ndarray

    def __post_init__(self):
        self.ends = np.append(self.starts[1:], len(self.points))
        self.low = np.minimum.reduceat(self.points, self.starts)
        self.high = np.maximum.reduceat(self.points, self.starts)

    def search(self, own: int, row: np.ndarray, length: float, point: np.ndarray, k: int, bound: float, factor: float):
        """The k nearest of the points that the test does not rule out, as (-score, id); ``bound``: squared distance known."""
        leaf_apart = box_distance(self.low, self.high, point)
        order = np.argsort(leaf_apart, kind="stable")
        leaf_apart = leaf_apart[order]
        best: list[tuple[float, int]] = []
        done, step = 0, 1
        while done < len(order) and leaf_apart[done] <= (limit := factor * bound + SLACK):
            taken = order[done : min(done + step, int(np.searchsorted(leaf_apart, limit, "right")))]
            done, step = done + len(taken), 2 * step
            rows = np.concatenate([np.arange(self.starts[i], self.ends[i]) for i in taken])
            apart = self.points[rows] - point
            apart = (apart * apart).sum(1)
            near = apart <= limit
            rows = rows[near][np.argsort(apart[near], kind="stable")]
            scores = (self.rows[rows] * row).sum(1) / (self.length[rows] * length)
            worst = -best[-1][0] if len(best) == k else -math.inf
            found = [(-float(scores[i]), other) for i in np.flatnonzero(scores >= worst) for other in self.ids[rows[i]] if other != own]
            best = sorted(best + found)[:k]
            if len(best) == k:
                bound = min(bound, max(0.0, 2 + 2 * best[-1][0]))
        return best


def points_of(embeddings: DataFrame, column: str = "embedding", k: int = 5) -> DataFrame:
    """Distinct usable vectors with the least k + 1 ids of each; no task sees all copies of a vector."""
    rows = usable_vectors(embeddings, column).where(F.exists("vector", lambda c: c != 0) & F.col("vec_id").isNotNull())
    rows = rows.groupBy("vec_id").agg(F.min("vector").alias("vector"))
    spread = F.pmod(F.xxhash64("vec_id"), F.lit(SPREAD))
    for keys in ([F.col("vector"), spread], [F.col("vector")]):
        place = F.row_number().over(Window.partitionBy(*keys).orderBy("vec_id"))
        rows = rows.withColumn("place", place).where(F.col("place") <= k + 1).drop("place")
    return rows.groupBy("vector").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))


def _placed(batches: Iterator[pa.RecordBatch], dims: np.ndarray, values: np.ndarray) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            region = region_of(projected(matrix(batch.column("vector"))), dims, values)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(region, pa.int32())], names=[*batch.schema.names, "region"])


def _cell_row(table: pa.Table) -> pa.Table:
    vectors = matrix(table["vector"])
    points = projected(vectors)
    order, starts = leaf_order(points)
    points, d = points[order], vectors.shape[1]
    return pa.table({
        "region": table["region"][:1], "part": table["part"][:1],
        "ids": pa.array([table["ids"].take(order).to_pylist()], pa.list_(pa.list_(pa.int64()))),
        "vectors": [vectors[order].tobytes()], "d": pa.array([d], pa.int32()),
        "starts": pa.array([starts], pa.list_(pa.int32())),
        "low": pa.array([points.min(0)], pa.list_(pa.float64())), "high": pa.array([points.max(0)], pa.list_(pa.float64())),
    })


INDEX = "region int, part long, ids array<array<long>>, vectors binary, d int, starts array<int>, low array<double>, high array<double>"


def with_region(rows: DataFrame, cuts: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema)
    return rows.mapInArrow(partial(_placed, dims=cuts[0], values=cuts[1]), f"{kinds}, region int")


def fit_regions(points: DataFrame, regions: int = REGIONS, sample: int = SAMPLE) -> tuple[np.ndarray, np.ndarray]:
    """Cuts of the top of the tree, from a sample of bounded size."""
    found = points.select("vector").orderBy(F.xxhash64("vector"), "vector").limit(sample).toArrow()["vector"]
    d = len(found[0]) if len(found) else 1
    return median_tree(projected(matrix(found)) if len(found) else np.zeros((0, d)), regions)


def build_index(points: DataFrame, cuts: tuple[np.ndarray, np.ndarray], cell: int = CELL) -> DataFrame:
    """A table with a row per cell."""
    placed = with_region(points, cuts)
    sizes = placed.groupBy("region").agg(F.count("*").alias("size"))
    dealt = placed.join(sizes, "region").withColumn(
        "part", F.pmod(F.xxhash64("vector"), F.ceil(F.col("size") / cell))).drop("size")
    return saved(dealt.groupBy("region", "part").applyInArrow(_cell_row, INDEX), "neighbour-index")


def _cell(row: dict) -> Cell:
    rows, length = scaled(np.frombuffer(row["vectors"], np.float64).reshape(-1, row["d"]))
    return Cell(row["ids"], rows, length, (rows / length[:, None]) @ directions(row["d"]), np.array(row["starts"]))


def _search(batches: Iterator[pa.RecordBatch], k: int, factor: float) -> Iterator[pa.RecordBatch]:
    """Each row holds a cell and a pack of queries."""
    for batch in batches:
        for i in range(batch.num_rows):
            row = {name: batch.column(name)[i].as_py() for name in batch.schema.names if name != "pack"}
            cell, out = _cell(row), []
            pack = batch.column("pack")[i].values
            vectors = matrix(pack.field("vector"))
            rows, length = scaled(vectors)
            points = projected(vectors)
            for j, own in enumerate(pack.field("query_id").to_pylist()):
                bound = pack.field("bound")[j].as_py()
                found = cell.search(own, rows[j], length[j], points[j], k, bound, factor)
                out += [(own, other, -score) for score, other in found]
            query, other, score = zip(*out) if out else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [pa.array(query, pa.int64()), pa.array(other, pa.int64()), pa.array(score, pa.float64())],
                names=["query_id", "vec_id", "score"],
            )


def _nearest(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def search_cells(index: DataFrame, asked: DataFrame, k: int, sure: float = SURE, pack: int = PACK) -> DataFrame:
    """What each row of ``asked`` (query_id, vector, bound, region) finds in the cells of its region."""
    sizes = asked.groupBy("region").agg(F.count("*").alias("size"))
    packs = (
        asked.join(sizes, "region")
        .groupBy("region", F.pmod(F.xxhash64("query_id"), F.ceil(F.col("size") / pack)).alias("number"))
        .agg(F.collect_list(F.struct("query_id", "vector", "bound")).alias("pack"))
    )
    parts = index.groupBy("region").agg(F.max("part").alias("parts"))
    packs = packs.join(parts, "region").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts"))))
    factor = chi_square_quantile(sure, DIRECTIONS)
    met = index.drop("low", "high").join(packs.select("region", "part", "pack"), ["region", "part"])
    return _nearest(met.mapInArrow(partial(_search, k=k, factor=factor), "query_id long, vec_id long, score double"), k)


def _open_regions(batches: Iterator[pa.RecordBatch], boxes, factor: float) -> Iterator[pa.RecordBatch]:
    names, low, high = boxes.value
    for batch in batches:
        if not batch.num_rows:
            continue
        points = projected(matrix(batch.column("vector")))
        bounds = batch.column("bound").to_numpy()
        home = batch.column("region").to_numpy()
        wanted = [
            names[(box_distance(low, high, p) <= factor * b + SLACK) & (names != h)] for p, b, h in zip(points, bounds, home)
        ]
        offsets = np.cumsum([0, *map(len, wanted)])
        lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.concatenate(wanted), pa.int32()))
        kept = [c for c in batch.schema.names if c != "region"]
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), lists], names=[*kept, "regions"])


def nearest_neighbours(
    embeddings: DataFrame, is_query: Column, k: int = 5, column: str = "embedding", sure: float = SURE, cell: int = CELL,
) -> DataFrame:
    """Per query row (``is_query`` over ``vec_id``) the k nearest others found: query_id, rank, vec_id, score."""
    spark = embeddings.sparkSession
    points = saved(points_of(embeddings, column, k), "neighbour-points")
    cuts = fit_regions(points)
    index = build_index(points, cuts, cell)
    # A vector's copies beyond the least k + 1 are queries, too.
    usable = usable_vectors(embeddings, column).where(F.exists("vector", lambda c: c != 0))
    queries = usable.where(is_query).groupBy(F.col("vec_id").alias("query_id")).agg(F.min("vector").alias("vector"))
    queries = saved(with_region(queries, cuts), "neighbour-queries")
    # No two unit vectors are further apart than 2.
    first = saved(search_cells(index, queries.withColumn("bound", F.lit(4.0)), k, sure), "neighbour-home")
    known = first.where(F.col("rank") == k).select("query_id", F.greatest(F.lit(0.0), 2 - 2 * F.col("score")).alias("known"))
    asked = queries.join(known, "query_id", "left").select(
        "query_id", "vector", F.coalesce("known", F.lit(4.0)).alias("bound"), "region")
    boxes = index.groupBy("region").agg(
        *[F.array(*[f(F.col(side)[i]) for i in range(DIRECTIONS)]).alias(side) for side, f in (("low", F.min), ("high", F.max))]
    ).collect()
    found = first.drop("rank")
    if boxes:
        shared = spark.sparkContext.broadcast((
            np.array([b["region"] for b in boxes], np.int32), np.array([b["low"] for b in boxes]), np.array([b["high"] for b in boxes])
        ))
        factor = chi_square_quantile(sure, DIRECTIONS)
        routed = asked.mapInArrow(
            partial(_open_regions, boxes=shared, factor=factor), "query_id long, vector array<double>, bound double, regions array<int>")
        routed = routed.select("query_id", "vector", "bound", F.explode("regions").alias("region"))
        found = found.unionByName(search_cells(index, routed, k, sure).drop("rank"))
    return _nearest(found, k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
