"""Whitening of embeddings: projection on the leading components of their covariance, scaled to unit variance.

Entries become whole numbers x = floor(scale * c) + shift. The covariance is fitted on distinct x
vectors, so copies weigh once. Sums are exact; the covariance is added up from vectors centred by
the exact mean, one d x d matrix per partition, summed entry by entry in Spark. Only these d * d / 2
sums and d totals come to the driver. There the matrix is brought to tridiagonal form
(Householder), its leading eigenvalues are bisected by Sturm counts, and the components follow by
inverse iteration with orthogonalisation within clusters. The d x 16 projection is broadcast.

Defined cases: rows with a null vector, a null or non-finite entry, no entries, or another length
than the most frequent one are dropped. A repeated row or a null vec_id stays as it is; further columns
are dropped. An empty table gives no rows. Directions without variance (an eigenvalue under
``RANK`` of the largest) have no whitened value, so there are fewer components; if all vectors are equal,
there is none and no row. Scaled entries beyond 2^40 are taken as 2^40; a deviation that a long
cannot hold is null.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from logspark.llm.common import saved
from logspark.llm.symmetric import leading_eigenvectors
from logspark.llm.vectors import matrix, usable_vectors

SCALE, SHIFT, COMPONENTS = 64, 1_000_000, 16
#: Least eigenvalue that counts, as a share of the largest.
RANK = 1e-12
_LARGEST = float(1 << 40)
#: Vectors that are centred at a time.
BLOCK = 1 << 12


@dataclass(frozen=True)
class Fit:
    """What the fit list gives: its size, exact sums per dimension, components as columns, eigenvalues, trace."""

    n: int
    sums: tuple[int, ...]
    components: np.ndarray
    values: np.ndarray
    trace: float

    def centred(self, x: np.ndarray) -> np.ndarray:
        """n * x - S, exact; as Python integers where 64 bits might not do."""
        if self.n * int(np.abs(x).max(initial=0)) + max(map(abs, self.sums)) < 2**62:
            return self.n * x - np.array(self.sums, np.int64)
        return self.n * x.astype(object) - np.array(self.sums, object)

    def whitened(self, x: np.ndarray) -> np.ndarray:
        y = (self.centred(x) / self.n).astype(float)
        return y @ (self.components / np.sqrt(self.values))


def whole_numbers(vectors: DataFrame, scale: int = SCALE, shift: int = SHIFT) -> DataFrame:
    """Adds ``x``, the entries as whole numbers."""
    scaled = F.transform(
        "vector",
        lambda c: F.floor(F.greatest(F.least(c * scale, F.lit(_LARGEST)), F.lit(-_LARGEST))).cast("long") + shift,
    )
    return vectors.withColumn("x", scaled)


def _blocks(batches: Iterator[pa.RecordBatch], column: str = "x") -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for batch in batches:
        for at in range(0, batch.num_rows, BLOCK):
            part = batch.slice(at, BLOCK)
            yield part, matrix(part.column(column), np.int64)


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    n, total = 0, None
    for _, x in _blocks(batches):
        n += len(x)
        # A block holds 2^12 numbers up to 2^40; the totals are Python integers.
        part = x.sum(0).astype(object)
        total = part if total is None else total + part
    if n:
        sums = pa.array([str(s) for s in total])
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(len(sums)), pa.int32()), sums, pa.array(np.full(len(sums), n), pa.int64())],
            names=["i", "s", "n"],
        )


def _products(batches: Iterator[pa.RecordBatch], values) -> Iterator[pa.RecordBatch]:
    """Upper triangle of the sum of y y' over a partition, and the sums of y in row -1."""
    products, sums = 0, 0
    for _, x in _blocks(batches):
        y = values(x)
        products, sums = products + y.T @ y, sums + y.sum(0)
    if np.ndim(products):
        d = len(products)
        i, j = np.triu_indices(d)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.concatenate((i, np.full(d, -1))), pa.int32()),
                pa.array(np.concatenate((j, np.arange(d))), pa.int32()),
                pa.array(np.concatenate((products[i, j], sums)), pa.float64()),
            ],
            names=["i", "j", "v"],
        )


def _covariance(fit_list: DataFrame, n: int, values) -> np.ndarray:
    """Covariance (divisor n) of ``values(x)``, which are centred; what rounding leaves of their mean is taken off."""
    rows = fit_list.mapInArrow(partial(_products, values=values), "i int, j int, v double")
    found = {(r.i, r.j): r.v for r in rows.groupBy("i", "j").agg(F.sum("v").alias("v")).collect()}
    d = 1 + max(j for _, j in found)
    out = np.empty((d, d))
    for i in range(d):
        for j in range(i, d):
            out[i, j] = out[j, i] = found[i, j] / n - (found[-1, i] / n) * (found[-1, j] / n)
    return out


def fit(fit_list: DataFrame, count: int = COMPONENTS) -> Fit | None:
    """Components of the distinct vectors ``x`` of ``fit_list``; None if there are none."""
    totals = (
        fit_list.mapInArrow(_sums, "i int, s string, n long").groupBy("i")
        .agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s"), F.sum("n").alias("n")).orderBy("i").collect()
    )
    if not totals:
        return None
    n, sums = totals[0]["n"], tuple(int(r["s"]) for r in totals)
    d = len(sums)
    centre = Fit(n, sums, np.eye(d), np.ones(d), 0.0)
    covariance = _covariance(fit_list, n, centre.whitened)
    values, components = leading_eigenvectors(covariance, count)
    kept = values > RANK * max(values[0], 0)
    return Fit(n, sums, components[:, kept], values[kept], float(np.trace(covariance)))


def _project(batches: Iterator[pa.RecordBatch], shared) -> Iterator[pa.RecordBatch]:
    fitted: Fit = shared.value
    d = len(fitted.sums)
    for part, x in _blocks(batches):
        z = fitted.centred(x)
        if z.dtype == object or d * float(np.abs(z).max(initial=0)) ** 2 >= 2.0**62:
            exact = (z.astype(object) ** 2).sum(1)
            deviation = [int(v) if v < 2**63 else None for v in exact]
        else:
            deviation = (z * z).sum(1)
        w = fitted.whitened(x)
        offsets = pa.array(np.arange(len(w) + 1) * w.shape[1], pa.int32())
        yield pa.RecordBatch.from_arrays(
            [part.column("vec_id"), pa.array(deviation, pa.int64()), pa.ListArray.from_arrays(offsets, pa.array(w.ravel()))],
            names=["vec_id", "deviation", "whitened"],
        )


def whiten(embeddings: DataFrame, column: str = "embedding", count: int = COMPONENTS) -> DataFrame:
    """Per usable row and component: the whitened value, with ``n``, ``deviation``, ``explained``, ``identity_error``."""
    spark = embeddings.sparkSession
    rows = whole_numbers(usable_vectors(embeddings, column)).select("vec_id", "x")
    fit_list = saved(rows.select("x").distinct(), "whitening")
    fitted = fit(fit_list, count)
    if fitted is None or not len(fitted.values):
        kinds = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
        return spark.createDataFrame([], kinds)
    error = float(np.abs(_covariance(fit_list, fitted.n, fitted.whitened) - np.eye(len(fitted.values))).max())
    shared = spark.sparkContext.broadcast(fitted)
    projected = rows.mapInArrow(partial(_project, shared=shared), "vec_id long, deviation long, whitened array<double>")
    explained = F.array(*[F.lit(float(v / fitted.trace)) for v in fitted.values])
    return projected.select(
        "vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened")
    ).select(
        "vec_id", (F.col("at") + 1).cast("int").alias("component"), F.lit(fitted.n).cast("long").alias("n"), "deviation",
        "whitened", F.element_at(explained, F.col("at") + 1).alias("explained"), F.lit(error).alias("identity_error"),
    )
