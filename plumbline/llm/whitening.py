"""Whitening of embeddings with a weighted covariance over distinct vectors.

Every entry c becomes the integer ``x = floor(1024 * c) + 100000``. Rows with the same x vector fold
into one counted row, map-side first, so a vector that a third of all rows share is one row from
then on. The covariance is the product of the centred distinct vectors with themselves, weighted
by their counts (``weights="counts"``, the fit list is every row) or by one (``weights="ones"``, the
fit list is every distinct vector). Each task adds up its own matrix; the matrices are added by
Spark, and only the sum, dims x dims numbers, reaches the driver for the eigenvectors. Each distinct
vector is whitened once and joined back to its rows; the few vectors that hold much of the table
are joined by broadcast, so that no task gets all their rows.

Sums and ``deviation`` are exact: whole numbers throughout, as Python integers where 64 bits might
not do.

Rows whose vector is null, empty or holds a null or non-finite entry, or one of 2^51 or more, are
left out and counted nowhere. A space has one length: rows of any but the most frequent length (the
longer of equally frequent ones) are left out as well. A null id stays null; repeated rows each have
their own result. Directions without variance have no component, so a table whose vectors are all
equal gives no rows, as an empty table does. A deviation that a long can't hold is null. Only the id
and the vector are read; other columns may have any names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import hot_join, stage

SCALE, OFFSET = 1024, 100_000
COMPONENTS = 8
#: Eigenvalues below this share of the largest are rounding errors of a direction without variance.
LEAST_SHARE = 1e-12
_LONG = 2**63
_LARGEST = 2.0**51
_DIGITS = pa.decimal128(38, 0)


@dataclass(frozen=True)
class Whitener:
    """What the fit learned: exact sums, and the directions with their eigenvalues."""

    n: int
    sums: list[int]
    vectors: np.ndarray  # dims x components
    values: np.ndarray
    trace: float

    @property
    def centre(self) -> tuple[np.ndarray, np.ndarray]:
        """The mean of x as whole parts and remainders: mean = whole + rest / n."""
        parts = [divmod(s, self.n) for s in self.sums]
        return np.array([q for q, _ in parts], np.int64), np.array([r for _, r in parts], np.int64)


def quantised(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(id, x) of the rows that have a vector of numbers."""
    number = "c is not null and not isnan(c) and abs(c) < double('Infinity')"
    place = f"try_add(try_cast(floor({SCALE} * cast(c as double)) as bigint), {OFFSET}L)"
    rows = df.select(F.col(id_col).alias("id"), F.col(vec_col).cast("array<double>").alias("v")).where("size(v) > 0").where(
        f"forall(v, c -> {number} and abs(c) * {SCALE} < 9.2e18D)")
    return rows.select("id", F.expr(f"transform(v, c -> {place})").alias("x"))


def distinct_vectors(rows: DataFrame) -> DataFrame:
    """(x, weight) of the most frequent length, written once: three passes read it."""
    counted = stage(rows.groupBy("x").agg(F.count("*").alias("weight")), "vectors")
    sizes = counted.groupBy(F.size("x").alias("size")).agg(F.sum("weight").alias("rows"))
    best = sizes.agg(F.max_by("size", F.struct("rows", "size"))).first()[0]
    return counted.where(F.size("x") == F.lit(best or 0))


def _matrix(column: pa.Array, kind) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(kind, copy=False)
    return flat.reshape(len(column), -1)


def exact_sums(vectors: DataFrame) -> tuple[int, list[int]]:
    """n and the sum of every dimension, as whole numbers of any size."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, None
        for batch in batches:
            if not batch.num_rows:
                continue
            x, w = _matrix(batch.column(0), np.int64), batch.column(1).to_numpy()
            n += int(w.sum())
            if int(np.abs(x).max()) * int(w.sum()) >= _LONG:
                x, w = x.astype(object), w.astype(object)
            total = w @ x + (0 if total is None else total)
            total = total.astype(object)
        if total is not None:
            place = np.arange(-1, len(total), dtype=np.int32)
            yield pa.RecordBatch.from_arrays(
                [pa.array(place), pa.array([Decimal(int(v)) for v in [n, *total]], _DIGITS)], ["place", "total"])

    sums = vectors.select("x", "weight").mapInArrow(partial, "place int, total decimal(38,0)")
    got = {r["place"]: int(r["total"]) for r in sums.groupBy("place").agg(F.sum("total").cast("decimal(38,0)").alias("total")).collect()}
    return got.pop(-1, 0), [got[i] for i in sorted(got)]


def covariance(vectors: DataFrame, centred, dims: int, n: int) -> np.ndarray:
    """Covariance with divisor n of weighted rows; ``centred(batch)`` gives their centred matrix and weights.

    A task keeps one matrix, whatever its number of rows.
    """

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dims, dims))
        for batch in batches:
            if batch.num_rows:
                y, w = centred(batch)
                total += (y * w[:, None]).T @ y
        at = np.triu_indices(dims)
        cell = (at[0] * dims + at[1]).astype(np.int64)
        for s in range(0, len(cell), 65536):
            yield pa.RecordBatch.from_arrays([pa.array(cell[s:s + 65536]), pa.array(total[at][s:s + 65536])], ["cell", "total"])

    cells = vectors.mapInArrow(partial, "cell long, total double").groupBy("cell").agg(F.sum("total").alias("total"))
    out = np.zeros(dims * dims)
    for r in cells.toLocalIterator():
        out[r["cell"]] = r["total"]
    out = out.reshape(dims, dims) / n
    return np.triu(out) + np.triu(out, 1).T


def _centred(x: np.ndarray, whole: np.ndarray, rest: np.ndarray, n: int) -> np.ndarray:
    return (x - whole).astype(float) - rest / n


def fit(vectors: DataFrame, components: int = COMPONENTS, weights: str = "counts") -> Whitener | None:
    """The leading directions of the fit list; None where it has no rows."""
    if weights not in ("counts", "ones"):
        raise ValueError("weights: counts or ones")
    fit_list = vectors.select("x", "weight" if weights == "counts" else F.lit(1).cast("bigint").alias("weight"))
    n, sums = exact_sums(fit_list)
    if not n:
        return None
    whole, rest = Whitener(n, sums, np.empty(0), np.empty(0), 0.0).centre

    def centred(batch):
        return _centred(_matrix(batch.column(0), np.int64), whole, rest, n), batch.column(1).to_numpy().astype(float)

    values, directions = np.linalg.eigh(covariance(fit_list, centred, len(sums), n))
    order = np.argsort(-values, kind="stable")
    trace = float(values.sum())
    kept = [i for i in order[:components] if values[i] > LEAST_SHARE * values[order[0]]] if values[order[0]] > 0 else []
    return Whitener(n, sums, directions[:, kept], values[kept], trace)


def transform(vectors: DataFrame, model: Whitener) -> DataFrame:
    """(x, weight, deviation, whitened): every distinct vector once."""
    whole, rest = model.centre
    n, scaled = model.n, model.vectors / np.sqrt(model.values)

    def whiten(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch.column(0), np.int64)
            near = x - whole
            if (int(np.abs(near).max()) + 1) * n >= 2**31 / np.sqrt(x.shape[1]):  # squares may outgrow 64 bits
                near = near.astype(object)
            deviation = ((near * n - rest) ** 2).sum(axis=1)
            fits = [int(v) if v < _LONG else None for v in deviation]
            w = _centred(x, whole, rest, n) @ scaled
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(fits, pa.int64()), pa.array(w.tolist(), pa.list_(pa.float64()))],
                ["x", "weight", "deviation", "whitened"])

    return vectors.select("x", "weight").mapInArrow(whiten, "x array<bigint>, weight bigint, deviation bigint, whitened array<double>")


def identity_error(whitened: DataFrame, model: Whitener, weights: str = "counts") -> float:
    """The largest entry of the whitened fit list's covariance minus the identity."""
    k = len(model.values)
    rows = whitened.select("whitened", "weight" if weights == "counts" else F.lit(1).cast("bigint").alias("weight"))
    mean = np.array(rows.agg(F.array(*[F.sum(F.col("whitened")[i] * F.col("weight")) for i in range(k)])).first()[0]) / model.n

    def centred(batch):
        return _matrix(batch.column(0), float) - mean, batch.column(1).to_numpy().astype(float)

    return float(np.abs(covariance(rows, centred, k, model.n) - np.eye(k)).max())


def whitened_rows(
    df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", components: int = COMPONENTS, weights: str = "counts",
) -> DataFrame:
    """One row per row and component: the id, ``component`` from 1, ``n``, ``deviation``, ``whitened``,
    ``explained`` and ``identity_error``."""
    spark = df.sparkSession
    rows = quantised(df, id_col, vec_col)
    vectors = distinct_vectors(rows)
    model = fit(vectors, components, weights)
    if model is None or not len(model.values):
        return rows.where("false").select(
            F.col("id").alias(id_col), F.lit(1).alias("component"), F.lit(0).cast("bigint").alias("n"), F.lit(0).cast("bigint").alias("deviation"),
            *[F.lit(0.0).alias(c) for c in ("whitened", "explained", "identity_error")])
    once = stage(transform(vectors, model), "whitened")
    error = identity_error(once, model, weights)
    total = model.n if weights == "counts" else once.agg(F.sum("weight")).first()[0]
    shares = spark.createDataFrame(
        [(i, float(v) / model.trace) for i, v in enumerate(model.values)], "place int, explained double")
    back = hot_join(rows, once, "x", "weight", total).select("id", "deviation", F.posexplode("whitened").alias("place", "whitened"))
    return back.join(F.broadcast(shares), "place").select(
        F.col("id").alias(id_col), (F.col("place") + 1).alias("component"), F.lit(model.n).cast("bigint").alias("n"), "deviation",
        "whitened", "explained", F.lit(error).alias("identity_error"))
