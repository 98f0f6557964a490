"""Isolation forest: trees from small hashed subsamples, scoring in Arrow batches.

An Estimator whose model keeps its trees and the threshold of the training scores, and is saved with both.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from plumbline.functions.scalar import hash_unit
from plumbline.operators.longform import number_array
from plumbline.operators.quantiles import exact_quantiles
from plumbline.session import stage

NODE_SCHEMA = "tree int, feature array<int>, cut array<double>, left array<int>, right array<int>, depth array<double>"


def average_path(n: float) -> float:
    """Mean depth of an unsuccessful search in a binary tree of ``n`` points."""
    if n <= 1:
        return 0.0
    if n <= 2:
        return 1.0
    return 2.0 * (math.log(n - 1.0) + 0.5772156649015329) - 2.0 * (n - 1.0) / n


def grow(x: np.ndarray, rng: np.random.Generator, limit: int) -> dict[str, list]:
    """One tree as flat arrays; a leaf has feature -1 and its path length."""
    tree: dict[str, list] = {"feature": [], "cut": [], "left": [], "right": [], "depth": []}
    todo = [(np.arange(len(x)), 0, -1, "left")]
    while todo:
        rows, depth, parent, side = todo.pop()
        me = len(tree["feature"])
        if parent >= 0:
            tree[side][parent] = me
        low, high = x[rows].min(axis=0), x[rows].max(axis=0)
        usable = np.flatnonzero(high > low)
        leaf = depth >= limit or len(rows) <= 1 or len(usable) == 0
        f = -1 if leaf else int(rng.choice(usable))
        cut = 0.0 if leaf else float(rng.uniform(low[f], high[f]))
        for name, value in (
            ("feature", f), ("cut", cut), ("left", -1), ("right", -1),
            ("depth", depth + average_path(len(rows)) if leaf else 0.0),
        ):
            tree[name].append(value)
        if not leaf:
            goes_left = x[rows, f] < cut
            todo.append((rows[~goes_left], depth + 1, me, "right"))
            todo.append((rows[goes_left], depth + 1, me, "left"))
    return tree


def binomial_steps(trials: int, p: float) -> list[float]:
    """Cumulative probabilities of 0, 1, 2, ... successes, up to where they are 1 in doubles."""
    if p >= 1:
        return [0.0] * trials  # always all of them
    out, total = [], 0.0
    for k in range(trials):
        log = math.lgamma(trials + 1) - math.lgamma(k + 1) - math.lgamma(trials - k + 1) + (k * math.log(p) if k else 0) + (trials - k) * math.log1p(-p)
        total += math.exp(log)
        out.append(min(total, 1.0))
        if k > trials * p and total >= 1 - 2**-33:  # the draws have 32 bits
            break
    return out


class _Isolation(Params):
    inputCols = Param(Params._dummy(), "inputCols", "columns", TypeConverters.toListString)
    keyCol = Param(Params._dummy(), "keyCol", "row key", TypeConverters.toString)
    trees = Param(Params._dummy(), "trees", "number of trees", TypeConverters.toInt)
    sample = Param(Params._dummy(), "sample", "rows a tree takes, about", TypeConverters.toInt)
    contamination = Param(Params._dummy(), "contamination", "share of training rows above the threshold", TypeConverters.toFloat)
    seed = Param(Params._dummy(), "seed", "seed", TypeConverters.toInt)


class IsolationForest(Estimator, _Isolation):
    def __init__(self, trees: int = 200, sample: int = 256, contamination: float = 0.05, seed: int = 42,
                 keyCol: str = "row_id", inputCols: list[str] | None = None):
        super().__init__()
        self._set(trees=trees, sample=sample, contamination=contamination, seed=seed, keyCol=keyCol, inputCols=inputCols or [])

    def fit(self, df: DataFrame, key: str | None = None, cols: list[str] | None = None) -> IsolationForestModel:
        """Fit on ``cols`` (default ``inputCols``) of rows named by ``key`` (default ``keyCol``)."""
        if isinstance(key, str):
            self._set(keyCol=key)
        if cols:
            self._set(inputCols=list(cols))
        return self._fit(df)

    def drawn(self, df: DataFrame) -> DataFrame:
        """(key, columns, tree): each row belongs to each tree with probability sample / rows, by hash.

        How many trees a row belongs to is one binomial draw, so a row of a large table costs one hash;
        only rows that belong to some tree rank the trees to find out which.
        """
        key, cols, seed, trees = (self.getOrDefault(p) for p in ("keyCol", "inputCols", "seed", "trees"))
        share = min(1.0, self.getOrDefault("sample") / max(df.count(), 1))
        steps = number_array(binomial_steps(trees, share))
        rows = df.select(F.col(key).alias("_key"), *cols, hash_unit(key, f"trees{seed}").alias("_u")).where(f"_u >= {steps}[0]")
        many = F.expr(f"size(filter({steps}, s -> s <= _u))")
        ranked = F.expr(f"array_sort(transform(sequence(0, {trees - 1}), t -> struct(xxhash64(_key, t, {seed}) as h, t as tree)))")
        return rows.select("_key", *cols, F.explode(F.slice(ranked, 1, many)).alias("_t")).select("_key", *cols, F.col("_t.tree").alias("tree"))

    def _fit(self, df: DataFrame) -> IsolationForestModel:
        cols, seed, size = (self.getOrDefault(p) for p in ("inputCols", "seed", "sample"))
        limit = math.ceil(math.log2(max(size, 2)))

        def build(pdf: pd.DataFrame) -> pd.DataFrame:
            x = pdf.sort_values("_key")[cols].to_numpy(dtype="float64")
            number = int(pdf["tree"].iloc[0])
            tree = grow(np.nan_to_num(x), np.random.default_rng([seed, number]), limit)
            return pd.DataFrame([{"tree": number, **tree, "rows": len(x)}])

        built = self.drawn(df).groupBy("tree").applyInPandas(build, NODE_SCHEMA + ", rows int").orderBy("tree").collect()
        model = IsolationForestModel()
        model._set(**{p: self.getOrDefault(p) for p in ("inputCols", "keyCol", "trees", "sample", "contamination", "seed")})
        model.nodes = [r.asDict() for r in built]
        model._set(psi=float(np.mean([r["rows"] for r in built])) if built else 1.0)
        q = exact_quantiles(model.score(df), ["anomaly_score"], [1 - self.getOrDefault("contamination")])["anomaly_score"]
        model._set(threshold=float(q[0]) if q else 1.0)
        return model


class _TreesToo(DefaultParamsWriter):
    def saveImpl(self, path: str) -> None:
        super().saveImpl(path)
        rows = [tuple(t[c] for c in ("tree", "feature", "cut", "left", "right", "depth")) for t in self.instance.nodes]
        self.sparkSession.createDataFrame(rows, NODE_SCHEMA).write.parquet(f"{path}/trees")


class _TreesBack(DefaultParamsReader):
    def load(self, path: str):
        model = super().load(path)
        model.nodes = [r.asDict() for r in self.sparkSession.read.parquet(f"{path}/trees").orderBy("tree").collect()]
        return model


class IsolationForestModel(Model, _Isolation, MLWritable, MLReadable):
    """Trees with the mean size of their samples and the threshold of the training scores."""

    psi = Param(Params._dummy(), "psi", "rows a tree took, on average", TypeConverters.toFloat)
    threshold = Param(Params._dummy(), "threshold", "scores above it are outliers", TypeConverters.toFloat)
    nodes: list[dict]

    def write(self):
        return _TreesToo(self)

    @classmethod
    def read(cls):
        return _TreesBack(cls)

    def _transform(self, df: DataFrame) -> DataFrame:
        return self.flag(df)

    def score(self, df: DataFrame) -> DataFrame:
        """Adds ``anomaly_score`` in (0, 1); higher is more unusual."""
        arrays = [
            tuple(np.asarray(t[k]) for k in ("feature", "cut", "left", "right", "depth")) for t in self.nodes
        ]
        shared = df.sparkSession.sparkContext.broadcast(arrays)  # trees x 2 x sample nodes at most
        scale = average_path(self.getOrDefault("psi")) or 1.0

        @F.pandas_udf(DoubleType())
        def anomaly(*xs: pd.Series) -> pd.Series:
            x = np.nan_to_num(np.column_stack([s.to_numpy(dtype="float64") for s in xs]))
            total, rows = np.zeros(len(x)), np.arange(len(x))
            for feature, cut, left, right, depth in shared.value:
                at = np.zeros(len(x), dtype=np.int64)
                while True:
                    f = feature[at]
                    inner = f >= 0
                    if not inner.any():
                        break
                    goes_left = x[rows, np.where(inner, f, 0)] < cut[at]
                    at = np.where(inner, np.where(goes_left, left[at], right[at]), at)
                total += depth[at]
            return pd.Series(np.power(2.0, -total / max(len(shared.value), 1) / scale))

        return df.withColumn("anomaly_score", anomaly(*[F.col(c).cast("double") for c in self.getOrDefault("inputCols")]))

    def flag(self, df: DataFrame) -> DataFrame:
        """Adds the score and ``is_outlier``: above the threshold that the training rows gave."""
        scored = stage(self.score(df), "anomaly")
        return scored.withColumn("is_outlier", F.col("anomaly_score") > self.getOrDefault("threshold"))


def anomaly_rate(flagged: DataFrame, by: str) -> DataFrame:
    """Share of rows above the training threshold per batch."""
    return flagged.groupBy(by).agg(
        F.count("*").alias("n"), F.count_if("is_outlier").alias("n_outliers"),
        F.avg(F.col("is_outlier").cast("double")).alias("anomaly_rate"),
    )
