import math

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import functions as F

from plumbline.config import FEATURES
from plumbline.functions import scalar
from plumbline.operators import models, transforms
from plumbline.operators.isolation import IsolationForest, average_path
from plumbline.operators.perturb import Plant, perturb


def base(frame, n=300, seed=20):
    rng = np.random.default_rng(seed)
    cols = {f: rng.normal(size=n) for f in FEATURES}
    target = 2 * cols["feature_2"] + cols["feature_2"] * cols["feature_13"] + rng.normal(0, 0.1, n)
    return frame(row_id=[f"r{i}" for i in range(n)], **cols, target=target)


def test_engineered_row_by_hand(spark):
    df = spark.createDataFrame([tuple(float(i - 3) for i in range(20))], ", ".join(f"{c} double" for c in FEATURES))
    out = transforms.engineer(df)
    assert len(out.columns) == 62 and out.columns == scalar.engineered_names()
    r = out.first()
    x = {f: float(i - 3) for i, f in enumerate(FEATURES)}
    assert r.feature_2_log == pytest.approx(math.log1p(1)) and r.feature_2_sq == 1.0
    assert r.feature_2_x_feature_13 == x["feature_2"] * x["feature_13"]
    assert r.feature_13_div_feature_9 == pytest.approx(10 / (6 + 1e-6))
    v = np.array(list(x.values()))
    assert r.row_mean == pytest.approx(v.mean()) and r.row_std == pytest.approx(v.std(ddof=1))
    assert (r.row_max, r.row_min, r.row_range) == (16.0, -3.0, 19.0)
    assert r.weighted_top == pytest.approx(0.5 * -1 + 0.3 * 10 + 0.15 * 13 + 0.05 * 6)


def test_ratio_by_zero_and_missing_cells(spark):
    schema = ", ".join(f"{c} double" for c in FEATURES)
    row = [1.0] * 20
    row[13], row[0], row[1] = 0.0, None, float("nan")
    r = transforms.engineer(spark.createDataFrame([tuple(row)], schema)).first()
    assert r.feature_2_div_feature_13 == pytest.approx(1e6)
    assert r.row_mean == pytest.approx(17 / 18)


def test_yeo_johnson_lambda_maximises_the_likelihood(frame):
    x = np.exp(np.random.default_rng(21).normal(size=2000)) - 1
    df = frame(x=x)
    lam = transforms.fit_lambdas(df, ["x"])["x"]

    def likelihood(v):
        up = (np.power(np.maximum(x, 0) + 1, v) - 1) / v
        down = -(np.power(1 - np.minimum(x, 0), 2 - v) - 1) / (2 - v)
        t = np.where(x >= 0, up, down)
        return -len(x) / 2 * np.log(t.var()) + (v - 1) * (np.sign(x) * np.log1p(np.abs(x))).sum()

    grid = np.arange(-1.9995, 1.9, 0.001)
    assert lam == pytest.approx(grid[np.argmax([likelihood(v) for v in grid])], abs=2e-3)
    out = transforms.PowerTransform(["x"]).fit(df).transform(df)
    m = out.agg(F.avg("x").alias("m"), F.stddev_pop("x").alias("s")).first()
    assert m.m == pytest.approx(0, abs=1e-9) and m.s == pytest.approx(1)


def test_selection_keeps_the_informative_columns(frame):
    df = base(frame, 1500)
    model = transforms.MutualInfoSelector(FEATURES, k=2).fit(df)
    assert "feature_2" in model.getOrDefault(model.inputCols)
    assert model.transform(df).first()["features"].size == 2


def test_pipeline_survives_saving(frame, tmp_path):
    df = base(frame)
    pipe = models.training_pipeline(RandomForestRegressor(labelCol="target", numTrees=5, maxDepth=4, seed=1), 30)
    fitted = pipe.fit(df)
    fitted.write().overwrite().save(str(tmp_path / "m"))
    a = {r.row_id: r.prediction for r in fitted.transform(df).select("row_id", "prediction").collect()}
    loaded = PipelineModel.load(str(tmp_path / "m"))
    b = {r.row_id: r.prediction for r in loaded.transform(df.drop("target")).select("row_id", "prediction").collect()}
    assert a == pytest.approx(b)


def test_folds_are_balanced_and_complete(spark):
    df = spark.range(10000).selectExpr("cast(id as string) as row_id")
    sizes = [r["count"] for r in models.assign_folds(df, "row_id").groupBy("fold").count().collect()]
    assert len(sizes) == 5 and sum(sizes) == 10000 and max(sizes) - min(sizes) < 300


def test_nested_cv_scores_every_row_once(frame):
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import VectorAssembler

    df = base(frame, 400)
    space = models.forest_space(trees=(3, 5), depth=(3, 4))

    def quick(regressor, k, target):
        return Pipeline(stages=[VectorAssembler(inputCols=FEATURES, outputCol="features"), regressor])

    got = models.nested_cv(df, "row_id", space, n_outer=3, n_inner=2, n_trials=2, mode="best_outer_fold", make=quick)
    assert got.oof.count() == 400 and got.oof.select("row_id").distinct().count() == 400
    assert got.scores.count() == 3 and got.best_params in got.fold_params
    assert models.long_scores(got.scores).count() == 27


def test_planted_outliers_rank_first(frame):
    rng = np.random.default_rng(22)
    x = rng.normal(size=(1000, 4))
    x[:10] += 8
    df = frame(row_id=[f"r{i}" for i in range(1000)], **{f"c{j}": x[:, j] for j in range(4)})
    cols = [f"c{j}" for j in range(4)]
    forest = IsolationForest(trees=60).fit(df, "row_id", cols)
    out = forest.flag(df)
    top = {r.row_id for r in out.orderBy(F.desc("anomaly_score")).limit(10).collect()}
    assert len(top & {f"r{i}" for i in range(10)}) >= 9
    assert out.where("is_outlier").count() == 50
    assert average_path(256) == pytest.approx(10.2448, abs=1e-3)


def test_perturbation_follows_the_plan(frame):
    ref = frame(a=[0.0, 2.0], b=[0.0, 0.0], c=[0.0, 0.0])  # population sigma of a is 1
    cur = frame(a=[1.0, 1.0], b=[1.0, 3.0], c=[5.0, 5.0], day=[4, 4])
    out = perturb(cur, ref, "day", {4: Plant({"a": 2.0}, {"b": 2.0}, {"c": ("a", 0.5)})}).orderBy("b").collect()
    assert [r.a for r in out] == [3.0, 3.0] and [r.b for r in out] == [0.0, 4.0] and [r.c for r in out] == [6.5, 6.5]
