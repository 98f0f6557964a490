"""What the second review found cut short."""

import random

from plumbline.operators import experiment, models
from plumbline.plans import experiments


def test_both_families_are_searched_in_full(spark, monkeypatch):
    calls = {}

    def record(df, key, space, **kw):
        calls[space.name] = (kw["n_outer"], kw["n_inner"], kw["n_trials"], [space.draw(random.Random(i)) for i in range(300)])
        return models.NestedResult(df, df, {}, None)

    monkeypatch.setattr(models, "nested_cv", record)
    monkeypatch.setattr(experiments, "_tuned_models", {})
    for name in ("nested_cv_forest", "nested_cv_boosting"):
        getattr(experiments, name)(spark, "/root/testdata/sf0.001")
    assert {n: c[:3] for n, c in calls.items()} == {"RandomForest": (5, 3, 5), "BoostedTrees": (5, 3, 5)}
    forest, boost = calls["RandomForest"][3], calls["BoostedTrees"][3]
    assert min(p["numTrees"] for p in forest) < 120 and max(p["numTrees"] for p in forest) > 780
    assert {p["maxDepth"] for p in forest} == set(range(5, 21))
    assert min(p["maxIter"] for p in boost) < 420 and max(p["maxIter"] for p in boost) > 1480


def test_trials_share_what_is_fitted_before_selection(spark, frame, monkeypatch):
    import numpy as np
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import StandardScaler, VectorAssembler

    fits = []

    class Counted(StandardScaler):
        def _fit(self, df):
            fits.append(1)
            return super()._fit(df)

    def make(regressor, k, target):
        raw = VectorAssembler(inputCols=["x"], outputCol="raw")
        scaled = Counted(inputCol="raw", outputCol="scaled")
        chosen = VectorAssembler(inputCols=["scaled"], outputCol="features")
        return Pipeline(stages=[raw, scaled, chosen, regressor])

    x = np.random.default_rng(1).normal(size=200)
    df = frame(row_id=[str(i) for i in range(200)], x=x, target=x * 2, fold=np.zeros(200, int))
    space = models.forest_space(trees=(2, 3), depth=(2, 3))
    models.search(df, "row_id", "target", space, n_inner=2, n_trials=3, seed=1, make=make)
    assert len(fits) == 2


def test_bootstrap_draws_rows_not_keys(spark):
    """A key with a third of the rows, all of one sign: drawn as one block, its weight would be the interval."""
    import math

    import numpy as np

    rng = np.random.default_rng(3)
    x = rng.normal(size=6000)
    x[:2000] += 6
    arm = np.arange(6000) % 2
    rows = [("hot" if i < 2000 else str(i), float(v), int(a)) for i, (v, a) in enumerate(zip(x, arm))]
    rows += [("same", 1.0, 0)] * 300  # equal rows fold, and count as many
    df = spark.createDataFrame(rows, "k string, y double, arm int")
    a = np.concatenate([x[arm == 0], np.ones(300)])
    b = x[arm == 1]
    want = 2 * 1.96 * math.sqrt(a.var() / len(a) + b.var() / len(b))
    got = experiment.bootstrap_mean_diff(df, "k", "y").first()
    assert abs((got[1] - got[0]) / want - 1) < 0.1
    assert got[0] < a.mean() - b.mean() < got[1]
    again = experiment.bootstrap_mean_diff(df.repartition(5), "k", "y").first()
    assert abs(again[0] - got[0]) < 1e-9 and abs(again[1] - got[1]) < 1e-9
    y = rng.normal(50, 1, 6000)
    p = y + rng.normal(0, 0.4, 6000)
    pairs = spark.createDataFrame([("hot" if i < 2000 else str(i), float(u), float(v)) for i, (u, v) in enumerate(zip(y, p))], "k string, y double, p double")
    e = (y - p) ** 2 - (1 - (1 - ((y - p) ** 2).mean() / y.var())) * (y - y.mean()) ** 2  # influence of a row on r2
    width = 2 * 1.96 * e.std() / y.var() / math.sqrt(6000)
    ci = experiment.bootstrap_r2(pairs, "k", "y", "p").first()
    assert abs((ci[1] - ci[0]) / width - 1) < 0.1


def test_explorations_read_every_row(spark, monkeypatch):
    sf, seen = "/root/testdata/sf0.001", {}

    class Stop(Exception):
        pass

    for name, operator in (("pca_variance", "pca_variance"), ("linear_vs_forest", "linear_vs_forest"),
                           ("kmeans_sweep", "kmeans_study"), ("kmeans_target_stats", "kmeans_study")):
        def record(df, cols, name=name):
            seen[name] = df.count()
            raise Stop

        monkeypatch.setattr(models, operator, record)
        try:
            getattr(experiments, name)(spark, sf)
        except Stop:
            pass
    n = spark.read.parquet(f"{sf}/embeddings.parquet").count()
    assert seen == dict.fromkeys(("pca_variance", "linear_vs_forest", "kmeans_sweep", "kmeans_target_stats"), n)


def test_missing_features_and_null_batches_have_records(spark):
    from plumbline.operators import drift

    ref = spark.range(500).selectExpr("cast(id as double) as x", "cast(id as double) as y")
    cur = spark.range(300).selectExpr(
        "cast(id as double) as x", "if(id % 3 = 0, null, cast(id as double)) as y", "element_at(array('a', 'b', null), cast(id % 3 as int) + 1) as day")
    got = {(r.day, r.feature): r for r in drift.drift(ref, cur, ["x", "y"], "day").collect()}
    assert set(got) == {(d, f) for d in ("a", "b", drift.NO_BATCH) for f in "xy"}
    lost = got["a", "y"]
    assert (lost.n_cur, lost.psi, lost.ks_stat, lost.out_of_range_pct, lost.severity) == (0, None, None, None, drift.MISSING)
    assert got["b", "y"].n_cur == got[drift.NO_BATCH, "x"].n_cur == 100 and got["b", "y"].severity != drift.MISSING
    alerts = {d: sum(r.severity in ("alert", drift.MISSING) for (day, _), r in got.items() if day == d) for d in ("a", "b", drift.NO_BATCH)}
    records = drift.drift(ref, cur, ["x", "y"], "day")
    assert {r.day: r.feature_n_alerts for r in drift.batch_summary(records, "day").collect()} == alerts
    rows = drift.monitoring(records.where("feature = 'x'"), records.where("feature = 'y'"), "day").collect()
    assert {r.day: r.severity for r in rows}["a"] == "alert"


def test_unlabelled_predictions_are_counted(spark):
    from plumbline.plans import monitoring
    from plumbline.streaming import jobs

    p = spark.range(50).selectExpr("id", "timestamp '2024-01-01' as ts", "cast(id as double) as prediction")
    y = p.selectExpr("id", "ts + make_dt_interval(cast(id % 10 as int)) as label_ts", "id + 1.0D as label")
    row = jobs.daily_performance(jobs.late_labels(p, y, "id", "ts", "label_ts", how="left"), "ts", "label", "prediction").first()
    assert (row.n_labelled, row.n_unlabelled, row.mbe) == (40, 10, 1.0)
    days = monitoring.late_label_coverage(spark, "/root/testdata/sf0.001").collect()
    assert sum(r.n_labelled for r in days) == spark.read.parquet("/root/testdata/sf0.001/events.parquet").count()
    assert sum(r.n_unlabelled for r in days) == 0
