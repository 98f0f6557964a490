import numpy as np
import pytest

from plumbline.operators import profile, ranks, regression, series
from plumbline.operators.quantiles import exact_quantiles


@pytest.mark.parametrize("max_rows", [5, 50, 2_000_000])
def test_quantiles_are_exact(frame, max_rows):
    rng = np.random.default_rng(5)
    x = rng.normal(size=3001)
    y = np.round(rng.normal(size=3001))
    y[:1500] = 7.0
    probs = [0.0, 0.1, 0.25, 0.5, 0.77, 1.0]
    got = exact_quantiles(frame(x=x, y=y), ["x", "y"], probs, max_rows=max_rows)
    np.testing.assert_allclose(got["x"], np.quantile(x, probs), rtol=0, atol=1e-12)
    np.testing.assert_allclose(got["y"], np.quantile(y, probs), rtol=0, atol=1e-12)


def test_quantiles_of_an_empty_column(spark):
    df = spark.createDataFrame([(1.0, None), (2.0, None)], "x double, y double")
    assert exact_quantiles(df, ["x", "y"], [0.5]) == {"x": [1.5], "y": []}


@pytest.mark.parametrize("rows_per_bucket", [10, 100_000])
def test_average_ranks(frame, rows_per_bucket):
    x = np.array([3.0, 1.0, 3.0, 2.0, 3.0, -0.0, 0.0] * 20)
    got = {r.value: r.avg_rank for r in ranks.average_ranks(frame(x=x), ["x"], rows_per_bucket=rows_per_bucket).collect()}
    s = np.sort(x)
    for v in set(x):
        at = np.flatnonzero(s == v) + 1
        assert got[v] == at.mean()


def test_attach_spreads_hot_values_and_keeps_rows(frame):
    x = np.array([1.0] * 400 + list(range(2, 302)), dtype=float)
    df = frame(k=np.arange(700), x=x)
    table = ranks.average_ranks(df, ["x"]).selectExpr("value as x", "n", "avg_rank", "tot_n")
    out = ranks.attach(df, table, ["x"], "n", "tot_n", salts=8)
    assert out.count() == 700
    assert out.where("x = 1").select("avg_rank").distinct().collect()[0][0] == 200.5


def test_spearman_and_metrics(frame):
    rng = np.random.default_rng(6)
    y = rng.normal(size=400)
    p = y + rng.normal(size=400)
    y[:100] = y[0]
    m = regression.regression_metrics(frame(y=y, p=p), "y", "p").first()

    def rank(v):
        s = np.sort(v)
        return (np.searchsorted(s, v, "left") + np.searchsorted(s, v, "right") + 1) / 2

    assert m.spearman_rho == pytest.approx(np.corrcoef(rank(y), rank(p))[0, 1])
    assert m.r2 == pytest.approx(1 - ((y - p) ** 2).sum() / ((y - y.mean()) ** 2).sum())
    assert m.mbe == pytest.approx((y - p).mean()) and m.efficiency == pytest.approx(m.r2 / 0.92)


def test_slices_and_durbin_watson(frame):
    rng = np.random.default_rng(7)
    k = rng.permutation(103)
    e = rng.normal(size=103)
    df = frame(k=k, y=e, p=np.zeros(103)).repartition(5)
    out = regression.batch_slices(df, ["k"], 4)
    assert out.count() == 100
    assert all(r.batch == r.k // 25 + 1 for r in out.collect())
    s = e[np.argsort(k)]
    got = regression.durbin_watson(df, "y", "p", ["k"]).first()
    assert got.durbin_watson == pytest.approx((np.diff(s) ** 2).sum() / (s**2).sum())


def test_iqr_bound_is_not_an_outlier(frame):
    # quartiles 2 and 4, so the upper bound is exactly 7
    df = frame(x=[1.0, 2.0, 3.0, 4.0, 7.0])
    assert profile.iqr_outliers(df, ["x"]).first().iqr_outliers == 0
    assert profile.iqr_outliers(frame(x=[1.0, 2.0, 3.0, 4.0, 7.1]), ["x"]).first().iqr_outliers == 1


def test_zero_mad_flags_nothing(frame):
    assert profile.mad_outliers(frame(x=[5.0] * 6 + [999.0]), ["x"]).first().mad_outliers == 0


def test_eta_squared(frame):
    same = profile.eta_squared(frame(g=[1, 1, 2, 2], target=[3.0, 3.0, 8.0, 8.0]), "g").first()
    assert same.eta_squared == 1.0 and same.eta_squared_classical == 1.0


def test_null_and_nan_are_counted_apart(spark):
    df = spark.createDataFrame([(1.0,), (None,), (float("nan"),)], "x double")
    r = profile.null_counts(df).first()
    assert (r.n_null, r.n_nan) == (1, 1)


def test_qq_points_are_order_statistics(frame):
    x = np.random.default_rng(8).normal(size=500)
    got = sorted(series.qq_points(frame(x=x), "x", 50).collect(), key=lambda r: r.place)
    want = np.sort(x)[[int(i * 499 / 49) for i in range(50)]]
    np.testing.assert_allclose([r.sample for r in got], want)


def test_running_sums_never_order_a_whole_table(frame):
    df = frame(x=np.random.default_rng(9).normal(size=2000))
    counts = ranks.value_counts(df, ["x"], rows_per_bucket=100)
    plan = ranks.running_sums(counts, ["n"])._jdf.queryExecution().optimizedPlan().toString()
    assert counts.select("bucket").distinct().count() > 10
    for line in plan.splitlines():
        if "Window" in line and "value" in line:
            assert "bucket" in line
