"""Faults that earlier fixtures didn't show."""

from plumbline.operators import profile, series
from plumbline.sources import tables


def test_all_null_columns_have_no_outliers(spark):
    df = spark.createDataFrame([(float(i), None) for i in range(20)], "a double, b double")
    got = {r.feature: r for r in profile.univariate_outliers(df, ["a", "b"]).collect()}
    assert (got["b"].iqr_outliers, got["b"].iqr_pct, got["b"].mad_outliers, got["b"].mad_pct) == (0, None, 0, None)
    assert got["a"].iqr_pct == 0.0


def test_one_bin_counts_its_rows(spark):
    df = spark.createDataFrame([(0.0,), (0.5,), (1.0,), (2.0,)], "x double")
    assert [r.n for r in series.histogram_edges(df, "x", [0.0, 1.0]).collect()] == [3]


def test_batch_ids_stay_text(spark, tmp_path):
    path = str(tmp_path / "batches")
    for batch in ("007", "7", "01"):
        tables.append_batch(spark.createDataFrame([(1.0,)], "x double"), path, batch)
    assert sorted(r.batch_id for r in tables.read_batches(spark, path).collect()) == ["007", "01", "7"]


def test_overwrite_replaces_from_its_own_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.overwrite(spark.createDataFrame([(1,), (2,)], "x int"), path)
    tables.overwrite(spark.read.parquet(path).where("x = 2"), path)
    assert [r.x for r in spark.read.parquet(path).collect()] == [2]
    assert [p.name for p in tmp_path.iterdir()] == ["t"]


def test_wasserstein_keeps_its_digits_far_from_zero(spark):
    from plumbline.operators import drift

    ref = spark.range(2000).selectExpr("1e12D + id / 1024.0D as x")
    cur = spark.range(2000).selectExpr("1e12D + 0.5D + id / 1024.0D as x", "'a' as day")
    assert abs(drift.ks_and_wasserstein(ref, cur, ["x"], "day").first()["wasserstein"] - 0.5) < 1e-6


def test_order_scores_count_every_rank_of_a_tie(spark):
    import random
    from statistics import NormalDist

    from plumbline.operators import regression

    draw = random.Random(4)
    xs = sorted(float(round(draw.gauss(0, 0.6))) for _ in range(3000))
    n, mean = len(xs), sum(xs) / len(xs)
    m = [NormalDist().inv_cdf((i - 0.375) / (n + 0.25)) for i in range(1, n + 1)]
    want = sum((x - mean) * s for x, s in zip(xs, m)) ** 2 / (sum((x - mean) ** 2 for x in xs) * sum(s * s for s in m))
    got = regression.shapiro_francia(spark.createDataFrame([(x,) for x in xs], "x double"), "x").first()
    assert abs(got["shapiro_w"] - want) < 1e-6 and want < 0.95


def test_the_power_search_leaves_its_first_bracket(spark):
    import random

    from plumbline.operators import transforms

    draw = random.Random(5)
    rows = [((1 - 20 * draw.gauss(0.02, 0.005)) ** (-1 / 20) - 1,) for _ in range(2000)]
    lam = transforms.fit_lambdas(spark.createDataFrame(rows, "x double"), ["x"])["x"]
    assert -30 < lam < -10


def test_spearman_ranks_complete_pairs_only(spark):
    from plumbline.operators import regression

    rows = [(1.0, 2.0), (2.0, 1.0), (3.0, None), (None, 1.5), (4.0, 4.0), (5.0, 3.0), (6.0, None)]
    got = regression.spearman(spark.createDataFrame(rows, "x double, y double"), "x", "y").first()["spearman_rho"]
    assert abs(got - 0.6) < 1e-12
