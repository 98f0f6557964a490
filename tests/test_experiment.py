import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from plumbline.config import CanaryStage
from plumbline.functions import special
from plumbline.operators import canary, experiment


def test_tail_probabilities_match_tables():
    assert special.t_two_sided(2.228, 10) == pytest.approx(0.05, abs=2e-4)
    assert special.t_two_sided(63.657, 1) == pytest.approx(0.01, abs=1e-5)
    assert special.normal_two_sided(1.959964) == pytest.approx(0.05, abs=1e-6)
    assert special.kolmogorov_tail(1.358) == pytest.approx(0.05, abs=3e-4)
    assert special.kolmogorov_tail(0.5) == pytest.approx(0.9639, abs=1e-4)
    assert special.wilcoxon_exact(0, 5) == 0.0625
    assert special.wilcoxon_exact(8, 10) == pytest.approx(0.048828125)


def test_normal_quantile_is_the_inverse(spark):
    p = [0.001, 0.02, 0.3, 0.5, 0.9, 0.999]
    df = spark.createDataFrame([(v,) for v in p], "p double").withColumn("z", special.normal_quantile(F.col("p")))
    for r in df.collect():
        assert 0.5 * math.erfc(-r.z / math.sqrt(2)) == pytest.approx(r.p, abs=1e-8)


def test_kolmogorov_as_column(spark):
    df = spark.createDataFrame([(0.05, 400, 300), (0.2, 400, 300), (0.0, 10, 10)], "d double, n long, m long")
    for r in df.withColumn("p", special.ks_pvalue(F.col("d"), F.col("n"), F.col("m"))).collect():
        lam = math.sqrt(r.n * r.m / (r.n + r.m)) * r.d
        assert r.p == pytest.approx(special.kolmogorov_tail(lam), abs=1e-9)


def brute_u(a, b):
    return sum((x > b).sum() + 0.5 * (x == b).sum() for x in a)


def test_compare_arms_against_brute_force(frame):
    rng = np.random.default_rng(10)
    a, b = np.round(rng.normal(size=150), 1), np.round(rng.normal(0.4, 1.3, 220), 1)
    df = frame(k=np.arange(370), y=np.concatenate([a, b]), arm=np.repeat([0, 1], [150, 220]))
    r = experiment.compare_arms(df, "k", "y").first()
    assert r.mw_u == brute_u(a, b)
    se = a.var(ddof=1) / 150 + b.var(ddof=1) / 220
    assert r.welch_t == pytest.approx((a.mean() - b.mean()) / math.sqrt(se))
    x = np.unique(np.concatenate([a, b]))
    gap = np.abs(np.searchsorted(np.sort(a), x, "right") / 150 - np.searchsorted(np.sort(b), x, "right") / 220).max()
    assert r.ks_stat == pytest.approx(gap)
    assert r.bootstrap_ci95_low < r.mean_diff < r.bootstrap_ci95_high
    width = 2 * 1.96 * math.sqrt(se)
    assert r.bootstrap_ci95_high - r.bootstrap_ci95_low == pytest.approx(width, rel=0.2)


def test_five_positive_differences(frame):
    df = frame(a=[2.0, 4.0, 6.0, 8.0, 10.0], b=[1.0, 2.0, 3.0, 4.0, 5.0])
    r = experiment.paired_report(df, "a", "b").first()
    assert r.paired_wilcoxon_p == 0.0625 and r.method == "exact"
    assert r.spearman_correlation == pytest.approx(1.0) and r.bias == 3.0


def test_bootstrap_r2_covers_the_estimate(frame):
    rng = np.random.default_rng(11)
    y = rng.normal(50, 1, 800)
    p = y + rng.normal(0, 0.4, 800)
    ci = experiment.bootstrap_r2(frame(k=np.arange(800), y=y, p=p), "k", "y", "p", replicates=400).first()
    r2 = 1 - ((y - p) ** 2).sum() / ((y - y.mean()) ** 2).sum()
    assert ci.oof_r2_ci95_low < r2 < ci.oof_r2_ci95_high
    assert ci.oof_r2_ci95_high - ci.oof_r2_ci95_low < 0.1


def test_false_alarm_rate_of_welch(spark):
    """200 hash seeds split the same rows; about 5 % of the splits may look different."""
    x = np.random.default_rng(12).normal(size=400)
    df = spark.createDataFrame([(i, float(v)) for i, v in enumerate(x)], "k int, y double").crossJoin(
        spark.range(200).withColumnRenamed("id", "seed")
    )
    from plumbline.functions.scalar import hash_unit

    arms = df.withColumn("arm", (hash_unit("k", F.col("seed")) < 0.5).cast("int"))
    m = arms.groupBy("seed").agg(*[
        F.expr(f"{f}(if(arm = {c}, y, null)) as {n}{c}")
        for c in (0, 1) for n, f in (("n", "count"), ("m", "avg"), ("v", "var_samp"))
    ]).toPandas()
    t = (m.m0 - m.m1) / np.sqrt(m.v0 / m.n0 + m.v1 / m.n1)
    rate = np.mean([special.normal_two_sided(v) < 0.05 for v in t])
    assert 0.02 <= rate <= 0.09


def preds(frame, n=4000, seed=13):
    rng = np.random.default_rng(seed)
    y = rng.normal(10, 2, n)
    return frame(row_id=[f"r{i}" for i in range(n)], champ=y, chall=y + rng.normal(0, 0.1, n))


def test_healthy_rollout_promotes(frame):
    d = canary.canary_health(preds(frame), "row_id", "champ", "chall").cache()
    assert [r.n_canary + r.n_champion for r in d.collect()] == [4000] * 4
    assert canary.promotion_gate(d).first().promoted


def test_constant_challenger_fails_on_correlation(frame):
    df = preds(frame).withColumn("chall", F.lit(10.0))
    rows = canary.canary_health(df, "row_id", "champ", "chall").collect()
    assert all("correlation" in r.fails and r.decision == "rollback" for r in rows)


def test_no_canary_rows_is_no_evidence(frame):
    d = canary.canary_health(preds(frame, 50), "row_id", "champ", "chall", [CanaryStage(1, 1.0)]).cache()
    r = d.first()
    assert r.healthy and r.n_canary == 0 and r.reason and r.mean_shift is None
    assert not canary.promotion_gate(d).first().promoted


def test_nested_rollout_only_adds_rows(frame):
    p = canary.canary_predictions(preds(frame, 2000), "row_id", "champ", "chall", nested=True)
    byday = {d: {r.row_id for r in p.where(f"day = {d} and arm = 1").collect()} for d in (1, 2, 3, 4)}
    assert byday[1] < byday[2] < byday[3] < byday[4]


def test_failed_gate_names_its_days(frame):
    d = canary.canary_health(preds(frame), "row_id", "champ", "chall", latency_ratio={1: 1.0, 2: 2.0, 3: 2.1, 4: 3.0})
    g = canary.promotion_gate(d).first()
    assert g.failed_days == [3, 4] and g.action == "rollback_keep_champion"
