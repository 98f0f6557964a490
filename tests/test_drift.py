import numpy as np
import pytest
from pyspark.sql import functions as F

from plumbline.config import DriftThresholds
from plumbline.functions.scalar import batch_severity, severity
from plumbline.operators import drift as D


def one(ref, cur, frame, **kw):
    r = frame(x=np.asarray(ref, float))
    c = frame(x=np.asarray(cur, float), b="1")
    return D.drift(r, c, ["x"], "b", **kw).first()


def brute(a, b):
    x = np.unique(np.concatenate([a, b]))
    fa = np.searchsorted(np.sort(a), x, side="right") / len(a)
    fb = np.searchsorted(np.sort(b), x, side="right") / len(b)
    gap = np.abs(fa - fb)
    return gap.max(), float((gap[:-1] * np.diff(x)).sum())


def brute_psi(ref, cur, bins=10, eps=1e-6):
    edges = np.unique(np.quantile(ref, np.linspace(0, 1, bins + 1)))
    edges[0] -= eps
    edges[-1] += eps
    r, c = np.histogram(ref, edges)[0], np.histogram(cur, edges)[0]
    k = len(r)
    rp, cp = (r + eps) / (r.sum() + eps * k), (c + eps) / (c.sum() + eps * k)
    return float(((cp - rp) * np.log(cp / rp)).sum())


def test_identity_is_zero(frame):
    x = np.random.default_rng(1).normal(size=500)
    r = one(x, x, frame)
    assert r.psi == pytest.approx(0, abs=1e-12)
    assert r.ks_stat == 0 and r.wasserstein == pytest.approx(0, abs=1e-12)


def test_constant_reference_has_no_psi(frame):
    assert one([3.0] * 50, [1.0, 2.0, 3.0], frame).psi == 0.0


def test_out_of_range_parity_and_clip(frame):
    x = np.random.default_rng(2).normal(size=800)
    plain, clipped = one(x, x + 100, frame), one(x, x + 100, frame, clip=True)
    assert plain.psi == pytest.approx(0, abs=1e-9) and plain.out_of_range_pct == 100.0
    assert clipped.psi > 1
    assert plain.severity == "alert"  # KS sees it


def test_disjoint_and_shifted(frame):
    r = np.arange(1, 11)
    assert one(r, r + 100, frame).ks_stat == 1.0
    assert one(r, r + 5, frame).wasserstein == pytest.approx(5.0)


@pytest.mark.parametrize("rows_per_bucket", [7, 100, 100_000])
def test_many_buckets_match_brute_force(spark, frame, rows_per_bucket):
    """A third of the rows share one value, batches differ in size and overlap the reference."""
    rng = np.random.default_rng(3)
    ref = np.round(rng.normal(size=900), 2)
    ref[:300] = 0.5
    batches = {
        "a": np.round(rng.normal(0.3, 1.2, 400), 2),
        "b": np.concatenate([np.full(200, 0.5), rng.normal(size=150)]),
        "c": np.array([10.0]), "d": ref[:1], "e": rng.normal(-4, 0.1, 50),
    }
    cur = frame(x=np.concatenate(list(batches.values())), b=np.repeat(list(batches), [len(v) for v in batches.values()]))
    got = {r.b: r for r in D.drift(frame(x=ref), cur, ["x"], "b", rows_per_bucket=rows_per_bucket).collect()}
    ks_only = {r.b: r for r in D.ks_table(frame(x=ref), cur, ["x"], "b", rows_per_bucket).collect()}
    for b, v in batches.items():
        ks, w1 = brute(ref, v)
        assert got[b].ks_stat == pytest.approx(ks, abs=1e-12), b
        assert ks_only[b].ks_stat == pytest.approx(ks, abs=1e-12), b
        assert got[b].wasserstein == pytest.approx(w1, abs=1e-9), b
        assert got[b].psi == pytest.approx(brute_psi(ref, v), abs=1e-9), b


def test_repartitioning_changes_nothing(spark, frame):
    rng = np.random.default_rng(4)
    r, c = frame(x=rng.normal(size=300)), frame(x=rng.normal(size=200), b="1")
    a = D.drift(r, c, ["x"], "b").first()
    b = D.drift(r.repartition(7), c.orderBy(F.desc("x")).repartition(3), ["x"], "b", rows_per_bucket=20).first()
    assert a.psi == pytest.approx(b.psi) and a.ks_stat == b.ks_stat
    assert a.wasserstein == pytest.approx(b.wasserstein)


def test_nulls_and_nan_are_left_out(spark):
    r = spark.createDataFrame([(float(i),) for i in range(100)], "x double")
    c = spark.createDataFrame([(1.0, "1"), (None, "1"), (float("nan"), "1"), (50.0, "1")], "x double, b string")
    row = D.drift(r, c, ["x"], "b").first()
    assert row.n_cur == 2 and row.ks_stat == row.ks_stat


def test_severity_limits_are_inclusive(spark):
    cases = [(0.10, 0.0, "warning"), (0.25, 0.0, "alert"), (0.0, 0.10, "warning"), (0.0, 0.20, "alert"), (0.0999, 0.0999, "ok")]
    df = spark.createDataFrame(cases, "psi double, ks double, want string")
    assert all(r.got == r.want for r in df.withColumn("got", severity(F.col("psi"), F.col("ks"))).collect())


def test_batch_severity_counts(spark):
    cases = [("ok", 2, 3, "ok"), ("ok", 3, 0, "alert"), ("ok", 0, 4, "warning"), ("warning", 0, 0, "warning"), ("alert", 0, 0, "alert")]
    df = spark.createDataFrame(cases, "s string, a int, w int, want string")
    got = df.withColumn("got", batch_severity(F.col("s"), F.col("a"), F.col("w"), DriftThresholds())).collect()
    assert all(r.got == r.want for r in got)
