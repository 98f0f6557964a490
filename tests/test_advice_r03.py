"""Missing cells, empty batches, missing features, and the integers of the bootstrap."""

import math

import numpy as np
import pytest

from plumbline.operators import drift, experiment, regression
from plumbline.sources.tables import append_batch, read_batches


def ranks(v):
    order = np.argsort(v, kind="stable")
    out = np.empty(len(v))
    out[order] = np.arange(1, len(v) + 1)
    for x in np.unique(v):
        out[v == x] = out[v == x].mean()
    return out


def test_spearman_ranks_only_the_complete_pairs(spark):
    rng = np.random.default_rng(8)
    n = 300
    y = rng.integers(0, 40, n).astype(float)
    cols = {"full": y + rng.normal(0, 9, n), "gaps": -y + rng.integers(0, 30, n), "few": rng.normal(size=n), "none": np.full(n, np.nan)}
    cols["gaps"][rng.random(n) < 0.4] = np.nan
    cols["few"][5:] = np.nan
    y[rng.random(n) < 0.1] = np.nan
    cell = lambda v: None if math.isnan(v) else float(v)
    df = spark.createDataFrame([(cell(y[i]), *[cell(c[i]) for c in cols.values()]) for i in range(n)], "y double, " + ", ".join(f"{c} double" for c in cols))
    got = {r.feature: r for r in regression.correlation_to_target(df, list(cols), "y").collect()}
    assert set(got) == {"full", "gaps", "few"}
    for c in got:
        ok = ~np.isnan(y) & ~np.isnan(cols[c])
        assert got[c].pearson == pytest.approx(np.corrcoef(cols[c][ok], y[ok])[0, 1])
        assert got[c].spearman == pytest.approx(np.corrcoef(ranks(cols[c][ok]), ranks(y[ok]))[0, 1])


def test_an_empty_rerun_replaces_its_batch(spark, tmp_path):
    path, day = str(tmp_path / "t"), spark.range(5)
    for batch in ("a/1", "b"):
        append_batch(day, path, batch)
    append_batch(day.where("id < 0"), path, "a/1")
    assert {(r.batch_id, r["count"]) for r in read_batches(spark, path).groupBy("batch_id").count().collect()} == {("b", 5)}
    append_batch(day, path, "a/1")
    assert read_batches(spark, path).count() == 10


def test_a_missing_feature_leads_the_alerts(spark):
    ref = spark.range(400).selectExpr("cast(id as double) as x", "cast(id as double) as y", "cast(id as double) as z")
    cur = spark.range(200).selectExpr("cast(id + 900 as double) as x", "cast(null as double) as y", "cast(2 * id as double) as z", "'d' as day")
    top = drift.top_drift(drift.drift(ref, cur, ["x", "y", "z"], "day"), "day").orderBy("place").collect()
    assert [(r.feature, r.severity) for r in top] == [("y", drift.MISSING), ("x", "alert")]


def test_bootstrap_counts_are_poisson():
    keys = np.array(experiment.replicate_keys(2000, 42), np.uint64)
    assert len(set(keys.tolist())) == 2000
    steps = experiment.POISSON_STEPS
    assert len(steps) == 13 and all(0 < b - a for a, b in zip(steps, steps[1:]))
    for k, s in enumerate(steps):
        assert s / 2**32 == pytest.approx(math.exp(-1) * sum(1 / math.factorial(j) for j in range(k + 1)), abs=2**-31)


def test_a_bootstrap_with_a_unique_key_shuffles_no_rows(spark):
    df = spark.range(500).selectExpr("id as k", "cast(id % 37 as double) as y", "cast(id % 2 as int) as arm")
    folded, plain = (experiment.bootstrap_mean_diff(df, "k", "y", unique_key=u).first() for u in (False, True))
    assert abs(folded[0] - plain[0]) < 0.6 and abs(folded[1] - plain[1]) < 0.6
    plan = experiment.bootstrap_mean_diff(df, "k", "y", unique_key=True)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(key" not in plan


def test_a_forest_draws_from_the_whole_table_and_is_saved_with_its_threshold(spark, tmp_path):
    from plumbline.operators.isolation import IsolationForest, IsolationForestModel, binomial_steps

    steps = binomial_steps(10, 0.3)
    assert steps == pytest.approx([sum(math.comb(10, j) * 0.3**j * 0.7 ** (10 - j) for j in range(k + 1)) for k in range(len(steps))])
    df = spark.range(4000).selectExpr("cast(id as string) as k", "cast(id % 61 as double) as a", "if(id < 5, 900.0D, cast(id % 13 as double)) as b")
    forest = IsolationForest(trees=50, sample=64, keyCol="k", inputCols=["a", "b"])
    drawn = forest.drawn(df)
    sizes = {r.tree: r["count"] for r in drawn.groupBy("tree").count().collect()}
    assert len(sizes) == 50 and 0.9 < sum(sizes.values()) / (50 * 64) < 1.1 and max(sizes.values()) < 110
    assert drawn.select("_key").distinct().count() > 1900  # 1 - (1 - 64 / 4000) ** 50 of the rows are in some tree
    assert drawn.groupBy("_key", "tree").count().where("count > 1").isEmpty()
    model = forest.fit(df)
    model.write().overwrite().save(str(tmp_path / "f"))
    back = IsolationForestModel.load(str(tmp_path / "f"))
    assert back.getOrDefault("threshold") == model.getOrDefault("threshold")
    flags = [{r.k for r in m.transform(df).where("is_outlier").collect()} for m in (model, back)]
    assert flags[0] == flags[1] and {"0", "1", "2", "3", "4"} <= flags[0] and len(flags[0]) <= 200
    assert back.transform(df.where("k = '-'")).count() == 0
    whole = IsolationForest(trees=3, sample=256, keyCol="k", inputCols=["a"]).drawn(df.limit(100))
    assert whole.count() == 300  # a small table is in every tree


def test_exact_p_values_count_all_arrangements(spark):
    from itertools import combinations

    from plumbline.functions.special import ks_exact, mann_whitney_exact

    for n, m in ((3, 4), (5, 5), (1, 6)):
        us, ds = [], []
        for a in combinations(range(n + m), n):
            arm = [0 if i in a else 1 for i in range(n + m)]
            us.append(sum(a) + n - n * (n + 1) / 2)
            ds.append(max(abs(arm[:i + 1].count(0) * m - arm[:i + 1].count(1) * n) for i in range(n + m)))
        for u, d in zip(us, ds):
            low = min(u, n * m - u)
            assert mann_whitney_exact(u, n, m) == pytest.approx(min(1.0, 2 * sum(v <= low for v in us) / len(us)))
            assert ks_exact(d / (n * m), n, m) == pytest.approx(sum(v >= d for v in ds) / len(ds))
    assert ks_exact(0.1, 400, 300) == pytest.approx(0.058, abs=0.02)  # the limit distribution says 0.064
    tied = spark.createDataFrame([(0, 1.0), (0, 2.0), (1, 2.0), (1, 3.0), (1, 4.0)], "arm int, y double")
    row = experiment.two_sample_tests(tied, "y", method="exact").first()
    assert (row.mw_method, row.ks_method) == ("asymptotic", "exact")


def test_two_writers_get_different_versions(spark, tmp_path):
    from concurrent.futures import ThreadPoolExecutor

    from pyspark.ml import Pipeline

    from plumbline.sources.runlog import Registry, claim

    model = Pipeline(stages=[]).fit(spark.range(1))
    writers = [Registry(spark, str(tmp_path / "r")) for _ in range(4)]
    with ThreadPoolExecutor(4) as pool:
        versions = list(pool.map(lambda w: w.register("m", model), writers))
    assert sorted(versions) == [1, 2, 3, 4]
    seqs = [r.seq for r in writers[0].events().collect()]
    assert len(seqs) == len(set(seqs)) == 4
    assert claim(spark, str(tmp_path / "r/claims/m"), 1) == 5
    one = writers[0]
    one.set_stage("m", 1, "Production")
    assert one.resolve("m", "Production") == 1
    one.set_alias("m", 2, "Production")
    one.delete_alias("m", "Production")
    with pytest.raises(LookupError):
        one.resolve("m", "Production")
    verdict = spark.createDataFrame([(False,)], "promoted boolean")
    assert not one.apply_gate("m", 3, verdict) and one.tags("m", 3).first()["value"] == "kept_champion"
    assert one.apply_gate("m", 3, spark.createDataFrame([(True,)], "promoted boolean")) and one.resolve("m", "Production") == 3
