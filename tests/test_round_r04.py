"""What the fourth review found too slow or too large: trees stay off the driver, ranks and powers in plain jobs."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from plumbline.operators import regression, transforms, trees
from plumbline.operators.trees import Growth, Nodes, TreeSpec, fit_together, held_r2, predictions

COLS = ["a", "b", "c", "d"]
BOOSTED = TreeSpec((0, 1, 2, 3), trees=1, rounds=12, depth=5, rate=0.3, l2=1.0, subsample=0.8, temperature=0.6, bags=False, min_leaf=0, min_split=0)
FOREST = TreeSpec((0, 1, 2, 3), trees=40, depth=6, share="0.5", min_leaf=2)


@pytest.fixture(scope="module")
def table(spark):
    import pandas as pd

    rng = np.random.default_rng(9)
    x = rng.normal(size=(500, 4))
    y = 2 * x[:, 0] + 3 * (x[:, 1] > 0) * x[:, 2] + rng.normal(size=500) * 0.1
    rows = pd.DataFrame(x, columns=COLS).assign(target=y, row_id=[f"r{i}" for i in range(500)])
    rows.loc[::9, "d"] = np.nan
    return spark.createDataFrame(rows)


@pytest.mark.parametrize("spec", [BOOSTED, FOREST])
def test_sums_in_one_number_grow_the_same_trees(spec):
    """the quick way against sums of residuals and weights apart."""
    rng = np.random.default_rng(3)
    x, h, y = rng.integers(0, trees.BINS, (300, 4)).astype(np.uint8), rng.integers(0, 2**63, 300).astype(np.uint64), rng.normal(size=300)
    quick = list(trees.grow_here(spec, 0, spec.trees, 0.1, 2.0**20, h, y, x))
    (_, slow), = trees._grow_slowly(spec, 0, spec.trees, 0.1, 2.0**20, h, y, x)
    joined = trees.Packed.joined([p for _, p in quick])
    for c in ("size", "column", "cut"):
        assert np.array_equal(getattr(joined, c), getattr(slow, c))
    assert np.allclose(joined.value, slow.value, rtol=1e-12, atol=0)
    assert np.allclose(joined.total(x), slow.nodes().value[slow.nodes().leaves(x.astype(int), slow.nodes().roots)].sum(axis=0))


def test_sums_too_wide_for_one_number_grow_apart():
    rng = np.random.default_rng(3)
    x, h, y = rng.integers(0, trees.BINS, (80, 4)).astype(np.uint8), rng.integers(0, 2**63, 80).astype(np.uint64), rng.normal(size=80)
    with pytest.raises(trees._TooWide):
        list(trees.grow_here(FOREST, 0, 2, 0.0, 2.0**60, h, y, x))
    (first, found), = trees.grown(FOREST, 4, 3, 0.0, 2.0**60, h, y, x)
    assert first == 4 and len(found.size) == 3


def test_columns_rank_the_same_in_one_task(spark, table, monkeypatch):
    """the small plan against the grouped one, with missing, constant and empty columns."""
    rows = table.withColumns({"e": F.lit(2.0), "f": F.lit(None).cast("double"), "g": F.expr("pmod(hash(row_id), 3) * 1.0D")})
    cols = [*COLS, "e", "f", "g"]
    want = {r.feature: r.mutual_info for r in regression.mutual_information(rows, cols, "target").collect()}
    got = transforms.near_information(rows, cols, "target")
    assert got == pytest.approx(want, abs=1e-12) and "f" not in got
    picker = transforms.MutualInfoSelector(cols, 3, "target")
    near = picker.ranking(rows)
    monkeypatch.setattr(transforms, "NEAR_ROWS", 10)
    assert near == picker.ranking(rows)
    assert transforms.near_information(rows.withColumn("a", F.lit(float("inf"))), cols, "target") is None


def test_moments_of_powers_are_those_of_all_rows(table):
    """numpy batches, merged, against Spark's aggregates."""
    got = transforms.transformed_moments(table.repartition(7), {"a": [0.0, 1.3, 2.0], "d": [-0.5]})
    for c, lams in (("a", [0.0, 1.3, 2.0]), ("d", [-0.5])):
        e = [transforms.yeo_johnson_sql(f"nanvl({c}, null)", f"{v!r}D") for v in lams]
        for found, sql in zip(got[c], e):
            want = table.agg(F.expr(f"count(nanvl({c}, null))"), F.expr(f"avg({sql})"), F.expr(f"var_pop({sql})"), F.expr(f"sum(sign(nanvl({c}, null)) * ln(1 + abs(nanvl({c}, null))))")).first()
            assert found == pytest.approx(tuple(want), rel=1e-9)


def test_held_out_scores_without_a_tree_on_the_driver(table, monkeypatch):
    """F2: the score of the tasks against that of fitted models."""
    fit, held = table.where("pmod(hash(row_id), 4) > 0"), table.where("pmod(hash(row_id), 4) = 0")
    models = fit_together(fit, "row_id", COLS, "target", [FOREST, BOOSTED])
    p = held.select("target", predictions(models, [F.col(c) for c in COLS]).alias("p")).toPandas()
    want = [1 - ((p.target - [v[i] for v in p.p]) ** 2).mean() / p.target.var(ddof=0) for i in range(2)]
    monkeypatch.setattr(trees.Ensemble, "pieces", None)
    assert held_r2(fit, held, "row_id", COLS, "target", [FOREST, BOOSTED]) == pytest.approx(want, rel=1e-9)
    monkeypatch.setattr(trees, "BLOCK", 10)
    assert held_r2(fit, held, "row_id", COLS, "target", [FOREST]) is None


def test_finished_trees_of_a_large_table_leave_the_driver(table, monkeypatch):
    """neither the driver nor a job holds more than the trees that grow."""
    sent, whole = [], Growth.settle
    only = Nodes.only
    monkeypatch.setattr(trees, "BLOCK", 10)
    monkeypatch.setattr(trees, "OPEN_NODES", 2 ** (FOREST.depth + 2))  # two trees at a time
    monkeypatch.setattr(Growth, "settle", lambda self, *a: (whole(self, *a), sent.append(len(self.nodes.column)))[0])
    monkeypatch.setattr(Nodes, "only", lambda self, *a: (got := only(self, *a), sent.append(len(got[0].column)))[0])
    found, = fit_together(table, "row_id", COLS, "target", [TreeSpec((0, 1, 2, 3), trees=8, depth=6, share="0.5", min_leaf=2)])
    assert len(found.nodes.roots) == 8 and max(sent) < 0.5 * len(found.nodes.column)


# --- F4, F5: rows of the history are neither sorted nor written twice --------------


def _dated(spark, n: int, days: int, twice: int):
    import datetime

    rows = [(f"{(i * 7919) % 997:06x}" if i % 13 else None, None if i % 17 == 0 else datetime.date(2000, 1, 1 + i % days), float(i)) for i in range(n)]
    return spark.createDataFrame(rows * twice, "row_id string, dt date, q double")


@pytest.mark.parametrize("n,days,twice", [(203, 5, 1), (61, 2, 4), (40, 1, 7), (3, 1, 1), (0, 1, 1)])
def test_slices_without_a_sort_are_those_of_the_index(spark, n, days, twice):
    """Equal rows, rows without a day or key, and slices that end among equal rows."""
    df = _dated(spark, n, days, twice)
    count = lambda d: sorted((str(r.dt), str(r.row_id), r.batch, r["count"]) for r in d.groupBy("dt", "row_id", "batch").count().collect())
    got = regression.batch_slices(df, ["dt", "row_id"], 4, index=False)
    assert count(got) == count(regression.batch_slices(df, ["dt", "row_id"], 4)) and "row_index" not in got.columns
    short = df.withColumn("row_id", F.unhex("row_id"))
    sizes = lambda d: sorted(r["count"] for r in d.groupBy("batch").count().collect())
    assert sizes(regression.batch_slices(short, ["dt", "row_id"], 4, index=False)) == sizes(got)


def test_drift_table_has_the_rows_of_the_wide_table(spark, tmp_path, monkeypatch):
    import datetime

    from plumbline.sources import fixtures as X

    day = lambda i: datetime.date(1997 + i % 4, 3, 1 + i % 20)
    tables = {
        "customer": ([(i, i * 1.5) for i in range(9)], "c_custkey bigint, c_acctbal double"),
        "supplier": ([(i, i * 2.5) for i in range(4)], "s_suppkey bigint, s_acctbal double"),
        "part": ([(i, i + 1, i * 3.5) for i in range(6)], "p_partkey bigint, p_size int, p_retailprice double"),
        "orders": ([(i if i % 11 else None, i % 10, i * 10.25, None if i % 12 == 0 else day(i)) for i in range(60)], "o_orderkey bigint, o_custkey bigint, o_totalprice double, o_orderdate date"),
        "lineitem": ([(i % 70, i % 3, i % 7, i % 4, float(i % 50), 0.01 * (i % 5), 0.02, 100.25 * i, day(i)) for i in range(300)] * 2,
                     "l_orderkey bigint, l_linenumber int, l_partkey bigint, l_suppkey bigint, l_quantity double, l_discount double, l_tax double, l_extendedprice double, l_shipdate date"),
    }
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / f"{name}.parquet"))
    monkeypatch.setattr(X, "PART_ROWS", 150)  # four parts
    got, want = X.drift_table(spark, str(tmp_path)), X.build_wide_table(spark, str(tmp_path)).where("dt is not null")
    key = f"if(dt >= '{X.SPLIT_DATE}', %s, null) as row_id"
    rows = lambda d, e: sorted(map(str, d.selectExpr(key % e, *X.WIDE_FEATURES, "dt").collect()))
    assert rows(got, "lower(hex(row_id))") == rows(want, "row_id") and got.where("row_id is not null and dt < '1999-01-01'").isEmpty()
    assert got.count() > 300
