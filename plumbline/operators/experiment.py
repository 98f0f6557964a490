"""Champion against challenger: assignment, two-sample and paired tests, agreement."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.config import AGREEMENT_Z, SIGNIFICANCE
from plumbline.functions.scalar import hash_unit
from plumbline.functions.special import (
    ks_exact_pvalue, ks_pvalue, mann_whitney_exact_pvalue, normal_pvalue, t_pvalue, wilcoxon_pvalue,
)
from plumbline.operators.longform import corr_sql, finite_sql
from plumbline.operators.quantiles import exact_quantiles
from plumbline.operators.ranks import running_sums, value_counts
from plumbline.operators.regression import residual_diagnostics, shapiro_francia, spearman, with_residual_pvalues

REPLICATES = 2000
MASK = 2**32 - 1
# Odd multipliers of the 32-bit mixer (the SQL of the bootstrap reads them)
MIX = (0x85EBCA6B, 0xC2B2AE35, 0x27D4EB2F, 0x9E3779B1)
#: A draw u of 32 bits is the Poisson(1) count of steps that it reaches; the last step is the last below 2**32.
POISSON_STEPS = [s for s in (int(math.exp(-1) * sum(1 / math.factorial(j) for j in range(k + 1)) * 2**32) for k in range(13)) if s < 2**32]


def replicate_keys(replicates: int, seed: int) -> list[int]:
    """One mixed 32-bit number per replicate."""
    out = []
    for r in range(1, replicates + 1):
        x = (r * MIX[3] + seed) & MASK
        for shift, by in ((16, MIX[0]), (13, MIX[1])):
            x = ((x ^ x >> shift) * by) & MASK
        out.append(x ^ x >> 16)
    return out


def assign_treatment(df: DataFrame, key: str, share: float, seed: int | str = 42) -> DataFrame:
    """Adds ``arm``: 1 with probability ``share``, fixed by the row key and the seed.

    With one seed a larger share always contains the smaller one.
    """
    return df.withColumn("arm", F.when(hash_unit(key, seed) < share, 1).otherwise(0))


def arm_moments(df: DataFrame, value: str, arm: str = "arm") -> DataFrame:
    x = finite_sql(value)
    aggs = []
    for name, code in (("a", 0), ("b", 1)):
        v = f"if(`{arm}` = {code}, {x}, null)"
        aggs += [
            f"count({v}) as n_{name}", f"avg({v}) as mean_{name}",
            f"stddev_pop({v}) as std_{name}", f"var_samp({v}) as var_{name}",
        ]
    return df.agg(*[F.expr(e) for e in aggs])


def welch(df: DataFrame, value: str, arm: str = "arm") -> DataFrame:
    """Welch t statistic (a minus b) and its Satterthwaite degrees of freedom."""
    se = "(var_a / n_a + var_b / n_b)"
    return arm_moments(df, value, arm).selectExpr(
        "n_a", "n_b", "mean_a", "mean_b", "std_a", "std_b", "mean_a - mean_b as mean_diff",
        f"(mean_a - mean_b) / nullif(sqrt({se}), 0.0D) as welch_t",
        f"{se} * {se} / nullif(var_a * var_a / (cast(n_a as double) * n_a * (n_a - 1))"
        " + var_b * var_b / (cast(n_b as double) * n_b * (n_b - 1)), 0.0D) as welch_df",
    )


def rank_tests(df: DataFrame, value: str, arm: str = "arm") -> DataFrame:
    """Mann-Whitney U (of arm a, tie-corrected z with continuity) and two-sample KS."""
    counts = value_counts(
        df, [value], {"na": f"if(`{arm}` = 0, 1, 0)", "nb": f"if(`{arm}` = 1, 1, 0)"}
    ).where("na + nb > 0")
    placed = running_sums(counts, ["na", "nb"]).selectExpr(
        "*", "cast(na + nb as double) as k", "cum_na + cum_nb as cum"
    )
    sums = placed.agg(
        F.expr("cast(max(tot_na) as double) as n"), F.expr("cast(max(tot_nb) as double) as m"),
        F.expr("sum(na * (cum - k + (k + 1) / 2)) as rank_sum_a"),
        F.expr("sum(k * k * k - k) as ties"),
        F.expr("max(abs(cum_na / nullif(tot_na, 0) - cum_nb / nullif(tot_nb, 0))) as ks_stat"),
    ).selectExpr("*", "rank_sum_a - n * (n + 1) / 2 as mw_u")
    spread = "sqrt(n * m / 12 * ((n + m + 1) - ties / ((n + m) * (n + m - 1))))"
    return sums.selectExpr(
        "mw_u",
        f"(greatest(mw_u, n * m - mw_u) - n * m / 2 - 0.5D) / nullif({spread}, 0.0D) as mw_z",
        "ks_stat", "n as _n", "m as _m", "ties > 0 as _tied",
    )


def two_sample_tests(df: DataFrame, value: str, arm: str = "arm", method: str = "asymptotic") -> DataFrame:
    """Mann-Whitney and KS with two-sided p-values, and how each was found.

    ``method="exact"`` counts arrangements, in steps of the product of the two arms' sizes: meant for
    small samples. Equal values have no exact rank-sum distribution here, so Mann-Whitney then says
    "asymptotic"; for KS the exact p of equal values is an upper bound.
    """
    if method not in ("asymptotic", "exact"):
        raise ValueError("method: asymptotic or exact")
    stats = rank_tests(df, value, arm)
    n, m = F.col("_n"), F.col("_m")
    mw = F.least(normal_pvalue(F.greatest("mw_z", F.lit(0.0))), F.lit(1.0))
    ks, mw_method = ks_pvalue(F.col("ks_stat"), n, m), F.lit("asymptotic")
    if method == "exact":
        ks = ks_exact_pvalue(F.col("ks_stat"), n, m)
        mw = F.when(F.col("_tied"), mw).otherwise(mann_whitney_exact_pvalue(F.col("mw_u"), n, m))
        mw_method = F.when(F.col("_tied"), "asymptotic").otherwise("exact")
    return stats.select(
        n.cast("bigint").alias("n_a"), m.cast("bigint").alias("n_b"), "mw_u", mw.alias("mw_p"), mw_method.alias("mw_method"),
        "ks_stat", ks.alias("ks_p"), F.lit(method).alias("ks_method"))


def oof_report(df: DataFrame, key: str, y: str, yhat: str, order: list[str], unique_key: bool = False) -> DataFrame:
    """All diagnostics of out-of-fold predictions in one row: fit with its interval, normality,
    heteroscedasticity and autocorrelation of the residual, with p-values."""
    return with_residual_pvalues(residual_diagnostics(df, y, yhat, order)).crossJoin(bootstrap_r2(df, key, y, yhat, unique_key=unique_key))


def _replicates(rows: DataFrame, names: list[str], sums: list[str], replicates: int, seed: int, unique_key: bool) -> DataFrame:
    """(rep, weighted sums): every row drawn a Poisson(1) number of times per replicate.

    A draw is a mix of two 32-bit words of the row's md5 with the replicate's number, in integers that
    SQL can repeat; retries and repartitioning change nothing. The first of ``names`` is the key: where
    it is unique, its md5 is the row's and nothing is shuffled. Otherwise equal rows fold to one with a
    count n, which is drawn Poisson(n) times, as n single rows are together, and the md5 is of the
    whole row; so a key that holds many rows ties them together no more than others. Each task sends
    one row of sums per replicate.
    """
    sums_out = [f"_s{i}" for i in range(len(sums))]
    if unique_key:
        folded, name = rows.withColumn("_n", F.lit(1).cast("bigint")), F.col(names[0]).cast("string")
    else:
        folded = rows.groupBy(*names).agg(F.count("*").alias("_n"))
        name = F.to_json(F.struct(*names), {"ignoreNullFields": "false"})
    md5 = F.md5(F.concat_ws(":", F.coalesce(name, F.lit("")), F.lit("boot")))
    words = [F.conv(F.substring(md5, at, 8), 16, 10).cast("bigint") for at in (1, 9)]
    folded = folded.select(*[w.alias(f"_h{i}") for i, w in enumerate(words)], "_n", *[
        F.expr(f"cast({e} as double) as {name}") for name, e in zip(sums_out, sums)])
    keys, steps = replicate_keys(replicates, seed), POISSON_STEPS

    def draw(batches):
        import numpy as np
        import pyarrow as pa

        ks, total = np.array(keys, np.uint32), np.zeros((len(sums), replicates))
        for batch in batches:
            h1, h2 = (batch.column(i).to_numpy().astype(np.uint32)[:, None] for i in (0, 1))
            n = batch.column(2).to_numpy()
            values = np.array([batch.column(i + 3).to_numpy(zero_copy_only=False) for i in range(len(sums))])
            for at in range(0, batch.num_rows, 64):
                x = h1[at:at + 64] ^ ks
                x *= np.uint32(MIX[0])
                x ^= x >> np.uint32(15)
                x += h2[at:at + 64]
                x *= np.uint32(MIX[1])
                x ^= x >> np.uint32(13)
                x *= np.uint32(MIX[2])
                x ^= x >> np.uint32(16)
                weights = np.zeros(x.shape, np.uint8)
                for s in steps:
                    weights += x >= np.uint32(s)
                weights = weights.astype(float)
                for i in np.flatnonzero(n[at:at + 64] > 1):
                    own = np.random.Generator(np.random.Philox(key=[int(h1[at + i, 0]) << 32 | int(h2[at + i, 0]), seed]))
                    weights[i] = own.poisson(n[at + i], replicates)
                total += values[:, at:at + 64] @ weights
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(replicates, dtype=np.int32)), *map(pa.array, total)], ["rep", *sums_out]
        )

    partial = folded.mapInArrow(draw, "rep int, " + ", ".join(f"{s} double" for s in sums_out))
    return partial.groupBy("rep").agg(*[F.sum(s).alias(s) for s in sums_out])


def _interval(stats: DataFrame, stat: str, prefix: str) -> DataFrame:
    return stats.agg(
        F.expr(f"percentile({stat}, 0.025) as {prefix}_low"),
        F.expr(f"percentile({stat}, 0.975) as {prefix}_high"),
    )


def bootstrap_mean_diff(
    df: DataFrame, key: str, value: str, arm: str = "arm", replicates: int = REPLICATES, seed: int = 42,
    unique_key: bool = False,
) -> DataFrame:
    """95 % bootstrap interval of mean(a) - mean(b), rows resampled.

    ``unique_key`` states that no two rows share a key, which saves a shuffle.
    """
    rows = df.selectExpr(f"`{key}` as key", f"{finite_sql(value)} as x", f"`{arm}` as arm").where("x is not null")
    sums = ["if(arm = 0, 1, 0)", "if(arm = 0, x, 0.0D)", "if(arm = 1, 1, 0)", "if(arm = 1, x, 0.0D)"]
    stats = _replicates(rows, ["key", "x", "arm"], sums, replicates, seed, unique_key).selectExpr(
        "_s1 / nullif(_s0, 0) - _s3 / nullif(_s2, 0) as diff"
    )
    return _interval(stats, "diff", "bootstrap_ci95")


def bootstrap_r2(
    df: DataFrame, key: str, y: str, yhat: str, replicates: int = REPLICATES, seed: int = 42,
    unique_key: bool = False,
) -> DataFrame:
    """95 % bootstrap interval of r2, rows resampled with target and prediction together."""
    rows = df.selectExpr(f"`{key}` as key", f"{finite_sql(y)} as y", f"{finite_sql(yhat)} as p").where(
        "y is not null and p is not null"
    )
    center = rows.agg(F.avg("y")).first()[0] or 0.0
    d = f"(y - {center!r}D)"
    stats = _replicates(rows, ["key", "y", "p"], ["1", d, f"{d} * {d}", "(y - p) * (y - p)"], replicates, seed, unique_key).selectExpr(
        "1 - _s3 / nullif(_s2 - _s1 * _s1 / nullif(_s0, 0), 0.0D) as r2"
    )
    return _interval(stats, "r2", "oof_r2_ci95")


def compare_arms(
    df: DataFrame, key: str, value: str, arm: str = "arm",
    name_a: str = "a", name_b: str = "b", seed: int = 42, unique_key: bool = False,
) -> DataFrame:
    """One report row: moments, Welch, Mann-Whitney, KS and a bootstrap interval."""
    report = (
        welch(df, value, arm)
        .crossJoin(rank_tests(df, value, arm))
        .crossJoin(bootstrap_mean_diff(df, key, value, arm, seed=seed, unique_key=unique_key))
    )
    return report.select(
        F.lit(name_a).alias("name_a"), F.lit(name_b).alias("name_b"),
        "n_a", "n_b", "mean_a", "mean_b", "std_a", "std_b", "mean_diff",
        "welch_t", "welch_df", t_pvalue(F.col("welch_t"), F.col("welch_df")).alias("welch_p"),
        "mw_u", F.least(normal_pvalue(F.greatest("mw_z", F.lit(0.0))), F.lit(1.0)).alias("mw_p"),
        "ks_stat", ks_pvalue(F.col("ks_stat"), F.col("_n"), F.col("_m")).alias("ks_p"),
        "bootstrap_ci95_low", "bootstrap_ci95_high",
    )


def aa_verdict(report: DataFrame, level: float = SIGNIFICANCE) -> DataFrame:
    """No test may reject when both arms hold the same model.

    Three tests at once raise the false alarm rate, so a family-wise verdict at
    level / 3 stands beside the plain one.
    """
    p = F.least("welch_p", "mw_p", "ks_p")
    return report.withColumns({
        "framework_passes_aa_test": p > level,
        "framework_passes_familywise": p > level / 3,
    })


def ab_flags(report: DataFrame, level: float = SIGNIFICANCE) -> DataFrame:
    return report.withColumn("is_statistically_significant", F.col("welch_p") < level)


def paired_moments(df: DataFrame, a: str, b: str) -> DataFrame:
    both = df.selectExpr(f"{finite_sql(a)} as a", f"{finite_sql(b)} as b").where(
        "a is not null and b is not null"
    )
    return both.agg(*[
        F.expr(e) for e in (
            "count(*) as n", "avg(a - b) as mean_diff", "stddev_pop(a - b) as std_diff",
            "avg(abs(a - b)) as mean_abs_diff", "max(abs(a - b)) as max_abs_diff",
            "avg(a - b) / nullif(stddev_samp(a - b) / sqrt(count(*)), 0.0D) as paired_t",
            corr_sql("a", "b") + " as pearson_correlation",
        )
    ])


def wilcoxon(df: DataFrame, a: str, b: str) -> DataFrame:
    """Signed-rank statistic of a - b (zero differences left out) and its normal score."""
    d = f"({finite_sql(a)} - {finite_sql(b)})"
    diffs = df.selectExpr(f"{d} as d").where("d is not null and d <> 0").selectExpr("abs(d) as size", "d > 0 as up")
    counts = value_counts(diffs, ["size"], {"n": "1", "up": "if(up, 1, 0)"})
    placed = running_sums(counts, ["n"]).selectExpr("*", "cum_n - n + (n + 1) / 2.0D as rank")
    sums = placed.agg(
        F.expr("cast(coalesce(sum(n), 0) as double) as n"),
        F.expr("coalesce(sum(up * rank), 0.0D) as w_plus"),
        F.expr("coalesce(sum(cast(n as double) * n * n - n), 0.0D) as ties"),
    ).selectExpr("*", "least(w_plus, n * (n + 1) / 2 - w_plus) as wilcoxon_w")
    spread = "sqrt((n * (n + 1) * (2 * n + 1) - ties / 2) / 24)"
    return sums.selectExpr(
        "cast(n as bigint) as n_nonzero", "wilcoxon_w",
        f"(wilcoxon_w - n * (n + 1) / 4) / nullif({spread}, 0.0D) as wilcoxon_z",
        "n <= 50 and ties = 0 as exact",
    )


def paired_tests(df: DataFrame, a: str, b: str) -> DataFrame:
    """Statistics of the paired comparison (no p-values yet)."""
    return (
        paired_moments(df, a, b)
        .crossJoin(wilcoxon(df, a, b))
        .crossJoin(spearman(df, a, b).withColumnRenamed("spearman_rho", "spearman_correlation"))
    )


def paired_report(df: DataFrame, a: str, b: str) -> DataFrame:
    """Paired tests with p-values, normality of the differences and agreement limits."""
    d = df.selectExpr(f"{finite_sql(a)} - {finite_sql(b)} as d").where("d is not null")
    sized = abs_diff_percentiles(df, a, b)
    report = (
        paired_tests(df, a, b).crossJoin(bland_altman(df, a, b).drop("n"))
        .crossJoin(shapiro_francia(d, "d").drop("n")).crossJoin(sized)
    )
    p_t = t_pvalue(F.col("paired_t"), F.col("n").cast("double") - 1)
    p_w = wilcoxon_pvalue(
        F.col("wilcoxon_w"), F.col("n_nonzero").cast("double"), F.col("wilcoxon_z"), F.col("exact")
    )
    # the order-score correlation falls with departure from normality: upper tail
    tail = normal_pvalue(F.col("shapiro_z")) / 2
    p_s = F.when(F.col("shapiro_z") > 0, tail).otherwise(1 - tail)
    return report.select(
        "*", p_t.alias("paired_ttest_p"), p_w.alias("paired_wilcoxon_p"), p_s.alias("diff_shapiro_p")
    ).withColumns({
        "significant": F.col("paired_ttest_p") < SIGNIFICANCE,
        "agree_on_rank": F.col("spearman_correlation") > 0.9,
        "method": F.when(F.col("exact"), "exact").otherwise("asymptotic"),
    })


def bland_altman(df: DataFrame, a: str, b: str) -> DataFrame:
    both = df.selectExpr(f"{finite_sql(a)} - {finite_sql(b)} as d").where("d is not null")
    return both.agg(
        F.expr("count(*) as n"), F.expr("avg(d) as bias"),
        F.expr(f"avg(d) - {AGREEMENT_Z}D * stddev_pop(d) as loa_lower"),
        F.expr(f"avg(d) + {AGREEMENT_Z}D * stddev_pop(d) as loa_upper"),
    )


def bland_altman_points(df: DataFrame, a: str, b: str, key: str, share: float = 1.0, seed: int = 42) -> DataFrame:
    """(key, pair mean, difference), hash-sampled when ``share`` is below 1."""
    rows = df if share >= 1.0 else df.where(hash_unit(key, seed) < share)
    return rows.selectExpr(f"`{key}`", f"(`{a}` + `{b}`) / 2 as pair_mean", f"`{a}` - `{b}` as diff")


def abs_diff_percentiles(df: DataFrame, a: str, b: str) -> DataFrame:
    q = exact_quantiles(df, {"d": f"abs({finite_sql(a)} - {finite_sql(b)})"}, [0.5, 0.9])["d"]
    p50, p90 = q if q else (None, None)
    return df.sparkSession.createDataFrame([(p50, p90)], "p50_abs_diff double, p90_abs_diff double")


def fold_wilcoxon(scores: DataFrame, model: str, fold: str, value: str, first: str, second: str) -> DataFrame:
    """Paired signed-rank test over the fold scores of two models.

    With few folds significance may be out of reach, so the smallest p that the
    number of folds allows is reported too.
    """
    pairs = scores.groupBy(fold).agg(
        F.max(F.when(F.col(model) == first, F.col(value))).alias("a"),
        F.max(F.when(F.col(model) == second, F.col(value))).alias("b"),
    )
    p = wilcoxon_pvalue(
        F.col("wilcoxon_w"), F.col("n_nonzero").cast("double"), F.col("wilcoxon_z"), F.col("exact")
    )
    return wilcoxon(pairs, "a", "b").select(
        "n_nonzero", "wilcoxon_w", p.alias("wilcoxon_p"),
        F.pow(F.lit(2.0), 1 - F.col("n_nonzero")).alias("min_attainable_p"),
    )


def model_comparison(scores: DataFrame, first: str, second: str) -> DataFrame:
    """Mean and population std of the fold scores per model, and the champion.

    ``scores`` has (model, fold, score); a tie goes to the second model.
    """
    def pick(m):
        return F.when(F.col("model") == m, F.col("score"))

    row = scores.agg(
        F.avg(pick(first)).alias("first_mean"), F.stddev_pop(pick(first)).alias("first_std"),
        F.avg(pick(second)).alias("second_mean"), F.stddev_pop(pick(second)).alias("second_std"),
    )
    return row.withColumns({
        "diff_mean": F.col("first_mean") - F.col("second_mean"),
        "champion": F.when(F.col("first_mean") > F.col("second_mean"), first).otherwise(second),
    })


def outlier_verdict(df: DataFrame, flag: str, target: str, total_iqr: int | None = None) -> DataFrame:
    """Do flagged rows have an unusual target? KS of flagged against the rest, and advice."""
    arms = df.selectExpr(f"if(`{flag}`, 1, 0) as arm", f"`{target}` as y")
    report = rank_tests(arms, "y").withColumn(
        "ks_p", F.when(F.col("_m") > 5, ks_pvalue(F.col("ks_stat"), F.col("_n"), F.col("_m")))
    )
    none_found = F.col("_m") == 0 if total_iqr is None else (F.col("_m") == 0) & F.lit(total_iqr == 0)
    verdict = (
        F.when(none_found, "keep all rows: nothing flagged")
        .when(F.col("ks_p") < SIGNIFICANCE, "keep all rows: flagged rows carry signal")
        .otherwise("keep all rows: models and transform are robust to outliers")
    )
    return report.select(
        F.col("_m").cast("bigint").alias("n_flagged"), F.col("_n").cast("bigint").alias("n_rest"),
        "ks_stat", "ks_p", verdict.alias("verdict"),
    )
