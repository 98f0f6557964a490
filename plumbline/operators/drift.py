"""Distribution drift of many features and batches against one reference.

One tagged long frame feeds everything: bin counts and moments (PSI), and counted
values in bucketed order (Kolmogorov-Smirnov, Wasserstein). The reference is never
copied per batch.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from plumbline.config import PSI_BINS, PSI_EPS, DriftThresholds
from plumbline.functions.scalar import batch_severity, severity
from plumbline.functions.special import ks_pvalue
from plumbline.operators.longform import finite_sql, stack, with_buckets
from plumbline.operators.quantiles import exact_quantiles
from plumbline.operators.ranks import ROWS_PER_BUCKET, running_sums, value_counts
from plumbline.session import stage

REFERENCE = "(reference)"
#: Rows without a batch are a batch of their own.
NO_BATCH = "(no batch)"
#: Severity of a feature without any value on one side.
MISSING = "missing"


def decile_edges(reference: DataFrame, cols: Sequence[str], bins: int = PSI_BINS) -> dict[str, list[float]]:
    """Distinct quantile edges per column, the outer two widened a little."""
    q = exact_quantiles(reference, cols, [i / bins for i in range(bins + 1)])
    edges = {}
    for c in cols:
        e = sorted(set(q[c]))
        if len(e) >= 3:
            e[0] -= PSI_EPS
            e[-1] += PSI_EPS
        edges[c] = e
    return edges


def with_bins(df: DataFrame, edges: dict[str, list[float]], clip: bool = False) -> DataFrame:
    """Adds ``<column>__bin``: 0-based bin [e0,e1), [e1,e2), ..., last bin closed.

    Out of range is null, or the nearest outer bin with ``clip``.
    """
    kept = df.columns
    usable = {c: e for c, e in edges.items() if len(e) >= 3}
    df = with_buckets(df, {c: [*e[:-1], math.nextafter(e[-1], math.inf)] for c, e in usable.items()})
    bins = []
    for c in edges:
        if c not in usable:
            bins.append(f"cast(null as int) as `{c}__bin`")
            continue
        top, b = len(usable[c]) - 2, f"`{c}__bucket` - 1"
        inside = f"least(greatest({b}, 0), {top})" if clip else f"if({b} between 0 and {top}, {b}, null)"
        bins.append(f"if(`{c}` is null, null, {inside}) as `{c}__bin`")
    return df.selectExpr(*[f"`{c}`" for c in kept], *bins)


def tag(reference: DataFrame, current: DataFrame, cols: Sequence[str], by: str) -> DataFrame:
    """Both sides in one frame; the reference and rows without a batch carry fixed batch names."""
    pick = [f"{finite_sql(c)} as `{c}`" for c in cols]
    return reference.selectExpr(f"'{REFERENCE}' as `{by}`", *pick).unionByName(
        current.selectExpr(f"coalesce(cast(`{by}` as string), '{NO_BATCH}') as `{by}`", *pick)
    )


def bin_summaries(
    tagged: DataFrame, edges: dict[str, list[float]], by: str, clip: bool = False
) -> DataFrame:
    """(feature, by, n_bins, n, moments, counts, n_in): one row per feature and batch.

    Every feature has a row in every batch, with n = 0 where all its values are null.
    """
    width = max([len(e) - 1 for e in edges.values()] + [1])
    long = stack(
        with_bins(tagged, edges, clip),
        [by],
        [
            {
                "fi": str(i),
                "value": f"`{c}`",
                "bin": f"`{c}__bin`",
            }
            for i, c in enumerate(edges)
        ],
    )
    per_bin = ", ".join(f"count_if(bin = {i})" for i in range(width))
    moments = [
        "count(value) as n", "avg(value) as mean",
        "stddev_pop(value) as std", "stddev_samp(value) as std_samp",
        "min(value) as low", "max(value) as high",
        f"array({per_bin}) as counts", "count(bin) as n_in",
    ]
    summed = long.groupBy("fi", by).agg(*[F.expr(e) for e in moments])
    names = ",".join(f"'{c}'" for c in edges)
    sizes = ",".join(str(len(e) - 1 if len(e) >= 3 else 0) for e in edges.values())
    return summed.selectExpr(
        f"array({names})[fi] as feature", f"`{by}`", f"array({sizes})[fi] as n_bins",
        "n", "mean", "std", "std_samp", "low", "high",
        f"slice(counts, 1, array({sizes})[fi]) as counts", "n_in",
    )


def psi_of_counts(ref: Column, cur: Column, ref_total: Column, cur_total: Column) -> Column:
    """PSI of two count arrays over the same bins; 0 when the edges collapsed."""
    k = F.size(ref).cast("double")
    eps = F.lit(PSI_EPS)

    def share(c, total):
        return (c + eps) / (total + eps * k)

    terms = F.zip_with(
        ref, cur,
        lambda r, c: (share(c, cur_total) - share(r, ref_total))
        * F.log(share(c, cur_total) / share(r, ref_total)),
    )
    return F.when(F.size(ref) < 2, F.lit(0.0)).otherwise(
        F.aggregate(terms, F.lit(0.0), lambda a, t: a + t)
    )


def psi_table(summaries: DataFrame, by: str) -> DataFrame:
    """PSI and moments of every batch against the reference row of its feature.

    PSI is null where one side has no value.
    """
    ref = summaries.where(F.col(by) == REFERENCE).select(
        "feature", "n_bins",
        F.col("n").alias("n_ref"), F.col("mean").alias("ref_mean"), F.col("std").alias("ref_std"),
        F.col("std_samp").alias("ref_std_samp"),
        F.col("counts").alias("_rc"), F.col("n_in").alias("_rn"),
    )
    cur = summaries.where(F.col(by) != REFERENCE).select(
        "feature", by,
        F.col("n").alias("n_cur"), F.col("mean").alias("cur_mean"), F.col("std").alias("cur_std"),
        F.col("std_samp").alias("cur_std_samp"),
        F.col("counts").alias("_cc"), F.col("n_in").alias("_cn"),
    )
    return cur.join(ref, "feature").select(
        "feature", by, "n_ref", "n_cur", "n_bins",
        F.when((F.col("n_ref") > 0) & (F.col("n_cur") > 0), psi_of_counts(
            F.col("_rc"), F.col("_cc"), F.col("_rn"), F.col("_cn"))).alias("psi"),
        "ref_mean", "cur_mean", "ref_std", "cur_std", "ref_std_samp", "cur_std_samp",
        (F.col("cur_mean") - F.col("ref_mean")).alias("mean_shift"),
        (100.0 * (F.col("n_cur") - F.col("_cn")) / F.nullif("n_cur", F.lit(0))).alias("out_of_range_pct"),
        F.when(F.col("n_bins") > 0, F.array_min("_rc")).alias("min_bin_ref"),
    ).withColumn("out_of_range_pct", F.when(F.col("n_bins") > 0, F.col("out_of_range_pct")))


def psi(
    reference: DataFrame,
    current: DataFrame,
    cols: Sequence[str],
    by: str,
    bins: int = PSI_BINS,
    clip: bool = False,
) -> DataFrame:
    edges = decile_edges(reference, cols, bins)
    return psi_table(bin_summaries(tag(reference, current, cols, by), edges, by, clip), by)


def _positions(tagged: DataFrame, cols: Sequence[str], by: str, rows_per_bucket: int) -> DataFrame:
    """Every distinct value with its place in the reference and in its own batch."""
    counts = value_counts(tagged, cols, by=[by], rows_per_bucket=rows_per_bucket)
    # sums of values are taken around the reference mean, or a large offset would cancel all digits
    centers = counts.where(F.col(by) == REFERENCE).groupBy("feature").agg(
        F.expr("sum(n * value) / sum(n) as _center")
    )
    counts = counts.join(F.broadcast(centers), "feature", "left").selectExpr(  # a row per feature
        "feature", "bucket", f"`{by}`", "value", "n", "value - coalesce(_center, 0.0D) as off",
        f"if(`{by}` = '{REFERENCE}', n, 0) as rn",
    ).selectExpr("*", "rn * off as rs")
    placed = running_sums(counts, ["rn", "rs"]).selectExpr(
        "*",
        "sum(rn) over (partition by bucket order by value range between current row and current row) as rn_here",
    )
    return running_sums(placed, ["n"], ["feature", by], base=counts)


def ks_table(reference, current, cols, by, rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """Exact two-sample KS per feature and batch.

    Between two batch values the batch CDF is flat and the reference CDF only
    rises, so the largest gap sits at a batch value or just before one.
    """
    return _ks(_positions(tag(reference, current, cols, by), cols, by, rows_per_bucket), by)


# largest distance between the two CDFs at a batch value and just below it
_GAP = (
    "greatest(cum_n / tot_n - cum_rn / tot_rn,"
    " (cum_rn - rn_here) / tot_rn - (cum_n - n) / tot_n)"
)


def _ks(placed: DataFrame, by: str) -> DataFrame:
    best = placed.where(f"`{by}` <> '{REFERENCE}' and tot_rn > 0").groupBy("feature", by).agg(
        F.expr(f"max({_GAP}) as ks_stat"), F.expr("max(tot_rn) as _n"), F.expr("max(tot_n) as _m")
    )
    p = ks_pvalue(F.col("ks_stat"), F.col("_n"), F.col("_m"))
    return best.select("feature", by, "ks_stat", p.alias("ks_pvalue"))


def ks_and_wasserstein(
    reference, current, cols, by, rows_per_bucket: int = ROWS_PER_BUCKET
) -> DataFrame:
    """KS plus the exact 1-Wasserstein distance, without copying the reference per batch.

    With G(x) the integral of the reference CDF up to x and H(c) the integral of its
    quantile function up to level c, the area between the reference CDF and the flat
    level c from the reference's c-quantile to x is  |G(x) - c x + H(c)|.  Each batch
    value adds that area for the level before it and takes away the one after it, with
    the sign of its side of the quantile. G is a running sum by value. H is a running
    sum by rank: only levels where the sign changes inside an interval need it, and
    they are looked up in rank buckets, which are balanced by construction.
    """
    # read three times below
    placed = stage(_positions(tag(reference, current, cols, by), cols, by, rows_per_bucket), "placed")
    batch = placed.where(f"`{by}` <> '{REFERENCE}' and tot_rn > 0").selectExpr(
        "feature", f"`{by}`", "bucket", "value", "tot_rn", "tot_n",
        f"{_GAP} as gap",
        "(cum_n - n) / tot_n as c0",
        "cum_n / tot_n as c1",
        "cum_rn / tot_rn as at",
        "off",
        "(off * cum_rn - cum_rs) / tot_rn as g",
    ).selectExpr("*", "if(at >= c0, 1.0D, -1.0D) as s0", "if(at >= c1, 1.0D, -1.0D) as s1")
    line = f"over (partition by bucket, `{by}` order by value)"
    steps = batch.selectExpr(
        "*", f"lag(s1) {line} as s_prev", f"lead(value) {line} is null as is_last"
    )
    direct = steps.groupBy("feature", by).agg(
        F.expr("max(gap) as ks_stat"),
        F.expr("sum(s0 * (g - c0 * off) - s1 * (g - c1 * off)) as w"),
        F.expr("max(tot_rn) as _n"), F.expr("max(tot_n) as _m"),
    )
    # levels whose quantile integral does not cancel with the neighbouring value
    probes = stack(
        steps, ["feature", by, "tot_rn"],
        [
            {"pos": "c0 * tot_rn", "weight": "s0 - coalesce(s_prev, 0.0D)"},
            {"pos": "c1 * tot_rn", "weight": "if(is_last, -s1, 0.0D)"},
        ],
    ).where("weight <> 0 and pos > 0")
    ref = placed.where(f"`{by}` = '{REFERENCE}' and tot_rn > 0")
    held = _quantile_integrals(ref, probes, by, rows_per_bucket)
    crossing = held.groupBy("feature", by).agg(F.expr("sum(weight * h) as wh"))
    p = ks_pvalue(F.col("ks_stat"), F.col("_n"), F.col("_m"))
    return direct.join(crossing, ["feature", by], "left").select(
        "feature", by, "ks_stat", p.alias("ks_pvalue"),
        F.expr("greatest(w + coalesce(wh, 0.0D), 0.0D) as wasserstein"),
    )


def _quantile_integrals(ref: DataFrame, probes: DataFrame, by: str, rows_per_bucket: int) -> DataFrame:
    """H at every probe: the first reference value whose running count reaches it."""
    points = ref.selectExpr(
        "feature", f"`{by}`", "cast(cum_rn as double) as pos", "tot_rn",
        "cast(null as double) as weight",
        "struct(off as value, cum_rn, rn, cum_rs) as step", "1 as is_ref",
    ).unionByName(
        probes.selectExpr("feature", f"`{by}`", "pos", "tot_rn", "weight", "0 as is_ref"),
        allowMissingColumns=True,
    ).selectExpr("*", f"floor(pos / {rows_per_bucket}) as slot")
    heads = points.groupBy("feature", "slot").agg(
        F.expr("min_by(step, if(is_ref = 1, pos, null)) as head")
    ).selectExpr(
        "feature", "slot",
        "last(head, true) over (partition by feature order by slot desc"
        " rows between unbounded preceding and 1 preceding) as next_head",
    )
    # reading downwards, the last reference row seen is the nearest one at or above
    found = points.selectExpr(
        "*",
        "last(step, true) over (partition by feature, slot order by pos desc, is_ref desc"
        " rows between unbounded preceding and current row) as hit",
    ).where("is_ref = 0")
    return found.join(heads, ["feature", "slot"]).withColumn(
        "hit", F.coalesce("hit", "next_head")
    ).selectExpr(
        "feature", f"`{by}`", "weight",
        "(hit.cum_rs - hit.rn * hit.value + (pos - (hit.cum_rn - hit.rn)) * hit.value) / tot_rn as h",
    )


def drift(
    reference: DataFrame,
    current: DataFrame,
    cols: Sequence[str],
    by: str,
    thresholds: DriftThresholds = DriftThresholds(),
    bins: int = PSI_BINS,
    clip: bool = False,
    rows_per_bucket: int = ROWS_PER_BUCKET,
) -> DataFrame:
    """The full drift record per (batch, feature), also where a feature has no value in a batch."""
    moments = psi(reference, current, cols, by, bins, clip)
    order = ks_and_wasserstein(reference, current, cols, by, rows_per_bucket)
    return with_severity(moments.join(order, ["feature", by], "left"), thresholds).withColumn(
        "shift_sigma", F.when(F.col("ref_std") > 0, F.col("mean_shift") / F.col("ref_std")).otherwise(0.0)
    )


def with_severity(records: DataFrame, thresholds: DriftThresholds = DriftThresholds()) -> DataFrame:
    """Adds ``severity``: that of PSI and KS, or ``missing`` without values on one side."""
    known = severity(F.col("psi"), F.col("ks_stat"), thresholds)
    return records.withColumn("severity", F.when((F.col("n_ref") == 0) | (F.col("n_cur") == 0), MISSING).otherwise(known))


def batch_summary(records: DataFrame, by: str) -> DataFrame:
    """PSI max / mean and alert / warning counts per batch; a missing feature is an alert."""
    return records.groupBy(by).agg(
        F.max("psi").alias("feature_psi_max"),
        F.avg("psi").alias("feature_psi_mean"),
        F.count_if(F.col("severity").isin("alert", MISSING)).alias("feature_n_alerts"),
        F.count_if(F.col("severity") == "warning").alias("feature_n_warnings"),
    )


def monitoring(
    feature_records: DataFrame,
    prediction_records: DataFrame,
    by: str,
    thresholds: DriftThresholds = DriftThresholds(),
) -> DataFrame:
    """One monitoring row per batch with the overall severity."""
    pred = prediction_records.select(
        by,
        F.col("n_cur").alias("n_rows"),
        F.col("psi").alias("prediction_psi"),
        F.col("ks_stat").alias("prediction_ks"),
        F.col("cur_mean").alias("prediction_mean"),
        F.when(F.col("severity") == MISSING, "alert").otherwise(F.col("severity")).alias("_ps"),
    )
    overall = batch_severity(
        F.col("_ps"), F.col("feature_n_alerts"), F.col("feature_n_warnings"), thresholds
    )
    return batch_summary(feature_records, by).join(pred, by).withColumn("severity", overall).drop("_ps")


def top_drift(records: DataFrame, by: str, k: int = 3, only: str | None = "alert") -> DataFrame:
    """The k features with the highest PSI per batch (of the given severity).

    A feature that is missing from a batch counts as an alert and comes before all others.
    """
    rows = records.where(F.col("severity").isin(only, *([MISSING] if only == "alert" else []))) if only else records
    place = F.row_number().over(W.partitionBy(by).orderBy(F.desc(F.col("severity") == MISSING), F.desc("psi"), "feature"))
    return rows.withColumn("place", place).where(F.col("place") <= k)


def shift_summary(reference: DataFrame, current: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Means and sample deviations of both sides and the shift in reference sigmas."""

    def side(df, prefix):
        items = ", ".join(
            f"struct('{c}' as feature, avg({finite_sql(c)}) as {prefix}_mean,"
            f" stddev_samp({finite_sql(c)}) as {prefix}_std)"
            for c in cols
        )
        return df.agg(F.expr(f"array({items}) as a")).selectExpr("inline(a)")

    both = side(reference, "train").join(side(current, "blind"), "feature")
    shift = F.when(
        F.col("train_std") > 0, (F.col("blind_mean") - F.col("train_mean")) / F.col("train_std")
    ).otherwise(0.0)
    return both.withColumn("shift_sigma", shift)


def shift_totals(summary: DataFrame) -> DataFrame:
    size = F.abs("shift_sigma")
    return summary.agg(
        F.max(size).alias("max_abs_shift_sigma"),
        F.avg(size).alias("mean_abs_shift_sigma"),
        F.count_if(size > 1).alias("n_features_shifted_gt_1sigma"),
        F.count_if(size > 2).alias("n_features_shifted_gt_2sigma"),
    )
