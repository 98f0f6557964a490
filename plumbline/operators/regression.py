"""Agreement between a target and a prediction, residual diagnostics, associations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plumbline.config import METRIC_EPS, NONLINEARITY_GAP, R2_CEILING
from plumbline.functions.special import normal_pvalue, t_pvalue
from plumbline.operators.drift import with_bins
from plumbline.operators.longform import corr_sql, finite_sql, stack
from plumbline.operators.quantiles import exact_quantiles
from plumbline.operators.ranks import attach, average_ranks, running_sums, value_counts
from plumbline.session import stage

#: Ranks that one array of order scores holds.
RANK_CHUNK = 1000


def with_ranks(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Adds ``<column>__rank`` (average rank). Rows with a missing value are dropped."""
    table = stage(average_ranks(df, cols), "ranks")
    for c in cols:
        mine = table.where(F.col("feature") == c).selectExpr(
            f"value as `{c}`", "n as _n", f"avg_rank as `{c}__rank`", "tot_n as _tot"
        )
        df = attach(df.withColumn(c, F.expr(f"{finite_sql(c)} + 0.0D")), mine, [c], "_n", "_tot")
    return df


def spearman(df: DataFrame, x: str, y: str) -> DataFrame:
    """Rank correlation over the rows where both numbers are present; ranks count only those rows."""
    both = df.selectExpr(f"{finite_sql(x)} as `{x}`", f"{finite_sql(y)} as `{y}`").where(
        F.col(x).isNotNull() & F.col(y).isNotNull()
    )
    return with_ranks(both, [x, y]).agg(F.expr(corr_sql(f"`{x}__rank`", f"`{y}__rank`") + " as spearman_rho"))


def regression_metrics(df: DataFrame, y: str, yhat: str) -> DataFrame:
    """One row of fit metrics over rows where both numbers are present.

    All moments are centred (Welford style) aggregates, so large means do not
    cancel. SSE comes from the moments of the residual.
    """
    both = df.selectExpr(f"{finite_sql(y)} as y", f"{finite_sql(yhat)} as p").where(
        "y is not null and p is not null"
    )
    e = METRIC_EPS
    moments = both.agg(
        F.expr("count(*) as n"), F.expr("avg(y) as my"), F.expr("avg(p) as mp"),
        F.expr("var_pop(y) as vy"), F.expr("var_pop(p) as vp"), F.expr("covar_pop(y, p) as cov"),
        F.expr("avg(y - p) as mbe"), F.expr("avg(abs(y - p)) as mae"),
        F.expr("avg((y - p) * (y - p)) as mse"), F.expr(corr_sql("y", "p") + " as pearson_r"),
    )
    r2 = "1 - mse / nullif(vy, 0.0D)"
    fit = moments.selectExpr(
        "n", f"{r2} as r2", "sqrt(mse) as rmse", "mae",
        f"2 * cov / (vy + vp + (my - mp) * (my - mp) + {e!r}D) as ccc",
        f"1 - mse * n / (vy * n + {e!r}D) as nse",
        "mbe", "pearson_r", f"({r2}) / {R2_CEILING}D as efficiency",
    )
    return fit.crossJoin(spearman(both, "y", "p"))


def correlation_to_target(
    df: DataFrame, features: Sequence[str], target: str, flag: float = NONLINEARITY_GAP
) -> DataFrame:
    """Pearson, Spearman and the gap of their sizes per feature, each over the rows where both numbers are present.

    Ranks count those rows only. A feature that is present wherever the target is shares the target's
    ranks; each of the others ranks the target among its own rows.
    """
    y = finite_sql(target)
    # the target alone, and beside each feature; a feature counts only where the target is present
    wide = df.selectExpr(f"{y} + 0.0D as `{target}`", *[f"if({y} is null, null, {finite_sql(c)} + 0.0D) as `{c}`" for c in features])
    present = wide.agg(F.expr(f"array(count(`{target}`), {', '.join(f'count(`{c}`)' for c in features)}) as n")).first()["n"]
    odd = [c for c, n in zip(features, present[1:]) if 0 < n < present[0]]
    own = {c: f"{target}__beside_{c}" for c in odd}
    wide = wide.selectExpr("*", *[f"if(`{c}` is null, null, `{target}`) as `{own[c]}`" for c in odd])
    long = stack(wide, [target], [{"feature": f"'{c}'", "value": f"`{c}`"} for c in features]).where("value is not null")
    pearson = long.groupBy("feature").agg(F.expr(corr_sql("value", f"`{target}`") + " as pearson"))
    ranks = stage(average_ranks(wide, [*features, target, *own.values()]), "ranks")

    def facts(which, feature, value, rank):
        return ranks.where(which).selectExpr(f"feature as `{feature}`", f"value as `{value}`", "n as _n", f"avg_rank as {rank}", "tot_n as _tot")

    full = [c for c in features if c not in own]
    pairs = None
    if full:
        ranked = attach(wide.select(*full, target), facts(F.col("feature") == target, "_f", target, "ry").drop("_f"), [target], "_n", "_tot")
        pairs = stack(ranked, ["ry"], [{"feature": f"'{c}'", "value": f"`{c}`"} for c in full]).where("value is not null")
    if odd:
        rows = stack(wide, [], [
            {"feature": f"'{c}'", "value": f"`{c}`", "beside": f"'{own[c]}'", "_y": f"`{own[c]}`"} for c in odd]).where("value is not null")
        mine = attach(rows, facts(F.col("feature").isin(*own.values()), "beside", "_y", "ry"), ["beside", "_y"], "_n", "_tot")
        mine = mine.select("ry", "feature", "value")
        pairs = mine if pairs is None else pairs.unionByName(mine)
    rho = attach(pairs, facts(F.col("feature").isin(*features), "feature", "value", "rx"), ["feature", "value"], "_n", "_tot").groupBy("feature").agg(
        F.expr(corr_sql("rx", "ry") + " as spearman")
    )
    return pearson.join(rho, "feature").selectExpr(
        "feature", "pearson", "spearman",
        "abs(pearson) as abs_pearson", "abs(spearman) as abs_spearman",
        "abs(spearman) - abs(pearson) as nonlinearity_gap",
        f"abs(spearman) - abs(pearson) > {flag}D as nonlinear",
    )


def mutual_information(df: DataFrame, features: Sequence[str], target: str, bins: int = 20) -> DataFrame:
    """Mutual information (nats) of every feature with the target over equal-frequency bins.

    The contingency table has at most features x bins x bins rows.
    """
    cols = [*features, target]
    q = exact_quantiles(df, cols, [i / bins for i in range(bins + 1)])
    edges = {c: sorted(set(q[c])) for c in cols}
    wide = df.selectExpr(*[f"{finite_sql(c)} as `{c}`" for c in cols])
    # a column with one value carries no information: every row falls in bin 0
    flat = [c for c in cols if len(edges[c]) < 3]
    binned = with_bins(wide, edges)
    if flat:
        binned = binned.selectExpr(
            *[f"if(`{c}` is null, null, {_two_way(edges[c], c)}) as `{c}__bin`" if c in flat else f"`{c}__bin`" for c in cols]
        )
    cells = (
        stack(binned, [], [
            {"feature": f"'{c}'", "bx": f"`{c}__bin`", "by": f"`{target}__bin`"} for c in features
        ])
        .where("bx is not null and by is not null")
        .groupBy("feature", "bx", "by").agg(F.count("*").alias("n"))
    )
    shares = cells.selectExpr(
        "feature", "n",
        "sum(n) over (partition by feature, bx) as nx",
        "sum(n) over (partition by feature, by) as ny",
        "sum(n) over (partition by feature) as nt",
    )
    mi = "sum(n / nt * ln(cast(n as double) * nt / (cast(nx as double) * ny))) as mutual_info"
    return shares.groupBy("feature").agg(F.expr(mi))


def _two_way(edges: list[float], c: str) -> str:
    return "0" if len(edges) < 2 else f"if(`{c}` >= {edges[1]!r}D, 1, 0)"


def residual_moments(df: DataFrame, y: str, yhat: str) -> DataFrame:
    """Jarque-Bera normality of the residual and the correlation of its size with the fit."""
    both = df.selectExpr(f"{finite_sql(y)} - {finite_sql(yhat)} as e", f"{finite_sql(yhat)} as p").where(
        "e is not null"
    )
    return both.agg(
        F.expr("count(*) as n"),
        F.expr("skewness(e) as skew"), F.expr("kurtosis(e) as excess_kurtosis"),
        F.expr(corr_sql("p", "abs(e)") + " as heteroscedasticity_r"),
    ).selectExpr(
        "n", "skew", "excess_kurtosis",
        "n / 6.0D * (skew * skew + excess_kurtosis * excess_kurtosis / 4) as jarque_bera",
        "exp(-n / 12.0D * (skew * skew + excess_kurtosis * excess_kurtosis / 4)) as jarque_bera_p",
        "heteroscedasticity_r",
        "heteroscedasticity_r * sqrt((n - 2) / nullif(1 - heteroscedasticity_r * heteroscedasticity_r, 0.0D))"
        " as heteroscedasticity_t",
    )


def ordered_index(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """Adds ``row_index`` (0-based) in the given total order.

    Rows are range partitioned and written out, which fixes the partition of every
    row; after that an index is a count inside a partition plus an offset. Order
    columns should end in a row key, so that no run of equal keys grows long.
    """
    n = max(
        df.sparkSession.sparkContext.defaultParallelism,
        int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")),
    )
    placed = stage(
        df.repartitionByRange(n, *order).withColumn("_part", F.spark_partition_id()), "ordered"
    )
    sizes = placed.groupBy("_part").agg(F.count("*").alias("_n")).selectExpr(
        "_part",
        "coalesce(sum(_n) over (order by _part rows between unbounded preceding and 1 preceding), 0) as _before",
    )
    inside = f"row_number() over (partition by _part order by {', '.join(order)}) - 1"
    local = placed.selectExpr("*", f"{inside} as _local")
    return local.join(F.broadcast(sizes), "_part").selectExpr(
        *df.columns, "_before + _local as row_index", "_part"
    )


def durbin_watson(df: DataFrame, y: str, yhat: str, order: Sequence[str]) -> DataFrame:
    """Sum of squared successive residual differences over the sum of squares.

    Differences inside a range partition come from ``lag``; the joints between
    partitions come from one first and one last row per partition.
    """
    e = df.selectExpr(*order, f"{finite_sql(y)} - {finite_sql(yhat)} as e").where("e is not null")
    rows = ordered_index(e, order)
    inner = rows.selectExpr(
        "_part", "row_index", "e", "lag(e) over (partition by _part order by row_index) as prev"
    )
    parts = inner.groupBy("_part").agg(
        F.expr("sum((e - prev) * (e - prev)) as ss_diff"), F.expr("sum(e * e) as ss"),
        F.expr("count(*) as n"),
        F.expr("min_by(e, row_index) as first_e"), F.expr("max_by(e, row_index) as last_e"),
    )
    joints = parts.selectExpr(
        "coalesce(ss_diff, 0.0D) + coalesce(pow(first_e - lag(last_e) over (order by _part), 2), 0.0D) as d",
        "ss", "n",
    )
    return joints.agg(F.expr("sum(n) as n"), F.expr("sum(d) / sum(ss) as durbin_watson"))


def _slice_ends(df: DataFrame, order: Sequence[str], k: int) -> list[tuple]:
    """Where slices 1..k end: (first value, key, rows of just that place that are before the end). No sort of
    the rows: counts per first value, then per leading bytes of the key, then single keys."""
    first, key = order
    short = f"substring(`{key}`, 1, {2 if dict(df.dtypes)[key] == 'binary' else 4})"
    days = df.groupBy(first).agg(F.count("*").alias("n")).collect()
    null_first = lambda v: (v is not None, v if v is not None else 0)
    ends, size = [], sum(r["n"] for r in days) // k
    for j in range(1, k + 1):
        left, where = j * size - 1, F.lit(True)  # the last row before the end
        for column, same in ((F.col(first), days), (F.expr(short), None), (F.col(key), None)):
            found = same or df.where(where).groupBy(column.alias("v")).agg(F.count("*").alias("n")).collect()
            for v, n in sorted(((r[0], r["n"]) for r in found), key=lambda r: null_first(bytes(r[0]) if isinstance(r[0], bytearray) else r[0])):
                if left < n:
                    break
                left -= n
            where = where & column.eqNullSafe(F.lit(bytes(v) if isinstance(v, bytearray) else v))
            if column is not None and same:
                day = v
        ends.append((day, bytes(v) if isinstance(v, bytearray) else v, left + 1, n))
    return ends


def _slices_by_ends(df: DataFrame, order: Sequence[str], k: int) -> DataFrame:
    """``batch`` from where each slice ends; of equal rows around an end just as many as fit go before it."""
    first, key = order
    if df.limit(k).count() < k:
        return df.withColumn("batch", F.lit(1)).where(F.lit(False))
    ends = _slice_ends(df, order, k)
    at = lambda e: F.col(first).eqNullSafe(F.lit(e[0])) & F.col(key).eqNullSafe(F.lit(e[1]))

    def after(e):
        def above(c, v):
            return F.col(c).isNotNull() if v is None else F.coalesce(F.col(c) > F.lit(v), F.lit(False))
        return above(first, e[0]) | (F.col(first).eqNullSafe(F.lit(e[0])) & above(key, e[1]))

    def batch(past):
        """1 + the slices that end before the row."""
        return sum((F.when(past(e), 1).otherwise(0) for e in ends), F.lit(1))

    split = [e for e in ends if e[2] < e[3]]
    if not split:
        return df.withColumn("batch", batch(after)).where(F.col("batch") <= k)
    odd = sum((F.when(at(e), 1).otherwise(0) for e in split), F.lit(0)) > 0
    place = F.row_number().over(Window.partitionBy(first, key).orderBy(F.lit(1)))
    some = df.where(odd).withColumn("_place", place).withColumn("batch", batch(lambda e: after(e) | (at(e) & (F.col("_place") > e[2]))))
    return df.where(~odd).withColumn("batch", batch(after)).unionByName(some.drop("_place")).where(F.col("batch") <= k)


def batch_slices(df: DataFrame, order: Sequence[str], k: int = 4, index: bool = True) -> DataFrame:
    """Adds ``batch`` 1..k: equal consecutive slices in order; the remainder is left out.

    Without ``index`` (``order``: a coarse column and a key of letters or bytes) no row is moved or written
    and ``row_index`` isn't added.
    """
    if not index:
        return _slices_by_ends(df, order, k)
    rows = ordered_index(df, order)
    size = rows.agg(F.expr(f"cast(floor(count(*) / {k}) as bigint) as _size"))
    return (
        rows.crossJoin(F.broadcast(size))
        .where(F.expr(f"_size > 0 and row_index < {k} * _size"))
        .withColumn("batch", F.expr("cast(floor(row_index / _size) + 1 as int)"))
        .drop("_size", "_part")
    )


def shapiro_francia(df: DataFrame, x: str) -> DataFrame:
    """Squared correlation of the ordered values with normal order scores, and its p.

    Every rank has its own score, also inside a run of equal values. Ranks are cut into chunks,
    so a value that many rows share is spread over tasks.
    """
    from plumbline.functions.special import normal_quantile, shapiro_francia_z

    counts = running_sums(value_counts(df, [x]), ["n"])
    chunks = counts.selectExpr(
        "value", "cum_n", "tot_n", "cum_n - n as start", f"explode(sequence(0L, (n - 1) div {RANK_CHUNK})) as chunk"
    ).selectExpr(
        "value", "tot_n", f"start + chunk * {RANK_CHUNK} + 1 as lo", f"least(start + (chunk + 1) * {RANK_CHUNK}, cum_n) as hi"
    ).repartition("lo")
    scores = F.transform(
        F.sequence("lo", "hi"), lambda i: normal_quantile((i - F.lit(0.375)) / (F.col("tot_n") + F.lit(0.25))))
    total = lambda a: F.aggregate(a, F.lit(0.0), lambda t, m: t + m)
    scored = chunks.withColumn("_m", scores).select(
        "value", "tot_n", F.expr("hi - lo + 1").alias("k"), total(F.col("_m")).alias("m"),
        total(F.transform("_m", lambda m: m * m)).alias("mm"))
    mean = scored.agg(F.expr("max(tot_n) as n"), F.expr("sum(k * value) / sum(k) as mx"))
    return (
        scored.drop("tot_n").crossJoin(F.broadcast(mean))
        .groupBy("n").agg(F.expr(
            "pow(sum((value - mx) * m), 2) / (sum(k * (value - mx) * (value - mx)) * sum(mm)) as shapiro_w"
        ))
        .withColumn("shapiro_z", shapiro_francia_z(F.col("shapiro_w"), F.col("n")))
    )


def residual_diagnostics(df: DataFrame, y: str, yhat: str, order: Sequence[str]) -> DataFrame:
    """r2, normality, heteroscedasticity and autocorrelation of the residual in one row."""
    both = df.selectExpr(f"{finite_sql(y)} as y", f"{finite_sql(yhat)} as p").where("y is not null and p is not null")
    r2 = both.agg(F.expr("1 - avg((y - p) * (y - p)) / nullif(var_pop(y), 0.0D) as oof_r2"))
    return (
        residual_moments(df, y, yhat).crossJoin(r2)
        .crossJoin(durbin_watson(df, y, yhat, order).drop("n"))
    )


def with_residual_pvalues(diagnostics: DataFrame) -> DataFrame:
    t, n = F.col("heteroscedasticity_t"), F.col("n").cast("double")
    return diagnostics.withColumn("heteroscedasticity_p", t_pvalue(t, n - 2))


def with_normal_pvalue(df: DataFrame, z: str, name: str) -> DataFrame:
    return df.withColumn(name, normal_pvalue(F.col(z)))
