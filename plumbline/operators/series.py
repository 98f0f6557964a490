"""Chart series as tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.config import IQR_FACTOR
from plumbline.functions.special import normal_quantile
from plumbline.operators.drift import with_bins
from plumbline.operators.longform import finite_sql, stack
from plumbline.operators.quantiles import exact_quantiles
from plumbline.operators.ranks import running_sums, value_counts


def histogram_density(
    df: DataFrame, cols: Sequence[str], bins: int = 25, by: str | None = None,
    shared_range: bool = False,
) -> DataFrame:
    """Equal-width density histogram per column, on each population's own range
    (as a plotting library does) or on one shared range."""
    group = f"`{by}`" if by else "'all'"
    rows = df.selectExpr(f"{group} as population", *[f"{finite_sql(c)} as `{c}`" for c in cols])
    long = stack(rows, ["population"], [{"feature": f"'{c}'", "x": f"`{c}`"} for c in cols]).where("x is not null")
    keys = ["feature"] if shared_range else ["feature", "population"]
    ranges = long.groupBy(*keys).agg(F.min("x").alias("lo"), F.max("x").alias("hi"))
    placed = long.join(F.broadcast(ranges), keys).selectExpr(
        "feature", "population", "lo", "hi",
        f"if(hi = lo, 0, least(cast(floor((x - lo) / ((hi - lo) / {bins})) as int), {bins - 1})) as bin",
    )
    counts = placed.groupBy("feature", "population", "bin", "lo", "hi").agg(F.count("*").alias("n"))
    return counts.selectExpr(
        "feature", "population", "bin",
        f"lo + bin * (hi - lo) / {bins} as left_edge", "n",
        f"n / nullif(sum(n) over (partition by feature, population) * ((hi - lo) / {bins}), 0.0D) as density",
    )


def histogram_edges(df: DataFrame, col: str, edges: Sequence[float]) -> DataFrame:
    """Counts in given bins (last one closed); values outside all bins are left out."""
    x = df.selectExpr(f"{finite_sql(col)} as x")
    if len(edges) == 2:  # one bin, closed on both sides
        binned = x.selectExpr(f"if(x between {float(edges[0])!r}D and {float(edges[1])!r}D, 0, null) as x__bin")
    else:
        binned = with_bins(x, {"x": list(edges)})
    counted = binned.where("x__bin is not null").groupBy("x__bin").agg(
        F.count("*").alias("n")
    )
    grid = df.sparkSession.createDataFrame(
        [(i, float(a), float(b)) for i, (a, b) in enumerate(zip(edges[:-1], edges[1:]))],
        "bin int, low double, high double",
    )
    return grid.join(counted, F.expr("bin = x__bin"), "left").selectExpr(
        "bin", "low", "high", "coalesce(n, 0L) as n"
    )


def boxplot_by_group(df: DataFrame, group: str, value: str, groups: Sequence) -> DataFrame:
    """Quartiles, whiskers (last values within 1.5 ranges) and outside counts per group."""
    x = finite_sql(value)
    cells = {str(g): f"if(`{group}` = {g!r}, {x}, null)" for g in groups}
    q = exact_quantiles(df, cells, [0.25, 0.5, 0.75])
    rows = []
    for g in groups:
        if q[str(g)]:
            q1, q2, q3 = q[str(g)]
            rows.append((g, q1, q2, q3, q1 - IQR_FACTOR * (q3 - q1), q3 + IQR_FACTOR * (q3 - q1)))
    kind = dict(df.dtypes)[group]
    fences = df.sparkSession.createDataFrame(
        rows, f"`{group}` {kind}, q1 double, median double, q3 double, lo double, hi double"
    )
    ends = df.select(group, F.expr(f"{x} as x")).where("x is not null").join(
        F.broadcast(fences.select(group, "lo", "hi")), group
    ).groupBy(group).agg(
        F.expr("min(if(x >= lo, x, null)) as whisker_low"),
        F.expr("max(if(x <= hi, x, null)) as whisker_high"),
        F.expr("count_if(x < lo or x > hi) as n_outside"),
    )
    return fences.drop("lo", "hi").join(ends, group)


def ecdf(df: DataFrame, expr: str) -> DataFrame:
    """(value, n, height): the height of the last of n equal values, i / (rows - 1)."""
    counts = running_sums(value_counts(df.selectExpr(f"{expr} as x"), ["x"]), ["n"])
    return counts.selectExpr("value", "n", "(cum_n - 1) / nullif(tot_n - 1, 0) as height")


def qq_points(df: DataFrame, expr: str, points: int | None = 1000) -> DataFrame:
    """Normal quantiles at evenly spaced positions .01 .. .99 against order statistics.

    At most ``points`` rows for a chart; a sample value is the exact order statistic at the
    lower rank of its position. ``points=None``: every row has its own position. The rows of a
    value that many share are dealt out in pieces.
    """
    counts = running_sums(value_counts(df.selectExpr(f"{expr} as x"), ["x"]), ["n"])
    if points is None:
        piece = 1000
        pieces = counts.selectExpr("value", "cum_n - n as start", "cum_n", "tot_n", f"explode(sequence(0L, (n - 1) div {piece})) as part").repartition("start", "part")
        rows = pieces.selectExpr(
            "value as sample", "tot_n", f"explode(sequence(start + part * {piece}, least(start + (part + 1) * {piece}, cum_n) - 1)) as place")
        out = rows.selectExpr("place", "0.01D + 0.98D * place / greatest(tot_n - 1, 1) as position", "sample")
        return out.withColumn("theoretical", normal_quantile(F.col("position")))
    scale = f"cast({points - 1} as double) / greatest(tot_n - 1, 1)"
    hits = counts.selectExpr(
        "value", f"ceil((cum_n - n) * {scale}) as a",
        f"least(ceil(cum_n * {scale}) - 1, {points - 1}) as b",
    ).where("a <= b").selectExpr("value as sample", "explode(sequence(a, b)) as i")
    out = hits.selectExpr("i as place", f"0.01D + 0.98D * i / {points - 1} as position", "sample")
    return out.withColumn("theoretical", normal_quantile(F.col("position")))


def concordance(records: DataFrame, by: str) -> DataFrame:
    """PSI against KS and the shift in sigmas, one point per drift record."""
    return records.selectExpr(
        f"`{by}`", "feature", "psi", "ks_stat", "shift_sigma", "abs(shift_sigma) > 0.1 as shifted", "severity"
    )


def cumulative_share(df: DataFrame, item: str, amount: str, level: float = 0.95) -> DataFrame:
    """Running share of a small table's total in falling order, and the place reaching ``level``."""
    order = f"order by {amount} desc, {item}"
    return df.selectExpr(
        item, amount,
        f"row_number() over ({order}) as place",
        f"sum({amount}) over ({order} rows between unbounded preceding and current row)"
        f" / sum({amount}) over () as cumulative",
    ).selectExpr("*", f"min(if(cumulative >= {level}D, place, null)) over () as n_for_level")
