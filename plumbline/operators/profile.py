"""Column profiles, data quality counts and univariate outliers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.config import IQR_FACTOR, MAD_CUTOFF, MAD_SCALE
from plumbline.operators.longform import finite_sql
from plumbline.operators.quantiles import exact_quantiles


def table_shape(df: DataFrame) -> DataFrame:
    """(column, type, n_columns, n_rows): the schema as rows, counted in one pass."""
    cols = ", ".join(
        f"struct('{f.name}' as column, '{f.dataType.simpleString()}' as type)" for f in df.schema
    )
    return df.agg(F.count("*").alias("n_rows")).selectExpr(
        f"inline(array({cols}))", f"{len(df.columns)} as n_columns", "n_rows"
    )


def describe(df: DataFrame, cols: Sequence[str], digits: int = 3) -> DataFrame:
    """count, mean, sample std, min, max per column from one aggregate."""

    def item(c):
        x = f"cast(`{c}` as double)"
        return (
            f"struct('{c}' as feature, count({x}) as count, round(avg({x}), {digits}) as mean,"
            f" round(stddev_samp({x}), {digits}) as stddev,"
            f" round(min({x}), {digits}) as min, round(max({x}), {digits}) as max)"
        )

    items = ", ".join(item(c) for c in cols)
    return df.agg(F.expr(f"array({items}) as a")).selectExpr("inline(a)")


def null_counts(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Nulls and NaNs per column; the two are different things in Spark."""
    types = dict(df.dtypes)

    def item(c):
        nan = f"count_if(isnan(`{c}`))" if types[c] in ("double", "float") else "0L"
        return f"struct('{c}' as feature, count_if(`{c}` is null) as n_null, {nan} as n_nan)"

    items = ", ".join(item(c) for c in cols or df.columns)
    return df.agg(F.expr(f"array({items}) as a")).selectExpr("inline(a)")


def duplicate_rows(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Rows beyond the first of every distinct row: one grouped job, not two counts."""
    cols = list(cols or df.columns)
    return df.groupBy(*cols).agg(F.count("*").alias("n")).agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"),
        F.count("*").alias("n_distinct"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("n_duplicates"),
    )


def quantile_rows(df: DataFrame, cols: Sequence[str], probs: Sequence[float]) -> DataFrame:
    """(feature, prob, value): exact interpolated quantiles as rows."""
    q = exact_quantiles(df, cols, probs)
    rows = [(c, float(p), float(v)) for c in cols for p, v in zip(probs, q[c])]
    return df.sparkSession.createDataFrame(rows, "feature string, prob double, value double")


def _flag_counts(df: DataFrame, tests: dict[str, str | None], name: str) -> DataFrame:
    """Outliers per column; a column without values has none, and no percentage."""
    items = ", ".join(
        f"struct('{c}' as feature, count_if({t or 'false'}) as {name}_outliers, "
        + (f"100.0D * count_if({t}) / count(*)" if t else "cast(null as double)") + f" as {name}_pct)"
        for c, t in tests.items()
    )
    return df.agg(F.expr(f"array({items}) as a")).selectExpr("inline(a)")


def iqr_tests(df: DataFrame, cols: Sequence[str]) -> dict[str, str | None]:
    """SQL test per column: strictly outside the quartiles by 1.5 interquartile ranges."""
    tests = {}
    for c, quartiles in exact_quantiles(df, cols, [0.25, 0.75]).items():
        if not quartiles:
            tests[c] = None
            continue
        q1, q3 = quartiles
        reach = IQR_FACTOR * (q3 - q1)
        x = finite_sql(c)
        tests[c] = f"({x} < {q1 - reach!r}D or {x} > {q3 + reach!r}D)"
    return tests


def iqr_outliers(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return _flag_counts(df, iqr_tests(df, cols), "iqr")


def mad_scales(df: DataFrame, cols: Sequence[str]) -> dict[str, tuple[float | None, float | None]]:
    """(median, median absolute deviation) per column; None where it has no values."""
    med = {c: q[0] for c, q in exact_quantiles(df, cols, [0.5]).items() if q}
    filled = list(med)
    dev = exact_quantiles(df, {c: f"abs({finite_sql(c)} - {med[c]!r}D)" for c in filled}, [0.5]) if filled else {}
    return {c: (med[c], dev[c][0]) if c in med else (None, None) for c in cols}


def mad_outliers(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Rows whose modified z exceeds 3.5 in size; none where the deviation is 0."""
    tests = {}
    for c, (med, mad) in mad_scales(df, cols).items():
        if med is None:
            tests[c] = None
            continue
        z = f"abs({MAD_SCALE}D * ({finite_sql(c)} - {med!r}D) / {mad!r}D)"
        tests[c] = "false" if mad == 0 else f"({z} > {MAD_CUTOFF}D)"
    return _flag_counts(df, tests, "mad")


def univariate_outliers(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return iqr_outliers(df, cols).join(mad_outliers(df, cols), "feature")


def outlier_totals(summary: DataFrame) -> DataFrame:
    return summary.agg(
        F.sum("iqr_outliers").alias("total_iqr_outliers"),
        F.sum("mad_outliers").alias("total_mad_outliers"),
        F.max("iqr_pct").alias("max_iqr_pct_per_feature"),
        F.max("mad_pct").alias("max_mad_pct_per_feature"),
    )


def group_stats(df: DataFrame, group: str, value: str = "target") -> DataFrame:
    return df.groupBy(group).agg(
        F.count("*").alias("n"),
        F.avg(value).alias(f"{value}_mean"),
        F.stddev_samp(value).alias(f"{value}_std"),
    )


def eta_squared(df: DataFrame, group: str, value: str = "target") -> DataFrame:
    """Share of variance explained by the group: df-adjusted and classical forms.

    The total variance is put together from the groups, so one pass is enough.
    """
    groups = df.groupBy(group).agg(
        F.count(value).alias("n"), F.avg(value).alias("m"), F.var_samp(value).alias("v")
    )
    # one row per group from here on
    total = groups.crossJoin(groups.agg(F.expr("sum(n * m) / sum(n) as grand"))).agg(
        F.expr("sum(n) as n"), F.expr("count(*) as g"),
        F.expr("sum(v * (n - 1)) as within"),
        F.expr("sum(n * (m - grand) * (m - grand)) as between_"),
    )
    return total.selectExpr(
        "n as n_rows", "g as n_groups",
        "1 - (within / (n - g)) / ((within + between_) / (n - 1)) as eta_squared",
        "between_ / (within + between_) as eta_squared_classical",
    )
