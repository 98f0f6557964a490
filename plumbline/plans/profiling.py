"""Queries: scans, profiles, outliers, feature engineering, associations, series."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from plumbline.config import FEATURES
from plumbline.functions import scalar
from plumbline.functions.special import normal_pvalue
from plumbline.operators import models, profile, regression, series, transforms
from plumbline.operators.experiment import abs_diff_percentiles, bland_altman, bland_altman_points, outlier_verdict
from plumbline.operators.longform import corr_sql, feature_columns, to_long
from plumbline.operators.ranks import average_ranks
from plumbline.plans import fragments as S
from plumbline.plans.registry import query, rounded
from plumbline.session import shared_dir, stage
from plumbline.sources import fixtures as X

WF = X.WIDE_FEATURES
WIDE = f"WITH {S.WIDE}"
VEC = f"WITH {S.VECTORS}"
FE = S.fe_sql()
WIDE_ALL = [*WF, "target"]
WLONG = S.long("wide", WIDE_ALL)


@query("scan_shape", "SELECT count(*) AS n_rows, 11 AS n_columns FROM lineitem")
def scan_shape(spark, sf):
    df = X.read(spark, sf, "lineitem")
    return df.agg(F.count("*").alias("n_rows")).withColumn("n_columns", F.lit(len(df.columns)))


@query("table_shape", "SELECT * FROM (VALUES ('row_id','string'),('q','double'),('d','double'),('t','double'),"
       "('tp','double'),('ps','double'),('rp','double'),('sa','double'),('ca','double'),('target','double'),"
       "('dt','date'),('champ','double'),('chall','double')) v(\"column\", type), "
       f"(WITH {S.WIDE} SELECT 13 AS n_columns, count(*) AS n_rows FROM wide)")
def table_shape(spark, sf):
    return profile.table_shape(X.wide_table(spark, sf))


@query("select_features", f"{VEC} SELECT row_id, {', '.join(S.r(c, c) for c in FEATURES)} FROM vectors")
def select_features(spark, sf):
    df = X.vector_table(spark, sf)
    return rounded(df.select("row_id", *feature_columns(df, "target", "feature_")))


@query("features_long", f"{WIDE} SELECT row_id, feature, {S.r('value', 'value')} FROM ({S.long('wide', WF, 'row_id')})")
def features_long(spark, sf):
    return rounded(to_long(X.wide_table(spark, sf), ["row_id"], WF))


@query("describe_columns", f"{WIDE} SELECT feature, count(value) AS count, {S.r('avg(value)', 'mean', 3)}, "
       f"{S.r('stddev_samp(value)', 'stddev', 3)}, {S.r('min(value)', 'min', 3)}, {S.r('max(value)', 'max', 3)} "
       f"FROM ({WLONG}) GROUP BY feature")
def describe_columns(spark, sf):
    return rounded(profile.describe(X.wide_table(spark, sf), WIDE_ALL), 3)


_DOC_COLS = ["doc_id", "text", "lang", "source", "n_chars", "quality", "toxic"]


@query("null_counts", "WITH d AS (SELECT documents.*, quality, toxic FROM documents LEFT JOIN labels USING (doc_id)) "
       + " UNION ALL ".join(f"SELECT '{c}' AS feature, count(*) - count({c}) AS n_null, 0::bigint AS n_nan FROM d" for c in _DOC_COLS))
def null_counts(spark, sf):
    docs = X.read(spark, sf, "documents").join(X.read(spark, sf, "labels"), "doc_id", "left")
    return profile.null_counts(docs, _DOC_COLS)


_LINEITEM = ", ".join(f"l_{c}" for c in (
    "orderkey partkey suppkey linenumber quantity extendedprice discount tax returnflag linestatus shipdate").split())


@query("duplicate_rows", "SELECT sum(n)::bigint AS n_rows, count(*) AS n_distinct, sum(n - 1)::bigint AS n_duplicates "
       "FROM (SELECT count(*) AS n FROM lineitem GROUP BY " + _LINEITEM + ")")
def duplicate_rows(spark, sf):
    return profile.duplicate_rows(X.read(spark, sf, "lineitem"))


_PROBS = [0.0, 0.05, 0.25, 0.5, 0.75, 0.95, 1.0]


@query("feature_quantiles", f"{WIDE}, p AS (SELECT unnest({_PROBS})::double AS prob), l AS ({WLONG}), "
       "g AS (SELECT feature, list_sort(list(value)) AS v FROM l GROUP BY feature), "
       "k AS (SELECT feature, prob, v, prob * (len(v) - 1) AS pos FROM g, p) "
       f"SELECT feature, prob, {S.r('v[floor(pos)::bigint + 1] + (v[ceil(pos)::bigint + 1] - v[floor(pos)::bigint + 1]) * (pos - floor(pos))', 'value')} FROM k")
def feature_quantiles(spark, sf):
    return rounded(profile.quantile_rows(X.wide_table(spark, sf), WIDE_ALL, _PROBS))


_OUT_COLS = [*WIDE_ALL, "champ", "chall"]
_OUT = f"""{WIDE}, l AS ({S.long('wide', _OUT_COLS)}),
qq AS (SELECT feature, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3, median(value) AS med FROM l GROUP BY feature),
iqr AS (SELECT feature, count(*) FILTER (value < q1 - 1.5 * (q3 - q1) OR value > q3 + 1.5 * (q3 - q1)) AS iqr_outliers, count(*) AS n
  FROM l JOIN qq USING (feature) GROUP BY feature),
md AS (SELECT feature, median(abs(value - med)) AS mad FROM l JOIN qq USING (feature) GROUP BY feature),
madc AS (SELECT feature, count(*) FILTER (mad > 0 AND abs(0.6745 * (value - med) / mad) > 3.5) AS mad_outliers
  FROM l JOIN qq USING (feature) JOIN md USING (feature) GROUP BY feature),
u AS (SELECT feature, iqr_outliers, 100.0 * iqr_outliers / n AS iqr_pct, mad_outliers, 100.0 * mad_outliers / n AS mad_pct
  FROM iqr JOIN madc USING (feature))"""


@query("iqr_outliers", f"{_OUT} SELECT feature, iqr_outliers, {S.r('iqr_pct', 'iqr_pct')} FROM u")
def iqr_outliers(spark, sf):
    return rounded(profile.iqr_outliers(X.wide_table(spark, sf), _OUT_COLS))


@query("mad_outliers", f"{_OUT} SELECT feature, mad_outliers, {S.r('mad_pct', 'mad_pct')} FROM u")
def mad_outliers(spark, sf):
    return rounded(profile.mad_outliers(X.wide_table(spark, sf), _OUT_COLS))


@query("outlier_univariate", f"{_OUT} SELECT feature, iqr_outliers, {S.r('iqr_pct', 'iqr_pct')}, mad_outliers, {S.r('mad_pct', 'mad_pct')} FROM u")
def outlier_univariate(spark, sf):
    return rounded(profile.univariate_outliers(X.wide_table(spark, sf), _OUT_COLS))


@query("outlier_totals", f"{_OUT} SELECT sum(iqr_outliers)::bigint AS total_iqr_outliers, sum(mad_outliers)::bigint AS total_mad_outliers, "
       f"{S.r('max(iqr_pct)', 'max_iqr_pct_per_feature')}, {S.r('max(mad_pct)', 'max_mad_pct_per_feature')} FROM u")
def outlier_totals(spark, sf):
    return rounded(profile.outlier_totals(profile.univariate_outliers(X.wide_table(spark, sf), _OUT_COLS)))


@query("group_target_stats", f"{WIDE} SELECT ps, count(*) AS n, {S.r('avg(target)', 'target_mean')}, {S.r('stddev_samp(target)', 'target_std')} FROM wide GROUP BY ps")
def group_target_stats(spark, sf):
    return rounded(profile.group_stats(X.wide_table(spark, sf), "ps"))


@query("eta_squared", f"{WIDE}, g AS (SELECT ps, count(*) AS n, var_samp(target) AS v FROM wide GROUP BY ps) "
       "SELECT (SELECT count(*) FROM wide) AS n_rows, count(*) AS n_groups, "
       f"{S.r('1 - (sum(v * (n - 1)) / (sum(n) - count(*))) / (SELECT var_samp(target) FROM wide)', 'eta_squared')}, "
       f"{S.r('1 - sum(v * (n - 1)) / (SELECT var_samp(target) * (count(*) - 1) FROM wide)', 'eta_squared_classical')} FROM g")
def eta_squared(spark, sf):
    return rounded(profile.eta_squared(X.wide_table(spark, sf), "ps"))


# --- feature engineering -----------------------------------------------------


@query("fe_unary", f"{VEC} SELECT row_id, {', '.join(FE['unary'])} FROM vectors")
def fe_unary(spark, sf):
    return rounded(X.vector_table(spark, sf).select("row_id", *scalar.unary_features()))


@query("fe_pairs", f"{VEC} SELECT row_id, {', '.join(FE['pairs'])} FROM vectors")
def fe_pairs(spark, sf):
    return rounded(X.vector_table(spark, sf).select("row_id", *scalar.pair_features()))


@query("fe_row_stats", f"{VEC} SELECT row_id, {', '.join(FE['stats'])} FROM vectors")
def fe_row_stats(spark, sf):
    return rounded(X.vector_table(spark, sf).select("row_id", *scalar.row_stats()))


@query("fe_weighted", f"{VEC} SELECT row_id, {FE['weighted'][0]} FROM vectors")
def fe_weighted(spark, sf):
    return rounded(X.vector_table(spark, sf).select("row_id", scalar.weighted_sum()))


@query("fe_full", f"{VEC} SELECT row_id, {', '.join([S.r(c, c) for c in FEATURES] + FE['unary'] + FE['pairs'] + FE['stats'] + FE['weighted'])} FROM vectors")
def fe_full(spark, sf):
    return rounded(transforms.engineer(X.vector_table(spark, sf)).select("row_id", *scalar.engineered_names()))


_LAMBDAS = {"feature_2": 0.5, "feature_13": 0.0, "feature_16": 2.0, "feature_9": 1.3}


def _yj(c: str, lam: float) -> str:
    up = f"ln(1 + {c})" if lam == 0 else f"(pow({c} + 1, {lam}) - 1) / {lam}"
    down = f"-ln(1 - {c})" if lam == 2 else f"-(pow(1 - {c}, {2 - lam}) - 1) / {2 - lam}"
    return f"CASE WHEN {c} >= 0 THEN {up} ELSE {down} END"


@query("yeo_johnson_apply", f"{VEC} SELECT row_id, {', '.join(S.r(_yj(c, v), c) for c, v in _LAMBDAS.items())} FROM vectors")
def yeo_johnson_apply(spark, sf):
    cols = [scalar.yeo_johnson(F.col(c), v).alias(c) for c, v in _LAMBDAS.items()]
    return rounded(X.vector_table(spark, sf).select("row_id", *cols))


@query("yeo_johnson_fit")
def yeo_johnson_fit(spark, sf):
    train = transforms.engineer(X.vector_table(spark, sf))
    model = transforms.PowerTransform(scalar.engineered_names()).fit(train)
    return model.transform(train).select("row_id", *scalar.engineered_names())


@query("standardize", f"{VEC} SELECT row_id, {', '.join(S.r(f'({c} - avg({c}) OVER ()) / stddev_samp({c}) OVER ()', c) for c in FEATURES)} FROM vectors")
def standardize(spark, sf):
    return rounded(models.standardize(X.vector_table(spark, sf).select("row_id", *FEATURES), FEATURES))


# --- association -------------------------------------------------------------

_CORR = (
    WIDE + ", " + ", ".join(S.avg_rank_cte(f"r_{c}", "wide", c).strip() for c in WIDE_ALL)
    + ", corr AS (" + " UNION ALL ".join(
        f"SELECT '{c}' AS feature, corr({c}, target) AS pearson, corr(r_{c}.rank::double, r_target.rank::double) AS spearman "
        f"FROM wide JOIN r_{c} ON wide.{c} = r_{c}.value JOIN r_target ON wide.target = r_target.value" for c in WF
    ) + ")"
)


@query("corr_to_target", f"{_CORR} SELECT feature, {S.r('pearson', 'pearson')}, {S.r('spearman', 'spearman')}, "
       f"{S.r('abs(pearson)', 'abs_pearson')}, {S.r('abs(spearman)', 'abs_spearman')}, "
       f"{S.r('abs(spearman) - abs(pearson)', 'nonlinearity_gap')}, abs(spearman) - abs(pearson) > 0.05 AS nonlinear FROM corr")
def corr_to_target(spark, sf):
    return rounded(regression.correlation_to_target(X.wide_table(spark, sf), WF, "target"))


_GAPS = f"""{WIDE}, gaps AS (SELECT CASE WHEN d < 0.02 THEN NULL ELSE q END AS q, CASE WHEN ca < 0 THEN NULL ELSE tp END AS tp, ps, rp,
  CASE WHEN t < 0.01 THEN NULL ELSE target END AS target FROM wide),
corr AS (""" + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, corr({c}, target) AS pearson, corr(rx, ry) AS spearman FROM (SELECT {c}, target, "
    f"rank() OVER (ORDER BY {c}) + (count(*) OVER (PARTITION BY {c}) - 1) / 2.0::double AS rx, "
    f"rank() OVER (ORDER BY target) + (count(*) OVER (PARTITION BY target) - 1) / 2.0::double AS ry "
    f"FROM gaps WHERE {c} IS NOT NULL AND target IS NOT NULL)" for c in ("q", "tp", "ps", "rp")) + ")"


@query("corr_with_missing_cells", f"{_GAPS} SELECT feature, {S.r('pearson', 'pearson')}, {S.r('spearman', 'spearman')} FROM corr")
def corr_with_missing_cells(spark, sf):
    """The same with cells missing from some features and from the target."""
    gaps = X.wide_table(spark, sf).selectExpr(
        "if(d < 0.02D, null, q) as q", "if(ca < 0, null, tp) as tp", "ps", "rp", "if(t < 0.01D, null, target) as target")
    out = regression.correlation_to_target(gaps, ["q", "tp", "ps", "rp"], "target")
    return rounded(out.select("feature", "pearson", "spearman"))


@query("top_pearson", f"{_CORR} SELECT feature, {S.r('abs(pearson)', 'abs_pearson')} FROM corr ORDER BY abs(pearson) DESC, feature LIMIT 4")
def top_pearson(spark, sf):
    # only Pearson is needed for the ranking: one aggregate, no ranks
    items = ", ".join(f"struct('{c}' as feature, abs({corr_sql(f'`{c}`', 'target')}) as abs_pearson)" for c in WF)
    one = X.wide_table(spark, sf).agg(F.expr(f"array({items}) as a")).selectExpr("inline(a)")
    return rounded(one.orderBy(F.desc("abs_pearson"), "feature").limit(4))


def _mi(source: str, cols: list[str], bins: int = 20) -> str:
    probs = ",".join(str(i / bins) for i in range(bins + 1))
    return f"""mw AS (SELECT row_number() OVER () AS i, * FROM {source}),
ml AS ({S.long('mw', [*cols, 'target'], 'i')}),
me AS (SELECT feature, list_sort(list_distinct(quantile_cont(value, [{probs}]))) AS e FROM ml GROUP BY feature),
mb AS (SELECT i, ml.feature, len(list_filter(e[2:len(e)-1], lambda y: y <= value)) AS b FROM ml JOIN me USING (feature)),
mc AS (SELECT x.feature, x.b AS bx, y.b AS bt, count(*) AS n FROM mb x JOIN mb y ON x.i = y.i AND y.feature = 'target'
  WHERE x.feature <> 'target' GROUP BY ALL),
mm AS (SELECT *, sum(n) OVER (PARTITION BY feature, bx) AS nx, sum(n) OVER (PARTITION BY feature, bt) AS ny,
  sum(n) OVER (PARTITION BY feature) AS nt FROM mc),
mi AS (SELECT feature, sum(n::double / nt::double * ln(n::double * nt::double / (nx::double * ny::double))) AS mutual_info FROM mm GROUP BY feature)"""


@query("mutual_info_binned", f"{WIDE}, {_mi('wide', WF)} SELECT feature, {S.r('mutual_info', 'mutual_info')} FROM mi")
def mutual_info_binned(spark, sf):
    return rounded(regression.mutual_information(X.wide_table(spark, sf), WF, "target"))


@query("top_mi", f"{VEC}, {_mi('vectors', FEATURES)} SELECT feature, {S.r('mutual_info', 'mutual_info')} FROM mi ORDER BY mutual_info DESC, feature LIMIT 10")
def top_mi(spark, sf):
    mi = regression.mutual_information(X.vector_table(spark, sf), FEATURES, "target")
    return rounded(mi.orderBy(F.desc("mutual_info"), "feature").limit(10))


@query("select_k_best", f"{VEC}, {_mi('vectors', FEATURES)} SELECT feature, {S.r('mutual_info', 'mutual_info')}, "
       "row_number() OVER (ORDER BY round(mutual_info, 9) DESC, feature) AS place FROM mi QUALIFY place <= 8")
def select_k_best(spark, sf):
    return rounded(transforms.rank_by_information(X.vector_table(spark, sf), FEATURES, "target").where("place <= 8"))


@query("avg_ranks", f"{WIDE}, l AS ({S.long('wide', WIDE_ALL)}), c AS (SELECT feature, value, count(*) AS n FROM l GROUP BY ALL) "
       f"SELECT feature, {S.r('value', 'value')}, n, {S.r('sum(n) OVER (PARTITION BY feature ORDER BY value) - n + (n + 1) / 2.0::double', 'avg_rank', 1)} FROM c")
def avg_ranks(spark, sf):
    return rounded(average_ranks(X.wide_table(spark, sf), WIDE_ALL).drop("tot_n"), 6, {"avg_rank": 1})


# --- series ------------------------------------------------------------------


@query("histogram_edges", f"{WIDE}, e AS (SELECT * FROM (VALUES " + ", ".join(f"({i}, {i * 20000.0}::double, {(i + 1) * 20000.0}::double)" for i in range(5)) + ") v(bin, low, high)) "
       "SELECT bin::int AS bin, low, high, count(target) AS n FROM e LEFT JOIN wide ON target >= low AND (target < high OR (bin = 4 AND target = high)) GROUP BY ALL")
def histogram_edges(spark, sf):
    return series.histogram_edges(X.wide_table(spark, sf), "target", [i * 20000.0 for i in range(6)])


@query("histogram_density", f"""WITH {S.WIDE}, l AS ({S.long("(SELECT *, CASE WHEN dt < DATE '1999-01-01' THEN 'ref' ELSE 'cur' END AS side FROM wide)", ['target', 'champ'], 'side AS population')}),
g AS (SELECT feature, population, min(value) AS lo, max(value) AS hi FROM l GROUP BY ALL),
b AS (SELECT feature, population, lo, hi, least(floor((value - lo) / ((hi - lo) / 25))::int, 24) AS bin FROM l JOIN g USING (feature, population)),
c AS (SELECT feature, population, lo, hi, bin, count(*) AS n FROM b GROUP BY ALL)
SELECT feature, population, bin, {S.r('lo + bin * (hi - lo) / 25', 'left_edge')}, n,
  {S.r('n / (sum(n) OVER (PARTITION BY feature, population) * ((hi - lo) / 25))', 'density', 9)} FROM c""")
def histogram_density(spark, sf):
    df = X.wide_table(spark, sf).withColumn(
        "side", F.when(F.col("dt") < F.lit(X.SPLIT_DATE).cast("date"), "ref").otherwise("cur")
    )
    return rounded(series.histogram_density(df, ["target", "champ"], 25, "side"), 6, {"density": 9})


@query("boxplot_by_group", f"""{VEC}, g AS (SELECT label, quantile_cont(target, 0.25) AS q1, quantile_cont(target, 0.5) AS median, quantile_cont(target, 0.75) AS q3 FROM vectors GROUP BY label)
SELECT label, {S.r('any_value(q1)', 'q1')}, {S.r('any_value(median)', 'median')}, {S.r('any_value(q3)', 'q3')},
  {S.r('min(target) FILTER (target >= q1 - 1.5 * (q3 - q1))', 'whisker_low')}, {S.r('max(target) FILTER (target <= q3 + 1.5 * (q3 - q1))', 'whisker_high')},
  count(*) FILTER (target < q1 - 1.5 * (q3 - q1) OR target > q3 + 1.5 * (q3 - q1)) AS n_outside FROM vectors JOIN g USING (label) GROUP BY label""")
def boxplot_by_group(spark, sf):
    # the label is the class of a vector, one of ten by the data's contract
    return rounded(series.boxplot_by_group(X.vector_table(spark, sf), "label", "target", list(range(10))))


_D = "abs(champ - chall)"


@query("ecdf_abs_diff", f"{WIDE}, c AS (SELECT {_D} AS value, count(*) AS n FROM wide GROUP BY 1) "
       f"SELECT {S.r('value', 'value')}, n, {S.r('(sum(n) OVER (ORDER BY value) - 1)::double / (sum(n) OVER () - 1)::double', 'height')} FROM c")
def ecdf_abs_diff(spark, sf):
    return rounded(series.ecdf(X.wide_table(spark, sf), _D))


@query("qq_points")
def qq_points(spark, sf):
    return series.qq_points(X.wide_table(spark, sf), "champ - chall")


@query("qq_points_all", f"{WIDE}, o AS (SELECT champ - chall AS x, row_number() OVER (ORDER BY champ - chall) - 1 AS place, count(*) OVER () AS n FROM cur) "
       f"SELECT place, {S.r('0.01::double + 0.98::double * place / greatest(n - 1, 1)', 'position')}, {S.r('x', 'sample')}, "
       "true AS cdf_is_position FROM o")
def qq_points_all(spark, sf):
    """A point of every row; the normal distribution takes the theoretical quantile back to the position."""
    out = series.qq_points(X.current_side(X.wide_table(spark, sf)), "champ - chall", points=None)
    tail = normal_pvalue(F.col("theoretical")) / 2
    cdf = F.when(F.col("theoretical") > 0, 1 - tail).otherwise(tail)
    back = (F.abs(cdf - F.col("position")) < 1e-7).alias("cdf_is_position")
    return rounded(out.select("place", "position", "sample", back))


@query("abs_diff_percentiles", f"{WIDE} SELECT {S.r(f'quantile_cont({_D}, 0.5)', 'p50_abs_diff')}, {S.r(f'quantile_cont({_D}, 0.9)', 'p90_abs_diff')} FROM wide")
def abs_diff_percentile_query(spark, sf):
    return rounded(abs_diff_percentiles(X.wide_table(spark, sf), "champ", "chall"))


@query("bland_altman", f"{WIDE} SELECT count(*) AS n, {S.r('avg(champ - chall)', 'bias')}, "
       f"{S.r('avg(champ - chall) - 1.96 * stddev_pop(champ - chall)', 'loa_lower')}, {S.r('avg(champ - chall) + 1.96 * stddev_pop(champ - chall)', 'loa_upper')} FROM wide")
def bland_altman_query(spark, sf):
    return rounded(bland_altman(X.wide_table(spark, sf), "champ", "chall"))


@query("bland_altman_points", f"{WIDE} SELECT row_id, {S.r('(champ + chall) / 2', 'pair_mean', 8)}, {S.r('champ - chall', 'diff', 8)} FROM wide")
def bland_altman_points_query(spark, sf):
    return rounded(bland_altman_points(X.wide_table(spark, sf), "champ", "chall", "row_id"), 8)


@query("cumulative_share", "WITH c AS (SELECT s_nationkey, sum(l_extendedprice) AS amount FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1), "
       "w AS (SELECT s_nationkey, amount, row_number() OVER (ORDER BY amount DESC, s_nationkey) AS place, "
       "sum(amount) OVER (ORDER BY amount DESC, s_nationkey ROWS UNBOUNDED PRECEDING) / sum(amount) OVER () AS cumulative FROM c) "
       f"SELECT s_nationkey, {S.r('amount', 'amount', 2)}, place, {S.r('cumulative', 'cumulative')}, min(place) FILTER (cumulative >= 0.95) OVER () AS n_for_level FROM w")
def cumulative_share(spark, sf):
    sums = X.read(spark, sf, "lineitem").join(
        X.read(spark, sf, "supplier"), F.col("l_suppkey") == F.col("s_suppkey")
    ).groupBy("s_nationkey").agg(F.sum("l_extendedprice").alias("amount"))
    return rounded(series.cumulative_share(sums, "s_nationkey", "amount"), 6, {"amount": 2})


@query("argmax_row", f"{WIDE}, m AS (SELECT ps::int AS ps, avg(target) AS score FROM wide GROUP BY 1) "
       f"SELECT arg_max(ps, (score, -ps)) AS ps, {S.r('max(score)', 'score')} FROM m")
def argmax_row(spark, sf):
    means = X.wide_table(spark, sf).groupBy(F.col("ps").cast("int").alias("ps")).agg(F.avg("target").alias("score"))
    return rounded(models.argbest(means, "ps", "score"))


# --- multivariate outliers ---------------------------------------------------


@query("isolation_forest")
def isolation_forest(spark, sf):
    from plumbline.operators.isolation import IsolationForest

    df = X.vector_table(spark, sf).select("row_id", *FEATURES, "target")
    forest = IsolationForest()
    return forest.fit(df, "row_id", FEATURES).flag(df).select("row_id", "target", "anomaly_score", "is_outlier")


@query("top_anomalies")
def top_anomalies(spark, sf):
    return isolation_forest(spark, sf).where("is_outlier").orderBy(F.desc("anomaly_score"), "row_id").limit(10)


@query("anomaly_rate")
def anomaly_rate_query(spark, sf):
    """A forest fitted on the reference side, saved with its threshold and loaded to watch the months."""
    from plumbline.operators.isolation import IsolationForest, IsolationForestModel, anomaly_rate

    df = X.wide_table(spark, sf)
    path = f"{shared_dir(spark)}/forest-{uuid.uuid4().hex}"
    IsolationForest(inputCols=WF).fit(X.reference_side(df)).write().save(path)
    watch = IsolationForestModel.load(path)
    return anomaly_rate(watch.transform(X.with_month(X.current_side(df)).select("row_id", "month", *WF)), "month")


@query("planted_anomalies", f"{VEC} SELECT count(*) AS n, count(*) FILTER (row_id::bigint % 50 = 7) AS n_planted, "
       "count(*) FILTER (row_id::bigint % 50 = 7) AS n_planted_flagged, true AS flags_near_share FROM vectors")
def planted_anomalies(spark, sf):
    """Rows moved far away in half of their columns: the forest flags each, and about its share of all rows."""
    from plumbline.operators.isolation import IsolationForest

    planted = F.expr("cast(row_id as bigint) % 50 = 7")
    moved = [F.when(planted, F.col(c) + 2.0 + i / 10).otherwise(F.col(c)).alias(c) for i, c in enumerate(FEATURES[:10])]
    df = stage(X.vector_table(spark, sf).select("row_id", *moved, *FEATURES[10:]), "planted")
    flagged = IsolationForest(inputCols=FEATURES).fit(df).transform(df)
    return flagged.agg(
        F.count("*").alias("n"), F.count_if(planted).alias("n_planted"), F.count_if(planted & F.col("is_outlier")).alias("n_planted_flagged"),
        F.avg(F.col("is_outlier").cast("double")).between(0.03, 0.051).alias("flags_near_share"))


@query("outlier_verdict", f"""{WIDE}, src AS (SELECT row_id, target, CASE WHEN q >= 49 AND d >= 0.09 THEN 1 ELSE 0 END AS arm FROM wide),
{S.arms_ctes('src', 'target')} SELECT m::bigint AS n_flagged, n::bigint AS n_rest, {S.r('ks_stat', 'ks_stat')},
  {S.r(f"CASE WHEN m > 5 THEN {S.kolmogorov('ks_stat', 'n', 'm')} END", 'ks_p')},
  CASE WHEN m = 0 THEN 'keep all rows: nothing flagged'
    WHEN m > 5 AND {S.kolmogorov('ks_stat', 'n', 'm')} < 0.05 THEN 'keep all rows: flagged rows carry signal'
    ELSE 'keep all rows: models and transform are robust to outliers' END AS verdict FROM rk""")
def outlier_verdict_query(spark, sf):
    flagged = X.wide_table(spark, sf).select("row_id", "target", F.expr("q >= 49 and d >= 0.09").alias("flag"))
    return rounded(outlier_verdict(flagged, "flag", "target"))
