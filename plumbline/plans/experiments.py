"""Queries: scoring, A/A, A/B, paired analysis, canary, registry, training."""

from __future__ import annotations

import uuid

from pyspark.ml import Pipeline
from pyspark.ml.feature import SQLTransformer
from pyspark.sql import functions as F

from plumbline.config import CANARY_STAGES, FEATURES, CanaryStage, CanaryThresholds
from plumbline.operators import canary as C
from plumbline.operators import experiment as E
from plumbline.operators import inference, models, regression
from plumbline.plans import fragments as S
from plumbline.plans.registry import query, rounded
from plumbline.session import shared_dir, stage
from plumbline.sources import fixtures as X
from plumbline.sources import runlog
from plumbline.sources.tables import append_batch, read_batches

WIDE = f"WITH {S.WIDE}"
CHAMPION = "1500.0D * q + 0.01D * tp + 200.0D * ps"

# --- scoring and predictions -------------------------------------------------


@query("batch_inference", f"{WIDE} SELECT row_id, {S.r('champ', 'prediction')}, 'v1' AS model_version, '2024-01-01 00:00:00' AS stamped FROM cur")
def batch_inference(spark, sf):
    """Score, append under a batch id (twice: a rerun must not double it) and read back."""
    batch = X.current_side(X.wide_table(spark, sf)).select("row_id", "q", "tp", "ps")
    path = f"{shared_dir(spark)}/predictions-{uuid.uuid4().hex}"
    scored = inference.score(batch, F.expr(CHAMPION), "v1", "2024-01-01 00:00:00")
    for _ in range(2):
        append_batch(scored, path, "2024-01-01")
    return rounded(read_batches(spark, path).select(
        "row_id", "prediction", "model_version",
        F.date_format("prediction_timestamp", "yyyy-MM-dd HH:mm:ss").alias("stamped"),
    ))


def _predictions(spark, sf):
    cur = X.current_side(X.wide_table(spark, sf))
    versions = "stack(2, 'v1', champ, 'v2', chall) as (model_version, prediction)"
    return cur.selectExpr("row_id", "cast(dt as timestamp) as prediction_timestamp", versions)


@query("prediction_summary", f"{WIDE}, p AS (SELECT 'v1' AS model_version, champ AS prediction, dt FROM cur UNION ALL SELECT 'v2', chall, dt FROM cur) "
       f"SELECT model_version, count(*) AS n_predictions, {S.r('avg(prediction)', 'pred_mean', 3)}, {S.r('stddev_samp(prediction)', 'pred_std', 3)}, "
       f"{S.r('min(prediction)', 'pred_min', 2)}, {S.r('max(prediction)', 'pred_max', 2)}, strftime(max(dt), '%Y-%m-%d') AS last_run FROM p GROUP BY model_version")
def prediction_summary(spark, sf):
    out = inference.prediction_summary(_predictions(spark, sf))
    return rounded(out.withColumn("last_run", F.date_format("last_run", "yyyy-MM-dd")))


@query("prediction_stats", f"{WIDE} SELECT count(champ) AS n, {S.r('avg(champ)', 'pred_mean')}, {S.r('stddev_pop(champ)', 'pred_std')}, {S.r('min(champ)', 'pred_min')}, {S.r('max(champ)', 'pred_max')} FROM wide")
def prediction_stats(spark, sf):
    return rounded(inference.prediction_stats(X.wide_table(spark, sf), "champ"))


@query("paired_predictions", f"{WIDE} SELECT row_id, {S.r('champ', 'champ')}, {S.r('chall', 'chall')} FROM cur")
def paired_predictions(spark, sf):
    """Two models logged apart, paired by row key."""
    both = _predictions(spark, sf)
    champ = both.where("model_version = 'v1'").select("row_id", F.col("prediction").alias("champ"))
    chall = both.where("model_version = 'v2'").select("row_id", F.col("prediction").alias("chall"))
    return rounded(champ.join(chall, "row_id"))


_FOLD = f"floor({S.unit('row_id', '42')} * 5)::int"


@query("fold_assignment", f"{WIDE} SELECT row_id, {_FOLD} AS fold FROM wide")
def fold_assignment(spark, sf):
    return models.assign_folds(X.wide_table(spark, sf).select("row_id"), "row_id")


_OOF = f"""f AS (SELECT *, {_FOLD} AS fold FROM wide),
g AS (SELECT ps, fold, sum(target) AS s, count(*) AS n FROM f GROUP BY ALL),
o AS (SELECT a.ps, a.fold, sum(b.s) AS s, sum(b.n) AS n FROM g a JOIN g b ON a.ps = b.ps AND a.fold <> b.fold GROUP BY ALL),
oof AS (SELECT row_id, f.fold, target, tp, s / n AS oof_prediction FROM f JOIN o USING (ps, fold))"""


def _oof(spark, sf):
    """Out-of-fold mean target by part size: a model that SQL can also fit."""
    rows = models.assign_folds(X.wide_table(spark, sf).select("row_id", "ps", "tp", "target", "dt"), "row_id")
    sums = rows.groupBy("ps", "fold").agg(F.sum("target").alias("s"), F.count("*").alias("n"))
    held_out = sums.selectExpr(
        "ps", "fold", "sum(s) over (partition by ps) - s as s", "sum(n) over (partition by ps) - n as n"
    ).where("n > 0").selectExpr("ps", "fold", "s / n as oof_prediction")
    return rows, rows.join(held_out, ["ps", "fold"]).select("row_id", "fold", "oof_prediction")


@query("oof_join", f"{WIDE}, {_OOF} SELECT row_id, fold, {S.r('target', 'target')}, {S.r('oof_prediction', 'oof_prediction', 8)} FROM oof")
def oof_join(spark, sf):
    rows, oof = _oof(spark, sf)
    out = inference.reference_snapshot(rows, oof, "row_id", ["fold"], "target")
    return rounded(out.select("row_id", "fold", "target", "oof_prediction"), 6, {"oof_prediction": 8})


@query("model_comparison", f"""{WIDE}, {_OOF}, oo AS (SELECT *, avg(target) OVER () AS gm FROM oof),
lin AS (SELECT fold, 1 - sum((target - champ) * (target - champ)) / (var_pop(target) * count(*)) AS score FROM f GROUP BY fold),
men AS (SELECT fold, 1 - sum((target - oof_prediction) * (target - oof_prediction)) / (var_pop(target) * count(*)) AS score FROM oof GROUP BY fold)
SELECT {S.r('(SELECT avg(score) FROM lin)', 'first_mean')}, {S.r('(SELECT stddev_pop(score) FROM lin)', 'first_std')},
  {S.r('(SELECT avg(score) FROM men)', 'second_mean')}, {S.r('(SELECT stddev_pop(score) FROM men)', 'second_std')},
  {S.r('(SELECT avg(score) FROM lin) - (SELECT avg(score) FROM men)', 'diff_mean')},
  CASE WHEN (SELECT avg(score) FROM lin) > (SELECT avg(score) FROM men) THEN 'linear' ELSE 'group_mean' END AS champion""")
def model_comparison(spark, sf):
    return rounded(E.model_comparison(_fold_scores(spark, sf), "linear", "group_mean"))


def _fold_scores(spark, sf):
    rows, oof = _oof(spark, sf)
    both = rows.join(oof.drop("fold"), "row_id").join(X.wide_table(spark, sf).select("row_id", "champ"), "row_id")
    long = both.selectExpr("fold", "target", "stack(2, 'linear', champ, 'group_mean', oof_prediction) as (model, p)")
    return long.groupBy("model", "fold").agg(
        F.expr("1 - avg((target - p) * (target - p)) / var_pop(target) as score")
    )


# the exact p counts the 2^n ways to give signs to the n ranks of the fold differences
@query("fold_wilcoxon", f"""{WIDE}, {_OOF},
lin AS (SELECT fold, 1 - avg((target - champ) * (target - champ)) / var_pop(target) AS score FROM f GROUP BY fold),
men AS (SELECT fold, 1 - avg((target - oof_prediction) * (target - oof_prediction)) / var_pop(target) AS score FROM oof GROUP BY fold),
df AS (SELECT lin.score - men.score AS d FROM lin JOIN men USING (fold)),
rd AS (SELECT d, row_number() OVER (ORDER BY abs(d)) AS rank, count(*) OVER () AS n FROM df WHERE d <> 0),
ws AS (SELECT max(n) AS n, least(sum(rank) FILTER (d > 0), sum(rank) FILTER (d < 0)) AS low,
  coalesce(sum(rank) FILTER (d > 0), 0) AS up FROM rd),
w AS (SELECT n, least(up, n * (n + 1) // 2 - up)::double AS w FROM ws),
sg AS (SELECT s, list_sum(list_transform(range(0, n), lambda i: CASE WHEN (s >> i) & 1 = 1 THEN i + 1 ELSE 0 END)) AS t
  FROM (SELECT n, unnest(range(0, (1 << n)::bigint)) AS s FROM w))
SELECT n AS n_nonzero, {S.r('w', 'wilcoxon_w')}, {S.r('least(1.0, 2.0 * (SELECT count(*) FROM sg, w WHERE t <= w) / (1 << n))', 'wilcoxon_p')},
  {S.r('pow(2.0, 1 - n)', 'min_attainable_p')} FROM w""")
def fold_wilcoxon(spark, sf):
    return rounded(E.fold_wilcoxon(stage(_fold_scores(spark, sf), "scores"), "model", "fold", "score", "linear", "group_mean"))


def _metric_sql(y: str, p: str, source: str) -> str:
    m = f"(SELECT avg({y}) FROM {source})"
    sse, sst = f"sum(({y} - {p}) * ({y} - {p}))", f"sum(({y} - {m}) * ({y} - {m}))"
    r2 = f"1 - {sse} / {sst}"
    return ", ".join([
        "count(*) AS n", S.r(r2, "r2"), S.r(f"sqrt(avg(({y} - {p}) * ({y} - {p})))", "rmse"), S.r(f"avg(abs({y} - {p}))", "mae"),
        S.r(f"2 * covar_pop({y}, {p}) / (var_pop({y}) + var_pop({p}) + pow(avg({y}) - avg({p}), 2) + 1e-8)", "ccc"),
        S.r(f"1 - {sse} / ({sst} + 1e-8)", "nse"), S.r(f"avg({y} - {p})", "mbe"), S.r(f"corr({y}, {p})", "pearson_r"),
        S.r(f"({r2}) / 0.92", "efficiency"),
    ])


_RANKS = f"{S.avg_rank_cte('ry', 'wide', 'target')}, {S.avg_rank_cte('rp', 'wide', 'champ')}"


@query("regression_metrics", f"{WIDE}, {_RANKS} SELECT {_metric_sql('target', 'champ', 'wide')}, "
       f"{S.r('(SELECT corr(ry.rank::double, rp.rank::double) FROM wide JOIN ry ON target = ry.value JOIN rp ON champ = rp.value)', 'spearman_rho')} FROM wide")
def regression_metrics(spark, sf):
    return rounded(regression.regression_metrics(X.wide_table(spark, sf), "target", "champ"))


@query("redeploy_gate", f"{WIDE} SELECT {S.r('1 - avg(pow(target - chall, 2)) / var_pop(target)', 'new_r2')}, {S.r('1 - avg(pow(target - champ, 2)) / var_pop(target)', 'old_r2')}, "
       "1 - avg(pow(target - chall, 2)) / var_pop(target) > 1 - avg(pow(target - champ, 2)) / var_pop(target) AS redeploy FROM cur")
def redeploy_gate(spark, sf):
    cur = X.current_side(X.wide_table(spark, sf))
    new = regression.regression_metrics(cur, "target", "chall")
    old = regression.regression_metrics(cur, "target", "champ")
    return rounded(C.better_on_validation(new, old))


_E = "(target - champ)"
_RES = f"""{WIDE}, e AS (SELECT dt, row_id, target, champ AS p, {_E} AS e, lag({_E}) OVER (ORDER BY dt, row_id) AS prev, avg({_E}) OVER () AS me FROM wide),
mo AS (SELECT count(*) AS n, avg(pow(e - me, 2)) AS m2, avg(pow(e - me, 3)) AS m3, avg(pow(e - me, 4)) AS m4, corr(p, abs(e)) AS hr,
  sum((e - prev) * (e - prev)) / sum(e * e) AS dw, 1 - avg(e * e) / var_pop(target) AS r2 FROM e),
jb AS (SELECT *, m3 / pow(m2, 1.5) AS sk, m4 / (m2 * m2) - 3 AS ku FROM mo)"""


@query("durbin_watson", f"{_RES} SELECT n, {S.r('dw', 'durbin_watson')} FROM jb")
def durbin_watson(spark, sf):
    return rounded(regression.durbin_watson(X.wide_table(spark, sf), "target", "champ", ["dt", "row_id"]))


@query("jarque_bera", f"{_RES} SELECT n, {S.r('sk', 'skew')}, {S.r('ku', 'excess_kurtosis')}, {S.r('n / 6.0 * (sk * sk + ku * ku / 4)', 'jarque_bera', 4)}, {S.r('exp(-n / 12.0 * (sk * sk + ku * ku / 4))', 'jarque_bera_p')} FROM jb")
def jarque_bera(spark, sf):
    out = regression.residual_moments(X.wide_table(spark, sf), "target", "champ")
    return rounded(out.select("n", "skew", "excess_kurtosis", "jarque_bera", "jarque_bera_p"), 6, {"jarque_bera": 4})


@query("heteroscedasticity", f"{_RES}, h AS (SELECT n, hr, hr * sqrt((n - 2) / (1 - hr * hr)) AS ht FROM jb) "
       f"SELECT n, {S.r('hr', 'heteroscedasticity_r')}, {S.r('ht', 'heteroscedasticity_t', 4)}, {S.r(S.student_p('ht', '(n - 2.0)'), 'heteroscedasticity_p')} FROM h")
def heteroscedasticity(spark, sf):
    out = regression.with_residual_pvalues(regression.residual_moments(X.wide_table(spark, sf), "target", "champ"))
    return rounded(out.select("n", "heteroscedasticity_r", "heteroscedasticity_t", "heteroscedasticity_p"), 6, {"heteroscedasticity_t": 4})


@query("residual_diagnostics", f"{_RES} SELECT n, {S.r('r2', 'oof_r2')}, {S.r('sk', 'skew')}, {S.r('ku', 'excess_kurtosis')}, {S.r('hr', 'heteroscedasticity_r')}, {S.r('dw', 'durbin_watson')} FROM jb")
def residual_diagnostics(spark, sf):
    out = regression.residual_diagnostics(X.wide_table(spark, sf), "target", "champ", ["dt", "row_id"])
    return rounded(out.select("n", "oof_r2", "skew", "excess_kurtosis", "heteroscedasticity_r", "durbin_watson"))


@query("residual_normality")
def residual_normality(spark, sf):
    e = X.wide_table(spark, sf).selectExpr("target - champ as e")
    return regression.with_normal_pvalue(regression.shapiro_francia(e, "e"), "shapiro_z", "two_sided_p")


# --- experiments -------------------------------------------------------------

_ARM = f"CASE WHEN {S.unit('row_id', '42')} < 0.5 THEN 1 ELSE 0 END"
_AA = f"{WIDE}, src AS (SELECT row_id, champ AS y, {_ARM} AS arm FROM cur), {S.arms_ctes('src', 'y')}"
_AB = f"{WIDE}, src AS (SELECT row_id, CASE WHEN {_ARM} = 1 THEN chall ELSE champ END AS y, {_ARM} AS arm FROM cur), {S.arms_ctes('src', 'y')}"
_REPORT = [
    "n_a", "n_b", "mean_a", "mean_b", "std_a", "std_b", "mean_diff", "welch_t", "welch_df", "welch_p",
    "mw_u", "mw_p", "ks_stat", "ks_p", "bootstrap_ci95_low", "bootstrap_ci95_high",
]
_DIGITS = {"welch_df": 3, "mw_u": 1}


def _arms(spark, sf, ab: bool):
    cur = E.assign_treatment(X.current_side(X.wide_table(spark, sf)), "row_id", 0.5, 42)
    y = F.expr("if(arm = 1, chall, champ)") if ab else F.col("champ")
    return cur.select("row_id", "arm", y.alias("y"))


@query("assign_treatment", f"{WIDE} SELECT row_id, {_ARM} AS arm FROM wide")
def assign_treatment(spark, sf):
    return E.assign_treatment(X.wide_table(spark, sf).select("row_id"), "row_id", 0.5)


@query("welch_ttest", f"{_AB} SELECT n_a, n_b, {S.r('mean_diff', 'mean_diff')}, {S.r('welch_t', 'welch_t')}, {S.r('welch_df', 'welch_df', 3)} FROM mom")
def welch_ttest(spark, sf):
    out = E.welch(_arms(spark, sf, True), "y").select("n_a", "n_b", "mean_diff", "welch_t", "welch_df")
    return rounded(out, 6, _DIGITS)


@query("mann_whitney", f"{_AB} SELECT {S.r('mw_u', 'mw_u', 1)}, {S.r('mw_z', 'mw_z')}, {S.r('ks_stat', 'ks_stat')} FROM rk")
def mann_whitney(spark, sf):
    return rounded(E.rank_tests(_arms(spark, sf, True), "y").select("mw_u", "mw_z", "ks_stat"), 6, _DIGITS)


_DIFF = S.replicate_ctes({
    "na": "CASE WHEN arm = 0 THEN 1 ELSE 0 END", "sa": "CASE WHEN arm = 0 THEN y ELSE 0 END",
    "nb": "CASE WHEN arm = 1 THEN 1 ELSE 0 END", "sb": "CASE WHEN arm = 1 THEN y ELSE 0 END"}, "src")
_CI = f"""{_DIFF}, ci AS (SELECT {S.r('quantile_cont(sa / na - sb / nb, 0.025)', 'bootstrap_ci95_low')},
  {S.r('quantile_cont(sa / na - sb / nb, 0.975)', 'bootstrap_ci95_high')} FROM reps)"""
_CI_COLS = "bootstrap_ci95_low, bootstrap_ci95_high"


@query("compare_arms", f"{_AB}, {_CI} SELECT {S.ARMS_SELECT}, {_CI_COLS} FROM mom, rk, ci")
def compare_arms(spark, sf):
    return rounded(_compared(spark, sf, True).select(*_REPORT), 6, _DIGITS)


def _compared(spark, sf, ab: bool):
    return E.compare_arms(_arms(spark, sf, ab), "row_id", "y", unique_key=True)


_P3 = f"least({S.student_p('welch_t', 'welch_df')}, {S.normal_p('greatest(mw_z, 0.0)')}, {S.kolmogorov('ks_stat', 'n', 'm')})"


@query("aa_test", f"{_AA}, {_CI} SELECT {S.ARMS_SELECT}, {_CI_COLS}, {_P3} > 0.05 AS framework_passes_aa_test, {_P3} > 0.05 / 3 AS framework_passes_familywise FROM mom, rk, ci")
def aa_test(spark, sf):
    out = E.aa_verdict(_compared(spark, sf, False))
    return rounded(out.select(*_REPORT, "framework_passes_aa_test", "framework_passes_familywise"), 6, _DIGITS)


@query("ab_test", f"{_AB}, {_CI} SELECT {S.ARMS_SELECT}, {_CI_COLS}, {S.student_p('welch_t', 'welch_df')} < 0.05 AS is_statistically_significant FROM mom, rk, ci")
def ab_test(spark, sf):
    out = E.ab_flags(_compared(spark, sf, True))
    return rounded(out.select(*_REPORT, "is_statistically_significant"), 6, _DIGITS)


@query("bootstrap_mean_diff", f"{_AB}, {_CI} SELECT {_CI_COLS} FROM ci")
def bootstrap_mean_diff(spark, sf):
    return rounded(E.bootstrap_mean_diff(_arms(spark, sf, True), "row_id", "y", unique_key=True))


_R2 = {"n": "1", "s1": "y", "s2": "y * y", "sse": "(y - p) * (y - p)"}


@query("bootstrap_r2", f"{WIDE}, src AS (SELECT row_id, target - (SELECT avg(target) FROM wide) AS y, champ - (SELECT avg(target) FROM wide) AS p FROM wide), "
       f"{S.replicate_ctes(_R2, 'src')} "
       f"SELECT {S.r('quantile_cont(1 - sse / (s2 - s1 * s1 / n), 0.025)', 'oof_r2_ci95_low')}, {S.r('quantile_cont(1 - sse / (s2 - s1 * s1 / n), 0.975)', 'oof_r2_ci95_high')} FROM reps")
def bootstrap_r2(spark, sf):
    return rounded(E.bootstrap_r2(X.wide_table(spark, sf), "row_id", "target", "champ", unique_key=True))


@query("oof_report", f"{_RES}, h AS (SELECT *, hr * sqrt((n - 2) / (1 - hr * hr)) AS ht FROM jb), "
       f"src AS (SELECT row_id, target - (SELECT avg(target) FROM wide) AS y, champ - (SELECT avg(target) FROM wide) AS p FROM wide), {S.replicate_ctes(_R2, 'src')}, "
       f"ci AS (SELECT {S.r('quantile_cont(1 - sse / (s2 - s1 * s1 / n), 0.025)', 'oof_r2_ci95_low')}, {S.r('quantile_cont(1 - sse / (s2 - s1 * s1 / n), 0.975)', 'oof_r2_ci95_high')} FROM reps) "
       f"SELECT n, {S.r('r2', 'oof_r2')}, oof_r2_ci95_low, oof_r2_ci95_high, {S.r('exp(-n / 12.0 * (sk * sk + ku * ku / 4))', 'jarque_bera_p')}, "
       f"{S.r('hr', 'heteroscedasticity_r')}, {S.r(S.student_p('ht', '(n - 2.0)'), 'heteroscedasticity_p')}, {S.r('dw', 'durbin_watson')} FROM h, ci")
def oof_report(spark, sf):
    """The diagnostics bundle: fit and its interval, p-values, autocorrelation."""
    out = E.oof_report(X.wide_table(spark, sf), "row_id", "target", "champ", ["dt", "row_id"], unique_key=True)
    return rounded(out.select(
        "n", "oof_r2", "oof_r2_ci95_low", "oof_r2_ci95_high", "jarque_bera_p", "heteroscedasticity_r", "heteroscedasticity_p", "durbin_watson"))


# the exact p-values by going through all ways to deal the quarters to two arms
@query("quarterly_exact_tests", f"""{WIDE}, qa AS (SELECT year(dt) * 4 + quarter(dt) AS quarter, avg(target) AS y FROM cur GROUP BY 1),
rq AS (SELECT quarter % 2 AS arm, y, row_number() OVER (ORDER BY y) AS rank, count(*) OVER () AS n FROM qa),
li AS (SELECT list(arm ORDER BY rank) AS arms, max(n) AS n, count(*) FILTER (arm = 0) AS na, count(*) FILTER (arm = 1) AS nb FROM rq),
al AS (SELECT n, na, nb, list_transform(range(0, n), lambda i: CASE WHEN (s >> i) & 1 = 1 THEN 0 ELSE 1 END) AS arms
  FROM (SELECT n, na, nb, unnest(range(0, (1 << n)::bigint)) AS s FROM li) WHERE bit_count(s) = na),
st AS (SELECT arms, list_sum(list_transform(range(1, n + 1), lambda i: CASE WHEN arms[i] = 0 THEN i ELSE 0 END)) - na * (na + 1) / 2 AS u,
  list_max(list_transform(range(1, n + 1), lambda i: abs(len(list_filter(arms[1:i], lambda a: a = 0)) * nb - len(list_filter(arms[1:i], lambda a: a = 1)) * na))) AS d, na, nb FROM al),
ob AS (SELECT st.* FROM st JOIN li ON st.arms = li.arms)
SELECT any_value(ob.na) AS n_a, any_value(ob.nb) AS n_b, {S.r('any_value(ob.u)::double', 'mw_u')},
  {S.r('least(1.0, 2.0 * count(*) FILTER (st.u <= least(ob.u, ob.na * ob.nb - ob.u)) / count(*))', 'mw_p')}, 'exact' AS mw_method,
  {S.r('any_value(ob.d)::double / any_value(ob.na * ob.nb)', 'ks_stat')}, {S.r('count(*) FILTER (st.d >= ob.d)::double / count(*)', 'ks_p')}, 'exact' AS ks_method FROM st, ob""")
def quarterly_exact_tests(spark, sf):
    """Quarters in turn as two small samples of mean targets, with exact p-values."""
    quarters = X.current_side(X.wide_table(spark, sf)).groupBy(F.expr("year(dt) * 4 + quarter(dt)").alias("quarter")).agg(F.avg("target").alias("y"))
    arms = stage(quarters.selectExpr("cast(quarter % 2 as int) as arm", "y"), "quarters")
    return rounded(E.two_sample_tests(arms, "y", method="exact"))


_PAIR = f"""{WIDE}, dd AS (SELECT champ - chall AS d, champ AS a, chall AS b FROM cur),
sz AS (SELECT abs(d) AS v, count(*) AS n, count(*) FILTER (d > 0) AS up FROM dd WHERE d <> 0 GROUP BY 1),
rkd AS (SELECT *, sum(n) OVER (ORDER BY v) - n + (n + 1) / 2.0 AS rank FROM sz),
wx0 AS (SELECT sum(n)::double AS n, sum(up * rank)::double AS wp, sum(n::double * n * n - n) AS ties FROM rkd),
wx AS (SELECT n::bigint AS n_nonzero, least(wp, n * (n + 1) / 2 - wp) AS wilcoxon_w,
  (least(wp, n * (n + 1) / 2 - wp) - n * (n + 1) / 4) / sqrt((n * (n + 1) * (2 * n + 1) - ties / 2) / 24) AS wilcoxon_z FROM wx0),
{S.avg_rank_cte('ra', 'dd', 'a').strip()}, {S.avg_rank_cte('rb', 'dd', 'b').strip()},
pm AS (SELECT count(*) AS n, avg(d) AS mean_diff, stddev_pop(d) AS std_diff, avg(abs(d)) AS mean_abs_diff, max(abs(d)) AS max_abs_diff,
  avg(d) / (stddev_samp(d) / sqrt(count(*))) AS paired_t, corr(a, b) AS pearson_correlation FROM dd),
sp AS (SELECT corr(ra.rank::double, rb.rank::double) AS spearman_correlation FROM dd JOIN ra ON a = ra.value JOIN rb ON b = rb.value)"""
_PAIR_COLS = ["mean_diff", "std_diff", "mean_abs_diff", "max_abs_diff", "pearson_correlation", "spearman_correlation", "wilcoxon_z"]


@query("paired_tests", f"{_PAIR} SELECT n, n_nonzero, {', '.join(S.r(c, c) for c in _PAIR_COLS)}, {S.r('paired_t', 'paired_t', 4)}, {S.r('wilcoxon_w', 'wilcoxon_w', 1)} FROM pm, wx, sp")
def paired_tests(spark, sf):
    out = E.paired_tests(X.current_side(X.wide_table(spark, sf)), "champ", "chall")
    return rounded(out.select("n", "n_nonzero", *_PAIR_COLS, "paired_t", "wilcoxon_w"), 6, {"paired_t": 4, "wilcoxon_w": 1})


@query("paired_report", f"{_PAIR}, ba AS (SELECT avg(d) AS bias, avg(d) - 1.96 * stddev_pop(d) AS loa_lower, avg(d) + 1.96 * stddev_pop(d) AS loa_upper, "
       "quantile_cont(abs(d), 0.5) AS p50_abs_diff, quantile_cont(abs(d), 0.9) AS p90_abs_diff FROM dd) "
       f"SELECT n, {', '.join(S.r(c, c) for c in ('mean_diff', 'bias', 'loa_lower', 'loa_upper', 'p50_abs_diff', 'p90_abs_diff', 'spearman_correlation'))}, "
       f"{S.r(S.student_p('paired_t', '(n - 1.0)'), 'paired_ttest_p')}, {S.r(S.normal_p('wilcoxon_z'), 'paired_wilcoxon_p')}, spearman_correlation > 0.9 AS agree_on_rank FROM pm, wx, sp, ba")
def paired_report(spark, sf):
    out = E.paired_report(X.current_side(X.wide_table(spark, sf)), "champ", "chall")
    return rounded(out.select(
        "n", "mean_diff", "bias", "loa_lower", "loa_upper", "p50_abs_diff", "p90_abs_diff",
        "spearman_correlation", "paired_ttest_p", "paired_wilcoxon_p", "agree_on_rank",
    ))


# --- canary ------------------------------------------------------------------

_LATENCY = {1: 1.1, 2: 1.2, 3: 1.3, 4: 2.5}


def _canary(stages, latency, max_shift: float) -> str:
    rows = ", ".join(f"({s.day}, {s.champion_share}::double, {C.stage_share(s)!r}::double, {latency[s.day]}::double)" for s in stages)
    arm = f"CASE WHEN ('0x' || substr(md5(concat(row_id, ':', (42 + day)::varchar)), 1, 8))::bigint / 4294967296.0::double < canary_share THEN 1 ELSE 0 END"
    return f"""{WIDE}, st AS (SELECT * FROM (VALUES {rows}) v(day, champion_share, canary_share, latency_ratio)),
served AS (SELECT st.*, champ, chall, {arm} AS arm FROM cur, st),
{S.psi_ctes("SELECT 'y' AS feature, champ AS value FROM cur", "SELECT day, 'y' AS feature, chall AS value FROM served WHERE arm = 1", 'day')},
sm AS (SELECT day, champion_share, canary_share, latency_ratio, count(*) FILTER (arm = 0) AS n_champion, count(*) FILTER (arm = 1) AS n_canary,
  avg(chall) FILTER (arm = 1) - avg(champ) FILTER (arm = 1) AS mean_shift, corr(champ, chall) FILTER (arm = 1) AS correlation FROM served GROUP BY ALL),
hl AS (SELECT sm.*, CASE WHEN n_canary >= 10 THEN psi ELSE 0 END AS pred_psi FROM sm JOIN psi ON psi.day = sm.day::varchar),
fl AS (SELECT *, list_filter([CASE WHEN abs(mean_shift) > {max_shift} THEN 'mean_shift' END, CASE WHEN pred_psi > 0.25 THEN 'prediction_psi' END,
  CASE WHEN latency_ratio > 2.0 THEN 'latency' END, CASE WHEN correlation < 0.85 THEN 'correlation' END], lambda x: x IS NOT NULL) AS fails FROM hl)"""


_CANARY_COLS = ", ".join([
    "day::int AS day", S.r("champion_share", "champion_share"), S.r("canary_share", "canary_share"), "n_champion", "n_canary",
    *[S.r(c, c) for c in ("mean_shift", "pred_psi", "latency_ratio", "correlation")],
    "CASE WHEN len(fails) = 0 THEN 'none' ELSE array_to_string(fails, ',') END AS failed_checks", "len(fails) = 0 AS healthy",
    "CASE WHEN len(fails) = 0 THEN 'promote' ELSE 'rollback' END AS decision",
])


def _decisions(spark, sf, stages, latency, limits):
    return C.canary_health(
        X.current_side(X.wide_table(spark, sf)), "row_id", "champ", "chall", stages, latency, limits
    )


@query("canary_health", f"{_canary([CanaryStage(2, 0.75)], _LATENCY, 1.5)} SELECT {_CANARY_COLS} FROM fl")
def canary_health(spark, sf):
    out = _decisions(spark, sf, [CanaryStage(2, 0.75)], _LATENCY, CanaryThresholds())
    return rounded(out.drop("fails", "reason"))


_SCALED = CanaryThresholds(max_mean_shift=20000.0)  # the mean shift gate in units of this target


@query("canary_stages", f"{_canary(CANARY_STAGES, _LATENCY, 20000.0)} SELECT {_CANARY_COLS} FROM fl")
def canary_stages(spark, sf):
    return rounded(_decisions(spark, sf, CANARY_STAGES, _LATENCY, _SCALED).drop("fails", "reason"))


@query("promotion_gate", f"{_canary(CANARY_STAGES, _LATENCY, 20000.0)} SELECT count(*) FILTER (n_canary > 0) AS n_evidence, count(*) FILTER (len(fails) > 0) AS n_failed, "
       "coalesce(string_agg(day::int::varchar, ',' ORDER BY day) FILTER (len(fails) > 0), '') AS failed_days, "
       "count(*) FILTER (n_canary > 0) > 0 AND count(*) FILTER (len(fails) > 0) = 0 AS promoted, "
       "CASE WHEN count(*) FILTER (n_canary > 0) > 0 AND count(*) FILTER (len(fails) > 0) = 0 THEN 'promote_challenger' ELSE 'rollback_keep_champion' END AS action FROM fl")
def promotion_gate(spark, sf):
    gate = C.promotion_gate(_decisions(spark, sf, CANARY_STAGES, _LATENCY, _SCALED))
    return gate.withColumn("failed_days", F.array_join("failed_days", ","))


_EVEN = {1: 1.1, 2: 1.2, 3: 1.3, 4: 1.4}


@query("gate_to_registry", f"{_canary(CANARY_STAGES, _EVEN, 20000.0)}, "
       "g AS (SELECT count(*) FILTER (n_canary > 0) > 0 AND count(*) FILTER (len(fails) > 0) = 0 AS ok FROM fl), "
       "b AS (SELECT avg(pow(target - chall, 2)) < avg(pow(target - champ, 2)) AS ok FROM cur) "
       "SELECT 'canary' AS gate, g.ok AS passed, (CASE WHEN g.ok THEN 2 ELSE 1 END)::INT AS production FROM g "
       "UNION ALL SELECT 'redeploy', b.ok, (CASE WHEN b.ok THEN 3 WHEN g.ok THEN 2 ELSE 1 END)::INT FROM g, b")
def gate_to_registry(spark, sf):
    """Gates that act: the canary's verdict on version 2, then the validation table's on version 3."""
    registry = runlog.Registry(spark, f"{shared_dir(spark)}/registry-{uuid.uuid4().hex}")
    versions = [registry.register("scorer", Pipeline(stages=[SQLTransformer(statement=f"select *, {rule} as prediction from __THIS__")]).fit(spark.range(1)))
                for rule in ("champ", "chall", "chall")]
    registry.set_alias("scorer", versions[0], "Production")
    cur = X.current_side(X.wide_table(spark, sf))
    better = C.better_on_validation(*[
        cur.agg(F.expr(f"1 - avg(pow(target - {p}, 2)) / var_pop(target) as r2")) for p in ("chall", "champ")])
    rows = []
    for gate, version, verdict, passed in (
        ("canary", versions[1], C.promotion_gate(_decisions(spark, sf, CANARY_STAGES, _EVEN, _SCALED)), "promoted"), ("redeploy", versions[2], better, "redeploy")):
        rows.append((gate, registry.apply_gate("scorer", version, verdict, passed), registry.resolve("scorer", "Production")))
    return spark.createDataFrame(rows, "gate string, passed boolean, production int")


_SERVED = ", ".join(f"({s.day}, {C.stage_share(s)!r}::double)" for s in CANARY_STAGES)


@query("canary_predictions", f"{WIDE}, st AS (SELECT * FROM (VALUES {_SERVED}) v(day, share)) SELECT row_id, day::int AS day, "
       "CASE WHEN ('0x' || substr(md5(concat(row_id, ':', (42 + day)::varchar)), 1, 8))::bigint / 4294967296.0::double < share THEN 1 ELSE 0 END AS arm, "
       f"{S.r('champ', 'champ')}, {S.r('chall', 'chall')} FROM cur, st")
def canary_predictions(spark, sf):
    """The per-arm prediction log, written by stage and read back."""
    log = C.canary_predictions(X.current_side(X.wide_table(spark, sf)), "row_id", "champ", "chall")
    path = f"{shared_dir(spark)}/canary-{uuid.uuid4().hex}"
    log.write.partitionBy("day").parquet(path)
    return rounded(spark.read.parquet(path).select("row_id", "day", "arm", "champ", "chall"))


@query("decision_audit", f"{_canary(CANARY_STAGES, _LATENCY, 20000.0)}, runs AS (SELECT unnest(['run-1', 'run-2']) AS run_id) "
       f"SELECT run_id, {_CANARY_COLS}, '2024-01-01 00:00:00' AS stamped, 'v1' AS champion_version, 'v2' AS challenger_version FROM fl, runs")
def decision_audit(spark, sf):
    """Decisions appended under a run id, so that earlier runs stay in the history."""
    decisions = _decisions(spark, sf, CANARY_STAGES, _LATENCY, _SCALED)
    path = f"{shared_dir(spark)}/audit-{uuid.uuid4().hex}"
    for run in ("run-1", "run-2"):
        append_batch(C.audit_rows(decisions, run, "2024-01-01 00:00:00", "v1", "v2"), path, run)
    stamped = F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss").alias("stamped")
    return rounded(read_batches(spark, path).select("*", stamped).drop("timestamp", "batch_id", "fails", "reason"))


# --- run log and registry over event rows ------------------------------------

_KINDS = ["click", "error", "purchase", "signup", "view"]


@query("run_metrics_pivot", "SELECT user_id, " + ", ".join(
    S.r(f"arg_max(value, (ts, value)) FILTER (event_type = '{k}')", k) for k in _KINDS) + " FROM events GROUP BY user_id")
def run_metrics_pivot(spark, sf):
    events = X.event_table(spark, sf)
    return rounded(runlog.metrics_wide(events, "user_id", "event_type", "value", "ts", _KINDS))


@query("latest_run_by_tag", "SELECT event_type, event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS started FROM "
       "(SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1")
def latest_run_by_tag(spark, sf):
    out = runlog.latest_runs(X.event_table(spark, sf), "event_type", "ts", "event_id")
    return out.select("event_type", "event_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("started"))


@query("registry_current_alias", "SELECT 'model_' || (user_id % 50)::varchar AS name, event_type AS alias, arg_max(event_id, (ts, event_id)) AS version FROM events GROUP BY ALL")
def registry_current_alias(spark, sf):
    events = X.event_table(spark, sf).selectExpr(
        "concat('model_', user_id % 50) as name", "event_type as alias", "event_id as version", "ts"
    )
    return runlog.current_aliases(events, ["name", "alias"], "version", ["ts", "version"])


@query("registry_tags", "SELECT event_id AS version, 'family' AS tag, event_type AS tag_value FROM events "
       "UNION ALL SELECT event_id, 'k', json_extract_string(props, '$.k') FROM events")
def registry_tags(spark, sf):
    versions = X.event_table(spark, sf).selectExpr(
        "event_id as version", "map('family', event_type, 'k', cast(k as string)) as tags"
    )
    return runlog.tag_rows(versions, ["version"], "tags")


# --- training ----------------------------------------------------------------


@query("pca_variance")
def pca_variance(spark, sf):
    return models.pca_variance(X.vector_table(spark, sf), FEATURES)


@query("linear_vs_forest")
def linear_vs_forest(spark, sf):
    return models.linear_vs_forest(X.vector_table(spark, sf), FEATURES)


@query("kmeans_sweep")
def kmeans_sweep(spark, sf):
    return models.kmeans_study(X.vector_table(spark, sf), FEATURES).sweep


@query("kmeans_target_stats")
def kmeans_target_stats(spark, sf):
    study = models.kmeans_study(X.vector_table(spark, sf), FEATURES)
    return study.stats.crossJoin(study.eta.select("eta_squared", (F.col("eta_squared") > 0.10).alias("groups_matter")))


_tuned_models: dict[tuple[str, str, str], models.NestedResult] = {}


def _tuned(spark, sf, space: models.Space) -> models.NestedResult:
    """The operator's whole search over the training side, run once per application and family."""
    key = (spark.sparkContext.applicationId, sf, space.name)
    if key not in _tuned_models:
        train = X.train_side(X.vector_table(spark, sf)).drop("label")
        _tuned_models[key] = models.nested_cv(
            train, "row_id", space, n_outer=5, n_inner=3, n_trials=5, mode="best_outer_fold"
        )
    return _tuned_models[key]


@query("nested_cv_forest")
def nested_cv_forest(spark, sf):
    """Outer-fold scores of a tuned forest."""
    return _tuned(spark, sf, models.forest_space()).scores


@query("nested_cv_boosting")
def nested_cv_boosting(spark, sf):
    """Outer-fold scores of tuned boosted trees."""
    return _tuned(spark, sf, models.boosting_space()).scores


@query("registered_model_scoring")
def registered_model_scoring(spark, sf):
    """Train one forest, register it, resolve the alias, load it and score the blind rows."""
    rows = X.vector_table(spark, sf)
    fixed = {"numTrees": 300, "maxDepth": 12, "minSplit": 4, "minInstancesPerNode": 2, "featureSubsetStrategy": "sqrt"}
    model = models.training_pipeline(models.forest_space().build(fixed, "target"), 46).fit(X.train_side(rows).drop("label"))
    registry = runlog.Registry(spark, f"{shared_dir(spark)}/registry-{uuid.uuid4().hex}")
    version = registry.register("tabular_champion", model, {"family": "RandomForest"})
    registry.set_alias("tabular_champion", version, "Production")
    loaded, v = registry.load("tabular_champion", "Production")
    blind = X.blind_side(rows).drop("label")
    return inference.score(blind, loaded, f"v{v}", "2024-01-01 00:00:00").select("row_id", "prediction", "model_version")
