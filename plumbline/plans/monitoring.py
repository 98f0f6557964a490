"""Queries: drift, monitoring history, severities, streaming drift."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from plumbline.operators import drift as D
from plumbline.operators.perturb import day_plan, perturb
from plumbline.operators.regression import batch_slices as slice_batches
from plumbline.operators.series import concordance
from plumbline.plans import fragments as S
from plumbline.plans.registry import query, rounded
from plumbline.session import shared_dir, stage, tidy
from plumbline.sources import fixtures as X
from plumbline.sources.runlog import retrain_signal
from plumbline.sources.tables import append_batch, read_batches, union_batches
from plumbline.streaming import jobs

WF = X.WIDE_FEATURES
WIDE = f"WITH {S.WIDE}"
_history: dict[tuple[str, str], tuple] = {}

MONTHLY = f"{WIDE}, {S.psi_ctes(S.long('ref', WF), S.long('cur', WF, 'month'), 'month')}"
MONTHLY_KS = f"{MONTHLY}, {S.ks_ctes('month')}"
RECORD = (
    "rec AS (SELECT p.feature, p.month, r.n_all AS n_ref, c.n_all AS n_cur, psi, ks_stat, wasserstein, ks.n, ks.m,"
    " r.m AS ref_mean, c.m AS cur_mean, r.s AS ref_std, c.s AS cur_std, c.m - r.m AS mean_shift,"
    f" 100.0 * (c.n_all - c.n_in) / c.n_all AS out_of_range_pct, {S.severity()} AS severity,"
    " CASE WHEN r.s > 0 THEN (c.m - r.m) / r.s ELSE 0 END AS shift_sigma"
    " FROM psi p JOIN ks USING (feature, month) JOIN side c ON c.feature = p.feature AND c.month = p.month"
    " JOIN side r ON r.feature = p.feature AND r.month = '(reference)')"
)


def _sides(spark, sf):
    df = X.wide_table(spark, sf)
    return X.reference_side(df), X.with_month(X.current_side(df))


@query("psi_features", f"{MONTHLY} SELECT feature, month, {S.r('psi', 'psi')} FROM psi")
def psi_features(spark, sf):
    return rounded(D.psi(*_sides(spark, sf), WF, "month").select("feature", "month", "psi"))


@query("psi_predictions", f"{WIDE}, {S.psi_ctes(S.long('(SELECT champ AS p FROM ref)', ['p']), S.long('(SELECT chall AS p, month FROM cur)', ['p'], 'month'), 'month')} "
       f"SELECT month, {S.r('psi', 'psi')} FROM psi")
def psi_predictions(spark, sf):
    ref, cur = _sides(spark, sf)
    return rounded(D.psi(
        ref.selectExpr("champ as p"), cur.selectExpr("chall as p", "month"), ["p"], "month"
    ).select("month", "psi"))


@query("ks_features", f"{MONTHLY_KS} SELECT feature, month, {S.r('ks_stat', 'ks_stat')}, {S.r(S.kolmogorov('ks_stat', 'n', 'm'), 'ks_pvalue')} FROM ks")
def ks_features(spark, sf):
    return rounded(D.ks_table(*_sides(spark, sf), WF, "month"))


@query("wasserstein_features", f"{MONTHLY_KS} SELECT feature, month, {S.r('wasserstein', 'wasserstein', 5)} FROM ks")
def wasserstein_features(spark, sf):
    out = D.ks_and_wasserstein(*_sides(spark, sf), WF, "month")
    return rounded(out.select("feature", "month", "wasserstein"), 5)


_RECORD_COLS = ["ref_mean", "cur_mean", "ref_std", "cur_std", "mean_shift", "out_of_range_pct", "shift_sigma"]


@query("drift_metrics", f"{MONTHLY_KS}, {RECORD} SELECT feature, month, n_ref, n_cur, {S.r('psi', 'psi')}, {S.r('ks_stat', 'ks_stat')}, "
       f"{S.r(S.kolmogorov('ks_stat', 'n', 'm'), 'ks_pvalue')}, {S.r('wasserstein', 'wasserstein', 5)}, "
       f"{', '.join(S.r(c, c) for c in _RECORD_COLS)}, severity FROM rec")
def drift_metrics(spark, sf):
    out = D.drift(*_sides(spark, sf), WF, "month")
    return rounded(out.select(
        "feature", "month", "n_ref", "n_cur", "psi", "ks_stat", "ks_pvalue", "wasserstein", *_RECORD_COLS, "severity"
    ), 6, {"wasserstein": 5})


@query("psi_ks_concordance", f"{MONTHLY_KS}, {RECORD} SELECT feature, month, {S.r('psi', 'psi')}, {S.r('ks_stat', 'ks_stat')}, "
       f"{S.r('shift_sigma', 'shift_sigma')}, abs(shift_sigma) > 0.1 AS shifted, severity FROM rec")
def psi_ks_concordance(spark, sf):
    return rounded(concordance(D.drift(*_sides(spark, sf), WF, "month"), "month"))


@query("monitoring_by_batch", f"{MONTHLY_KS}, {RECORD} SELECT month, {S.r('max(psi)', 'feature_psi_max')}, {S.r('avg(psi)', 'feature_psi_mean')}, "
       "count(*) FILTER (severity = 'alert') AS feature_n_alerts, count(*) FILTER (severity = 'warning') AS feature_n_warnings FROM rec GROUP BY month")
def monitoring_by_batch(spark, sf):
    """Which months drifted and how severely: the flagship."""
    ref, cur = _sides(spark, sf)
    moments = D.psi(ref, cur, WF, "month")
    return rounded(D.batch_summary(D.with_severity(moments.join(D.ks_table(ref, cur, WF, "month"), ["feature", "month"], "left")), "month"))


_PRED = (
    f"{WIDE}, {S.psi_ctes(S.long('(SELECT champ AS prediction FROM ref)', ['prediction']), S.long('(SELECT chall AS prediction, month FROM cur)', ['prediction'], 'month'), 'month')}, "
    f"{S.ks_ctes('month')}, {RECORD}"
)


@query("prediction_drift", f"{_PRED} SELECT month, n_cur, {S.r('psi', 'psi')}, {S.r('ks_stat', 'ks_stat')}, {S.r('wasserstein', 'wasserstein', 4)}, "
       f"{S.r('cur_mean', 'cur_mean')}, {S.r('mean_shift', 'mean_shift')}, severity FROM rec")
def prediction_drift(spark, sf):
    ref, cur = _sides(spark, sf)
    out = D.drift(ref.selectExpr("champ as prediction"), cur.selectExpr("chall as prediction", "month"), ["prediction"], "month")
    return rounded(out.select("month", "n_cur", "psi", "ks_stat", "wasserstein", "cur_mean", "mean_shift", "severity"), 6, {"wasserstein": 4})


_BASE = f"{WIDE}, {S.psi_ctes(S.long('ref', [*WF, 'target']), S.long('cur', [*WF, 'target'], chr(39) + 'all' + chr(39) + ' AS batch'), 'batch')}, {S.ks_ctes('batch')}"


@query("drift_baseline", f"{_BASE} SELECT feature, {S.r('psi', 'psi')}, {S.r('ks_stat', 'ks_stat')}, {S.r('wasserstein', 'wasserstein', 5)}, "
       f"{S.severity()} AS severity FROM psi JOIN ks USING (feature, batch)")
def drift_baseline(spark, sf):
    ref, cur = _sides(spark, sf)
    out = D.drift(ref, cur.withColumn("batch", F.lit("all")), [*WF, "target"], "batch")
    return rounded(out.select("feature", "psi", "ks_stat", "wasserstein", "severity"), 6, {"wasserstein": 5})


_SHIFT = (
    f"{WIDE}, a AS (SELECT feature, avg(value) AS train_mean, stddev_samp(value) AS train_std FROM ({S.long('ref', WF)}) GROUP BY 1), "
    f"b AS (SELECT feature, avg(value) AS blind_mean, stddev_samp(value) AS blind_std FROM ({S.long('cur', WF)}) GROUP BY 1), "
    "s AS (SELECT *, CASE WHEN train_std > 0 THEN (blind_mean - train_mean) / train_std ELSE 0 END AS shift_sigma FROM a JOIN b USING (feature))"
)


@query("shift_sigma", f"{_SHIFT} SELECT feature, {', '.join(S.r(c, c) for c in ('train_mean', 'train_std', 'blind_mean', 'blind_std', 'shift_sigma'))} FROM s")
def shift_sigma(spark, sf):
    return rounded(D.shift_summary(*_sides(spark, sf), WF))


@query("shift_totals", f"{_SHIFT} SELECT {S.r('max(abs(shift_sigma))', 'max_abs_shift_sigma')}, {S.r('avg(abs(shift_sigma))', 'mean_abs_shift_sigma')}, "
       "count(*) FILTER (abs(shift_sigma) > 1) AS n_features_shifted_gt_1sigma, count(*) FILTER (abs(shift_sigma) > 2) AS n_features_shifted_gt_2sigma FROM s")
def shift_totals(spark, sf):
    return rounded(D.shift_totals(D.shift_summary(*_sides(spark, sf), WF)))


_PROFILE = f"""{WIDE}, {S.psi_ctes(S.long('ref', [*WF, 'target', 'champ']), S.long('ref', [*WF, 'target', 'champ'], chr(39) + 'self' + chr(39) + ' AS b'), 'b')}
SELECT g.feature, g.bin::int AS bin, g.k::int AS n_bins, g.n_all AS n, {S.r('s.m', 'mean')}, {S.r('s.s', 'std')},
  {S.r('e[g.bin + 1] - CASE WHEN g.bin = 0 THEN 1e-6 ELSE 0 END', 'low')}, {S.r('e[g.bin + 2] + CASE WHEN g.bin = g.k - 1 THEN 1e-6 ELSE 0 END', 'high')}, coalesce(c.n, 0) AS n_in_bin
FROM grid g JOIN edges USING (feature) JOIN side s ON s.feature = g.feature AND s.b = g.b
LEFT JOIN cnt c ON c.feature = g.feature AND c.b = g.b AND c.bin = g.bin WHERE g.b = '(reference)'"""


@query("reference_profile", _PROFILE)
def reference_profile(spark, sf):
    """The stored baseline: edges, bin counts and moments per column, so that monitoring
    need not scan the reference again."""
    cols = [*WF, "target", "champ"]
    ref, _ = _sides(spark, sf)
    edges = D.decile_edges(ref, cols)
    tagged = ref.selectExpr(f"'{D.REFERENCE}' as b", *cols)
    rows = [(c, e) for c, e in edges.items()]
    bounds = spark.createDataFrame(rows, "feature string, e array<double>")
    return rounded(
        D.bin_summaries(tagged, edges, "b").join(bounds, "feature")
        .selectExpr("feature", "n_bins", "n", "mean", "std", "e", "posexplode(counts) as (bin, n_in_bin)")
        .selectExpr("feature", "bin", "n_bins", "n", "mean", "std", "e[bin] as low", "e[bin + 1] as high", "n_in_bin")
    )


# --- planted drift and the monitoring history --------------------------------


PREDICTION = "1500.0D * q + 0.01D * tp + 200.0D * ps"


def planted(spark, sf):
    """Reference and four slices with growing planted drift, scored by the champion."""
    ref, cur = _sides(spark, sf)
    sliced = slice_batches(cur.select("row_id", "dt", *WF), ["dt", "row_id"], 4)
    moved = perturb(stage(sliced, "sliced"), ref, "batch", day_plan("q", "tp", "ps"))
    return ref, moved.withColumn("prediction", F.expr(PREDICTION))


def history(spark, sf):
    """(drift records, monitoring rows) of the planted batches, written once per application
    like the monitoring table they stand for."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _history:
        # rows of this size are neither sorted nor written again: batches and changes are expressions
        table = X.drift_table(spark, sf)
        ref = X.reference_side(table).withColumn("prediction", F.expr(PREDICTION))
        sliced = slice_batches(X.current_side(table).select("row_id", "dt", *WF), ["dt", "row_id"], 4, index=False)
        cur = perturb(sliced, ref, "batch", day_plan("q", "tp", "ps")).withColumn("prediction", F.expr(PREDICTION))
        tidy(spark)
        both = stage(D.drift(ref, cur.select("batch", "prediction", *WF), [*WF, "prediction"], "batch"), "records")
        feats, preds = both.where("feature <> 'prediction'"), both.where("feature = 'prediction'")
        _history[key] = (feats, stage(D.monitoring(feats, preds, "batch"), "history"))
    return _history[key]


@query("batch_slices", f"{WIDE}, {S.planted_ctes()} SELECT row_id, batch, idx AS row_index FROM sliced")
def batch_slices(spark, sf):
    _, cur = _sides(spark, sf)
    return slice_batches(cur.select("row_id", "dt"), ["dt", "row_id"], 4).select("row_id", "batch", "row_index")


@query("perturb_batches", f"{WIDE}, {S.planted_ctes()} SELECT row_id, batch, {S.r('q', 'q', 4)}, {S.r('tp', 'tp', 4)}, {S.r('ps', 'ps', 4)} FROM planted")
def perturb_batches(spark, sf):
    return rounded(planted(spark, sf)[1].select("row_id", "batch", "q", "tp", "ps"), 4)


@query("union_batches", f"{WIDE} SELECT month, count(*) AS n, count(chall) AS n_chall, {S.r('avg(champ)', 'champ_mean')} FROM "
       "(SELECT month, champ, NULL AS chall FROM cur WHERE month < '2000-06-01' UNION ALL SELECT month, champ, chall FROM cur WHERE month >= '2000-06-01') GROUP BY month")
def union_batches_query(spark, sf):
    _, cur = _sides(spark, sf)
    early = cur.where("month < '2000-06-01'").select("month", "champ")
    late = cur.where("month >= '2000-06-01'").select("month", "champ", "chall")
    return rounded(union_batches([early, late]).groupBy("month").agg(
        F.count("*").alias("n"), F.count("chall").alias("n_chall"), F.avg("champ").alias("champ_mean")
    ))


HIST = f"WITH {S.history_ctes()}"


@query("overall_severity", f"{HIST} SELECT batch, n_rows, {', '.join(S.r(c, c) for c in ('feature_psi_max', 'feature_psi_mean'))}, "
       f"feature_n_alerts, feature_n_warnings, {', '.join(S.r(c, c) for c in ('prediction_psi', 'prediction_ks', 'prediction_mean'))}, severity FROM hist")
def overall_severity(spark, sf):
    return rounded(history(spark, sf)[1].select(
        "batch", "n_rows", "feature_psi_max", "feature_psi_mean", "feature_n_alerts", "feature_n_warnings",
        "prediction_psi", "prediction_ks", "prediction_mean", "severity",
    ))


@query("severity_timeline", f"{HIST} SELECT batch, severity, {S.r('prediction_psi', 'prediction_psi')}, {S.r('feature_psi_max', 'feature_psi_max')}, feature_n_alerts, feature_n_warnings FROM hist ORDER BY batch")
def severity_timeline(spark, sf):
    return rounded(history(spark, sf)[1].select(
        "batch", "severity", "prediction_psi", "feature_psi_max", "feature_n_alerts", "feature_n_warnings"
    ).orderBy("batch"))


@query("severity_counts", f"{HIST} SELECT count(*) FILTER (severity = 'alert') AS days_alert, count(*) FILTER (severity = 'warning') AS days_warning, count(*) FILTER (severity = 'ok') AS days_ok FROM hist")
def severity_counts(spark, sf):
    is_ = lambda s: F.count_if(F.col("severity") == s)
    return history(spark, sf)[1].agg(
        is_("alert").alias("days_alert"), is_("warning").alias("days_warning"), is_("ok").alias("days_ok")
    )


@query("days_with_drift", f"{HIST} SELECT count(*) AS days_with_drift FROM hist WHERE severity IN ('warning', 'alert')")
def days_with_drift(spark, sf):
    return history(spark, sf)[1].where(F.col("severity").isin("warning", "alert")).agg(F.count("*").alias("days_with_drift"))


@query("top_drift_features", f"{HIST} SELECT batch, feature, {S.r('psi', 'psi')}, row_number() OVER (PARTITION BY batch ORDER BY psi DESC, feature) AS place FROM rec WHERE severity = 'alert' QUALIFY place <= 3")
def top_drift_features(spark, sf):
    return rounded(D.top_drift(history(spark, sf)[0], "batch").select("batch", "feature", "psi", "place"))


@query("monitoring_history", f"{HIST} SELECT batch::varchar AS batch_id, n_rows, {S.r('feature_psi_max', 'feature_psi_max')}, {S.r('feature_psi_mean', 'feature_psi_mean')}, "
       f"feature_n_alerts, feature_n_warnings, {S.r('prediction_psi', 'prediction_psi')}, {S.r('prediction_ks', 'prediction_ks')}, severity FROM hist")
def monitoring_history(spark, sf):
    """The history table: a batch appended at a time, one of them twice, read back."""
    days = stage(history(spark, sf)[1], "days")
    path = f"{shared_dir(spark)}/history-{uuid.uuid4().hex}"
    for batch in (1, 2, 3, 4, 3):
        append_batch(days.where(F.col("batch") == batch).drop("batch"), path, str(batch))
    out = read_batches(spark, path).select(
        "batch_id", "n_rows", "feature_psi_max", "feature_psi_mean", "feature_n_alerts", "feature_n_warnings", "prediction_psi", "prediction_ks", "severity")
    return rounded(out)


@query("retrain_signal", f"{HIST} SELECT batch, severity FROM hist WHERE severity = 'alert' AND batch > (SELECT min(batch) FROM hist WHERE severity = 'alert')")
def retrain_signal_query(spark, sf):
    """A model was retrained on the first alert day; later alerts are still open."""
    days = history(spark, sf)[1]
    retrained = days.where("severity = 'alert'").agg(F.min("batch").alias("batch"))
    return retrain_signal(days, retrained, "batch").select("batch", "severity")


# --- event batches -----------------------------------------------------------

_EV = """WITH ev AS (SELECT *, json_extract_string(props, '$.k')::bigint::double AS k, ts::date AS day FROM events)"""
_EVL = " UNION ALL ".join(
    f"SELECT '{c}' AS feature, {c}::double AS value, strftime(day, '%Y-%m-%d') AS day FROM ev" for c in ("value", "k")
)
_EVENT = f"""{_EV}, evl AS ({_EVL}),
{S.psi_ctes("SELECT feature, value FROM evl WHERE day < '2024-01-15'", "SELECT day, feature, value FROM evl WHERE day >= '2024-01-15'", 'day')},
kb AS (SELECT c.feature, c.day, c.bin,
    sum(coalesce(x.n, 0)) OVER (PARTITION BY c.feature, c.day ORDER BY c.bin) / c.n_in::double AS fc,
    sum(coalesce(y.n, 0)) OVER (PARTITION BY c.feature, c.day ORDER BY c.bin) / f.n_in::double AS fr
  FROM grid c JOIN grid f ON f.feature = c.feature AND f.bin = c.bin AND f.day = '(reference)'
  LEFT JOIN cnt x ON x.feature = c.feature AND x.day = c.day AND x.bin = c.bin
  LEFT JOIN cnt y ON y.feature = c.feature AND y.day = '(reference)' AND y.bin = c.bin WHERE c.day <> '(reference)'),
kd AS (SELECT feature, day, max(abs(fc - fr)) AS ks_binned FROM kb GROUP BY ALL)
SELECT p.day, p.feature, s.n_all AS n, {S.r('s.m', 'mean')}, {S.r('psi', 'psi')}, {S.r('ks_binned', 'ks_binned')}, {S.severity('psi', 'ks_binned')} AS severity
FROM psi p JOIN kd USING (feature, day) JOIN side s ON s.feature = p.feature AND s.day = p.day"""


def _event_baseline(spark, sf):
    events = X.event_table(spark, sf)
    ref = events.where("ts < timestamp '2024-01-15'")
    edges = D.decile_edges(ref, ["value", "k"])
    counts = D.bin_summaries(ref.selectExpr(f"'{D.REFERENCE}' as b", "value", "cast(k as double) as k"), edges, "b")
    return events, edges, stage(counts.selectExpr("feature", "counts as ref_counts"), "baseline")


def _event_rows(out):
    return rounded(out.selectExpr(
        "date_format(window_start, 'yyyy-MM-dd') as day", "feature", "n", "mean", "psi", "ks_binned", "severity"
    ))


@query("event_drift_daily", _EVENT)
def event_drift_daily(spark, sf):
    events, edges, baseline = _event_baseline(spark, sf)
    now = events.where("ts >= timestamp '2024-01-15'")
    return _event_rows(jobs.binned_drift(jobs.windowed_bin_counts(now, "ts", ["value", "k"], edges), baseline, edges))


@query("stream_event_drift", _EVENT)
def stream_event_drift(spark, sf):
    """The same drift table built by a stream over the event file, in event-time windows."""
    events, edges, baseline = _event_baseline(spark, sf)
    raw = X.read(spark, sf, "events")
    stream = jobs.arriving_files(spark, f"{sf}/events.parquet*", raw.schema).selectExpr(
        "cast(ts as timestamp) as ts", "value", "cast(get_json_object(props, '$.k') as bigint) as k"
    ).where("ts >= timestamp '2024-01-15'")
    folder = f"{shared_dir(spark)}/stream-{uuid.uuid4().hex}"
    counts = jobs.windowed_bin_counts(stream, "ts", ["value", "k"], edges)

    def keep(batch, number):
        batch.write.mode("overwrite").parquet(f"{folder}/counts/batch={number}")

    job = counts.writeStream.outputMode("complete").foreachBatch(keep).option(
        "checkpointLocation", f"{folder}/state"
    ).trigger(availableNow=True).start()
    job.awaitTermination()
    written = spark.read.parquet(f"{folder}/counts")
    last = written.where(F.col("batch") == written.agg(F.max("batch")).first()[0]).drop("batch")
    return _event_rows(jobs.binned_drift(last, baseline, edges))


_LATE = """WITH p AS (SELECT event_id, ts, value * 1.9 + 1 AS prediction FROM events),
y AS (SELECT event_id, value * 2 AS label, ts + to_days((event_id % 4)::int) AS label_ts FROM events),
j AS (SELECT p.ts::date AS day, label, prediction FROM p {how} JOIN y ON p.event_id = y.event_id AND label_ts >= p.ts AND label_ts <= p.ts + INTERVAL {days} DAY)
SELECT strftime(day, '%Y-%m-%d') AS day, count(label) AS n_labelled, {counts}""" + ", ".join([
    S.r("sqrt(avg((label - prediction) * (label - prediction)))", "rmse"), S.r("avg(abs(label - prediction))", "mae"),
    S.r("avg(label - prediction)", "mbe"),
    S.r("1 - avg((label - prediction) * (label - prediction)) / var_pop(label)", "r2")]) + " FROM j GROUP BY day"


@query("late_label_performance", _LATE.format(how="", days=2, counts=""))
def late_label_performance(spark, sf):
    return _late_labels(spark, sf, "2 days", "inner").drop("n_unlabelled")


@query("late_label_coverage", _LATE.format(how="LEFT", days=7, counts="count(*) - count(label) AS n_unlabelled, "))
def late_label_coverage(spark, sf):
    """The same after the operator's whole wait, with a count of the events that have no label yet."""
    return _late_labels(spark, sf, "7 days", "left")


def _late_labels(spark, sf, wait: str, how: str):
    events = X.event_table(spark, sf)
    preds = events.selectExpr("event_id", "ts", "value * 1.9D + 1 as prediction")
    labels = events.selectExpr(
        "event_id", "value * 2 as label", "ts + make_dt_interval(cast(pmod(event_id, 4) as int)) as label_ts"
    )
    joined = jobs.late_labels(preds, labels, "event_id", "ts", "label_ts", wait, how)
    daily = jobs.daily_performance(joined, "ts", "label", "prediction")
    return rounded(daily.withColumn("day", F.date_format("day", "yyyy-MM-dd")))
