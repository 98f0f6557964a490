"""Structured Streaming forms of scoring, drift and late-label monitoring."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from plumbline.config import DriftThresholds
from plumbline.functions.scalar import severity
from plumbline.operators.drift import psi_of_counts, with_bins
from plumbline.operators.inference import score
from plumbline.operators.longform import stack


def arriving_files(spark: SparkSession, path: str, schema, per_trigger: int = 1000) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", per_trigger).parquet(path)


def score_arriving(
    stream: DataFrame, model: PipelineModel, version: str, as_of: str, sink: str, checkpoint: str
) -> StreamingQuery:
    """Score files as they arrive. The file sink and the checkpoint make it exactly-once."""
    return (
        score(stream, model, version, as_of)
        .writeStream.format("parquet").outputMode("append")
        .option("path", sink).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )


def windowed_bin_counts(
    events: DataFrame, ts: str, cols: list[str], edges: dict[str, list[float]],
    window: str = "1 day", delay: str = "1 day",
) -> DataFrame:
    """(window, feature, counts, n) per tumbling event-time window.

    Bin edges come fixed from the reference, so state is one count array per open
    window and feature. Works on a stream and on a table alike.
    """
    rows = events.withWatermark(ts, delay) if events.isStreaming else events
    binned = with_bins(rows.selectExpr(f"`{ts}`", *[f"cast(`{c}` as double) as `{c}`" for c in cols]), edges)
    long = stack(binned, [ts], [
        {"feature": f"'{c}'", "value": f"`{c}`", "bin": f"`{c}__bin`"} for c in cols
    ]).where("value is not null and not isnan(value)")
    width = max(len(e) - 1 for e in edges.values())
    per_bin = ", ".join(f"count_if(bin = {i})" for i in range(width))
    return long.groupBy(F.window(ts, window).alias("w"), "feature").agg(
        F.count("*").alias("n"), F.avg("value").alias("mean"), F.expr(f"array({per_bin}) as counts")
    ).select(F.col("w.start").alias("window_start"), "feature", "n", "mean", "counts")


def binned_drift(
    counts: DataFrame, reference: DataFrame, edges: dict[str, list[float]],
    thresholds: DriftThresholds = DriftThresholds(),
) -> DataFrame:
    """PSI and binned KS of window counts against the reference bin counts.

    ``reference`` has (feature, ref_counts), one row per feature. Binned KS looks at
    bin edges only and is a lower bound of the exact statistic.
    """
    sizes = "map(" + ",".join(f"'{c}',{max(len(e) - 1, 0)}" for c, e in edges.items()) + ")"
    both = counts.join(F.broadcast(reference), "feature").withColumn(
        "counts", F.expr(f"slice(counts, 1, {sizes}[feature])")
    ).withColumn("ref_counts", F.expr(f"slice(ref_counts, 1, {sizes}[feature])"))
    total = "aggregate({0}, 0L, (a, x) -> a + x)"
    both = both.withColumns({
        "_cn": F.expr(total.format("counts")), "_rn": F.expr(total.format("ref_counts"))
    })
    gap = (
        "aggregate(zip_with(counts, ref_counts, (c, r) -> struct(c, r)),"
        " struct(0.0D as c, 0.0D as r, 0.0D as best),"
        " (a, x) -> struct(a.c + x.c / _cn as c, a.r + x.r / _rn as r,"
        " greatest(a.best, abs(a.c + x.c / _cn - a.r - x.r / _rn)) as best), a -> a.best)"
    )
    psi = psi_of_counts(F.col("ref_counts"), F.col("counts"), F.col("_rn"), F.col("_cn"))
    out = both.withColumns({"psi": psi, "ks_binned": F.when(F.col("_cn") > 0, F.expr(gap)).otherwise(0.0)})
    return out.withColumn("severity", severity(F.col("psi"), F.col("ks_binned"), thresholds)).select(
        "window_start", "feature", "n", "mean", "psi", "ks_binned", "severity"
    )


def late_labels(
    predictions: DataFrame, labels: DataFrame, key: str, pred_ts: str, label_ts: str, wait: str = "7 days",
    how: str = "inner",
) -> DataFrame:
    """Predictions joined with labels that arrive up to ``wait`` later.

    On streams both watermarks bound the state; on tables it is a plain join. ``how="left"`` also
    keeps the predictions without a label, on streams once the wait is over.
    """
    p, y = predictions, labels.withColumnRenamed(key, "_key")
    if predictions.isStreaming:
        p, y = p.withWatermark(pred_ts, "1 day"), y.withWatermark(label_ts, "1 day")
    cond = (F.col(key) == F.col("_key")) & (F.col(label_ts) >= F.col(pred_ts)) & (
        F.col(label_ts) <= F.col(pred_ts) + F.expr(f"interval {wait}")
    )
    return p.join(y, cond, how).drop("_key")


def daily_performance(joined: DataFrame, ts: str, y: str, yhat: str) -> DataFrame:
    """Fit metrics per prediction day over rows whose label has arrived, and how many rows have none."""
    err = f"(`{y}` - `{yhat}`)"
    return joined.groupBy(F.to_date(ts).alias("day")).agg(
        F.count(y).alias("n_labelled"), F.count_if(F.col(y).isNull()).alias("n_unlabelled"),
        F.expr(f"sqrt(avg({err} * {err})) as rmse"), F.expr(f"avg(abs({err})) as mae"),
        F.expr(f"avg({err}) as mbe"),
        F.expr(f"1 - avg({err} * {err}) / nullif(var_pop(`{y}`), 0.0D) as r2"),
    )


def for_each_batch(
    stream: DataFrame, job: Callable[[DataFrame, int], None], checkpoint: str
) -> StreamingQuery:
    """Run a batch operator (such as the exact drift record) on every micro-batch.

    ``job`` gets the batch number, so that it can write idempotently under it.
    """
    return stream.writeStream.foreachBatch(job).option("checkpointLocation", checkpoint).trigger(
        availableNow=True
    ).start()
