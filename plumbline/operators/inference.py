"""Batch scoring, prediction summaries and the reference snapshot."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.sources.tables import append_batch, observed_write


def score(df: DataFrame, model: PipelineModel | Column, version: str, as_of: str) -> DataFrame:
    """Input columns plus prediction, time and version. Scoring stays on the executors."""
    if isinstance(model, Column):
        scored = df.withColumn("prediction", model)
    else:
        scored = model.transform(df).select(*df.columns, "prediction")
    return scored.withColumns({
        "prediction_timestamp": F.lit(as_of).cast("timestamp"), "model_version": F.lit(version),
    })


def score_batch(df: DataFrame, model, version: str, as_of: str, path: str, batch_id: str) -> dict:
    """Score and append one batch; returns rows, seconds and rows per second."""
    return observed_write(score(df, model, version, as_of), lambda out: append_batch(out, path, batch_id))


def prediction_summary(predictions: DataFrame) -> DataFrame:
    return predictions.groupBy("model_version").agg(
        F.count("*").alias("n_predictions"),
        F.round(F.avg("prediction"), 3).alias("pred_mean"),
        F.round(F.stddev_samp("prediction"), 3).alias("pred_std"),
        F.round(F.min("prediction"), 2).alias("pred_min"),
        F.round(F.max("prediction"), 2).alias("pred_max"),
        F.max("prediction_timestamp").alias("last_run"),
    )


def prediction_stats(predictions: DataFrame, col: str = "prediction") -> DataFrame:
    return predictions.agg(
        F.count(col).alias("n"), F.avg(col).alias("pred_mean"), F.stddev_pop(col).alias("pred_std"),
        F.min(col).alias("pred_min"), F.max(col).alias("pred_max"),
    )


def reference_snapshot(train: DataFrame, oof: DataFrame, key: str, features: list[str], target: str) -> DataFrame:
    """Features, target and out-of-fold prediction per row, joined by row key."""
    return train.select(key, *features, target).join(oof.select(key, "oof_prediction"), key)
