"""Table reads with a schema contract, and Parquet sinks that are safe to rerun."""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.types import StructType

from plumbline.config import FEATURES

PREDICTION_COLUMNS = "prediction double, prediction_timestamp timestamp, model_version string, batch_id string"
REFERENCE_SNAPSHOT = ", ".join([*[f"{c} double" for c in FEATURES], "target double", "oof_prediction double"])
MONITORING = (
    "day string, timestamp timestamp, n_rows bigint, feature_psi_max double, feature_psi_mean double,"
    " feature_n_alerts bigint, feature_n_warnings bigint, prediction_psi double, prediction_ks double,"
    " prediction_mean double, severity string"
)


class SchemaError(ValueError):
    """The table lacks a column, has an unexpected one or one of another type."""


def check_schema(df: DataFrame, expected: StructType | str, allow_extra: bool = True) -> DataFrame:
    want = StructType.fromDDL(expected) if isinstance(expected, str) else expected
    have = {f.name: f.dataType for f in df.schema}
    missing = [f.name for f in want if f.name not in have]
    typed = [
        f"{f.name}: {have[f.name].simpleString()} instead of {f.dataType.simpleString()}"
        for f in want if f.name in have and have[f.name] != f.dataType
    ]
    extra = [] if allow_extra else [c for c in have if c not in {f.name for f in want}]
    if missing or typed or extra:
        raise SchemaError(f"missing {missing}, wrong type {typed}, unexpected {extra}")
    return df


def scan(spark: SparkSession, name: str, expected: StructType | str | None = None) -> DataFrame:
    """A catalog table or a Parquet path, checked against its contract."""
    df = spark.read.parquet(name) if "/" in name else spark.table(name)
    return check_schema(df, expected) if expected else df


def _files(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where, jvm


def exists(spark: SparkSession, path: str) -> bool:
    fs, where, _ = _files(spark, path)
    return bool(fs.exists(where))


def overwrite(df: DataFrame, path: str) -> None:
    """Replace the table and its schema.

    The new rows are written beside the old ones and swapped in by rename, so the
    table may be overwritten from a plan that reads it, and a failed write leaves
    the old rows in place.
    """
    spark = df.sparkSession
    fresh, old = f"{path}.new-{uuid.uuid4().hex}", f"{path}.old-{uuid.uuid4().hex}"
    df.write.parquet(fresh)
    fs, where, jvm = _files(spark, path)
    path_of = jvm.org.apache.hadoop.fs.Path
    had = fs.exists(where)
    if had and not fs.rename(where, path_of(old)):
        raise OSError(f"{path} can't be moved aside; the new rows are in {fresh}")
    if not fs.rename(path_of(fresh), where):
        if had and not fs.rename(path_of(old), where):
            raise OSError(f"{path} can't be replaced; its rows are in {old}, the new ones in {fresh}")
        raise OSError(f"{path} can't be replaced; it is as it was, the new rows are in {fresh}")
    if had:
        fs.delete(path_of(old), True)


def append_batch(df: DataFrame, path: str, batch_id: str) -> None:
    """Append one batch. Running the same batch again replaces it, never doubles it.

    The batch id is a partition, and only that partition is overwritten; a batch without
    rows leaves the partition without rows. Columns may be added from batch to batch;
    ``read_batches`` merges the schemas.
    """
    seen = Observation()
    rows = df.withColumn("batch_id", F.lit(batch_id)).observe(seen, F.count(F.lit(1)).alias("rows"))
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(path)
    if not seen.get["rows"]:
        spark = df.sparkSession
        name = spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName(batch_id)
        fs, where, _ = _files(spark, f"{path}/batch_id={name}")
        fs.delete(where, True)


def read_batches(spark: SparkSession, path: str) -> DataFrame:
    """All batches; a batch id comes back as the text it was written with ("007", not 7)."""
    seen = spark.read.option("mergeSchema", "true").parquet(path).schema
    fields = [T.StructField(f.name, T.StringType() if f.name == "batch_id" else f.dataType) for f in seen]
    return spark.read.schema(T.StructType(fields)).parquet(path)


def union_batches(frames: list[DataFrame]) -> DataFrame:
    """Concatenate batches by column name; a missing column becomes null."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def export_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def observed_write(df: DataFrame, write: Callable[[DataFrame], None]) -> dict[str, float]:
    """Run a write and report rows, seconds and rows per second, counted on the way."""
    seen = Observation()
    t0 = time.perf_counter()
    write(df.observe(seen, F.count(F.lit(1)).alias("rows")))
    seconds = time.perf_counter() - t0
    rows = seen.get["rows"]
    return {"rows": rows, "seconds": seconds, "rows_per_sec": rows / max(seconds, 1e-6)}


def latency_ms_per_row(df: DataFrame, rows: int) -> float:
    """Wall clock of scoring every row into a sink that keeps nothing."""
    t0 = time.perf_counter()
    df.write.format("noop").mode("overwrite").save()
    return 1000.0 * (time.perf_counter() - t0) / max(rows, 1)
