"""Session settings and the shared folder for staged tables."""

from __future__ import annotations

import gc
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def get_spark(app: str = "plumbline", cores: str | int = "*", **conf: str) -> SparkSession:
    """A local session for tests and the bench; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_own_folders: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    Only a local-mode session may fall back to a temporary folder: on a cluster
    executors on other machines could not see it.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):  # local-cluster has executors of its own
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    app = spark.sparkContext.applicationId
    if app not in _own_folders:
        _own_folders[app] = tempfile.mkdtemp(prefix="plumbline-")
    return _own_folders[app]


def stage(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back.

    Used where an operator needs several passes over something expensive. It cuts
    lineage, survives the loss of executors and keeps column pruning and filter
    pushdown for the later passes.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def tidy(spark: SparkSession) -> None:
    """Collects garbage, here and in the driver's JVM: Spark keeps the shuffle files and broadcasts of finished
    jobs until then, and the heap what their plans took."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()
