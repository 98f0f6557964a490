"""Run log and model registry as append-only tables."""

from __future__ import annotations

import json
import uuid
from datetime import datetime, timezone

from py4j.protocol import Py4JJavaError
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.sources.tables import _files, exists

RUN_SCHEMA = "run_id string, run_name string, stage string, kind string, key string, value string, ts timestamp"
EVENT_SCHEMA = "name string, version bigint, event string, key string, value string, event_ts timestamp, seq bigint"


class RunLog:
    """Metrics, tags, parameters and small documents of a run as long rows."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def log(
        self, run_id: str, run_name: str, stage: str, metrics: dict | None = None,
        tags: dict | None = None, params: dict | None = None, documents: dict | None = None,
        ts: datetime | None = None,
    ) -> None:
        ts = ts or datetime.now(timezone.utc).replace(tzinfo=None)
        rows = []
        for kind, items in (("metric", metrics), ("tag", tags), ("param", params), ("document", documents)):
            for k, v in (items or {}).items():
                text = json.dumps(v) if kind == "document" else str(v)
                rows.append((run_id, run_name, stage, kind, k, text, ts))
        self.spark.createDataFrame(rows, RUN_SCHEMA).coalesce(1).write.mode("append").parquet(self.path)

    def read(self) -> DataFrame:
        return self.spark.read.schema(RUN_SCHEMA).parquet(self.path)


def metrics_wide(runs: DataFrame, run: str, key: str, value: str, ts: str, keys: list[str]) -> DataFrame:
    """One row per run with the latest value of every named key."""
    return runs.groupBy(run).agg(*[
        F.max_by(value, F.when(F.col(key) == k, F.struct(ts, value))).alias(k) for k in keys
    ])


def latest_runs(runs: DataFrame, family: str, start: str, run: str) -> DataFrame:
    """The most recent run per tag value; the largest run id breaks a tie."""
    newest = F.max_by(F.struct(run, start), F.struct(start, run)).alias("r")
    return runs.groupBy(family).agg(newest).select(family, f"r.{run}", f"r.{start}")


def claim(spark: SparkSession, folder: str, first: int) -> int:
    """The first number from ``first`` on that nobody has claimed in ``folder``; now it is claimed.

    Hadoop's local file system looks for the file and then opens it, so two writers may both create it;
    there the file is created by Java, in one step.
    """
    number = first
    while True:
        fs, where, _ = _files(spark, f"{folder}/{number}")
        if fs.getUri().getScheme() == "file":
            fs.mkdirs(where.getParent())
            if spark._jvm.java.io.File(fs.makeQualified(where).toUri().getPath()).createNewFile():
                return number
            number += 1
            continue
        try:
            fs.create(where, False).close()
            return number
        except Py4JJavaError as taken:
            if not fs.exists(where):
                raise taken
            number += 1


class Registry:
    """Model versions, tags and aliases as events; the last event per alias wins.

    Numbers of versions and events are claimed by creating a file that must not exist, so two
    writers at once get different ones; each writes its events into a folder of their own.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def events(self) -> DataFrame:
        if not exists(self.spark, f"{self.path}/events"):
            return self.spark.createDataFrame([], EVENT_SCHEMA)
        return self.spark.read.schema(EVENT_SCHEMA).option("recursiveFileLookup", "true").parquet(f"{self.path}/events")

    def _append(self, rows: list[tuple]) -> None:
        last = self.events().agg(F.coalesce(F.max("seq"), F.lit(0))).first()[0]
        now = datetime.now(timezone.utc).replace(tzinfo=None)
        data = []
        for r in rows:
            last = claim(self.spark, f"{self.path}/claims/events", last + 1)
            data.append((*r, now, last))
        self.spark.createDataFrame(data, EVENT_SCHEMA).coalesce(1).write.parquet(f"{self.path}/events/{uuid.uuid4().hex}")

    def register(self, name: str, model: PipelineModel, tags: dict | None = None) -> int:
        version = self.events().where(F.col("name") == name).agg(F.coalesce(F.max("version"), F.lit(0))).first()[0] + 1
        version = claim(self.spark, f"{self.path}/claims/{name}", version)
        model.write().overwrite().save(f"{self.path}/models/{name}/{version}")
        self._append([(name, version, "register", None, None)]
                     + [(name, version, "tag", k, str(v)) for k, v in (tags or {}).items()])
        return version

    def set_alias(self, name: str, version: int, alias: str) -> None:
        self._append([(name, version, "alias", alias, None)])

    def delete_alias(self, name: str, alias: str) -> None:
        self._append([(name, None, "alias", alias, None)])

    def set_stage(self, name: str, version: int, stage: str) -> None:
        self._append([(name, version, "stage", stage, None)])

    def resolve(self, name: str, alias: str) -> int:
        """Version of the alias or, where it was never set, of the stage of that name; a deleted alias has none."""
        now = current_aliases(
            self.events().where((F.col("name") == name) & (F.col("key") == alias)).where(
                F.col("event").isin("alias", "stage")
            ),
            ["name", "event"], "version", ["event_ts", "seq"],
        ).collect()
        found = {r["event"]: r["version"] for r in now}
        version = found["alias"] if "alias" in found else found.get("stage")
        if version is None:
            raise LookupError(f"{name}@{alias} is not registered")
        return version

    def load(self, name: str, alias: str) -> tuple[PipelineModel, int]:
        version = self.resolve(name, alias)
        return PipelineModel.load(f"{self.path}/models/{name}/{version}"), version

    def tags(self, name: str, version: int) -> DataFrame:
        rows = self.events().where(
            (F.col("name") == name) & (F.col("version") == version) & (F.col("event") == "tag")
        )
        return rows.groupBy("key").agg(F.max_by("value", F.struct("event_ts", "seq")).alias("value"))

    def promote(self, name: str, challenger: int) -> None:
        """The challenger becomes Production, the old champion is archived."""
        try:
            old = self.resolve(name, "Production")
        except LookupError:
            old = None
        rows = [(name, challenger, "alias", "Production", None), (name, None, "alias", "Challenger", None)]
        if old is not None and old != challenger:
            rows.append((name, old, "stage", "Archived", None))
        self._append(rows)


    def apply_gate(self, name: str, challenger: int, verdict: DataFrame, passed: str = "promoted") -> bool:
        """Acts on the one row of a promotion or redeployment gate: promotes, or keeps the champion and records that."""
        row = verdict.select(passed).first()
        go = bool(row and row[0])
        if go:
            self.promote(name, challenger)
        else:
            self._append([(name, challenger, "tag", "gate", "kept_champion")])
        return go


def current_aliases(events: DataFrame, keys: list[str], version: str, order: list[str]) -> DataFrame:
    return events.groupBy(*keys).agg(F.expr(
        f"max_by(struct({version}), struct({', '.join(order)})).{version}"
    ).alias(version))


def tag_rows(versions: DataFrame, keys: list[str], tags: str) -> DataFrame:
    """One row per tag of a map column."""
    return versions.select(*keys, F.explode(F.map_entries(tags)).alias("e")).select(
        *keys, F.col("e.key").alias("tag"), F.col("e.value").alias("tag_value")
    )


def retrain_signal(history: DataFrame, retrains: DataFrame, ts: str = "timestamp") -> DataFrame:
    """Alert rows that no later retraining has answered. The last retraining is one row."""
    last = retrains.agg(F.max(ts).alias("_last"))
    return history.where(F.col("severity") == "alert").crossJoin(F.broadcast(last)).where(
        F.col("_last").isNull() | (F.col(ts) > F.col("_last"))
    ).drop("_last")
