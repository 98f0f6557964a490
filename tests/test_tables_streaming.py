import pytest
from pyspark.ml import Pipeline
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from plumbline.operators import drift as D
from plumbline.operators.inference import score, score_batch
from plumbline.sources import runlog, tables
from plumbline.streaming import jobs


def model_of(df):
    return Pipeline(stages=[
        VectorAssembler(inputCols=["x"], outputCol="features"), LinearRegression(labelCol="y"),
    ]).fit(df)


@pytest.fixture(scope="module")
def line(spark):
    return spark.range(200).selectExpr("id as row_id", "cast(id as double) as x", "2.0D * id + 1 as y")


def test_schema_contract(spark, line):
    tables.check_schema(line, "x double")
    with pytest.raises(tables.SchemaError, match="missing"):
        tables.check_schema(line, "z double")
    with pytest.raises(tables.SchemaError, match="instead of int"):
        tables.check_schema(line, "x int")
    with pytest.raises(tables.SchemaError, match="unexpected"):
        tables.check_schema(line, "x double", allow_extra=False)


def test_overwrite_may_read_its_own_table(spark, line, tmp_path):
    path = str(tmp_path / "t")
    tables.overwrite(line, path)
    tables.overwrite(spark.read.parquet(path).where("x < 10").withColumn("z", F.lit(1)), path)
    got = spark.read.parquet(path)
    assert got.count() == 10 and "z" in got.columns


def test_rerun_of_a_batch_does_not_double_it(spark, line, tmp_path):
    path = str(tmp_path / "p")
    model = model_of(line)
    for _ in range(2):
        seen = score_batch(line.drop("y"), model, "1", "2024-01-01", path, "b1")
    assert seen["rows"] == 200 and seen["rows_per_sec"] > 0
    tables.append_batch(score(line.drop("y"), model, "2", "2024-01-02").withColumn("note", F.lit("n")), path, "b2")
    got = tables.read_batches(spark, path)
    assert got.count() == 400 and "note" in got.columns
    assert got.where("batch_id = 'b1'").select("model_version").distinct().collect()[0][0] == "1"


def test_registry_aliases_and_fallback(spark, line, tmp_path):
    reg = runlog.Registry(spark, str(tmp_path / "r"))
    model = model_of(line)
    v1, v2 = reg.register("m", model, {"family": "linear"}), reg.register("m", model)
    assert (v1, v2) == (1, 2)
    reg.set_stage("m", v1, "Production")
    assert reg.resolve("m", "Production") == 1  # stage only
    reg.set_alias("m", v1, "Production")
    reg.set_alias("m", v2, "Challenger")
    reg.promote("m", v2)
    assert reg.resolve("m", "Production") == 2
    with pytest.raises(LookupError):
        reg.resolve("m", "Challenger")
    loaded, v = reg.load("m", "Production")
    assert v == 2 and loaded.transform(line).count() == 200
    assert reg.tags("m", 1).collect()[0].value == "linear"


def test_run_log(spark, tmp_path):
    log = runlog.RunLog(spark, str(tmp_path / "runs"))
    log.log("r1", "first", "training", metrics={"r2": 0.5}, tags={"family": "rf"}, documents={"params": {"k": 3}})
    log.log("r2", "second", "training", metrics={"r2": 0.7}, tags={"family": "rf"})
    runs = log.read()
    wide = runlog.metrics_wide(runs.where("kind = 'metric'"), "run_id", "key", "value", "ts", ["r2"])
    assert {r.run_id: r.r2 for r in wide.collect()} == {"r1": "0.5", "r2": "0.7"}
    newest = runlog.latest_runs(runs.where("kind = 'tag'").withColumnRenamed("value", "family"), "family", "ts", "run_id")
    assert newest.first().run_id == "r2"


def test_csv_export_has_a_header(spark, line, tmp_path):
    tables.export_csv(line.limit(3), str(tmp_path / "c"))
    assert spark.read.option("header", True).csv(str(tmp_path / "c")).columns == ["row_id", "x", "y"]


def test_streamed_scoring_restarts_without_duplicates(spark, line, tmp_path):
    src, sink, state = (str(tmp_path / d) for d in ("in", "out", "state"))
    model, x = model_of(line), line.drop("y")
    x.where("row_id < 100").write.parquet(src)
    for extra in (False, True, False):
        if extra:
            x.where("row_id >= 100").write.mode("append").parquet(src)
        stream = jobs.arriving_files(spark, src, x.schema, 1)
        jobs.score_arriving(stream, model, "1", "2024-01-01", sink, state).awaitTermination()
    got = spark.read.parquet(sink)
    assert got.count() == 200 and got.select("row_id").distinct().count() == 200


def test_streamed_windows_equal_the_batch(spark, tmp_path):
    events = spark.range(600).selectExpr(
        "timestamp '2024-01-01' + make_dt_interval(0, cast(id div 10 as int)) as ts", "cast(id % 37 as double) as v"
    )
    events.repartition(4).write.parquet(str(tmp_path / "ev"))
    edges = D.decile_edges(events, ["v"])
    stream = jobs.arriving_files(spark, str(tmp_path / "ev"), events.schema)
    out = str(tmp_path / "out")

    def keep(df, n):
        df.write.mode("overwrite").parquet(f"{out}/batch={n}")

    q = jobs.windowed_bin_counts(stream, "ts", ["v"], edges).writeStream.outputMode("complete").foreachBatch(keep)
    q.option("checkpointLocation", str(tmp_path / "s")).trigger(availableNow=True).start().awaitTermination()
    streamed = spark.read.parquet(out)
    last = streamed.agg(F.max("batch")).first()[0]
    a = {r.window_start: r.counts for r in streamed.where(f"batch = {last}").collect()}
    b = {r.window_start: r.counts for r in jobs.windowed_bin_counts(events, "ts", ["v"], edges).collect()}
    assert a == b and len(a) == 3


def test_late_labels_stream_join(spark, tmp_path):
    p = spark.range(50).selectExpr("id", "timestamp '2024-01-01' as ts", "cast(id as double) as prediction")
    y = spark.range(50).selectExpr(
        "id", "timestamp '2024-01-01' + make_dt_interval(cast(id % 10 as int)) as label_ts", "id + 1.0D as label"
    )
    p.write.parquet(str(tmp_path / "p"))
    y.write.parquet(str(tmp_path / "y"))
    sp, sy = (spark.readStream.schema(d.schema).parquet(str(tmp_path / n)) for d, n in ((p, "p"), (y, "y")))
    joined = jobs.late_labels(sp, sy, "id", "ts", "label_ts", "7 days")
    joined.writeStream.format("parquet").option("path", str(tmp_path / "o")).option(
        "checkpointLocation", str(tmp_path / "s")
    ).trigger(availableNow=True).start().awaitTermination()
    got = spark.read.parquet(str(tmp_path / "o"))
    assert got.count() == jobs.late_labels(p, y, "id", "ts", "label_ts").count() == 40
    perf = jobs.daily_performance(got, "ts", "label", "prediction").first()
    assert perf.n_labelled == 40 and perf.mbe == 1.0


def test_retrain_signal(spark):
    h = spark.createDataFrame([(1, "ok"), (2, "alert"), (3, "alert")], "timestamp int, severity string")
    none = spark.createDataFrame([], "timestamp int")
    assert runlog.retrain_signal(h, none).count() == 2
    assert runlog.retrain_signal(h, spark.createDataFrame([(2,)], "timestamp int")).collect()[0].timestamp == 3
