"""Model interface, sources, sinks, alerts, shards and metrics."""

import json
import math
import os
import time
from collections import Counter
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeline.functions import times, vectors
from gaugeline.ml import scorers
from gaugeline.ml.model import VectorModel, WindowForecaster, WindowForecastModel
from gaugeline.operators import projections, scoring, sharding
from gaugeline.plans import job, metrics, sweep
from gaugeline.session import scratch_dir
from gaugeline.sinks import examples as example_sink
from gaugeline.sinks import predictions as prediction_sink
from gaugeline.sources import examples, files, predictions, telemetry

START = datetime(2020, 10, 1)


@pytest.fixture
def usage(spark):
    rng = np.random.default_rng(11)
    rows = [(START + timedelta(minutes=3 * i), float(v)) for i, v in enumerate(rng.normal(45, 9, 200).round(2))]
    return spark.createDataFrame(rows, "ts timestamp, `%used` double")


def test_model_on_one_unnamed_series(spark, usage):
    model = (
        WindowForecastModel(orderCols=["ts"], timeCol="ts")
        .setInputMapping({"%used": "window"})
        .setOutputMapping({"score": "prediction"})
    )
    out = model.transform(usage).orderBy("window_id").collect()
    assert [r.window_id for r in out] == [0, 1, 2]
    values = np.array([r["%used"] for r in usage.orderBy("ts").collect()])
    for r in out:
        x = values[r.window_id * 60 : r.window_id * 60 + 60]
        low, mid, high = np.percentile(x, [25, 50, 75])
        score = np.tanh((np.arange(1, 61) * (x - mid) / (high - low)).sum() / 1830)
        assert math.isclose(r.prediction, score * (high - low) + mid)
        assert r.window_end == START + timedelta(minutes=3 * (60 * r.window_id + 59))


def test_estimator_against_least_squares(spark, usage, tmp_path):
    estimator = WindowForecaster(orderCols=["ts"], windowSize=2, scaling="none", args={"note": "kept"})
    estimator.setInputMapping({"%used": "window"}).setOutputMapping({"score": "prediction"})
    model = estimator.fit(usage)
    v = np.array([r["%used"] for r in usage.orderBy("ts").collect()])
    x = np.array([[v[i], v[i + 1], 1.0] for i in range(0, 198, 2)])
    y = np.array([v[i + 2] for i in range(0, 198, 2)])
    want = np.linalg.lstsq(x, y, rcond=None)[0]
    assert np.allclose(model.getArgs()["coefficients"], want[:2])
    assert math.isclose(model.getArgs()["intercept"], want[2])
    assert model.getInputMapping() == {"%used": "window"} and model.getArgs()["note"] == "kept"
    path = f"{tmp_path}/model"
    model.write().save(path)
    again = WindowForecastModel.load(path)
    assert again.getArgs() == model.getArgs()
    a = {r.window_id: r.prediction for r in model.transform(usage).collect()}
    assert a == {r.window_id: r.prediction for r in again.transform(usage).collect()}
    assert len(a) == 100


def test_params(spark):
    model = WindowForecastModel(args={"batchSize": 1, "extra": 2})
    assert model.merged_args()["batchSize"] == 100 and model.merged_args()["extra"] == 2
    assert WindowForecaster().getEpochs() == 1 and WindowForecaster().getMaxIter() == 1000
    with pytest.raises(TypeError):
        model.setInputMapping([("a", "b")])
    with pytest.raises(KeyError):
        scorers.lookup("missing")
    with pytest.raises(ValueError):
        model.transform(spark.range(1))


def test_steps_of_the_iterative_fit_count(spark, usage):
    def fitted(**params):
        estimator = WindowForecaster(orderCols=["ts"], windowSize=2, scaling="none", **params)
        args = estimator.setInputMapping({"%used": "window"}).fit(usage).getArgs()
        return np.array([*args["coefficients"], args["intercept"]])

    exact = fitted()
    assert np.allclose(fitted(solver="l-bfgs", maxIter=50, epochs=2), exact, rtol=1e-5)
    assert np.allclose(fitted(solver="l-bfgs", maxIter=1, epochs=3), fitted(solver="l-bfgs", maxIter=3))
    assert not np.allclose(fitted(solver="l-bfgs", maxIter=1), exact, rtol=1e-5)


def test_merged_args_reach_the_scorer(spark, usage):
    scorers.register("told", scorers.Scorer(lambda options: lambda x: np.full(len(x), options["batchSize"] + options["extra"])))
    model = WindowForecastModel(orderCols=["ts"], signature="told", batchSize=7, args={"batchSize": 1, "extra": 2}, scaling="none")
    assert {r.prediction for r in model.setInputMapping({"%used": "x"}).transform(usage).collect()} == {9.0}


def test_vector_model(spark, tmp_path):
    rows = [(i, [float(i), 1.0, -2.0, 5.0], [0.5] * 4) for i in range(7)]
    df = spark.createDataFrame(rows, "id int, a array<double>, b array<double>")
    model = VectorModel(signature="folded_classes", inputShape=[4], args={"classes": 2}, batchSize=3)
    model.setInputMapping({"a": "x"}).setOutputMapping({"scores": "s"})
    model.write().save(f"{tmp_path}/vectors")
    for m in (model, VectorModel.load(f"{tmp_path}/vectors")):
        out = m.transform(df)
        assert out.columns == ["id", "a", "b", "s"]
        assert {r.id: r.s for r in out.collect()} == {i: [i - 2.0, 6.0] for i in range(7)}
    pair = VectorModel(signature="ramp_pair", inputShape=[4]).setInputMapping({"a": "a", "b": "b"})
    row = pair.setOutputMapping({"gap": "g", "level": "l"}).transform(df).where("id = 0").first()
    assert math.isclose(row.l, np.tanh(1.6)) and math.isclose(row.g, np.tanh(1.6) - np.tanh(0.5))


def test_model_file_is_read_through_spark(spark, usage, tmp_path):
    path = tmp_path / "weights.json"
    path.write_text(json.dumps({"coefficients": [0.0] * 59 + [1.0], "intercept": 0.0}))
    model = (
        WindowForecastModel(orderCols=["ts"], signature="linear", modelPath=f"file:{path}")
        .setInputMapping({"%used": "window"})
        .setOutputMapping({"score": "prediction"})
    )
    values = [r["%used"] for r in usage.orderBy("ts").collect()]
    got = {r.window_id: r.prediction for r in model.transform(usage).collect()}
    assert all(math.isclose(got[w], values[w * 60 + 59]) for w in range(3))


def test_wrong_output_size_is_an_error(spark):
    scorers.register("short", scorers.Scorer(lambda options: lambda x: x.sum(axis=1)[:-1]))
    df = spark.createDataFrame([([1.0, 2.0],)] * 4, "v array<double>").coalesce(1)
    with pytest.raises(Exception, match="do not match"):
        scoring.score(df, "v", "short", [2]).collect()


def test_alerts_on_stored_values(spark):
    # Line numbers and values of one stored run with four alerts.
    values = [20.133108, 49.999999, 50.0, 58.548319, float("nan"), None, -1.0]
    rows = [(START, v) for v in values]
    df = spark.createDataFrame(rows, "window_end timestamp, prediction double")
    hits = projections.threshold_alerts(df).orderBy("prediction").collect()
    assert [r.prediction for r in hits] == [50.0, 58.548319]
    assert hits[1].message == (
        "Warning! Anomaly memory usage rate is predicted : 2020/10/01-00:00:00 : 58.548319"
    )


def test_dated_prediction_files(spark, tmp_path):
    line = '{"Datetime":["2020/10/31-21:00:45"],"prediction":[28.98306818528387]}'
    (tmp_path / "part-00000.json").write_text(line + "\n")
    stored = predictions.read_predictions(spark, str(tmp_path))
    (row,) = predictions.prediction_values(stored).collect()
    assert (row.Datetime, row.prediction) == ("2020/10/31-21:00:45", 28.98306818528387)


def test_prediction_sinks_append(spark):
    df = spark.createDataFrame([(START, 1.5)], "window_end timestamp, prediction double")
    base = scratch_dir(spark)
    folder = prediction_sink.write_predictions(df, base, run=times.run_id(datetime(2021, 4, 8, 2, 24, 59)))
    assert folder == f"{base}/20210408022459-prediction"
    prediction_sink.write_predictions(df, base, run="20210408022459-prediction")
    assert predictions.read_predictions(spark, folder).count() == 2
    report = scratch_dir(spark)
    prediction_sink.write_report(df, report)
    assert [r.value for r in spark.read.text(report).collect()] == ["[1.5]"]


def test_examples_by_role(spark, tmp_path):
    (tmp_path / "a.tsv").write_text('city\tsize\tlabel\n"x\t1.5\t1\n\t\t\n')
    (tmp_path / "b.tsv").write_text("city\tsize\tlabel\ny\\z\t2\t0\n")
    got = examples.read_examples(spark, str(tmp_path), continuous=["size"], has_header=True)
    assert sorted(map(tuple, got.collect())) == [('"x', 1.5, 1.0), ("0", 0.0, 0.0), ("y\\z", 2.0, 0.0)]
    plain = tmp_path / "plain"
    plain.mkdir()
    (plain / "c.txt").write_text("a,1,2\nb,oops,3\n")
    read = dict(continuous=["n"], columns=["k", "n", "label"], sep=",")
    with pytest.raises(Exception):
        examples.read_examples(spark, str(plain), **read).collect()
    with pytest.raises(ValueError):
        examples.read_examples(spark, str(plain))


def test_headers_are_skipped_by_place(spark, tmp_path):
    """A data row equal to the header stays; headers may differ, repeat names, and files be split."""
    (tmp_path / "a.tsv").write_text("k\tn\tlabel\nk\t1\t2\n\t\t\nx\t3\t4\n")
    (tmp_path / "b.tsv").write_text("other\tnames\there\nk\t5\t6\n")
    (tmp_path / "c.tsv").write_text("k\tn\tlabel\n" + "y\t7\t8\n" * 20_000)
    kept = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")
    try:
        got = examples.read_examples(spark, str(tmp_path), continuous=["n"], has_header=True)
        assert got.rdd.getNumPartitions() > 3
        found = Counter(map(tuple, got.collect()))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", kept)
    assert found == {("k", 1.0, 2.0): 1, ("0", 0.0, 0.0): 1, ("x", 3.0, 4.0): 1, ("k", 5.0, 6.0): 1, ("y", 7.0, 8.0): 20_000}
    same = tmp_path / "same"
    same.mkdir()
    (same / "d.txt").write_text("k,n,label\nk,n,label\n")
    read = examples.read_examples(spark, str(same), sep=",", use_columns=["k", "n"], has_header=True)
    assert [tuple(r) for r in read.collect()] == [("k", "n")]


def test_longer_arrays_are_an_error(spark):
    stored = spark.createDataFrame([([1.0],), ([],), (None,)], "prediction array<double>")
    assert [r.prediction for r in predictions.prediction_values(stored).collect()] == [1.0, None, None]
    with pytest.raises(Exception, match="more than one item"):
        predictions.prediction_values(spark.createDataFrame([([1.0, 2.0],)], "prediction array<double>")).collect()


def test_shared_folder_is_asked_for_on_a_cluster():
    class Conf(dict):
        def get(self, key, default=None):
            return dict.get(self, key, default)

    class Session:
        conf = Conf({"spark.master": "yarn"})

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_dir(Session())
    Session.conf["spark.checkpoint.dir"] = "hdfs:///shared/"
    assert scratch_dir(Session()).startswith("hdfs:///shared/gaugeline-")


def test_shards_load_the_model_once_per_worker(spark, tmp_path):
    def factory(options):
        (tmp_path / f"{os.getpid()}-{time.time_ns()}").touch()
        return lambda x: x.sum(axis=1)

    scorers.register("counted", scorers.Scorer(factory))
    df = spark.createDataFrame([(i, [float(i), 1.0]) for i in range(400)], "id long, v array<double>").repartition(64)
    got = scoring.score_shards(df, "v", "counted", ["id"], output="s").collect()
    assert sorted((r.id, r.s) for r in got) == [(i, i + 1.0) for i in range(400)]
    assert len(list(tmp_path.iterdir())) < 64


def test_file_listing(spark, tmp_path):
    for name in ("d/x.csv", "d/e/y.csv", "d/e/z.json", "d/_SUCCESS"):
        target = tmp_path / name
        target.parent.mkdir(parents=True, exist_ok=True)
        target.write_text("1\n")
    names = lambda df: sorted(r.path.rsplit("/", 1)[1] for r in df.collect())
    assert names(files.list_files(spark, str(tmp_path))) == ["x.csv", "y.csv", "z.json"]
    assert names(files.list_files(spark, str(tmp_path), [r"e/.*\.csv$", "json"])) == ["y.csv", "z.json"]
    sharded = sharding.file_shards(files.list_files(spark, str(tmp_path)), 2)
    assert [r.shard for r in sharded.orderBy("path").collect()] == [0, 1, 0]


def test_telemetry_file(spark, tmp_path):
    (tmp_path / "m.csv").write_text("Date,time,%used\n2020/10/26,21:42:45,51.5\n")
    raw = telemetry.read_telemetry(spark, str(tmp_path))
    (row,) = telemetry.normalize_telemetry(raw).collect()
    assert (row.series, row.ts, row.value) == ("all", datetime(2020, 10, 26, 21, 42, 45), 51.5)


def test_tied_times_give_the_same_windows(spark):
    """Two readings a minute, ordered by id or, without one, by value: any partitioning agrees."""
    rng = np.random.default_rng(2)
    minute = [(START + timedelta(minutes=i // 2)) for i in range(300)]
    rows = [(i, t.strftime("%Y/%m/%d"), t.strftime("%H:%M:%S"), float(v)) for i, (t, v) in enumerate(zip(minute, rng.normal(50, 9, 300)))]
    raw = spark.createDataFrame(rows, "id int, Date string, time string, `%used` double")
    for ids in (["id"], []):
        seen = []
        for parts in (1, 4, 8):
            table = telemetry.normalize_telemetry(raw.orderBy(F.rand(parts)).repartition(parts), keep=ids)
            run = job.forecast_run(table, scratch_dir(spark), 40, ids, threshold=-1e9, decimals=6)
            stored = predictions.prediction_values(predictions.read_predictions(spark, run.folder))
            assert stored.count() == predictions.read_report(spark, run.report).count() == 8
            seen.append({(r.window_id, r.message) for r in run.alerts.collect()})
        assert len(seen[0]) == 8 and seen[0] == seen[1] == seen[2]


def test_train_and_test_sets(spark):
    df = spark.createDataFrame([(i, i % 3, [i, i]) for i in range(200)] + [(None, 0, [9, 9])], "id bigint, label int, image array<bigint>")
    folders = example_sink.write_train_test(df, scratch_dir(spark), "id", 30, records=25)
    count = {n: examples.read_example_lines(spark, p).count() for n, p in folders.items()}
    assert sum(count.values()) == 201 and 30 <= count["test"] <= 90
    files_written = spark.read.text(folders["train"]).select(F.input_file_name().alias("f")).groupBy("f").count()
    assert files_written.agg(F.max("count")).first()[0] <= 25


def test_shards_and_examples(spark):
    df = spark.createDataFrame([(i, i % 3, [i, 2 * i]) for i in range(40)], "id bigint, label bigint, image array<bigint>")
    lines = scratch_dir(spark)
    example_sink.write_example_lines(df, lines, files=4)
    back = examples.read_example_lines(spark, lines)
    assert sorted((r.label, *r.image) for r in back.collect()) == sorted((i % 3, i, 2 * i) for i in range(40))
    report = scratch_dir(spark)
    scored = df.select("id", "label", (F.col("id") % 2).alias("pred"), sharding.row_shard(F.col("id"), 4).alias("shard"))
    example_sink.write_label_pred(scored, report, files_per_shard=2)
    stored = spark.read.text(report)
    assert {(r.shard, r.n) for r in stored.groupBy("shard").agg(F.count("*").alias("n")).collect()} == {(s, 10) for s in range(4)}
    kept = sharding.dataset_from_rows(spark, [(1,), (2,)], "x int", 3)
    assert kept.rdd.getNumPartitions() == 3 and kept.count() == 2
    kept.unpersist()


def test_shuffle_is_repeatable(spark):
    ids = lambda df: [r.id for r in df.collect()]
    df = spark.range(1000)
    once = ids(sharding.shuffle_rows(df, "id", 1))
    assert once == ids(sharding.shuffle_rows(df.repartition(7), "id", 1))
    assert once != ids(sharding.shuffle_rows(df, "id", 2)) and sorted(once) == list(range(1000))


def test_vector_helpers(spark):
    nan = float("nan")
    df = spark.createDataFrame([([1.0, 5.0, 5.0],), ([nan, 2.0, 9.0],), ([-1.0, -3.0, -2.0],)], "v array<double>")
    assert [r[0] for r in df.select(vectors.argmax(F.col("v"))).collect()] == [1, 0, 0]
    square = spark.createDataFrame([(list(range(784)),)], "v array<bigint>").select(
        vectors.reshape(F.col("v"), 28, 28).alias("m"), vectors.reshape(F.col("v"), 2, 2).alias("bad")
    )
    (row,) = square.collect()
    assert np.array_equal(np.array(row.m), np.arange(784).reshape(28, 28)) and row.bad is None


def test_time_bucket_of_text_and_before_epoch(spark):
    df = spark.createDataFrame([("2020-10-31 21:14:59",), ("1969-12-31 23:59:59",)], "t string")
    got = [times.time_bucket("t"), times.time_bucket("t", 60)]
    rows = [[str(x) for x in r] for r in df.select(*got).collect()]
    assert rows == [["2020-10-31 21:00:00", "2020-10-31 21:14:00"], ["1969-12-31 23:45:00", "1969-12-31 23:59:00"]]


def test_sweep_equals_separate_runs(spark, usage):
    lengths = [50, 120, 130, 500]
    for tail in ("drop", "reuse_previous"):
        swept = sweep.prefix_sweep(usage, lengths, "ts", "%used", 40, time="ts", tail=tail)
        got = {(r.prefix_rows, r.window_id): (r.window_end, round(r.prediction, 9)) for r in swept.collect()}
        want = {}
        for n in lengths:
            head = projections.prefix_rows(usage, n, "ts")
            model = WindowForecastModel(orderCols=["ts"], timeCol="ts", windowSize=40, tail=tail)
            for r in model.setInputMapping({"%used": "x"}).transform(head).collect():
                want[n, r.window_id] = (r.window_end, round(r.prediction, 9))
        assert got == want


def test_run_metrics(spark, usage):
    seen = metrics.measure(usage, "%used", metrics.consume, "usage")
    assert seen.rows == 200 and seen.low <= seen.mean <= seen.high and seen.seconds > 0
    steps = metrics.measure_each([("a", usage), ("b", usage.limit(0))], "%used", metrics.consume)
    assert [(m.stage, m.rows) for m in steps] == [("a", 200), ("b", 0)] and all(m.seconds > 0 for m in steps)


def test_scores_of_several_types(spark):
    scorers.register(
        "both", scorers.Scorer(lambda options: lambda x: {"a": x[:, 0], "b": x[:, 1]}, {"a": T.DoubleType(), "b": T.DoubleType()})
    )
    df = spark.createDataFrame([([1.0, 2.0],)], "v array<double>")
    (row,) = scoring.score(df, "v", "both", [2], "out").collect()
    assert (row.out.a, row.out.b) == (1.0, 2.0)
