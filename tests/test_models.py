"""Model bundles, fits that go on from their state, shuffle buffers, gangs, operator metrics."""

import random

import numpy as np
import pytest
from gaugeline.ml.bundle import Function, load_function, read_bundle, write_bundle
from gaugeline.ml.model import VectorModel, WindowForecaster, WindowForecastModel
from gaugeline.operators import scoring, sharding
from gaugeline.plans import gradient
from gaugeline.plans.metrics import operator_metrics
from pyspark.errors import PySparkException
from pyspark.sql import functions as F


@pytest.fixture()
def bundle(spark, tmp_path):
    path = str(tmp_path / "bundle")
    sums = Function("linear", ["a", "b"], {"total": "score"}, {"coefficients": [1.0, 1.0, 10.0, 10.0], "intercept": 0.5})
    pair = Function("ramp_pair", ["b", "a"], {"upper": "level"})
    write_bundle(spark, path, {"serve": {"sums": sums, "pair": pair}, "serve,gpu": {"sums": pair}})
    return path


def rows(spark):
    return spark.createDataFrame([(1, [1.0, 2.0], [3.0, 4.0]), (2, [0.0, 0.0], [1.0, 1.0])], "id int, x array<double>, y array<double>")


def test_functions_of_a_bundle(spark, bundle):
    model = VectorModel(inputShape=[2], exportDir=bundle, signature="sums").setInputMapping({"x": "a", "y": "b"}).setOutputMapping({"total": "t"})
    assert {r.id: r.t for r in model.transform(rows(spark)).collect()} == {1: 73.5, 2: 20.5}
    # the same columns under the other inputs: the function finds them by name
    model.setInputMapping({"x": "b", "y": "a"})
    assert {r.id: r.t for r in model.transform(rows(spark)).collect()} == {1: 37.5, 2: 2.5}
    model.setInputMapping({"x": "a", "y": "b"}).setSignature("pair").setOutputMapping({"upper": "u"})
    ramp = (np.array([1.0, 2.0]) / 3) @ np.array([3.0, 4.0])
    assert model.transform(rows(spark)).where("id = 1").first().u == pytest.approx(np.tanh(ramp))


def test_wrong_tags_signatures_and_inputs_are_errors(spark, bundle):
    assert set(read_bundle(spark, bundle, "gpu, serve")) == {"sums"}
    with pytest.raises(ValueError, match="no variant with tags 'train'"):
        read_bundle(spark, bundle, "train")
    with pytest.raises(KeyError, match="no signature 'level'"):
        load_function(spark, bundle, "level")
    write_bundle(spark, f"{bundle}-2", {"serve": {"f": Function("ramp_pair", ["a", "b"], {"x": "none"})}})
    with pytest.raises(ValueError, match="no output"):
        load_function(spark, f"{bundle}-2", "f")
    model = VectorModel(inputShape=[2], exportDir=bundle, signature="sums").setInputMapping({"x": "a", "y": "c"}).setOutputMapping({"total": "t"})
    with pytest.raises(PySparkException, match="takes inputs"):
        model.transform(rows(spark)).collect()


def test_window_model_of_a_bundle_is_saved_with_its_place(spark, bundle, tmp_path):
    write_bundle(spark, f"{bundle}-3", {"serve": {"mean": Function("window_mean", ["w"], {"mean": "score"})}})
    model = WindowForecastModel(orderCols=["i"], windowSize=5, scaling="none", exportDir=f"{bundle}-3", signature="mean")
    model.setInputMapping({"v": "w"}).setOutputMapping({"mean": "p"})
    model.save(str(tmp_path / "model"))
    table = spark.range(20).select(F.col("id").alias("i"), F.col("id").cast("double").alias("v"))
    again = WindowForecastModel.load(str(tmp_path / "model"))
    assert again.getTagSet() == "serve" and sorted(r.p for r in again.transform(table).collect()) == [2.0, 7.0, 12.0, 17.0]


def examples(spark, n=400, width=5):
    draw = np.random.default_rng(1)
    x = draw.normal(size=(n, width)) * [1, 10, 0.1, 3, 1]
    y = x @ np.arange(1, width + 1) + 7 + draw.normal(size=n)
    df = spark.createDataFrame([(r.tolist(), float(t)) for r, t in zip(x, y)], "features array<double>, label double")
    return df.repartition(5).persist(), np.linalg.lstsq(np.column_stack([x, np.ones(n)]), y, rcond=None)[0]


def test_a_fit_goes_on_from_its_state(spark, tmp_path):
    df, exact = examples(spark)
    whole = gradient.fit_linear(df, 12)
    assert np.allclose(whole.weights, exact, atol=1e-6)
    short = gradient.fit_linear(df, 4)
    for steps in (2, 4):
        resumed = gradient.fit_linear(df, steps, model_dir=str(tmp_path / "state"))
    assert resumed.step == 4 and np.allclose(resumed.weights, short.weights, rtol=1e-9)
    assert gradient.latest_state(spark, str(tmp_path / "state")) == resumed
    assert gradient.fit_linear(df, 3, model_dir=str(tmp_path / "state")) == resumed
    assert not np.allclose(short.weights, whole.weights, atol=1e-6)
    with pytest.raises(ValueError, match="has a state of 400 examples"):
        gradient.fit_linear(df.limit(10), 5, model_dir=str(tmp_path / "state"))


def test_fit_without_examples_and_constant_features(spark):
    with pytest.raises(ValueError, match="no training examples"):
        gradient.fit_linear(spark.createDataFrame([], "features array<double>, label double"), 3)
    flat = spark.createDataFrame([([0.0, 1.0], 3.0), ([0.0, 2.0], 5.0), ([0.0, 3.0], 7.0)], "features array<double>, label double")
    assert np.allclose(gradient.fit_linear(flat, 10).weights, [0.0, 2.0, 1.0], atol=1e-8)


def test_estimator_resumes(spark, tmp_path):
    table = spark.range(300).select(F.col("id").alias("i"), (F.sin("id") * 10 + F.col("id") % 7).alias("v"))
    common = dict(orderCols=["i"], windowSize=3, scaling="none", inputMapping={"v": "w"}, outputMapping={"score": "p"})
    exact = WindowForecaster(**common).fit(table).getArgs()
    state = str(tmp_path / "state")
    for epochs in (1, 6):
        model = WindowForecaster(**common, solver="gradient", maxIter=1, epochs=epochs, modelDir=state).fit(table)
    assert np.allclose(model.getArgs()["coefficients"], exact["coefficients"], atol=1e-7)
    assert model.getArgs()["intercept"] == pytest.approx(exact["intercept"], abs=1e-6)
    assert gradient.latest_state(spark, state).step <= 6


def replay(rows, buffer, seed, partition):
    draw, held, out = random.Random(f"{seed}-{partition}"), [], []
    for row in rows:
        if len(held) < buffer:
            held.append(row)
        else:
            place = draw.randrange(buffer)
            out.append(held[place])
            held[place] = row
    draw.shuffle(held)
    return out + held


@pytest.mark.parametrize("buffer", [1, 7, 512, 5000])
def test_shuffle_buffer_equals_a_plain_replay(spark, buffer):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 100)
    try:
        df = spark.range(0, 3000, 1, 3).withColumn("t", F.array(F.col("id").cast("string")))
        mixed = sharding.buffer_shuffle(df, buffer, seed=9).withColumn("part", F.spark_partition_id()).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    for part in range(3):
        want = replay(range(part * 1000, part * 1000 + 1000), buffer, 9, part)
        assert [r.id for r in mixed if r.part == part] == want
        assert all(r.t == [str(r.id)] for r in mixed)


def test_shuffle_buffer_has_no_exchange(spark):
    plan = sharding.buffer_shuffle(spark.range(10))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Sort" not in plan
    assert sharding.buffer_shuffle(spark.range(0)).count() == 0
    with pytest.raises(ValueError):
        sharding.buffer_shuffle(spark.range(3), 0)


def test_gang_scores_each_shard_in_a_task_of_its_own(spark):
    df = spark.range(40).select("id", sharding.row_shard(F.col("id"), 3).alias("shard"), F.array(F.col("id").cast("double"), F.lit(1.0)).alias("v"))
    gang = sharding.gang_partitions(df, 3)
    alone = scoring.score_shards(df, "v", "folded_classes", keep=["id", "shard"], options={"classes": 2})
    together = scoring.score_shards(gang, "v", "folded_classes", keep=["id", "shard"], options={"classes": 2}, gang=True)
    assert sorted(together.collect()) == sorted(alone.collect())
    assert together.rdd.getNumPartitions() == 3
    assert together.withColumn("task", F.spark_partition_id()).where("task <> shard").count() == 0


def test_rows_and_time_of_each_operator(spark):
    df = spark.range(1000).where("id % 2 = 0").groupBy((F.col("id") % 10).alias("k")).count()
    found = operator_metrics(df)
    assert found[0].depth == 0 and max(m.depth for m in found) >= 4
    by = {}
    for m in found:
        by.setdefault(m.operator.split(" (")[0], []).append(m)
    assert [m.rows for m in by["Filter"]] == [500]
    assert sorted(m.rows for m in by["HashAggregate"])[0] == 5
    assert any(m.seconds > 0 for m in found if "Codegen" in m.operator) and by["Exchange"][0].rows > 0
