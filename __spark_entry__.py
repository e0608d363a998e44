"""

Every query reads the whole of the tables it names. Round trips write below
the folder the session names in ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import os
import sys
from collections.abc import Callable

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from gaugeline.functions import times, vectors  # noqa: E402
from gaugeline.ml import bundle  # noqa: E402
from gaugeline.ml.model import WindowForecaster, WindowForecastModel  # noqa: E402
from gaugeline.operators import indexing, projections, scaling, scoring, sharding, windows  # noqa: E402
from gaugeline.plans import forecast, job, metrics, sweep, training  # noqa: E402
from gaugeline.plans.classify import classify_vectors  # noqa: E402
from gaugeline.session import scratch_dir, written  # noqa: E402
from gaugeline.sinks import examples as example_sink  # noqa: E402
from gaugeline.sinks import predictions as prediction_sink  # noqa: E402
from gaugeline.sinks import runs  # noqa: E402
from gaugeline.sources import examples, files, predictions, telemetry  # noqa: E402
from gaugeline.sources.file_order import FILE_ORDER, in_file_order  # noqa: E402

try:  # the training-data operators are a part that can be left out
    import gaugeline.llm.queries as llm  # noqa: E402

    import corpus_pipeline  # noqa: E402
except ModuleNotFoundError as error:
    if not (error.name or "").startswith(("gaugeline.llm", "corpus_pipeline")):
        raise
    llm = None

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_ORACLES: dict[str, str] = {}

SIZE = 60
SERIES = ["event_type"]
ORDER = ["ts", "event_id"]
LINE_SERIES = ["l_returnflag"]
# Order and line number do not tell all lines apart; with the part key they do.
LINE_ORDER = ["l_shipdate", "l_orderkey", "l_linenumber", "l_partkey"]
LINE_INPUTS = ["l_extendedprice", "l_quantity"]
SWEEP = [480, 960, 1440]
CUT_SWEEP = [90, 480, 1000]


def query(name: str, sql: str | None = None):
    def add(build: Callable[[SparkSession, str], DataFrame]):
        _QUERIES[name] = build
        if sql is not None:
            _ORACLES[name] = sql
        return build

    return add


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    # Times are wall-clock readings: the session zone must not shift them.
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "events")


def _embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "embeddings")


def _lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "lineitem")


def _images(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Embeddings on an integer intensity scale: the labelled example set."""
    cell = lambda x: F.floor(x.cast("double") * 127 + 128).cast("bigint")
    return _embeddings(spark, sf_dir).select(
        "vec_id", F.col("label").cast("bigint").alias("label"),
        F.transform("embedding", cell).alias("image"),
    )


def _event_windows(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    return windows.window_vectors(
        _events(spark, sf_dir), ORDER, "value", SIZE, SERIES, "ts", **options
    )


def _predictions(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    return forecast.predict_windows(
        _events(spark, sf_dir), ORDER, "value", SIZE, SERIES, "ts", **options
    )


def _usage_files(spark: SparkSession, sf_dir: str) -> str:
    """Usage files with separate date and time columns and a header."""
    target = scratch_dir(spark)
    _events(spark, sf_dir).select(
        "event_id",
        "event_type",
        F.date_format("ts", "yyyy/MM/dd").alias("Date"),
        F.date_format("ts", "HH:mm:ss").alias("time"),
        F.col("value").alias("%used"),
    ).write.option("header", True).csv(target)
    return target


def _stamp(column: str):
    return times.time_text(F.col(column))


# --------------------------------------------------------------------------
# SQL building blocks
# --------------------------------------------------------------------------

_STAMP = "strftime({}, '%Y/%m/%d-%H:%M:%S')"

_CELLS = """
idx AS (
  SELECT event_type, event_id, ts, value,
         row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) - 1 AS row_idx
  FROM events
),
cells AS (
  SELECT *, row_idx // 60 AS window_id, row_idx % 60 AS pos FROM idx
)"""

_FIT = (
    _CELLS
    + """,
fit AS (
  SELECT event_type, window_id, count(*) AS n, max(ts) AS window_end,
         quantile_cont(value, 0.5) AS center,
         CASE WHEN quantile_cont(value, 0.75) = quantile_cont(value, 0.25) THEN 1.0
              ELSE quantile_cont(value, 0.75) - quantile_cont(value, 0.25) END AS scale
  FROM cells GROUP BY event_type, window_id
),
scaled AS (
  SELECT c.event_type, c.window_id, c.pos, c.value, f.n, f.center, f.scale,
         (c.value - f.center) / f.scale AS x
  FROM cells c JOIN fit f USING (event_type, window_id)
),
scores AS (
  SELECT event_type, window_id, any_value(n) AS n,
         tanh(sum((pos + 1) * x) / 1830.0) AS score,
         avg(x) AS mean_score
  FROM scaled GROUP BY event_type, window_id
)"""
)

_PREDICTED = (
    _FIT
    + """,
predicted AS (
  SELECT f.event_type, f.window_id, f.window_end, s.score * f.scale + f.center AS prediction,
         s.mean_score * f.scale + f.center AS mean_prediction
  FROM fit f JOIN scores s USING (event_type, window_id)
  WHERE f.n = 60
)"""
)

# Usage files hold whole seconds.
_SECONDS_FIT = _FIT.replace(
    "FROM events",
    "FROM (SELECT event_id, event_type, date_trunc('second', ts) AS ts, value FROM events)",
)
_MESSAGE = (
    "printf('"
    + projections.ALERT_MESSAGE.replace("%s : %s", "%s : %.6f")
    + f"', {_STAMP.format('window_end')}, prediction)"
)

_LINE_FIT = """
cells AS (
  SELECT *, row_idx // 60 AS window_id, row_idx % 60 AS pos
  FROM (SELECT l_returnflag, l_quantity AS q, l_extendedprice AS p,
               row_number() OVER (PARTITION BY l_returnflag
                                  ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey) - 1 AS row_idx
        FROM lineitem)
),
fit AS (
  SELECT l_returnflag, window_id, count(*) AS n,
         quantile_cont(q, 0.5) AS q_center, quantile_cont(p, 0.5) AS p_center,
         CASE WHEN quantile_cont(q, 0.75) = quantile_cont(q, 0.25) THEN 1.0
              ELSE quantile_cont(q, 0.75) - quantile_cont(q, 0.25) END AS q_scale,
         CASE WHEN quantile_cont(p, 0.75) = quantile_cont(p, 0.25) THEN 1.0
              ELSE quantile_cont(p, 0.75) - quantile_cont(p, 0.25) END AS p_scale
  FROM cells GROUP BY l_returnflag, window_id
)"""

_IMAGES = """
images AS (
  SELECT vec_id, CAST(label AS BIGINT) AS label,
         [CAST(floor(CAST(x AS DOUBLE) * 127 + 128) AS BIGINT) FOR x IN embedding] AS image
  FROM embeddings
)"""

_CLASSES = """
classes AS (
  SELECT vec_id, label, (pos - 1) % 10 AS class, sum(CAST(embedding[pos] AS DOUBLE) / 255.0) AS score
  FROM (SELECT vec_id, label, embedding, unnest(range(1, len(embedding) + 1)) AS pos FROM embeddings)
  GROUP BY vec_id, label, class
),
best AS (
  SELECT vec_id, CAST(label AS BIGINT) AS label, CAST(class AS BIGINT) AS pred
  FROM (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY score DESC, class) AS rk FROM classes)
  WHERE rk = 1
)"""


# --------------------------------------------------------------------------
# Flagship: scoring and alerts
# --------------------------------------------------------------------------


@query(
    "anomaly_alerts",
    f"""WITH {_PREDICTED}
    SELECT event_type, window_id, round(prediction, 6) AS prediction,
           {_MESSAGE} AS message
    FROM predicted WHERE prediction >= 50""",
)
def anomaly_alerts(spark, sf_dir):
    alerts = projections.threshold_alerts(_predictions(spark, sf_dir), decimals=6)
    return alerts.select(
        "event_type", "window_id", F.round("prediction", 6).alias("prediction"), "message"
    )


@query(
    "telemetry_alerts",
    f"""WITH {_SECONDS_FIT},
    predicted AS (
      SELECT f.event_type AS series, f.window_id, f.window_end, s.score * f.scale + f.center AS prediction
      FROM fit f JOIN scores s ON s.event_type = f.event_type AND s.n = 60
       AND s.window_id = CASE WHEN f.n = 60 THEN f.window_id ELSE f.window_id - 1 END)
    SELECT series, window_id, round(prediction, 6) AS prediction, {_MESSAGE} AS message,
           count(*) OVER () AS alerts, (SELECT count(*) FROM predicted) AS predictions,
           (SELECT count(*) FROM predicted) AS report_lines
    FROM predicted WHERE prediction >= 50""",
)
def telemetry_alerts(spark, sf_dir):
    """Usage files to the alerts of a run; its JSON and report lines are read back and counted."""
    target, schema = _usage_files(spark, sf_dir), "event_id bigint, event_type string, Date string, time string, `%used` double"
    raw = telemetry.read_telemetry(spark, target, schema)
    rows = telemetry.normalize_telemetry(raw, series="event_type", keep=["event_id"])
    run = job.forecast_run(rows, scratch_dir(spark), SIZE, ["event_id"], decimals=6)
    stored = predictions.prediction_values(predictions.read_predictions(spark, run.folder))
    lines = predictions.read_report(spark, run.report)
    n = lambda df, name: df.agg(F.count("prediction").alias(name))
    return (
        run.alerts.select("series", "window_id", F.round("prediction", 6).alias("prediction"), "message")
        .withColumn("alerts", F.lit(run.alerts.count()).cast("bigint"))
        .withColumn("predictions", n(stored, "n").scalar())
        .withColumn("report_lines", n(lines, "n").scalar())
    )


@query(
    "score_windows",
    f"""WITH {_PREDICTED}
    SELECT event_type, window_id, round(prediction, 6) AS prediction FROM predicted""",
)
def score_windows(spark, sf_dir):
    model = (
        WindowForecastModel(seriesCols=SERIES, orderCols=ORDER)
        .setInputMapping({"value": "window"})
        .setOutputMapping({"score": "prediction"})
        .setSignature("serving_default")
        .setBatchSize(60)
    )
    scored = model.transform(_events(spark, sf_dir))
    return scored.withColumn("prediction", F.round("prediction", 6))


@query(
    "score_by_signature",
    f"""WITH {_PREDICTED}
    SELECT event_type, window_id, 'ramp_tanh' AS signature, round(prediction, 6) AS prediction
    FROM predicted
    UNION ALL
    SELECT event_type, window_id, 'window_mean', round(mean_prediction, 6) FROM predicted""",
)
def score_by_signature(spark, sf_dir):
    """Two models over the same windows, built once."""
    names = ["ramp_tanh", "window_mean"]
    scaled = forecast.scaled_windows(_events(spark, sf_dir), ORDER, "value", SIZE, SERIES)
    for name in names:
        scaled = scoring.score(scaled, "value_scaled", name, [SIZE], name)
    restored = scaling.robust_inverse(scaled, {name: "value" for name in names})
    return restored.select("event_type", "window_id", F.explode(F.array(*[
        F.struct(F.lit(name).alias("signature"), F.round(name, 6).alias("prediction")) for name in names
    ])).alias("r")).select("event_type", "window_id", "r.signature", "r.prediction")


@query(
    "score_by_bundle",
    f"""WITH {_CELLS},
    sums AS (
      SELECT event_type, window_id, sum(value * (pos + 1)) / 1830.0 + 0.5 AS level, avg(value) AS mean
      FROM cells GROUP BY event_type, window_id HAVING count(*) = 60)
    SELECT event_type, window_id, 'level' AS signature, round(level, 6) AS prediction FROM sums
    UNION ALL SELECT event_type, window_id, 'mean', round(mean, 6) FROM sums""",
)
def score_by_bundle(spark, sf_dir):
    """Two functions of one bundle, chosen by signature and tags."""
    target = scratch_dir(spark)
    weights = {"coefficients": [(i + 1) / 1830 for i in range(SIZE)], "intercept": 0.5}
    level = bundle.Function("linear", ["window"], {"level": "score"}, weights)
    mean = bundle.Function("window_mean", ["window"], {"mean": "score"})
    other = bundle.Function("ramp_tanh", ["window"], {"level": "score"})
    bundle.write_bundle(spark, target, {"serve": {"level": level, "mean": mean}, "serve,other": {"level": other}})
    rows = _events(spark, sf_dir)

    def scored(signature: str) -> DataFrame:
        model = (
            WindowForecastModel(seriesCols=SERIES, orderCols=ORDER, scaling="none")
            .setInputMapping({"value": "window"})
            .setOutputMapping({signature: "prediction"})
            .setExportDir(target).setTagSet("serve").setSignature(signature)
        )
        return model.transform(rows).select(
            "event_type", "window_id", F.lit(signature).alias("signature"), F.round("prediction", 6).alias("prediction")
        )

    return scored("level").union(scored("mean"))


@query(
    "score_multi_output",
    f"""WITH {_LINE_FIT},
    scores AS (
      SELECT l_returnflag, window_id,
             tanh(sum((pos + 1) * (p - p_center) / p_scale) / 1830.0) AS p_score,
             tanh(sum((pos + 1) * (q - q_center) / q_scale) / 1830.0) AS q_score
      FROM cells JOIN fit USING (l_returnflag, window_id) WHERE n = 60
      GROUP BY l_returnflag, window_id
    )
    SELECT l_returnflag, window_id,
           round(p_score * p_scale + p_center, 4) AS price_level,
           round((p_score - q_score) * q_scale + q_center, 4) AS quantity_gap
    FROM scores JOIN fit USING (l_returnflag, window_id)""",
)
def score_multi_output(spark, sf_dir):
    model = (
        WindowForecastModel(seriesCols=LINE_SERIES, orderCols=LINE_ORDER, signature="ramp_pair")
        .setInputMapping({"l_extendedprice": "a", "l_quantity": "b"})
        .setOutputMapping({"level": "price_level", "gap": "quantity_gap"})
        .setScaleBy({"level": "l_extendedprice", "gap": "l_quantity"})
    )
    scored = model.transform(_lineitem(spark, sf_dir))
    return scored.select(
        "l_returnflag",
        "window_id",
        F.round("price_level", 4).alias("price_level"),
        F.round("quantity_gap", 4).alias("quantity_gap"),
    )


@query(
    "score_size_check",
    f"""WITH {_CELLS},
    sizes AS (SELECT event_type, window_id, count(*) AS n FROM cells GROUP BY event_type, window_id)
    SELECT event_type, count(*) AS windows, count(*) AS predictions
    FROM sizes WHERE n = 60 GROUP BY event_type""",
)
def score_size_check(spark, sf_dir):
    scaled = forecast.scaled_windows(_events(spark, sf_dir), ORDER, "value", SIZE, SERIES)
    scored = scoring.score(scaled, "value_scaled", "ramp_tanh", [SIZE])
    return scored.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("windows"), F.count("score").alias("predictions")
    )


@query(
    "batch_invariance",
    f"""WITH {_PREDICTED}
    SELECT b.batch_size, event_type, window_id, round(prediction, 6) AS prediction
    FROM predicted, (SELECT unnest([1, 10, 100]) AS batch_size) b""",
)
def batch_invariance(spark, sf_dir):
    scaled = forecast.scaled_windows(_events(spark, sf_dir), ORDER, "value", SIZE, SERIES)
    for size in (1, 10, 100):
        scaled = scoring.score(
            scaled, "value_scaled", "ramp_tanh", [SIZE], f"b{size}", batch_size=size
        )
    result = scaled.select(
        "event_type",
        "window_id",
        "value_center",
        "value_scale",
        F.explode(
            F.array(*[F.struct(F.lit(b).alias("batch_size"), F.col(f"b{b}").alias("s")) for b in (1, 10, 100)])
        ).alias("r"),
    )
    restored = vectors.robust_inverse(F.col("r.s"), F.col("value_center"), F.col("value_scale"))
    return result.select(
        F.col("r.batch_size").alias("batch_size"),
        "event_type",
        "window_id",
        F.round(restored, 6).alias("prediction"),
    )


@query(
    "classify_vectors",
    f"""WITH {_CLASSES} SELECT vec_id, label, pred FROM best""",
)
def classify(spark, sf_dir):
    return classify_vectors(_embeddings(spark, sf_dir), "embedding", keep=["vec_id"], shape=[64])


@query(
    "score_by_shard",
    f"""WITH {_CLASSES}
    SELECT vec_id, CAST(vec_id % 4 AS INTEGER) AS shard, label, pred FROM best""",
)
def score_by_shard(spark, sf_dir):
    vecs = _embeddings(spark, sf_dir).select(
        "vec_id",
        sharding.row_shard(F.col("vec_id"), 4).alias("shard"),
        F.col("label").cast("bigint").alias("label"),
        vectors.normalize(F.col("embedding")).alias("vector"),
    )
    scored = scoring.score_shards(
        vecs, "vector", "folded_classes", keep=["vec_id", "shard", "label"], batch_size=10
    )
    return scored.select("vec_id", "shard", "label", vectors.argmax(F.col("scores")).alias("pred"))


@query(
    "score_by_shard_gang",
    f"""WITH {_CLASSES}
    SELECT vec_id, CAST(vec_id % 2 AS INTEGER) AS shard, label, pred, CAST(vec_id % 2 AS INTEGER) AS task FROM best""",
)
def score_by_shard_gang(spark, sf_dir):
    """Each shard in one task, and the tasks side by side."""
    vecs = _embeddings(spark, sf_dir).select(
        "vec_id",
        sharding.row_shard(F.col("vec_id"), 2).alias("shard"),
        F.col("label").cast("bigint").alias("label"),
        vectors.normalize(F.col("embedding")).alias("vector"),
    )
    gang = sharding.gang_partitions(vecs, 2).withColumn("task", F.spark_partition_id())
    scored = scoring.score_shards(
        gang, "vector", "folded_classes", keep=["vec_id", "shard", "label", "task"], batch_size=10, gang=True
    )
    return scored.select("vec_id", "shard", "label", vectors.argmax(F.col("scores")).alias("pred"), "task")


# --------------------------------------------------------------------------
# Windows
# --------------------------------------------------------------------------

_COUNT_WINDOWS_SQL = f"WITH {_CELLS} SELECT event_id, event_type, window_id, CAST(pos AS INTEGER) AS pos FROM cells"


@query("count_windows", _COUNT_WINDOWS_SQL)
def count_windows(spark, sf_dir):
    cut = windows.count_windows(_events(spark, sf_dir), ORDER, SIZE, SERIES)
    return cut.select("event_id", "event_type", "window_id", "pos")


@query("count_windows_hot_series", _COUNT_WINDOWS_SQL)
def count_windows_hot_series(spark, sf_dir):
    """The same rows with every series over the size limit and so cut into ranges."""
    cut = windows.count_windows(_events(spark, sf_dir), ORDER, SIZE, SERIES, split_rows=500)
    return cut.select("event_id", "event_type", "window_id", "pos")


@query(
    "count_windows_single_series",
    """SELECT event_id, (rn - 1) // 60 AS window_id, CAST((rn - 1) % 60 AS INTEGER) AS pos
    FROM (SELECT event_id, row_number() OVER (ORDER BY ts, event_id) AS rn FROM events)""",
)
def count_windows_single_series(spark, sf_dir):
    """The whole table as one series."""
    cut = windows.count_windows(_events(spark, sf_dir), ORDER, SIZE, split_rows=1000)
    return cut.select("event_id", "window_id", "pos")


@query(
    "tail_drop",
    f"""WITH {_CELLS}
    SELECT event_type, window_id, count(*) AS n FROM cells
    GROUP BY event_type, window_id HAVING count(*) = 60""",
)
def tail_drop(spark, sf_dir):
    kept = windows.apply_tail(_event_windows(spark, sf_dir), SIZE, "drop", SERIES)
    return kept.select("event_type", "window_id", "n")


@query(
    "tail_left_out",
    f"""WITH {_CELLS}
    SELECT event_type, sum(n)::BIGINT AS n_rows, sum(CASE WHEN n < 60 THEN n ELSE 0 END)::BIGINT AS n_left_out
    FROM (SELECT event_type, window_id, count(*) AS n FROM cells GROUP BY event_type, window_id)
    GROUP BY event_type""",
)
def tail_left_out(spark, sf_dir):
    """Rows without a prediction where short windows are dropped."""
    return windows.left_out(_event_windows(spark, sf_dir), SIZE, SERIES)


_USER_TAIL_SQL = f"""WITH {_FIT.replace('event_type', 'user_id')}
    SELECT f.user_id, f.window_id, f.n, round(f.center, 6) AS center,
           round(coalesce(p.score, s.score) * f.scale + f.center, 6) AS prediction
    FROM fit f
    JOIN scores s USING (user_id, window_id)
    LEFT JOIN scores p ON f.n < 60 AND p.user_id = f.user_id AND p.window_id = f.window_id - 1
    WHERE f.n = 60 OR p.score IS NOT NULL"""


@query("tail_reuse_previous", _USER_TAIL_SQL)
def tail_reuse_previous(spark, sf_dir):
    scaled = forecast.scaled_windows(
        _events(spark, sf_dir), ORDER, "value", SIZE, ["user_id"], tail="reuse_previous"
    )
    scored = scoring.score(scaled, "value_scaled", "ramp_tanh", [SIZE])
    restored = scaling.robust_inverse(scored, {"score": "value"})
    return restored.select(
        "user_id",
        "window_id",
        "n",
        F.round("value_center", 6).alias("center"),
        F.round("score", 6).alias("prediction"),
    )


@query(
    "window_vectors",
    f"WITH {_CELLS} SELECT event_type, window_id, CAST(pos AS INTEGER) AS pos, value FROM cells",
)
def window_vectors(spark, sf_dir):
    cut = _event_windows(spark, sf_dir).select("event_type", "window_id", "value")
    return windows.window_rows(cut, "value")


@query(
    "multi_input_windows",
    f"""WITH {_LINE_FIT}
    SELECT l_returnflag, window_id, n,
           round(p_center, 6) AS price_center, round(p_scale, 6) AS price_scale,
           round(q_center, 6) AS quantity_center, round(q_scale, 6) AS quantity_scale
    FROM fit""",
)
def multi_input_windows(spark, sf_dir):
    cut = windows.window_vectors(
        _lineitem(spark, sf_dir), LINE_ORDER, LINE_INPUTS, SIZE, LINE_SERIES
    )
    fitted = scaling.robust_fit(cut, LINE_INPUTS)
    return fitted.select(
        "l_returnflag",
        "window_id",
        "n",
        F.round("l_extendedprice_center", 6).alias("price_center"),
        F.round("l_extendedprice_scale", 6).alias("price_scale"),
        F.round("l_quantity_center", 6).alias("quantity_center"),
        F.round("l_quantity_scale", 6).alias("quantity_scale"),
    )


@query(
    "window_end_time",
    f"""WITH {_CELLS}
    SELECT event_type, window_id, {_STAMP.format('max(ts)')} AS window_end
    FROM cells GROUP BY event_type, window_id""",
)
def window_end_time(spark, sf_dir):
    cut = _event_windows(spark, sf_dir)
    return cut.select("event_type", "window_id", _stamp("window_end").alias("window_end"))


@query(
    "prefix_sweep",
    f"""WITH {_PREDICTED}
    SELECT l.prefix_rows, event_type, window_id, {_STAMP.format('window_end')} AS window_end,
           round(prediction, 6) AS prediction
    FROM predicted, (SELECT unnest({SWEEP})::BIGINT AS prefix_rows) l
    WHERE (window_id + 1) * 60 <= l.prefix_rows""",
)
def prefix_sweep(spark, sf_dir):
    swept = sweep.prefix_sweep(
        _events(spark, sf_dir), SWEEP, ORDER, "value", SIZE, SERIES, "ts"
    )
    return swept.withColumn("prediction", F.round("prediction", 6)).withColumn(
        "window_end", _stamp("window_end")
    )


@query(
    "prefix_sweep_tails",
    f"""WITH {_CELLS.replace('event_type', 'user_id')},
    shown AS (
      SELECT l.prefix_rows, c.* FROM cells c,
             (SELECT unnest({CUT_SWEEP})::BIGINT AS prefix_rows) l
      WHERE c.row_idx < l.prefix_rows
    ),
    fit AS (
      SELECT prefix_rows, user_id, window_id, count(*) AS n, max(ts) AS window_end,
             quantile_cont(value, 0.5) AS center,
             CASE WHEN quantile_cont(value, 0.75) = quantile_cont(value, 0.25) THEN 1.0
                  ELSE quantile_cont(value, 0.75) - quantile_cont(value, 0.25) END AS scale
      FROM shown GROUP BY prefix_rows, user_id, window_id
    ),
    scores AS (
      SELECT prefix_rows, user_id, window_id,
             tanh(sum((pos + 1) * (value - center) / scale) / 1830.0) AS score
      FROM shown JOIN fit USING (prefix_rows, user_id, window_id)
      GROUP BY prefix_rows, user_id, window_id
    )
    SELECT f.prefix_rows, f.user_id, f.window_id, {_STAMP.format('f.window_end')} AS window_end,
           round(coalesce(p.score, s.score) * f.scale + f.center, 6) AS prediction
    FROM fit f JOIN scores s USING (prefix_rows, user_id, window_id)
    LEFT JOIN scores p ON f.n < 60 AND p.prefix_rows = f.prefix_rows
         AND p.user_id = f.user_id AND p.window_id = f.window_id - 1
    WHERE f.n = 60 OR p.score IS NOT NULL""",
)
def prefix_sweep_tails(spark, sf_dir):
    swept = sweep.prefix_sweep(
        _events(spark, sf_dir), CUT_SWEEP, ORDER, "value", SIZE, ["user_id"], "ts",
        tail="reuse_previous",
    )
    return swept.withColumn("prediction", F.round("prediction", 6)).withColumn(
        "window_end", _stamp("window_end")
    )


# --------------------------------------------------------------------------
# Scaling and vectors
# --------------------------------------------------------------------------


@query(
    "robust_fit",
    f"""WITH {_FIT}
    SELECT event_type, window_id, n, round(center, 6) AS center, round(scale, 6) AS scale FROM fit""",
)
def robust_fit(spark, sf_dir):
    fitted = scaling.robust_fit(_event_windows(spark, sf_dir), "value")
    return fitted.select(
        "event_type",
        "window_id",
        "n",
        F.round("value_center", 6).alias("center"),
        F.round("value_scale", 6).alias("scale"),
    )


@query(
    "robust_transform",
    f"""WITH {_FIT}
    SELECT event_type, window_id, CAST(pos AS INTEGER) AS pos, round(x, 6) AS scaled FROM scaled""",
)
def robust_transform(spark, sf_dir):
    fitted = scaling.robust_fit(_event_windows(spark, sf_dir), "value")
    scaled = scaling.robust_transform(fitted, "value").select(
        "event_type", "window_id", F.col("value_scaled").alias("scaled")
    )
    return windows.window_rows(scaled, "scaled").withColumn("scaled", F.round("scaled", 6))


@query(
    "robust_inverse",
    f"""WITH {_CELLS}
    SELECT event_type, window_id, CAST(pos AS INTEGER) AS pos, round(value, 6) AS restored FROM cells""",
)
def robust_inverse(spark, sf_dir):
    fitted = scaling.robust_fit(_event_windows(spark, sf_dir), "value")
    scaled = scaling.robust_transform(fitted, "value").select(
        "event_type", "window_id", "value_center", "value_scale", F.col("value_scaled").alias("restored")
    )
    cells = scaling.robust_inverse(windows.window_rows(scaled, "restored"), {"restored": "value"})
    return cells.select("event_type", "window_id", "pos", F.round("restored", 6).alias("restored"))


@query(
    "normalize_vectors",
    """SELECT vec_id, CAST(pos - 1 AS INTEGER) AS pos,
           round(CAST(embedding[pos] AS DOUBLE) / 255.0, 9) AS value
    FROM (SELECT vec_id, embedding, unnest(range(1, len(embedding) + 1)) AS pos FROM embeddings)""",
)
def normalize_vectors(spark, sf_dir):
    scaled = _embeddings(spark, sf_dir).select(
        "vec_id", F.posexplode(vectors.normalize(F.col("embedding"))).alias("pos", "value")
    )
    return scaled.withColumn("value", F.round("value", 9))


@query(
    "flatten_reshape",
    """SELECT vec_id, CAST((pos - 1) // 8 AS INTEGER) AS r, CAST((pos - 1) % 8 AS INTEGER) AS c,
           round(CAST(embedding[pos] AS DOUBLE), 6) AS value, TRUE AS flat_again
    FROM (SELECT vec_id, embedding, unnest(range(1, len(embedding) + 1)) AS pos FROM embeddings)""",
)
def flatten_reshape(spark, sf_dir):
    square = _embeddings(spark, sf_dir).select(
        "vec_id", "embedding", vectors.reshape(F.col("embedding"), 8, 8).alias("square")
    )
    rows = square.select(
        "vec_id",
        (vectors.flatten_rows(F.col("square")) == F.col("embedding")).alias("flat_again"),
        F.posexplode("square").alias("r", "row"),
    )
    cells = rows.select("vec_id", "flat_again", "r", F.posexplode("row").alias("c", "value"))
    return cells.withColumn("value", F.round(F.col("value").cast("double"), 6))


@query(
    "argmax",
    """SELECT vec_id, CAST(list_position(embedding, list_max(embedding)) - 1 AS BIGINT) AS best
    FROM embeddings""",
)
def argmax(spark, sf_dir):
    return _embeddings(spark, sf_dir).select(
        "vec_id", vectors.argmax(F.col("embedding")).alias("best")
    )


# --------------------------------------------------------------------------
# Projections, casts, prefixes
# --------------------------------------------------------------------------


@query(
    "input_mapping",
    """SELECT event_id, event_type AS metric_in, user_id AS host_in, value AS level_in FROM events""",
)
def input_mapping(spark, sf_dir):
    return projections.input_mapping(
        _events(spark, sf_dir),
        {"value": "level_in", "event_type": "metric_in", "user_id": "host_in"},
        keep=["event_id"],
    )


@query(
    "output_mapping",
    """SELECT event_id, value * 2 AS twice, value + 1 AS plus_one FROM events""",
)
def output_mapping(spark, sf_dir):
    outputs = _events(spark, sf_dir).select(
        "event_id",
        F.struct(
            (F.col("value") + 1).alias("dense_1"),
            F.col("user_id").alias("unused"),
            (F.col("value") * 2).alias("dense_2"),
        ).alias("outputs"),
    )
    return projections.output_mapping(
        outputs, {"dense_2": "twice", "dense_1": "plus_one"}, "outputs", keep=["event_id"]
    )


@query(
    "feature_label_split",
    """SELECT l_orderkey, l_linenumber, l_extendedprice, l_discount, l_returnflag, l_quantity AS label
    FROM lineitem""",
)
def feature_label_split(spark, sf_dir):
    split = projections.feature_label_split(
        _lineitem(spark, sf_dir),
        ["l_extendedprice", "l_discount", "l_returnflag"],
        "l_quantity",
        keep=["l_orderkey", "l_linenumber"],
    )
    return split.select("l_orderkey", "l_linenumber", "features.*", "label")


@query(
    "prefix_rows",
    "SELECT event_id, event_type, value FROM events ORDER BY ts, event_id LIMIT 480",
)
def prefix_rows(spark, sf_dir):
    head = projections.prefix_rows(_events(spark, sf_dir), 480, ORDER)
    return head.select("event_id", "event_type", "value")


@query(
    "prefix_rows_per_series",
    """SELECT event_id, event_type, value
    FROM (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) AS rn FROM events)
    WHERE rn <= 480""",
)
def prefix_rows_per_series(spark, sf_dir):
    head = projections.prefix_rows(_events(spark, sf_dir), 480, ORDER, SERIES)
    return head.select("event_id", "event_type", "value")


@query(
    "cast_float",
    """SELECT event_id, CAST(CAST(value AS FLOAT) AS DOUBLE) AS value FROM events""",
)
def cast_float(spark, sf_dir):
    return _events(spark, sf_dir).select(
        "event_id", vectors.to_float(F.col("value")).cast("double").alias("value")
    )


@query(
    "binary_to_string",
    "SELECT doc_id, md5(text) AS digest, CAST(length(text) AS INTEGER) AS n_chars FROM documents",
)
def binary_to_string(spark, sf_dir):
    raw = _table(spark, sf_dir, "documents").select(
        "doc_id", F.encode("text", "UTF-8").alias("payload")
    )
    text = raw.select("doc_id", vectors.binary_to_string(F.col("payload")).alias("text"))
    return text.select(
        "doc_id",
        F.md5(F.encode("text", "UTF-8")).alias("digest"),
        F.length("text").alias("n_chars"),
    )


# --------------------------------------------------------------------------
# Times
# --------------------------------------------------------------------------


@query(
    "time_bucket",
    """SELECT event_type,
           strftime(make_timestamp(CAST(floor(epoch(ts) / 900) AS BIGINT) * 900000000),
                    '%Y-%m-%d %H:%M:%S') AS bucket,
           count(*) AS n, round(avg(value), 6) AS mean_value
    FROM events GROUP BY 1, 2""",
)
def time_bucket(spark, sf_dir):
    bucket = times.time_bucket("ts")
    return (
        _events(spark, sf_dir)
        .groupBy("event_type", bucket.alias("start"))
        .agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("value"), 6).alias("mean_value"))
        .select(
            "event_type",
            times.time_text(F.col("start"), times.BUCKET_TIME_FORMAT).alias("bucket"),
            "n",
            "mean_value",
        )
    )


@query(
    "event_time",
    """SELECT event_id, strftime(ts, '%Y/%m/%d-%H:%M:%S') AS event_time,
           CAST(floor(epoch(ts)) AS BIGINT) AS epoch
    FROM events""",
)
def event_time(spark, sf_dir):
    texts = _events(spark, sf_dir).select(
        "event_id",
        F.date_format("ts", "yyyy/MM/dd").alias("Date"),
        F.date_format("ts", "HH:mm:ss").alias("time"),
    )
    joined = texts.select("event_id", times.event_time().alias("at"))
    return joined.select(
        "event_id", _stamp("at").alias("event_time"), F.unix_seconds("at").alias("epoch")
    )


# --------------------------------------------------------------------------
# Shards and example sets
# --------------------------------------------------------------------------


@query(
    "shard_assignment",
    "SELECT vec_id, CAST(vec_id % 7 AS INTEGER) AS shard FROM embeddings",
)
def shard_assignment(spark, sf_dir):
    return _embeddings(spark, sf_dir).select(
        "vec_id", sharding.row_shard(F.col("vec_id"), 7).alias("shard")
    )


@query(
    "file_shards",
    "SELECT vec_id, CAST((vec_id % 12) % 5 AS INTEGER) AS shard FROM embeddings",
)
def file_shards(spark, sf_dir):
    target = scratch_dir(spark)
    _embeddings(spark, sf_dir).select(
        "vec_id", F.lpad(F.pmod("vec_id", F.lit(12)).cast("string"), 2, "0").alias("part")
    ).repartition("part").write.partitionBy("part").parquet(target)
    rows = spark.read.parquet(target).select(
        "vec_id", F.col("_metadata.file_path").alias("file")
    )
    found = files.list_files(spark, target, [r"\.parquet$"])
    return sharding.assign_file_shards(rows, found, 5).select("vec_id", "shard")


@query(
    "shuffle_examples",
    """SELECT event_id, event_type, value,
           row_number() OVER (ORDER BY md5('512-' || event_id), event_id) - 1 AS place
    FROM events""",
)
def shuffle_examples(spark, sf_dir):
    """The place of every row in the shuffled order."""
    rows = _events(spark, sf_dir).select("event_id", "event_type", "value")
    return sharding.shuffled_places(rows, "event_id", seed=512)


@query("shuffle_buffer", "SELECT event_id, event_type, value FROM events")
def shuffle_buffer(spark, sf_dir):
    """Every row once, in another order."""
    return sharding.buffer_shuffle(_events(spark, sf_dir).select("event_id", "event_type", "value"), seed=7)


@query(
    "dataset_from_rows",
    """SELECT n_name, count(*) AS customers, round(sum(c_acctbal), 2) AS balance
    FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name""",
)
def dataset_from_rows(spark, sf_dir):
    """A small collection of the driver as a cached dataset, released when its result is written."""
    nations = _table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    held = sharding.dataset_from_rows(spark, [tuple(r) for r in nations.collect()], nations.schema, 5)
    try:
        customers = _table(spark, sf_dir, "customer").join(held, F.col("c_nationkey") == F.col("n_nationkey"))
        total = customers.groupBy("n_name").agg(
            F.count(F.lit(1)).alias("customers"), F.round(F.sum("c_acctbal"), 2).alias("balance")
        )
        return written(total)
    finally:
        held.unpersist()


@query(
    "partitioned_dataset",
    """SELECT event_type, count(*) AS n, round(sum(value), 4) AS total, 10 AS partitions
    FROM events GROUP BY event_type""",
)
def partitioned_dataset(spark, sf_dir):
    """Used once here, so nothing is kept: a cache would need someone to release it."""
    spread = sharding.partitioned_dataset(
        _events(spark, sf_dir).select("event_type", "value"), 10, cache=False
    )
    return (
        spread.withColumn("at", F.spark_partition_id())
        .groupBy("event_type")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.round(F.sum("value"), 4).alias("total"),
            F.count_distinct("at").cast("int").alias("partitions"),
        )
    )


# --------------------------------------------------------------------------
# Sources and sinks: written, read back, compared with the table
# --------------------------------------------------------------------------

_EVENT_ROWS_SQL = (
    f"SELECT event_id, {_STAMP.format('ts')} AS ts, user_id, event_type, value, props FROM events"
)


def _events_as_csv(spark, sf_dir) -> str:
    target = scratch_dir(spark)
    _events(spark, sf_dir).write.option("header", True).csv(target)
    return target


def _event_rows(df: DataFrame) -> DataFrame:
    return df.select(
        F.col("event_id").cast("bigint").alias("event_id"),
        _stamp("ts").alias("ts"),
        F.col("user_id").cast("bigint").alias("user_id"),
        "event_type",
        "value",
        "props",
    )


@query("csv_scan", _EVENT_ROWS_SQL)
def csv_scan(spark, sf_dir):
    schema = _events(spark, sf_dir).schema
    return _event_rows(telemetry.read_telemetry(spark, _events_as_csv(spark, sf_dir), schema))


@query("csv_scan_inferred", _EVENT_ROWS_SQL)
def csv_scan_inferred(spark, sf_dir):
    return _event_rows(telemetry.read_telemetry(spark, _events_as_csv(spark, sf_dir)))


@query(
    "csv_scan_by_name",
    """SELECT event_id, CASE WHEN event_id % 97 = 0 OR event_id % 89 = 0 THEN NULL ELSE event_type END AS event_type,
           CASE WHEN event_id % 97 = 0 OR event_id % 89 = 0 THEN NULL ELSE round(value, 4) END AS used,
           CASE WHEN event_id % 97 = 0 OR event_id % 89 = 0 THEN 'malformed record' END AS reason
    FROM events""",
)
def csv_scan_by_name(spark, sf_dir):
    """Files whose columns stand in different orders, with text for numbers and rows that are too long."""
    target = scratch_dir(spark)
    number = F.round("value", 4).cast("string")
    number = F.when(F.col("event_id") % 97 == 0, "n/a").when(F.col("event_id") % 89 == 0, F.concat(number, F.lit(",9,9"))).otherwise(number)
    rows = _events(spark, sf_dir).select(F.col("event_id").cast("string").alias("event_id"), "event_type", number.alias("%used"))
    for k, order in enumerate((["event_id", "event_type", "%used"], ["event_id", "%used", "event_type"])):
        part = rows.where(F.col("event_id").cast("bigint") % 2 == k).select(*[f"`{c}`" for c in order])
        part.write.option("header", True).option("quote", "").mode("append").csv(target)
    scan = telemetry.scan_telemetry(spark, target, "event_id bigint, event_type string, `%used` double")
    kept = scan.stored(scratch_dir(spark))
    good = kept.rows.select("event_id", "event_type", F.col("%used").alias("used"), F.lit(None).cast("string").alias("reason"))
    first = F.split("record", ",")[0].cast("bigint")
    bad = kept.rejects.select(
        first.alias("event_id"), F.lit(None).cast("string").alias("event_type"), F.lit(None).cast("double").alias("used"), "reason"
    )
    return good.union(bad)


@query(
    "prefix_file_order",
    """SELECT event_id, event_type, value, row_number() OVER (ORDER BY ts, event_id) - 1 AS place
    FROM events QUALIFY place < 480""",
)
def prefix_file_order(spark, sf_dir):
    """The first rows of CSV files by their place in the files alone; no column says their order."""
    target = scratch_dir(spark)
    laid = _events(spark, sf_dir).repartitionByRange(6, "ts", "event_id").sortWithinPartitions("ts", "event_id")
    laid.select("event_id", "event_type", "value").write.option("header", True).csv(target)
    lines = spark.read.schema("event_id bigint, event_type string, value double").option("header", True).csv(target)
    return indexing.index_rows(in_file_order(lines), FILE_ORDER, name="place", first=480).drop(*FILE_ORDER)


@query(
    "count_windows_file_order",
    """SELECT event_id, row // 60 AS window_id, CAST(row % 60 AS INTEGER) AS pos
    FROM (SELECT event_id, row_number() OVER (ORDER BY ts, event_id) - 1 AS row FROM events)""",
)
def count_windows_file_order(spark, sf_dir):
    """Windows over Parquet files in file order, by the row's index in its file."""
    target = scratch_dir(spark)
    laid = _events(spark, sf_dir).repartitionByRange(6, "ts", "event_id").sortWithinPartitions("ts", "event_id")
    laid.select("event_id", "value").write.parquet(target)
    cut = windows.count_windows(in_file_order(spark.read.parquet(target)), FILE_ORDER, SIZE)
    return cut.select("event_id", "window_id", "pos")


@query(
    "telemetry_normalized",
    f"""SELECT event_type AS series, {_STAMP.format('ts')} AS ts, value FROM events""",
)
def telemetry_normalized(spark, sf_dir):
    """A usage file with separate date and time columns, read by its header."""
    raw = telemetry.read_telemetry(
        spark,
        _usage_files(spark, sf_dir),
        "event_id bigint, event_type string, Date string, time string, `%used` double",
    )
    return telemetry.normalize_telemetry(raw, series="event_type").withColumn("ts", _stamp("ts"))


@query(
    "examples_scan",
    """SELECT CAST(l_orderkey AS VARCHAR) AS l_orderkey, CAST(l_linenumber AS VARCHAR) AS l_linenumber,
           CASE WHEN l_returnflag = 'A' THEN '0' ELSE '"' || l_returnflag END AS flag,
           l_extendedprice, l_discount, l_quantity AS label
    FROM lineitem""",
)
def examples_scan(spark, sf_dir):
    """Tab-separated lines with a header; quotes are data, empty fields take defaults."""
    target = scratch_dir(spark)
    _lineitem(spark, sf_dir).select(
        "l_orderkey",
        "l_linenumber",
        F.when(F.col("l_returnflag") != "A", F.concat(F.lit('"'), "l_returnflag")).alias("flag"),
        "l_extendedprice",
        "l_tax",
        F.when(F.col("l_discount") != 0, F.col("l_discount")).alias("l_discount"),
        F.col("l_quantity").alias("label"),
    ).write.option("sep", "\t").option("header", True).option("quote", "").csv(target)
    return examples.read_examples(
        spark,
        target,
        continuous=["l_extendedprice", "l_tax", "l_discount"],
        use_columns=["l_orderkey", "l_linenumber", "flag", "l_extendedprice", "l_discount", "label"],
        has_header=True,
    )


@query(
    "file_list",
    "SELECT DISTINCT event_type FROM events WHERE event_type LIKE '%r%' OR event_type = 'view'",
)
def file_list(spark, sf_dir):
    target = scratch_dir(spark)
    _events(spark, sf_dir).select("event_id", "event_type").write.partitionBy("event_type").parquet(target)
    found = files.list_files(spark, target, ["event_type=[a-z_]*r[a-z_]*/", "event_type=view/"])
    return found.select(F.regexp_extract("path", "event_type=([^/]+)/", 1).alias("event_type")).distinct()


@query(
    "json_roundtrip",
    f"""WITH {_PREDICTED}
    SELECT {_STAMP.format('window_end')} AS "Datetime", round(prediction, 6) AS prediction
    FROM predicted""",
)
def json_roundtrip(spark, sf_dir):
    folder = prediction_sink.write_predictions(_predictions(spark, sf_dir), scratch_dir(spark))
    stored = predictions.prediction_values(predictions.read_predictions(spark, folder))
    return stored.withColumn("prediction", F.round("prediction", 6))


@query(
    "json_scan_rejects",
    """SELECT event_id, CASE WHEN event_id % 3 <> 0 AND event_id % 4 <> 0 THEN round(value, 6) END AS prediction,
           CASE WHEN event_id % 3 = 0 THEN 'malformed record' WHEN event_id % 4 = 0 THEN 'no prediction' END AS reason
    FROM events""",
)
def json_scan_rejects(spark, sf_dir):
    """Lines that break off and lines without a prediction are reported, never read as null; the schema is inferred once."""
    target = scratch_dir(spark)
    line = F.to_json(F.struct(F.array(F.col("event_id").cast("string")).alias("Datetime"), F.array(F.round("value", 6)).alias("prediction")))
    broken = F.when(F.col("event_id") % 3 == 0, F.expr("left(line, length(line) - 2)"))
    absent = F.when(F.col("event_id") % 4 == 0, F.regexp_replace("line", '"prediction":.*$', '"other":1}'))
    rows = _events(spark, sf_dir).withColumn("line", line)
    rows.select(F.coalesce(broken, absent, "line").alias("value")).write.text(f"{target}/lines")
    runs.commit(spark, f"{target}/run", spark.read.text(f"{target}/lines").write.text)
    inferred = predictions.inferred_schema(spark, f"{target}/run")
    schema = predictions.inferred_schema(spark, f"{target}/run")
    if schema != inferred:
        raise ValueError("the kept schema differs from the inferred one")
    scan = predictions.scan_predictions(spark, f"{target}/run", schema)
    good = predictions.prediction_values(scan.rows).select(
        F.col("Datetime").cast("bigint").alias("event_id"), "prediction", F.lit(None).cast("string").alias("reason")
    )
    at = F.regexp_extract("record", r"\"Datetime\":\[\"(\d+)", 1).cast("bigint")
    return good.union(scan.rejects.select(at.alias("event_id"), F.lit(None).cast("double").alias("prediction"), "reason"))


@query(
    "committed_run",
    f"""WITH {_PREDICTED}
    SELECT {_STAMP.format('window_end')} AS "Datetime", round(prediction, 6) AS prediction,
           (SELECT count(*) FROM predicted) AS report_lines
    FROM predicted""",
)
def committed_run(spark, sf_dir):
    """One run id, written three times, once left without a commit: one set of rows is read."""
    base, run = scratch_dir(spark), "20210408022459-prediction"
    scored = written(_predictions(spark, sf_dir))
    prediction_sink.write_predictions(scored, base, f"{run}/attempt-0")  # an attempt that broke before its commit
    for _ in range(2):
        folder = prediction_sink.commit_predictions(scored, base, run)
        prediction_sink.commit_report(scored, f"{folder}-report")
    stored = predictions.prediction_values(predictions.read_predictions(spark, folder))
    lines = predictions.read_report(spark, f"{folder}-report").agg(F.count("prediction"))
    return stored.withColumn("prediction", F.round("prediction", 6)).withColumn("report_lines", lines.scalar())


@query(
    "text_report",
    f"WITH {_PREDICTED} SELECT round(prediction, 6) AS prediction FROM predicted",
)
def text_report(spark, sf_dir):
    target = scratch_dir(spark)
    prediction_sink.write_report(_predictions(spark, sf_dir), target)
    return predictions.read_report(spark, target).withColumn("prediction", F.round("prediction", 6))


_EXAMPLE_ROWS_SQL = f"""WITH {_IMAGES}
    SELECT label, array_to_string(image, ' ') AS image, count(*) AS n FROM images GROUP BY ALL"""


def _example_rows(df: DataFrame) -> DataFrame:
    text = F.concat_ws(" ", F.col("image").cast("array<string>"))
    return df.groupBy("label", text.alias("image")).agg(F.count(F.lit(1)).alias("n"))


@query("examples_to_csv", _EXAMPLE_ROWS_SQL)
def examples_to_csv(spark, sf_dir):
    target = scratch_dir(spark)
    example_sink.write_example_lines(_images(spark, sf_dir), target)
    return _example_rows(examples.read_example_lines(spark, target))


@query(
    "train_test_export",
    f"""WITH {_IMAGES}
    SELECT CASE WHEN ('0x' || md5(vec_id::VARCHAR)[1:8])::BIGINT % 100 < 20 THEN 'test' ELSE 'train' END AS "set",
           label, array_to_string(image, ' ') AS image, count(*) AS n FROM images GROUP BY ALL""",
)
def train_test_export(spark, sf_dir):
    """Both sets written in one pass, each read back from its own folder."""
    folders = example_sink.write_train_test(_images(spark, sf_dir), scratch_dir(spark), "vec_id", 20)
    train, test = (
        _example_rows(examples.read_example_lines(spark, folder)).withColumn("set", F.lit(name))
        for name, folder in folders.items()
    )
    return train.unionByName(test)


@query("examples_to_records", _EXAMPLE_ROWS_SQL)
def examples_to_records(spark, sf_dir):
    target = scratch_dir(spark)
    example_sink.write_example_records(_images(spark, sf_dir), target)
    return _example_rows(examples.read_example_records(spark, target))


@query(
    "sharded_examples_scan",
    f"""WITH {_IMAGES}
    SELECT count(*) AS examples, CAST(sum(list_sum(image)) AS BIGINT) AS ink, 6 AS files FROM images""",
)
def sharded_examples_scan(spark, sf_dir):
    target = scratch_dir(spark)
    example_sink.write_example_records(_images(spark, sf_dir), target, files=6)
    ink = F.aggregate("image", F.lit(0).cast("bigint"), lambda acc, x: acc + x)
    return examples.read_example_records(spark, target).agg(
        F.count(F.lit(1)).alias("examples"),
        F.sum(ink).alias("ink"),
        F.count_distinct("file").cast("int").alias("files"),
    )


@query(
    "raw_line_scan",
    """SELECT line, count(*) AS n
    FROM (SELECT unnest(string_split(text, chr(10))) AS line FROM documents) GROUP BY line""",
)
def raw_line_scan(spark, sf_dir):
    target = scratch_dir(spark)
    _table(spark, sf_dir, "documents").select("text").write.text(target)
    return (
        files.read_lines(spark, target)
        .groupBy(F.col("value").alias("line"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


@query(
    "label_pred_report",
    f"""WITH {_CLASSES}
    SELECT CAST(vec_id % 4 AS INTEGER) AS shard, label || ' ' || pred AS line, count(*) AS n
    FROM best GROUP BY ALL""",
)
def label_pred_report(spark, sf_dir):
    target = scratch_dir(spark)
    best = classify_vectors(_embeddings(spark, sf_dir), "embedding", keep=["vec_id"], shape=[64])
    sharded = best.withColumn("shard", sharding.row_shard(F.col("vec_id"), 4))
    example_sink.write_label_pred(sharded, target)
    return (
        spark.read.text(target)
        .groupBy("shard", F.col("value").alias("line"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


# --------------------------------------------------------------------------
# Training and metrics
# --------------------------------------------------------------------------

_PAIRS = """
pairs AS (
  SELECT event_type, value AS x,
         lead(value) OVER (PARTITION BY event_type ORDER BY ts, event_id) AS y
  FROM events
)"""


@query(
    "fit_ar1",
    f"""WITH {_PAIRS}
    SELECT event_type, CAST(regr_count(y, x) AS BIGINT) AS pairs, round(regr_slope(y, x), 8) AS slope,
           round(regr_intercept(y, x), 6) AS intercept
    FROM pairs WHERE y IS NOT NULL GROUP BY event_type""",
)
def fit_ar1(spark, sf_dir):
    fitted = training.fit_ar1(_events(spark, sf_dir), ORDER, "value", SERIES)
    return fitted.select(
        "event_type",
        "pairs",
        F.round("slope", 8).alias("slope"),
        F.round("intercept", 6).alias("intercept"),
    )


@query(
    "fit_forecaster",
    f"""WITH {_PAIRS},
    line AS (SELECT regr_slope(y, x) AS slope, regr_intercept(y, x) AS intercept FROM pairs WHERE y IS NOT NULL)
    SELECT e.event_id, e.event_type, round(e.value * slope + intercept, 5) AS prediction
    FROM events e, line""",
)
def fit_forecaster(spark, sf_dir):
    """One-row windows without scaling: the estimator must find the pooled least-squares line."""
    events = _events(spark, sf_dir)
    model = (
        WindowForecaster(seriesCols=SERIES, orderCols=ORDER, windowSize=1, scaling="none")
        .setInputMapping({"value": "window"})
        .setOutputMapping({"score": "prediction"})
        .fit(events)
    )
    ids = windows.count_windows(events, ORDER, 1, SERIES)
    return (
        model.transform(events)
        .join(ids.select("event_type", "window_id", "event_id"), ["event_type", "window_id"])
        .select("event_id", "event_type", F.round("prediction", 5).alias("prediction"))
    )


@query(
    "forecast_fitted",
    f"""WITH {_CELLS.replace("// 60", "// 2").replace("% 60", "% 2")},
    windows AS (
      SELECT event_type, window_id, max(value) FILTER (pos = 0) AS a, max(value) FILTER (pos = 1) AS b,
             count(*) AS n, max(ts) AS window_end
      FROM cells GROUP BY event_type, window_id),
    examples AS (
      SELECT a, b, lead(a) OVER (PARTITION BY event_type ORDER BY window_id) AS y, n FROM windows),
    moments AS (
      SELECT var_pop(a) AS aa, var_pop(b) AS bb, covar_pop(a, b) AS ab, covar_pop(a, y) AS ay,
             covar_pop(b, y) AS yb, avg(a) AS ma, avg(b) AS mb, avg(y) AS my
      FROM examples WHERE n = 2 AND y IS NOT NULL),
    slopes AS (
      SELECT (ay * bb - yb * ab) / (aa * bb - ab * ab) AS wa, (yb * aa - ay * ab) / (aa * bb - ab * ab) AS wb,
             ma, mb, my FROM moments)
    SELECT event_type, window_id, {_STAMP.format('window_end')} AS window_end,
           round(wa * (a - ma) + wb * (b - mb) + my, 5) AS prediction
    FROM windows, slopes WHERE n = 2""",
)
def forecast_fitted(spark, sf_dir):
    """Fit the next value on two-row windows, predict with the fitted model: three unknowns."""
    events = _events(spark, sf_dir)
    model = (
        WindowForecaster(seriesCols=SERIES, orderCols=ORDER, timeCol="ts", windowSize=2, scaling="none")
        .setInputMapping({"value": "window"})
        .setOutputMapping({"score": "prediction"})
        .fit(events)
    )
    return model.transform(events).select(
        "event_type", "window_id", _stamp("window_end").alias("window_end"), F.round("prediction", 5).alias("prediction")
    )


@query(
    "fit_resumed",
    f"""WITH {_PAIRS},
    line AS (SELECT regr_slope(y, x) AS slope, regr_intercept(y, x) AS intercept FROM pairs WHERE y IS NOT NULL)
    SELECT event_id, event_type, round(value * slope + intercept, 5) AS prediction FROM events, line""",
)
def fit_resumed(spark, sf_dir):
    """A fit that stops after one step, gone on from its written state by another estimator."""
    events, state = _events(spark, sf_dir), scratch_dir(spark)
    for epochs in (1, 4):
        forecaster = (
            WindowForecaster(seriesCols=SERIES, orderCols=ORDER, windowSize=1, scaling="none", solver="gradient", maxIter=1)
            .setInputMapping({"value": "window"})
            .setOutputMapping({"score": "prediction"})
            .setEpochs(epochs).setModelDir(state)
        )
        model = forecaster.fit(events)
    line = model.getArgs()
    fitted = F.col("value") * line["coefficients"][0] + line["intercept"]
    return events.select("event_id", "event_type", F.round(fitted, 5).alias("prediction"))


@query(
    "training_feed",
    """SELECT CAST(epoch AS INTEGER) AS epoch, event_id, event_type, value
    FROM events, range(3) r(epoch)""",
)
def training_feed(spark, sf_dir):
    return projections.training_feed(
        _events(spark, sf_dir), ["value", "event_type", "event_id"], epochs=3
    )


@query(
    "run_metrics",
    f"""WITH {_CELLS}
    SELECT 'rows ' || l.n AS stage, count(*) AS n_rows, min(value) AS low, max(value) AS high,
           round(avg(value), 6) AS mean
    FROM cells, (SELECT unnest({SWEEP}) AS n) l WHERE row_idx < l.n GROUP BY l.n""",
)
def run_metrics(spark, sf_dir):
    """What each step of a sweep over history lengths processed."""
    events = _events(spark, sf_dir)
    steps = ((f"rows {n}", projections.prefix_rows(events, n, ORDER, SERIES)) for n in SWEEP)
    seen = metrics.measure_each(steps, "value", metrics.consume)
    return spark.createDataFrame(
        [(m.stage, m.rows, m.low, m.high, round(m.mean, 6)) for m in seen],
        "stage string, n_rows bigint, low double, high double, mean double",
    )


# --------------------------------------------------------------------------


def entry(spark: SparkSession) -> DataFrame:
    """Telemetry scoring on the smallest tables: one prediction per full window."""
    sf_dir = "/root/testdata/sf0.001"
    return _predictions(spark, sf_dir).withColumn("window_end", _stamp("window_end"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    if llm is None:
        return dict(_QUERIES)
    return {**_QUERIES, **llm.QUERIES, "pipeline": corpus_pipeline.run}


def oracle_sql() -> dict[str, str]:
    if llm is None:
        return dict(_ORACLES)
    piped = {"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {}
    return {**_ORACLES, **llm.ORACLES, **piped}
