"""Prediction and report files of a run."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeline.functions.names import col
from gaugeline.functions.times import run_id, time_text
from gaugeline.sinks.runs import commit


def _records(df: DataFrame, prediction: str, time: str | None) -> DataFrame:
    stamp = [F.array(time_text(col(time))).alias("Datetime")] if time else []
    return df.select(*stamp, F.array(col(prediction)).alias("prediction"))


def write_predictions(
    df: DataFrame,
    base: str,
    run: str | None = None,
    prediction: str = "prediction",
    time: str | None = "window_end",
) -> str:
    """Append one JSON line per prediction to the run's folder; the folder is returned."""
    target = f"{base.rstrip('/')}/{run or run_id()}"
    _records(df, prediction, time).write.mode("append").json(target)
    return target


def commit_predictions(
    df: DataFrame, base: str, run: str, prediction: str = "prediction", time: str | None = "window_end"
) -> str:
    """As ``write_predictions``, but a run that is committed already is left as it is."""
    target = f"{base.rstrip('/')}/{run}"
    commit(df.sparkSession, target, _records(df, prediction, time).write.json)
    return target


def _lines(df: DataFrame, prediction: str) -> DataFrame:
    return df.select(F.to_json(F.array(col(prediction))).alias("value"))


def write_report(df: DataFrame, target: str, prediction: str = "prediction") -> None:
    """One ``[value]`` line per prediction."""
    _lines(df, prediction).write.mode("append").text(target)


def commit_report(df: DataFrame, target: str, prediction: str = "prediction") -> None:
    """As ``write_report``, once for a target."""
    commit(df.sparkSession, target, _lines(df, prediction).write.text)
