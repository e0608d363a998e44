"""Column mappings, feature/label split, prefix selection and alerts."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeline.functions.names import col, cols, name_list
from gaugeline.functions.times import time_text
from gaugeline.operators.indexing import index_rows

# Alert level and message.
ALERT_THRESHOLD = 50.0
ALERT_MESSAGE = "Warning! Anomaly memory usage rate is predicted : %s : %s"


def input_mapping(
    df: DataFrame, mapping: dict[str, str], keep: Iterable[str] = ()
) -> DataFrame:
    """Columns renamed to model inputs, in order of the column names."""
    return df.select(*cols(keep), *[col(c).alias(mapping[c]) for c in sorted(mapping)])


def output_mapping(
    df: DataFrame, mapping: dict[str, str], outputs: str, keep: Iterable[str] = ()
) -> DataFrame:
    """Mapped fields of the struct column ``outputs``, by name, in order of the output names."""
    return df.select(
        *cols(keep), *[col(outputs).getField(o).alias(mapping[o]) for o in sorted(mapping)]
    )


def feature_label_split(
    df: DataFrame, features: Iterable[str], label: str = "label", keep: Iterable[str] = ()
) -> DataFrame:
    """Used columns as one ``features`` struct, the label apart."""
    return df.select(
        *cols(keep), F.struct(*cols(features)).alias("features"), col(label).alias("label")
    )


def prefix_rows(
    df: DataFrame,
    n: int,
    order: str | Iterable[str],
    series: str | Iterable[str] = (),
    **index_options,
) -> DataFrame:
    """First ``n`` rows in order, of the whole table or of every series."""
    series = name_list(series)
    if not series:
        return df.orderBy(*cols(name_list(order))).limit(n)
    return index_rows(df, order, series, name="__idx", first=n, **index_options).drop("__idx")


def is_alert(prediction: Column, threshold: float = ALERT_THRESHOLD) -> Column:
    """At or above the threshold. NaN is no alert, although Spark orders it above any number."""
    return (prediction >= threshold) & ~F.isnan(prediction)


def threshold_alerts(
    predictions: DataFrame,
    threshold: float = ALERT_THRESHOLD,
    prediction: str = "prediction",
    time: str = "window_end",
    decimals: int | None = None,
) -> DataFrame:
    """Rows at or above the threshold with a ``message`` naming the window's time and value.

    The value is written in full, or with ``decimals`` places.
    """
    hit = predictions.where(is_alert(col(prediction), threshold))
    value = col(prediction).cast("string")
    if decimals is not None:
        value = F.format_string(f"%.{decimals}f", col(prediction))
    return hit.withColumn("message", F.format_string(ALERT_MESSAGE, time_text(col(time)), value))


def training_feed(df: DataFrame, columns: Iterable[str], epochs: int = 1) -> DataFrame:
    """Mapped columns in name order, once per epoch and tagged with it. No shuffle."""
    passes = F.explode(F.sequence(F.lit(0), F.lit(epochs - 1))).alias("epoch")
    return df.select(passes, *cols(sorted(columns)))
