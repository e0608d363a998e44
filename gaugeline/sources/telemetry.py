"""Telemetry tables."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeline.functions.names import col, cols
from gaugeline.functions.times import DATE_FORMAT, EVENT_TIME_FORMAT, TIME_FORMAT, event_time
from gaugeline.sources.checked import Scan, read_delimited


def scan_telemetry(spark: SparkSession, path, schema=None, **options) -> Scan:
    """CSV files with a header each: readable rows, and rejects. Columns are bound by name, file by file.

    Give a schema for large data: inferring one reads files twice.
    """
    return read_delimited(spark, path, schema, **options)


def read_telemetry(spark: SparkSession, path, schema=None, **options) -> DataFrame:
    """The rows of ``scan_telemetry``; a malformed record is an error."""
    return scan_telemetry(spark, path, schema, **options).strict()


def with_event_times(scan: Scan, date: str = "Date", time: str = "time", fmt: str = EVENT_TIME_FORMAT) -> Scan:
    """Also reject rows whose date and time (both text) are no event time."""
    read = F.try_to_timestamp(F.concat_ws("-", col(date), col(time)), F.lit(fmt))
    return scan.refused(read.isNull(), "no event time", F.to_json(F.struct(*cols(scan.names))))


def normalize_telemetry(
    df: DataFrame,
    value: str = "%used",
    date: str = "Date",
    time: str = "time",
    series: str | None = None,
    fmt: str = EVENT_TIME_FORMAT,
    keep: Iterable[str] = (),
) -> DataFrame:
    """``series``, ``ts``, ``value`` out of date, time and usage columns, and the ``keep`` columns.

    Keep an id where times repeat and order by ``(ts, id)``. Without one, order by
    ``(ts, value)``: readings that share both can change places unnoticed.

    Schema inference may have turned the date or the time of day into a
    timestamp (of today); their texts are restored before they are joined.
    """
    for name, text_format in ((date, DATE_FORMAT), (time, TIME_FORMAT)):
        if not isinstance(df.schema[name].dataType, T.StringType):
            df = df.withColumn(name, F.date_format(col(name), text_format))
    key = col(series) if series else F.lit("all")
    return df.select(
        key.cast("string").alias("series"),
        event_time(date, time, fmt).alias("ts"),
        col(value).cast("double").alias("value"),
        *cols(keep),
    )
