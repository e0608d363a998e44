"""Event times, time buckets and run identifiers."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

from gaugeline.functions.names import col

# Text formats that existing readers of the files rely on.
EVENT_TIME_FORMAT = "yyyy/MM/dd-HH:mm:ss"
DATE_FORMAT = "yyyy/MM/dd"
TIME_FORMAT = "HH:mm:ss"
BUCKET_TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
RUN_ID_FORMAT = "%Y%m%d%H%M%S"
RUN_DIR_SUFFIX = "-prediction"
BUCKET_SECONDS = 900


def event_time(date: str = "Date", time: str = "time", fmt: str = EVENT_TIME_FORMAT) -> Column:
    """One timestamp out of a date column and a time column, both text."""
    return F.to_timestamp(F.concat_ws("-", col(date), col(time)), fmt)


def time_bucket(
    column: str | Column,
    seconds: int = BUCKET_SECONDS,
    fmt: str = BUCKET_TIME_FORMAT,
) -> Column:
    """Start of the fixed-width bucket (counted from the epoch) a time falls in.

    Text is parsed with ``fmt``; timestamps are taken as they are.
    """
    if seconds <= 0:
        raise ValueError("a time bucket needs a positive width")
    value = col(column) if isinstance(column, str) else column
    epoch = F.unix_timestamp(value, fmt)
    return F.timestamp_seconds(epoch - F.pmod(epoch, F.lit(seconds)))


def time_text(column: Column, fmt: str = EVENT_TIME_FORMAT) -> Column:
    return F.date_format(column, fmt)


def run_id(now: datetime | None = None) -> str:
    """Name of one run's output folder; fixed once on the driver."""
    return (now or datetime.now()).strftime(RUN_ID_FORMAT) + RUN_DIR_SUFFIX
