"""The same forecast for several history lengths, in one job."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeline.functions.names import cols, name_list
from gaugeline.operators.windows import WINDOW_SIZE, window_vectors
from gaugeline.plans.forecast import scale_windows, score_windows

# Fixed value: rows one history step adds.
STEP_ROWS = 480


def step_lengths(steps: int, step: int = STEP_ROWS) -> list[int]:
    return [step * i for i in range(1, steps + 1)]


def prefix_windows(
    df: DataFrame,
    lengths: Iterable[int],
    order: str | Iterable[str],
    value: str,
    size: int = WINDOW_SIZE,
    series: str | Iterable[str] = (),
    time: str | None = None,
    tail: str = "drop",
    **options,
) -> DataFrame:
    """Scaled windows of all prefixes, each distinct window once.

    A window lies in a prefix with its first ``m`` rows (``m`` = all of them,
    unless the prefix ends inside). Prefixes that show the same ``m`` share the
    row: its ``lengths`` column lists them, so windows are built, scaled and
    scored once instead of once per length.
    """
    lengths = sorted(set(int(n) for n in lengths))
    series = name_list(series)
    rows = df
    inputs = [value]
    if time:
        rows = df.withColumn("__time", F.unix_micros(F.col(time).cast("timestamp")))
        inputs = [value, "__time"]
    windows = window_vectors(
        rows, order, inputs, size, series, first=lengths[-1], **options
    )
    all_lengths = F.array(*[F.lit(n).cast("bigint") for n in lengths])
    start = F.col("window_id") * size

    def shown(length):
        return F.least(F.col("n"), length - start)

    seen = F.array_distinct(F.filter(F.transform(all_lengths, shown), lambda m: m > 0))
    cut = (
        windows.withColumn("__m", F.explode(seen))
        .withColumn("lengths", F.filter(all_lengths, lambda n: shown(n) == F.col("__m")))
        .withColumn("n", F.col("__m"))
        .withColumns({c: F.slice(F.col(c), F.lit(1), F.col("__m").cast("int")) for c in inputs})
        .drop("__m")
    )
    if time:
        cut = cut.withColumn(
            "window_end", F.timestamp_micros(F.array_max("__time").cast("bigint"))
        ).drop("__time")
    return scale_windows(cut, [value], size, series, tail)


def prefix_sweep(
    df: DataFrame,
    lengths: Iterable[int],
    order: str | Iterable[str],
    value: str,
    size: int = WINDOW_SIZE,
    series: str | Iterable[str] = (),
    time: str | None = None,
    tail: str = "drop",
    shape: list[int] | None = None,
    index_options: dict | None = None,
    **scoring,
) -> DataFrame:
    """Predictions per history length: ``prefix_rows``, series, ``window_id``, prediction."""
    series = name_list(series)
    windows = prefix_windows(
        df, lengths, order, value, size, series, time, tail, **(index_options or {})
    )
    keep = [*series, "window_id", *(["window_end"] if time else [])]
    scored = score_windows(windows, [value], [*keep, "lengths"], shape or [size], **scoring)
    outputs = [c for c in scored.columns if c not in (*keep, "lengths")]
    return scored.select(
        F.explode("lengths").alias("prefix_rows"), *cols([*keep, *outputs])
    )
