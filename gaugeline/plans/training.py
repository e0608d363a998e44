"""Training sets out of windows, and closed-form fits per series."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeline.functions.names import col, cols, name_list
from gaugeline.operators.scaling import robust_fit, robust_transform
from gaugeline.operators.windows import WINDOW_SIZE, window_vectors

# Rows per block when neighbouring rows are paired; any value gives the same pairs.
PAIR_BLOCK = 512


def lag_features(
    df: DataFrame,
    order: str | Iterable[str],
    inputs: str | Iterable[str],
    target: str,
    size: int = WINDOW_SIZE,
    series: str | Iterable[str] = (),
    scaling: str = "robust",
    **options,
) -> DataFrame:
    """``features`` = a full window's values, ``label`` = the next value of ``target``.

    Both are on the window's own scale. Windows with a missing value or without
    a following row are no training examples.
    """
    inputs, series = name_list(inputs), name_list(series)
    windows = window_vectors(df, order, inputs, size, series, ahead=1, **options)
    # Checked on the raw arrays, so that no filter is pushed through the scaling.
    following = F.get(col(f"{target}_ahead"), F.lit(0))
    usable = (F.col("n") == size) & following.isNotNull()
    for name in inputs:
        usable = usable & F.forall(col(name), lambda x: x.isNotNull())
    windows = windows.where(usable)
    if scaling == "robust":
        windows = robust_transform(robust_fit(windows, inputs), inputs)
        following = (following - col(f"{target}_center")) / col(f"{target}_scale")
        inputs = [f"{n}_scaled" for n in inputs]
    lags = F.concat(*cols(inputs)) if len(inputs) > 1 else col(inputs[0])
    return windows.select(
        *cols(series),
        "window_id",
        array_to_vector(lags).alias("features"),
        following.alias("label"),
    )


def next_value_pairs(
    df: DataFrame,
    order: str | Iterable[str],
    value: str,
    series: str | Iterable[str] = (),
    **options,
) -> DataFrame:
    """``x`` and ``y``: each value with the one that follows it in its series.

    Rows are paired inside blocks that also hold the next block's first row, so
    no task sees a whole series.
    """
    series = name_list(series)
    blocks = window_vectors(df, order, value, PAIR_BLOCK, series, ahead=1, **options)
    run = F.concat(col(value), col(f"{value}_ahead"))
    pairs = F.arrays_zip(
        F.slice(run, F.lit(1), F.greatest(F.size(run) - 1, F.lit(0))).alias("x"),
        F.slice(run, F.lit(2), F.greatest(F.size(run) - 1, F.lit(0))).alias("y"),
    )
    return blocks.select(*cols(series), F.inline(pairs))


def fit_ar1(
    df: DataFrame,
    order: str | Iterable[str],
    value: str,
    series: str | Iterable[str] = (),
    **options,
) -> DataFrame:
    """Least-squares line ``next = intercept + slope * value`` per series, partially aggregated."""
    pairs = next_value_pairs(df, order, value, series, **options)
    return pairs.groupBy(*cols(name_list(series))).agg(
        F.regr_count("y", "x").alias("pairs"),
        F.regr_slope("y", "x").alias("slope"),
        F.regr_intercept("y", "x").alias("intercept"),
    )
