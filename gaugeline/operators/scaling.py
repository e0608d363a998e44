"""Per-window robust scaling of window arrays, one scaler state per input column."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeline.functions import vectors
from gaugeline.functions.names import col, name_list


def robust_fit(windows: DataFrame, inputs: str | Iterable[str]) -> DataFrame:
    """Add ``<input>_center`` (median) and ``<input>_scale`` (p75 - p25, 1 if zero).

    Missing values do not count. A window is a short array, so its quantiles
    come from sorting that array; no aggregation and no shuffle.
    """
    inputs = name_list(inputs)
    ordered = windows.select(
        "*", *[vectors.ordered_values(col(n)).alias(f"__ordered_{n}") for n in inputs]
    )
    state = []
    for n in inputs:
        values = col(f"__ordered_{n}")
        state += [
            vectors.robust_center(values).alias(f"{n}_center"),
            vectors.robust_scale(values).alias(f"{n}_scale"),
        ]
    return ordered.select(*[col(c) for c in windows.columns], *state)


def robust_transform(windows: DataFrame, inputs: str | Iterable[str]) -> DataFrame:
    """Add ``<input>_scaled``: the array on the scale found by :func:`robust_fit`."""
    return windows.select(
        "*",
        *[
            vectors.robust_transform(
                col(n), col(f"{n}_center"), col(f"{n}_scale")
            ).alias(f"{n}_scaled")
            for n in name_list(inputs)
        ],
    )


def robust_inverse(df: DataFrame, values: dict[str, str]) -> DataFrame:
    """Put columns back on the original scale: ``{column: input whose state inverts it}``."""
    return df.withColumns(
        {
            c: vectors.robust_inverse(col(c), col(f"{n}_center"), col(f"{n}_scale"))
            for c, n in values.items()
        }
    )
