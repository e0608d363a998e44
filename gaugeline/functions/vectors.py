"""Array-column expressions: robust scaling, normalising, reshaping, argmax, casts.

All of them run inside the JVM. Arrays hold one window or one example each, so
they are short whatever the size of the table.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: largest intensity of an 8-bit image cell.
PIXEL_MAX = 255.0


def missing_as_null(value: Column) -> Column:
    """Double with NaN as null, because Spark would sort NaN as the largest number."""
    number = value.cast("double")
    return F.when(~F.isnan(number), number)


def quantile(ordered: Column, p: float) -> Column:
    """Linearly interpolated quantile of an ascending array without nulls."""
    at = (F.size(ordered) - 1) * F.lit(float(p))
    below = F.floor(at).cast("int")
    low = F.get(ordered, below)
    high = F.get(ordered, F.ceil(at).cast("int"))
    return low + (high - low) * (at - below)


def ordered_values(values: Column) -> Column:
    """Present values of an array in ascending order."""
    return F.sort_array(F.array_compact(values))


def robust_center(ordered: Column) -> Column:
    return quantile(ordered, 0.5)


def robust_scale(ordered: Column) -> Column:
    """Interquartile range; 1 where the middle half is constant."""
    spread = quantile(ordered, 0.75) - quantile(ordered, 0.25)
    return F.when(spread == 0.0, F.lit(1.0)).otherwise(spread)


def robust_transform(values: Column, center: Column, scale: Column) -> Column:
    """``(x - center) / scale`` per item.

    The state goes in as an array argument, not as a captured column: should the
    optimizer inline its expression here, it is still evaluated once per array
    and not once per item.
    """
    state = F.array_repeat(F.struct(center.alias("c"), scale.alias("s")), F.size(values))
    return F.zip_with(values, state, lambda x, at: (x - at.getField("c")) / at.getField("s"))


def robust_inverse(value: Column, center: Column, scale: Column) -> Column:
    return value * scale + center


def normalize(vector: Column, high: float = PIXEL_MAX) -> Column:
    return F.transform(vector, lambda x: x.cast("double") / F.lit(high))


def flatten_rows(matrix: Column) -> Column:
    return F.flatten(matrix)


def reshape(vector: Column, rows: int, columns: int) -> Column:
    """A flat array as ``rows`` arrays of ``columns`` items; null if the length does not fit."""
    cut = F.transform(
        F.sequence(F.lit(0), F.lit(rows - 1)),
        lambda r: F.slice(vector, r * columns + 1, columns),
    )
    return F.when(F.size(vector) == rows * columns, cut)


def argmax(vector: Column) -> Column:
    """Zero-based position of the largest item; the first one wins."""
    return (F.array_position(vector, F.array_max(vector)) - 1).cast("bigint")


def to_float(value: Column) -> Column:
    return value.cast("float")


def to_float_array(vector: Column) -> Column:
    return vector.cast("array<float>")


def binary_to_string(value: Column) -> Column:
    return value.cast("string")
