"""Count-based tumbling windows: assignment, vectors, tail policy."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeline.functions import vectors
from gaugeline.functions.names import col, cols, name_list
from gaugeline.operators.indexing import index_rows

WINDOW_SIZE = 60
TAIL_POLICIES = ("drop", "reuse_previous")

_RANGE = "__range"


def count_windows(
    df: DataFrame,
    order: str | Iterable[str],
    size: int = WINDOW_SIZE,
    series: str | Iterable[str] = (),
    **index_options,
) -> DataFrame:
    """Add ``window_id`` and ``pos``: every ``size`` consecutive rows of a series form a window.

    Windows follow the order key within each series, so their number and
    content are the same for any partitioning of the input.
    """
    if size <= 0:
        raise ValueError("a count window needs a positive size")
    indexed = index_rows(df, order, series, name="__idx", **index_options)
    position = F.pmod(F.col("__idx"), F.lit(size))
    number = ((F.col("__idx") - position) / size).cast("bigint")
    # Never null, and declared so: a join on window_id then adds no null filter
    # below the grouping, and both sides can share one shuffle.
    return (
        indexed.withColumn("pos", position.cast("int"))
        .withColumn("window_id", F.coalesce(number, F.lit(0).cast("bigint")))
        .drop("__idx")
    )


def window_vectors(
    df: DataFrame,
    order: str | Iterable[str],
    inputs: str | Iterable[str],
    size: int = WINDOW_SIZE,
    series: str | Iterable[str] = (),
    time: str | None = None,
    ahead: int = 0,
    **index_options,
) -> DataFrame:
    """One row per (series, window_id): an ordered array per input column.

    Columns: the series, ``window_id``, ``n`` (rows in the window), one
    ``array<double>`` per input under the input's name, ``window_end`` (latest
    ``time``) if asked for and, with ``ahead`` > 0, ``<input>_ahead``: the first
    ``ahead`` values of the following window.

    Rows are packed into arrays where the index already grouped them (no
    shuffle), then the few pieces of each window that straddles two ranges are
    joined. That second shuffle carries packed doubles, spreads one long series
    over all tasks by ``window_id``, and never holds more than a window per group.
    """
    if not 0 <= ahead <= size:
        raise ValueError("ahead must lie between 0 and the window size")
    order, inputs, series = name_list(order), name_list(inputs), name_list(series)
    used = dict.fromkeys([*series, *order, *([time] if time else []), *inputs])
    rows = count_windows(
        df.select(*cols(used)), order, size, series, keep_range=True, **index_options
    )
    if ahead:
        own = F.struct(F.col("window_id"), F.col("pos"))
        lead = F.struct(
            (F.col("window_id") - 1).alias("window_id"), (F.col("pos") + size).alias("pos")
        )
        leads = (F.col("pos") < ahead) & (F.col("window_id") > 0)
        rows = (
            rows.withColumn("__slot", F.explode(F.when(leads, F.array(own, lead)).otherwise(F.array(own))))
            .withColumn("window_id", F.col("__slot.window_id"))
            .withColumn("pos", F.col("__slot.pos"))
            .drop("__slot")
        )

    cells = [f"__v{i}" for i in range(len(inputs))]
    values = [vectors.missing_as_null(col(n)).alias(v) for n, v in zip(inputs, cells)]
    end = [F.max(F.when(F.col("pos") < size, col(time))).alias("window_end")] if time else []
    pieces = (
        rows.groupBy(*cols(series), _RANGE, "window_id")
        .agg(F.sort_array(F.collect_list(F.struct("pos", *values))).alias("__cells"), *end)
        .select(
            *cols(series),
            "window_id",
            *(["window_end"] if time else []),
            F.struct(
                F.get("__cells", F.lit(0)).getField("pos").alias("start"),
                *[F.col("__cells").getField(v).alias(v) for v in cells],
            ).alias("__piece"),
        )
    )
    joined = pieces.groupBy(*cols(series), "window_id").agg(
        F.sort_array(F.collect_list("__piece")).alias("__pieces"),
        *([F.max("window_end").alias("window_end")] if time else []),
    )
    arrays = [F.flatten(F.col("__pieces").getField(v)).alias(v) for v in cells]
    whole = joined.select(
        *cols(series), "window_id", *(["window_end"] if time else []), *arrays
    )
    first = F.col(cells[0])
    named = [
        (F.slice(F.col(v), 1, size) if ahead else F.col(v)).alias(n)
        for n, v in zip(inputs, cells)
    ]
    following = [
        F.slice(F.col(v), size + 1, ahead).alias(f"{n}_ahead") for n, v in zip(inputs, cells)
    ]
    return whole.select(
        *cols(series),
        "window_id",
        F.least(F.size(first), F.lit(size)).cast("bigint").alias("n"),
        *(["window_end"] if time else []),
        *named,
        *(following if ahead else []),
    )


def apply_tail(
    windows: DataFrame,
    size: int,
    policy: str,
    series: str | Iterable[str] = (),
    carried: Iterable[str] = (),
) -> DataFrame:
    """Full windows plus, by policy, each series' short last window.

    ``drop`` keeps full windows only. ``reuse_previous`` gives a short window
    the ``carried`` columns of the window before it and keeps the rest (its
    scaling state, end time, count) as its own; a short window with none before
    it has nothing to reuse and is dropped.

    Only the last window of a series (or of each prefix of it) is short, so
    there are few; each meets its predecessor in an equi-join on
    (series, window_id), which spreads over tasks where a ``lag`` per series
    would put a long series into one.
    """
    if policy not in TAIL_POLICIES:
        raise ValueError(f"tail must be one of {TAIL_POLICIES}, not {policy!r}")
    full = windows.where(F.col("n") == size)
    if policy == "drop":
        return full
    series, carried = name_list(series), list(carried)
    kept = [c for c in windows.columns if c not in carried and c not in series]
    key_names = [f"__key{i}" for i in range(len(series))]
    own = F.struct(*cols(kept))
    tails = (
        windows.where(F.col("n") < size)
        .groupBy(
            *[col(s).alias(k) for s, k in zip(series, key_names)],
            (F.col("window_id") - 1).alias("__previous"),
        )
        .agg(F.collect_list(own).alias("__tails"))
    )
    match = F.col("window_id") == F.col("__previous")
    for s, k in zip(series, key_names):
        match = match & col(s).eqNullSafe(F.col(k))
    rows = F.when(F.col("__tails").isNull(), F.array(own)).otherwise(
        F.concat(F.array(own), F.col("__tails"))
    )
    return (
        full.join(tails, match, "left")
        .select(*cols([*series, *carried]), F.explode(rows).alias("__row"))
        .select(
            *[
                F.col("__row").getField(c).alias(c) if c in kept else col(c)
                for c in windows.columns
            ]
        )
    )


def left_out(windows: DataFrame, size: int, series: str | Iterable[str] = ()) -> DataFrame:
    """Per series: ``n_rows`` in windows, ``n_left_out`` of them in the short window that ``drop`` leaves out."""
    short = F.when(F.col("n") < size, F.col("n")).otherwise(F.lit(0))
    return windows.groupBy(*cols(name_list(series))).agg(
        F.sum("n").alias("n_rows"), F.sum(short).cast("bigint").alias("n_left_out")
    )


def window_rows(windows: DataFrame, inputs: str | Iterable[str]) -> DataFrame:
    """Window arrays back to one row per (window, pos)."""
    inputs = name_list(inputs)
    rest = [c for c in windows.columns if c not in inputs]
    return windows.select(
        *cols(rest), F.posexplode(F.arrays_zip(*cols(inputs))).alias("pos", "__cell")
    ).select(
        *cols(rest), "pos", *[F.col("__cell").getField(n).alias(n) for n in inputs]
    )
