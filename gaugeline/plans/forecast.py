"""Telemetry rows -> scaled windows -> scores -> predictions on the original scale."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeline.functions.names import cols, name_list
from gaugeline.ml.scorers import DEFAULT_SIGNATURE, lookup
from gaugeline.operators.projections import output_mapping
from gaugeline.operators.scaling import robust_fit, robust_inverse, robust_transform
from gaugeline.operators.scoring import BATCH_SIZE, score
from gaugeline.operators.windows import WINDOW_SIZE, apply_tail, window_vectors

SCALINGS = ("robust", "none")


def scaled_windows(
    df: DataFrame,
    order: str | Iterable[str],
    inputs: str | Iterable[str],
    size: int = WINDOW_SIZE,
    series: str | Iterable[str] = (),
    time: str | None = None,
    tail: str = "drop",
    **options,
) -> DataFrame:
    """Windows with scaler state and scaled arrays, after the tail policy.

    With ``reuse_previous`` the unscaled arrays are left out: no step after the
    scaling reads them, and the join of short windows would carry them along.
    """
    inputs = name_list(inputs)
    windows = window_vectors(df, order, inputs, size, series, time, **options)
    return scale_windows(windows, inputs, size, series, tail)


def scale_windows(
    windows: DataFrame,
    inputs: list[str],
    size: int,
    series: str | Iterable[str],
    tail: str,
) -> DataFrame:
    if tail == "drop":
        windows = apply_tail(windows, size, tail, series)
    scaled = robust_transform(robust_fit(windows, inputs), inputs)
    if tail == "drop":
        return scaled
    slim = scaled.drop(*inputs)
    return apply_tail(slim, size, tail, series, carried=[f"{n}_scaled" for n in inputs])


def score_windows(
    windows: DataFrame,
    inputs: list[str],
    keep: Iterable[str],
    shape: list[int],
    signature: str = DEFAULT_SIGNATURE,
    outputs: dict[str, str] | None = None,
    scale_by: dict[str, str] | None = None,
    scaling: str = "robust",
    batch_size: int = BATCH_SIZE,
    options: dict | None = None,
) -> DataFrame:
    """Score window rows and restore the scale of each mapped output.

    ``outputs`` maps output names to columns; ``scale_by`` names, per output,
    the input column whose state inverts it (the last input if not given).
    """
    if scaling not in SCALINGS:
        raise ValueError(f"scaling must be one of {SCALINGS}, not {scaling!r}")
    names = list(lookup(signature).outputs) or sorted(outputs or {})
    options = {"outputs": names, **(options or {})}
    outputs = outputs or ({names[0]: "prediction"} if len(names) == 1 else {n: n for n in names})
    suffix = "_scaled" if scaling == "robust" else ""
    scored = score(
        windows, [n + suffix for n in inputs], signature, shape, "__out", batch_size, options
    )
    if len(names) == 1:
        scored = scored.withColumn("__out", F.struct(F.col("__out").alias(names[0])))
    keep = list(keep)
    state = [f"{n}_{s}" for n in inputs for s in ("center", "scale")] if scaling == "robust" else []
    mapped = output_mapping(scored, outputs, "__out", keep=[*keep, *state])
    if scaling == "robust":
        scale_by = scale_by or {}
        mapped = robust_inverse(
            mapped, {c: scale_by.get(o, inputs[-1]) for o, c in outputs.items()}
        )
    return mapped.select(*cols(keep), *cols(outputs[o] for o in sorted(outputs)))


def predict_windows(
    df: DataFrame,
    order: str | Iterable[str],
    inputs: str | Iterable[str],
    size: int = WINDOW_SIZE,
    series: str | Iterable[str] = (),
    time: str | None = None,
    tail: str = "drop",
    scaling: str = "robust",
    shape: list[int] | None = None,
    index_options: dict | None = None,
    **scoring,
) -> DataFrame:
    """One prediction row per window: series, ``window_id``, ``window_end``, outputs.

    ``shape`` is the model's view of one window, ``[size]`` if not given.
    """
    inputs, series = name_list(inputs), name_list(series)
    options = dict(index_options or {})
    if scaling == "robust":
        windows = scaled_windows(df, order, inputs, size, series, time, tail, **options)
    else:
        windows = window_vectors(df, order, inputs, size, series, time, **options)
        windows = apply_tail(windows, size, tail, series, carried=inputs)
    keep = [*series, "window_id", *(["window_end"] if time else [])]
    return score_windows(windows, inputs, keep, shape or [size], scaling=scaling, **scoring)
