"""The main job: telemetry files -> predictions, a report and alerts of one run."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame

from gaugeline.functions.times import run_id
from gaugeline.operators.projections import ALERT_THRESHOLD, threshold_alerts
from gaugeline.operators.windows import WINDOW_SIZE
from gaugeline.plans.forecast import predict_windows
from gaugeline.session import written
from gaugeline.sinks.predictions import commit_predictions, commit_report


@dataclass(frozen=True)
class Run:
    folder: str
    report: str
    alerts: DataFrame


def forecast_run(
    telemetry: DataFrame,
    base: str,
    size: int = WINDOW_SIZE,
    ids: Iterable[str] = (),
    tail: str = "reuse_previous",
    threshold: float = ALERT_THRESHOLD,
    decimals: int | None = None,
    run: str | None = None,
    **options,
) -> Run:
    """Score normalised telemetry, write the run's JSON and report, and return its alerts.

    Readings are ordered by time and ``ids``, or by time and value where there is
    no id. Windows are scored once: both files and the alerts come from one
    written table. Every reading counts, the short last window of a series too,
    unless ``tail`` is ``drop`` or the series is shorter than one window. Files are
    committed: a job repeated with the same ``run`` adds nothing to them.
    """
    order = ["ts", *(list(ids) or ["value"])]
    run = run or run_id()
    predictions = written(
        predict_windows(telemetry, order, "value", size, "series", "ts", tail, **options)
    )
    folder = commit_predictions(predictions, base, run)
    report = f"{folder}-report"
    commit_report(predictions, report)
    return Run(folder, report, threshold_alerts(predictions, threshold, decimals=decimals))
