"""Run metrics: what an action processed and how long it really took."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from gaugeline.functions.names import col


@dataclass(frozen=True)
class RunMetrics:
    stage: str
    seconds: float
    rows: int
    low: float | None
    high: float | None
    mean: float | None


def measure(
    df: DataFrame, value: str, action: Callable[[DataFrame], None], stage: str = "run"
) -> RunMetrics:
    """Run ``action`` on ``df`` once; time it and observe ``value`` on the way through.

    The metrics ride along with the action's own tasks, so nothing is computed
    twice, and the clock covers the work, not the building of the plan.
    """
    seen = Observation(stage)
    watched = df.observe(
        seen,
        F.count(F.lit(1)).alias("rows"),
        F.min(col(value)).alias("low"),
        F.max(col(value)).alias("high"),
        F.avg(col(value)).alias("mean"),
    )
    start = time.perf_counter()
    action(watched)
    seconds = time.perf_counter() - start
    return RunMetrics(stage=stage, seconds=seconds, **seen.get)


def measure_each(
    frames: Iterable[tuple[str, DataFrame]], value: str, action: Callable[[DataFrame], None]
) -> list[RunMetrics]:
    """``measure`` for one frame after the other: the stages of a run, or the steps of a sweep."""
    return [measure(df, value, action, stage) for stage, df in frames]


@dataclass(frozen=True)
class OperatorMetrics:
    """One operator of an executed plan, ``depth`` levels below its result.

    ``rows`` are those it gave on, where it counts them; ``seconds`` is the time it
    states for itself, summed over its tasks: of a whole code-generation stage,
    a scan, a sort, a shuffle's write, Python workers.
    """

    operator: str
    depth: int
    rows: int | None
    seconds: float
    metrics: dict[str, int]


#: Types of Spark's metrics that are times, and their part of a second.
_TIMES = {"timing": 1e-3, "nsTiming": 1e-9}


def operator_metrics(df: DataFrame) -> list[OperatorMetrics]:
    """Run the plan of ``df`` once and read the metrics that its operators kept, from the result downwards.

    They are the numbers of the plan that ran, after adaptive execution; no web
    page or listener is needed. ``consume`` runs a plan of its own, so nothing else does.
    """
    execution = df._jdf.queryExecution()
    execution.toRdd().count()
    out = []

    def walk(node, depth: int) -> None:
        kind = node.nodeName()
        if kind.startswith("AdaptiveSparkPlan"):
            return walk(node.executedPlan(), depth)
        if kind.endswith("QueryStage"):
            return walk(node.plan(), depth)
        values, seconds, found = {}, 0.0, node.metrics().iterator()
        while found.hasNext():
            entry = found.next()
            value = entry._2().value()
            values[entry._1()] = value
            seconds += max(0, value) * _TIMES.get(entry._2().metricType(), 0.0)
        rows = values.get("numOutputRows", values.get("shuffleRecordsWritten"))
        out.append(OperatorMetrics(kind, depth, rows, seconds, values))
        children = node.children()
        for i in range(children.size()):
            walk(children.apply(i), depth + 1)

    walk(execution.executedPlan(), 0)
    return out


def consume(df: DataFrame) -> None:
    """Run the whole plan and keep nothing."""
    df.write.format("noop").mode("overwrite").save()
