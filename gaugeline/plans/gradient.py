"""Least squares by conjugate gradients: distributed sums, state on shared storage, warm start.

A step is one pass over the examples: every partition multiplies its own rows
with the search direction and sums its share of the gradient, and the shares are
summed by position. What reaches the driver is one number per feature. The
state of the solver is written at every epoch; a fit that finds a state goes on
from the latest one, as if it had never stopped.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import asdict, dataclass

import numpy as np
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TOLERANCE = 1e-12


@dataclass(frozen=True)
class SolverState:
    """``weights`` are those of the features and, last, the intercept."""

    step: int
    examples: int
    weights: list[float]
    residual: list[float]
    direction: list[float]
    diagonal: list[float]

    @property
    def error(self) -> float:
        """How far the gradient is from zero, on the scale of its own features."""
        return float(sum(r * r / d for r, d in zip(self.residual, self.diagonal))) ** 0.5


def _sums(examples: DataFrame, of: Callable) -> np.ndarray:
    """Sums over all rows of ``of(features with a 1 at the end, label)``, an array per block of rows."""

    def share(batches):
        import numpy as np
        import pyarrow as pa

        total = None
        for batch in batches:
            if batch.num_rows:
                rows = batch.column("features").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
                label = batch.column("label").to_numpy(zero_copy_only=False)
                part = of(np.column_stack([rows, np.ones(len(rows))]), label)
                total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_pydict({"sums": [total.tolist()]}, pa.schema([("sums", pa.list_(pa.float64()))]))

    cells = examples.mapInArrow(share, "sums array<double>").select(F.posexplode("sums").alias("at", "amount"))
    found = {r["at"]: r["amount"] for r in cells.groupBy("at").agg(F.sum("amount").alias("amount")).collect()}
    return np.array([found[i] for i in range(len(found))])


def _start(examples: DataFrame) -> SolverState:
    sums = _sums(examples, lambda x, y: np.concatenate([[len(y)], (x * x).sum(axis=0), x.T @ y]))
    if not len(sums):
        raise ValueError("there are no training examples")
    width = (len(sums) - 1) // 2
    squares, right = sums[1 : 1 + width], sums[1 + width :]
    diagonal = np.where(squares > 0, squares, 1.0)
    return SolverState(0, int(sums[0]), [0.0] * width, right.tolist(), (right / diagonal).tolist(), diagonal.tolist())


def _advanced(examples: DataFrame, state: SolverState) -> SolverState:
    along = np.array(state.direction)
    image = _sums(examples, lambda x, y: x.T @ (x @ along))
    diagonal, residual = np.array(state.diagonal), np.array(state.residual)
    before = residual @ (residual / diagonal)
    size = before / (along @ image)
    weights, residual = np.array(state.weights) + size * along, residual - size * image
    scaled = residual / diagonal
    along = scaled + (residual @ scaled) / before * along
    return SolverState(state.step + 1, state.examples, weights.tolist(), residual.tolist(), along.tolist(), state.diagonal)


def latest_state(spark: SparkSession, model_dir: str) -> SolverState | None:
    """The state of the most steps below ``model_dir``; a state is one file, written whole or not at all."""
    try:
        states = spark.read.text(f"{model_dir.rstrip('/')}/state-*")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    step = F.get_json_object("value", "$.step").cast("int")
    found = states.orderBy(step.desc()).first()
    return SolverState(**json.loads(found["value"])) if found else None


def _save(spark: SparkSession, model_dir: str, state: SolverState) -> None:
    line = spark.createDataFrame([(json.dumps(asdict(state)),)], "value string").coalesce(1)
    line.write.mode("overwrite").text(f"{model_dir.rstrip('/')}/state-{state.step:09d}")


def fit_linear(
    examples: DataFrame, steps: int, every: int = 1, model_dir: str | None = None, tolerance: float = TOLERANCE
) -> SolverState:
    """Fit ``label`` to ``features`` (an array) by ``steps`` steps in all, those of earlier fits included.

    With ``model_dir`` the state is written every ``every`` steps and at the end,
    and the fit goes on from the latest one there. A state of other examples
    (their number or width) is an error. It ends early when the gradient is
    ``tolerance`` of what it began with, and needs no more steps than there are
    features and one. The examples are read once a step: persist them.
    """
    if steps < 0 or every < 1:
        raise ValueError("steps and every must be positive")
    spark, begun = examples.sparkSession, _start(examples)
    state = (latest_state(spark, model_dir) if model_dir else None) or begun
    if (state.examples, len(state.weights)) != (begun.examples, len(begun.weights)):
        raise ValueError(
            f"{model_dir} has a state of {state.examples} examples with {len(state.weights)} weights,"
            f" not {begun.examples} with {len(begun.weights)}"
        )
    saved = state.step if state is not begun else -1
    while state.step < steps and state.error > tolerance * begun.error:
        state = _advanced(examples, state)
        if model_dir and state.step % every == 0:
            _save(spark, model_dir, state)
            saved = state.step
    if model_dir and saved != state.step:
        _save(spark, model_dir, state)
    return state
