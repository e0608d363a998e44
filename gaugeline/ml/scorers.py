"""Named scoring functions for :mod:`gaugeline.operators.scoring`.

A scorer is a factory ``factory(options) -> predict`` plus its named outputs.
``predict`` takes one NumPy array per model input (batch first) and returns one
array, or a dict of arrays by output name. The factory runs once per Python
worker. A scorer without declared
outputs takes their names from the output mapping, one double each.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import SparkSession
from pyspark.sql import types as T

DEFAULT_SIGNATURE = "serving_default"


@dataclass(frozen=True)
class Scorer:
    """``parse`` turns the bytes of a small file at ``model_path`` into options, once on the driver."""

    factory: Callable[[dict], Callable]
    outputs: dict[str, T.DataType] = field(default_factory=lambda: {"score": T.DoubleType()})
    parse: Callable[[bytes], dict] | None = None


def with_model_file(spark: SparkSession, scorer: Scorer, options: dict) -> dict:
    """``options`` with the content of the model file, read by Spark from any storage it knows.

    Scorers without ``parse`` open ``model_path`` themselves, on the worker.
    """
    if scorer.parse is None or "model_path" not in options:
        return options
    (content,) = spark.read.format("binaryFile").load(options["model_path"]).select("content").first()
    return {**options, **scorer.parse(bytes(content))}


def _ramp(x: np.ndarray) -> np.ndarray:
    """Positions 1..k, scaled to sum to 1."""
    k = x.shape[1]
    return np.arange(1, k + 1, dtype=np.float64) / (k * (k + 1) / 2)


def ramp_tanh(options: dict) -> Callable:
    """tanh of the position-weighted mean: recent values count most. Non-linear on purpose."""

    def predict(x):
        return np.tanh(x @ _ramp(x))

    return predict


def window_mean(options: dict) -> Callable:
    def predict(x):
        return x.mean(axis=1)

    return predict


def ramp_pair(options: dict) -> Callable:
    """Two inputs, two outputs: level from the first, spread between both."""

    def predict(a, b):
        ramp = _ramp(a)
        return {"level": np.tanh(a @ ramp), "gap": np.tanh(a @ ramp) - np.tanh(b @ ramp)}

    return predict


def folded_classes(options: dict) -> Callable:
    """One score per class: the sum of the vector items whose position is the class modulo k."""
    k = int(options.get("classes", 10))

    def predict(x):
        flat = x.reshape(len(x), -1).astype(np.float64)
        position = np.arange(flat.shape[1])
        return flat @ (position[:, None] % k == np.arange(k)).astype(np.float64)

    return predict


def linear(options: dict) -> Callable:
    """Fitted linear model: ``coefficients`` and ``intercept``, given or from a JSON file at ``model_path``."""
    coefficients = np.asarray(options["coefficients"], dtype=np.float64)
    intercept = float(options["intercept"])

    def predict(*inputs):
        return np.concatenate(inputs, axis=1) @ coefficients + intercept

    return predict


_REGISTRY: dict[str, Scorer] = {}


def register(name: str, scorer: Scorer) -> None:
    _REGISTRY[name] = scorer


def lookup(name: str | Scorer) -> Scorer:
    """The scorer of this name; a scorer (such as a function of a bundle) stands for itself."""
    if isinstance(name, Scorer):
        return name
    try:
        return _REGISTRY[name]
    except KeyError:
        raise KeyError(f"no scoring signature {name!r}; known: {sorted(_REGISTRY)}") from None


register(DEFAULT_SIGNATURE, Scorer(ramp_tanh))
register("ramp_tanh", Scorer(ramp_tanh))
register("window_mean", Scorer(window_mean))
register("ramp_pair", Scorer(ramp_pair, {"gap": T.DoubleType(), "level": T.DoubleType()}))
register("folded_classes", Scorer(folded_classes, {"scores": T.ArrayType(T.DoubleType())}))
register("linear", Scorer(linear, parse=json.loads))
