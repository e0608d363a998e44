"""Batch scoring: one Arrow hand-over to Python per partition, model loaded once per worker."""

from __future__ import annotations

import inspect
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.ml.functions import predict_batch_udf
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from gaugeline.functions.names import cols, name_list
from gaugeline.ml.scorers import Scorer, lookup, with_model_file

BATCH_SIZE = 100


def _checked(predict, n_inputs: int):
    """``predict`` with the size check, and with its number of inputs spelled out for Spark."""

    def checked(*inputs):
        result = predict(*inputs)
        rows = len(inputs[0])
        outputs = result.values() if isinstance(result, dict) else [result]
        sizes = [len(o) for o in outputs]
        if any(s != rows for s in sizes):
            raise ValueError(f"output sizes {sizes} do not match the {rows} input rows")
        return result

    checked.__signature__ = inspect.Signature(
        inspect.Parameter(f"input_{i}", inspect.Parameter.POSITIONAL_ONLY) for i in range(n_inputs)
    )
    return checked


def score(
    df: DataFrame,
    inputs: str | Iterable[str],
    signature: str,
    shape: list[int],
    output: str = "score",
    batch_size: int = BATCH_SIZE,
    options: dict | None = None,
) -> DataFrame:
    """Add the column ``output`` with the scorer's result for every row.

    ``shape`` is what the model expects of one row of each input, for example
    ``[60]``, ``[60, 1]`` or ``[28, 28, 1]``; columns hold flat arrays. A scorer
    with one output gives a plain column, one with several a struct with a field per output name; ``options["outputs"]`` names those of a scorer
    that declares none. Every output must have one item per row.

    The function is declared non-deterministic for the optimizer's sake only: a
    filter on the result must not be pushed below it, which would run the model
    a second time.
    """
    scorer: Scorer = lookup(signature)
    settings = with_model_file(df.sparkSession, scorer, dict(options or {}))
    factory = scorer.factory
    named = scorer.outputs or {n: T.DoubleType() for n in settings["outputs"]}
    if len(named) == 1:
        (result_type,) = named.values()
    else:
        result_type = T.StructType([T.StructField(n, t) for n, t in named.items()])

    inputs = name_list(inputs)
    n_inputs = len(inputs)

    def make_predict_fn():
        return _checked(factory(settings), n_inputs)

    scored = predict_batch_udf(
        make_predict_fn,
        return_type=result_type,
        batch_size=batch_size,
        input_tensor_shapes=[list(shape)] * n_inputs,
    ).asNondeterministic()
    return df.withColumn(output, scored(*cols(inputs)))


def score_shards(
    df: DataFrame,
    vector: str,
    signature: str,
    keep: Iterable[str],
    output: str = "scores",
    batch_size: int = BATCH_SIZE,
    options: dict | None = None,
    gang: bool = False,
    profile=None,
) -> DataFrame:
    """Score partitions independently; the model is loaded once per Python worker, not per task.

    With ``gang`` all partitions are scored at the same time or not at all (a
    barrier stage; the cluster needs a free slot for each), as by workers that each own a
    shard; ``profile`` is a resource profile for these tasks.

    Rows stay where the scan put them, so a scan that reads shards needs no
    shuffle; ``keep`` must name the shard column if it is wanted in the result.
    """
    scorer = lookup(signature)
    (result_type,) = scorer.outputs.values()
    settings = with_model_file(df.sparkSession, scorer, dict(options or {}))
    keep, factory = list(keep), scorer.factory
    source = df.select(*cols([*keep, vector]))

    schema = T.StructType([source.schema[k] for k in keep] + [T.StructField(output, result_type)])
    model = uuid.uuid4()

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark.ml.model_cache import ModelCache

        predict = ModelCache.get(model)
        if predict is None:
            predict = _checked(factory(settings), 1)
            ModelCache.add(model, predict)
        for batch in batches:
            for start in range(0, len(batch), batch_size):
                part = batch.iloc[start : start + batch_size]
                result = predict(np.stack(part[vector].to_numpy()))
                yield part[keep].assign(**{output: list(result)})

    return source.mapInPandas(walk, schema, barrier=gang, profile=profile)
