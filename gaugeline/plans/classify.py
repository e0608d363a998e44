"""Labelled vectors -> scores -> (label, pred)."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame

from gaugeline.functions import vectors
from gaugeline.functions.names import col, cols
from gaugeline.ml.model import VectorModel
from gaugeline.ml.scorers import lookup

# Examples per model call; cells of one image.
EXAMPLE_BATCH = 10
IMAGE_SHAPE = [28, 28, 1]


def classify_vectors(
    examples: DataFrame,
    vector: str,
    label: str = "label",
    keep: Iterable[str] = (),
    signature: str = "folded_classes",
    high: float = vectors.PIXEL_MAX,
    batch_size: int = EXAMPLE_BATCH,
    shape: list[int] | None = None,
    options: dict | None = None,
) -> DataFrame:
    """Normalise, score, take the best class. Narrow: no shuffle, only the used columns are read."""
    keep = list(keep)
    ready = examples.select(
        *cols(keep),
        col(label).cast("bigint").alias("label"),
        vectors.normalize(col(vector), high).alias("__vector"),
    )
    model = VectorModel(
        signature=signature, inputShape=list(shape or IMAGE_SHAPE), batchSize=batch_size, args=options or {}
    )
    (output,) = lookup(signature).outputs
    scored = model.setInputMapping({"__vector": "x"}).setOutputMapping({output: "__scores"}).transform(ready)
    return scored.select(*cols(keep), "label", vectors.argmax(col("__scores")).alias("pred"))
