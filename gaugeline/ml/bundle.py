"""Model bundles: one file with several named functions, by tags, read through Spark.

A bundle holds variants, told apart by their set of tags; a variant holds
functions by signature name. A function names a registered scorer, the order in
which it takes the model's inputs, what its outputs are called, and its weights
or other options. The file is JSON and small (weights of windowed models), on any storage Spark knows.
"""

from __future__ import annotations

import json
from collections.abc import Iterable
from dataclasses import asdict, dataclass, field

from pyspark.sql import SparkSession

from gaugeline.functions.names import name_list
from gaugeline.ml.scorers import DEFAULT_SIGNATURE, Scorer, lookup

SERVING_TAG = "serve"


@dataclass(frozen=True)
class Function:
    """``outputs`` maps the function's output names to the scorer's; all of the scorer's by default."""

    scorer: str
    inputs: list[str]
    outputs: dict[str, str] = field(default_factory=dict)
    options: dict = field(default_factory=dict)


def tags_of(tag_set: str | Iterable[str]) -> frozenset[str]:
    """Tags out of a list or a text with commas; their order does not matter."""
    return frozenset(t.strip() for name in name_list(tag_set) for t in name.split(","))


def write_bundle(spark: SparkSession, path: str, variants: dict[str, dict[str, Function]]) -> None:
    """``variants``: tag set (with commas) -> signature -> function. An existing bundle is replaced."""
    content = [
        {"tags": sorted(tags_of(tags)), "functions": {n: asdict(f) for n, f in functions.items()}}
        for tags, functions in variants.items()
    ]
    line = json.dumps({"variants": content}, allow_nan=False)
    spark.createDataFrame([(line,)], "value string").coalesce(1).write.mode("overwrite").text(path)


def read_bundle(spark: SparkSession, path: str, tag_set: str | Iterable[str] = SERVING_TAG) -> dict[str, Function]:
    """The functions of the variant with exactly these tags; other tags are an error."""
    wanted = tags_of(tag_set)
    variants = json.loads(spark.read.text(path).first()["value"])["variants"]
    for variant in variants:
        if frozenset(variant["tags"]) == wanted:
            return {name: Function(**f) for name, f in variant["functions"].items()}
    known = [",".join(v["tags"]) for v in variants]
    raise ValueError(f"no variant with tags {','.join(sorted(wanted))!r} in {path}; it has {known}")


def scorer_of(function: Function) -> Scorer:
    """A function as a scorer: inputs found by name, outputs renamed, its options set.

    The factory is told the model inputs in the order of the columns
    (``options["inputs"]``); names that the function does not take are an error.
    """
    base = lookup(function.scorer)
    outputs = function.outputs or {n: n for n in base.outputs}
    unknown = set(outputs.values()) - set(base.outputs)
    if base.outputs and unknown:
        raise ValueError(f"scorer {function.scorer!r} has no output {sorted(unknown)}")
    factory, takes, fixed, alone = base.factory, list(function.inputs), dict(function.options), len(base.outputs) == 1

    def bundled(options: dict):
        predict = factory({**options, **fixed})
        given = options.get("inputs", takes)
        if sorted(given) != sorted(takes):
            raise ValueError(f"the function takes inputs {takes}, not {given}")
        place = [list(given).index(n) for n in takes]

        def call(*inputs):
            result = predict(*[inputs[i] for i in place])
            named = {name: result if alone else result[own] for name, own in outputs.items()}
            return next(iter(named.values())) if len(named) == 1 else named

        return call

    return Scorer(bundled, {name: base.outputs[own] for name, own in outputs.items()} if base.outputs else {})


def load_function(
    spark: SparkSession, path: str, signature: str = DEFAULT_SIGNATURE, tag_set: str | Iterable[str] = SERVING_TAG
) -> Scorer:
    """One function of a bundle, ready for ``score`` and ``predict_windows`` in place of a signature name."""
    functions = read_bundle(spark, path, tag_set)
    if signature not in functions:
        raise KeyError(f"no signature {signature!r} in {path}; it has {sorted(functions)}")
    return scorer_of(functions[signature])
