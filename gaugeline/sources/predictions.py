"""Stored predictions."""

from __future__ import annotations

import json

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeline.sinks.runs import committed_files
from gaugeline.sources.checked import Scan, read_json

PREDICTION_SCHEMA = "prediction array<double>"
DATED_PREDICTION_SCHEMA = "Datetime array<string>, prediction array<double>"
#: Lines that a schema is inferred from.
SCHEMA_LINES = 10_000
_SCHEMA = "_schema"


def _files(spark: SparkSession, path: str) -> list[str]:
    """Committed files of a run; all its JSON files where it was written without a commit."""
    found = committed_files(spark, path)
    return [f"{path.rstrip('/')}/*.json"] if found is None else found


def scan_predictions(spark: SparkSession, path: str, schema=DATED_PREDICTION_SCHEMA) -> Scan:
    """Prediction JSON of a run folder: readable rows, and broken lines as rejects.

    The schema is declared, so files are read once. A line without a prediction is a reject.
    """
    return read_json(spark, _files(spark, path), schema, ["prediction"])


def read_predictions(spark: SparkSession, path: str, schema=DATED_PREDICTION_SCHEMA) -> DataFrame:
    """The rows of ``scan_predictions``; a broken line is an error."""
    return scan_predictions(spark, path, schema).strict()


def inferred_schema(spark: SparkSession, path: str, lines: int = SCHEMA_LINES) -> T.StructType:
    """The schema of a run's JSON, inferred once from ``lines`` lines at most and kept beside the run."""
    kept = f"{path.rstrip('/')}/{_SCHEMA}"
    try:
        return T.StructType.fromJson(json.loads(spark.read.text(kept).first()["value"]))
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
    sample = [r["value"] for r in spark.read.text(_files(spark, path)).limit(lines).collect()]
    found = spark.read.json(spark.sparkContext.parallelize(sample, 1)).schema
    schema = T.StructType([f for f in found if f.name != "_corrupt_record"])
    spark.createDataFrame([(schema.json(),)], "value string").coalesce(1).write.text(kept)
    return schema


def prediction_values(df: DataFrame) -> DataFrame:
    """The single items of the stored one-item arrays, bound by name; a longer array is an error."""

    def single(c):
        longer = F.raise_error(F.concat(F.lit(f"more than one item in {c}: "), F.to_json(F.col(c))))
        return F.when(F.size(c) > 1, longer).otherwise(F.get(F.col(c), F.lit(0))).alias(c)

    return df.select(*[single(c) for c in df.columns if c in ("Datetime", "prediction")])


def read_report(spark: SparkSession, path: str) -> DataFrame:
    """``[value]`` lines as ``prediction``; committed ones where the report was committed."""
    found = committed_files(spark, path)
    if found == []:
        return spark.createDataFrame([], "prediction double")
    return spark.read.text(path if found is None else found).select(
        F.get(F.from_json("value", "array<double>"), F.lit(0)).alias("prediction")
    )
