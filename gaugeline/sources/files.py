"""File discovery and raw lines."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def list_files(spark: SparkSession, root: str, patterns: Iterable[str] = ()) -> DataFrame:
    """``path`` and ``length`` of every file below ``root`` that matches one of the regexes.

    Without patterns all files count. Success markers and other hidden files do
    not. File contents are not read. Paths are written the way rows read from the
    files report them, so the two can be joined.
    """
    found = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .load(root)
        .select(F.col("_metadata.file_path").alias("path"), "length")
    )
    found = found.where(~F.col("path").contains("_SUCCESS"))
    patterns = list(patterns)
    if patterns:
        found = found.where(F.col("path").rlike("|".join(f"(?:{p})" for p in patterns)))
    return found


def read_lines(spark: SparkSession, path) -> DataFrame:
    """Every line of the files as ``value``, unparsed."""
    return spark.read.text(path)
