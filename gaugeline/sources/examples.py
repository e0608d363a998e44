"""Delimited and sharded example files."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeline.functions.names import name_list

# What an empty field becomes, by role.
NUMBER_DEFAULT = 0.0
TEXT_DEFAULT = "0"
LABEL = "label"


def without_first_lines(lines: DataFrame) -> DataFrame:
    """Lines of a text scan but the first of each file, told by its place and not by what it says.

    A task reads its pieces of files one after another, so the first row of a
    piece that begins at byte 0 is the file's first line.
    """
    placed = lines.select("value", "_metadata.file_path", "_metadata.file_block_start")

    def skip(batches):
        import numpy as np
        import pyarrow as pa

        last = None
        for batch in batches:
            if not batch.num_rows:
                continue
            path, start = batch.column("file_path"), batch.column("file_block_start").to_numpy()
            code = path.dictionary_encode().indices.to_numpy()
            new = np.ones(len(start), bool)
            new[1:] = (code[1:] != code[:-1]) | (start[1:] != start[:-1])
            new[0] = (path[0].as_py(), start[0]) != last
            last = path[len(start) - 1].as_py(), start[-1]
            kept = batch.select(["value"]).filter(pa.array(~(new & (start == 0))))
            yield kept

    return placed.mapInArrow(skip, "value string")


def read_examples(
    spark: SparkSession,
    paths: str | Iterable[str],
    continuous: Iterable[str] = (),
    use_columns: Iterable[str] | None = None,
    columns: Iterable[str] | None = None,
    sep: str = "\t",
    has_header: bool = False,
) -> DataFrame:
    """Delimited examples typed by role: ``continuous`` and the label are doubles, the rest text.

    Names come from the first file's header, or from ``columns`` for files
    without one; the first line of every file is then skipped, whatever it says.
    A name that comes twice stands for its first column. Quotes are ordinary
    characters. Empty fields get the role's default; a row with another number
    of fields, or text where a number belongs, is an error.

    Lines are split here rather than by the CSV reader, which drops a line that
    is nothing but separators when the separator is a tab.
    """
    paths = name_list(paths)
    lines = spark.read.text(paths)
    if has_header:
        first = min(spark.read.text(paths[0]).inputFiles())
        columns = spark.read.text(first).first()["value"].split(sep)
        lines = without_first_lines(lines)
    elif columns is None:
        raise ValueError("files without a header need column names")
    columns = list(columns)
    numbers = {*continuous, LABEL}
    cells = F.split("value", re.escape(sep), -1)
    fits = F.when(F.size("cells") != len(columns), F.raise_error(
        F.concat(F.lit(f"expected {len(columns)} fields: "), F.col("value"))
    )).otherwise(F.col("cells"))

    def field(name: str) -> Column:
        cell = F.get("cells", F.lit(columns.index(name)))
        if name not in numbers:
            return F.when(cell == "", F.lit(TEXT_DEFAULT)).otherwise(cell)
        number = F.coalesce(
            cell.try_cast("double"),
            F.raise_error(F.concat(F.lit(f"no number in {name}: "), cell)),
        )
        return F.when(cell == "", F.lit(NUMBER_DEFAULT)).otherwise(number)

    wanted = list(use_columns) if use_columns is not None else columns
    return (
        lines.select("value", cells.alias("cells"))
        .select(fits.alias("cells"))
        .select(*[field(c).alias(c) for c in wanted])
    )


def read_example_records(spark: SparkSession, path: str) -> DataFrame:
    """Sharded ``label``/``image`` records and the ``file`` each came from."""
    return spark.read.parquet(f"{path.rstrip('/')}/part-*").select(
        "label", "image", F.col("_metadata.file_path").alias("file")
    )


def read_example_lines(spark: SparkSession, path: str) -> DataFrame:
    """Sharded ``label,f0,f1,...`` lines as ``label`` and one ``image`` array.

    One array column keeps the plan small however many features a line has.
    """
    cells = F.split("value", ",")
    return spark.read.text(f"{path.rstrip('/')}/part-*").select(
        F.get(cells, F.lit(0)).cast("bigint").alias("label"),
        F.slice(cells, F.lit(2), F.size(cells) - 1).cast("array<bigint>").alias("image"),
        F.col("_metadata.file_path").alias("file"),
    )
