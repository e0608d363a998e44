"""Example sets and classification results."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeline.functions.names import col, cols


#: Examples that one written file holds at most.
FILE_RECORDS = 1_000_000
#: The sets of a split export.
TRAIN, TEST = "train", "test"


def _writer(df: DataFrame, files: int | None, records: int):
    """Written from the tasks that hold the rows, without a shuffle, unless a file count is asked for."""
    df = df if files is None else df.repartition(files)
    return df.write.option("maxRecordsPerFile", records)


def _line(label: str, image: str) -> Column:
    return F.concat_ws(",", col(label).cast("string"), col(image).cast("array<string>"))


def write_example_lines(
    df: DataFrame, target: str, files: int | None = None, label: str = "label", image: str = "image",
    records: int = FILE_RECORDS,
) -> None:
    """``label,f0,f1,...`` text lines, ``records`` to a file at most, or in ``files`` files."""
    _writer(df.select(_line(label, image).alias("value")), files, records).text(target)


def write_example_records(
    df: DataFrame, target: str, files: int | None = None, label: str = "label", image: str = "image",
    records: int = FILE_RECORDS,
) -> None:
    """``label bigint, image array<bigint>`` Parquet records, ``records`` to a file at most, or in ``files`` files."""
    rows = df.select(
        col(label).cast("bigint").alias("label"),
        col(image).cast("array<bigint>").alias("image"),
    )
    _writer(rows, files, records).parquet(target)


def example_set(key: Column, test_percent: int) -> Column:
    """``train`` or ``test``, drawn from an MD5 of the key: the same in every run and engine."""
    drawn = F.conv(F.substring(F.md5(key.cast("string")), 1, 8), 16, 10).cast("bigint") % 100
    return F.when(drawn < test_percent, TEST).otherwise(TRAIN)


def write_train_test(
    df: DataFrame, base: str, key: str, test_percent: int = 10, label: str = "label", image: str = "image",
    records: int = FILE_RECORDS,
) -> dict[str, str]:
    """Example lines of a train and a test set, in one pass; the folder of each set is returned.

    A row without a key belongs to the train set.
    """
    rows = df.select(example_set(col(key), test_percent).alias("set"), _line(label, image).alias("value"))
    rows.write.option("maxRecordsPerFile", records).partitionBy("set").text(base)
    return {name: f"{base.rstrip('/')}/set={name}" for name in (TRAIN, TEST)}


def write_label_pred(
    df: DataFrame,
    target: str,
    files_per_shard: int | None = None,
    shard: str = "shard",
    label: str = "label",
    pred: str = "pred",
) -> None:
    """``label pred`` lines, one folder per shard.

    By default rows are written from the tasks that hold them, without a
    shuffle. ``files_per_shard`` gathers each shard into that many files; rows
    are salted over them by a hash of their content, so a large shard is still
    written by several tasks and a repeated task sends its rows the same way.
    """
    if files_per_shard is not None:
        salt = F.pmod(F.xxhash64(*cols(df.columns)), F.lit(files_per_shard))
        df = df.repartition(col(shard), salt)
    df.select(
        col(shard).cast("int").alias("shard"),
        F.format_string(
            "%d %d", col(label).cast("bigint"), col(pred).cast("bigint")
        ).alias("value"),
    ).write.partitionBy("shard").text(target)
