"""Rows in the order of their files: an order key for scans without an order column.

A file's rows are told apart by their place: in Parquet by the row's index in
the file, in line formats by the byte at which the task's piece of the file
begins and a number that grows along the piece. Pieces of a file are ordered by
their first byte and a piece is read by one task from its first line to its last, so
the order is that of the lines however the files are cut and dealt.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Columns that ``in_file_order`` adds, in order.
FILE_ORDER = ["__file", "__block", "__line"]


def in_file_order(scan: DataFrame) -> DataFrame:
    """``scan`` with the columns ``FILE_ORDER``: file (by name), piece, row.

    ``scan`` must be a scan of files as ``spark.read`` returns it, with no more
    than columns selected. Give ``FILE_ORDER`` as ``order`` to
    ``prefix_rows``, ``count_windows`` or any other operator on ordered rows, and
    drop the columns afterwards.
    """
    indexed = "row_index" in scan.select("_metadata.*").columns
    file, block = F.col("_metadata.file_path"), F.col("_metadata.file_block_start")
    line = F.col("_metadata.row_index") if indexed else F.monotonically_increasing_id()
    block = F.lit(0).cast("bigint") if indexed else block
    return scan.select("*", *[c.alias(n) for c, n in zip((file, block, line), FILE_ORDER)])
