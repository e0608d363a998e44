"""Delimited and JSON scans that bind by name and keep what they cannot read.

A scan has two sides: ``rows``, and ``rejects`` with the file and the text of
every record that is malformed (a wrong number of fields, text where a number
belongs, broken JSON). Which side a record is on depends on all its wanted
columns, not on those a query happens to select: Spark's readers convert only
selected columns, so both sides refer to all of them.
"""

from __future__ import annotations

import csv
from collections.abc import Iterable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeline.functions.names import col, cols, name_list

_RECORD = "__record"
_FILE = "__file"
_REASON = "__reason"
MALFORMED = "malformed record"
#: One file to a task, however long, for the pass that reads only first lines.
_WHOLE_FILE = 1 << 50


@dataclass(frozen=True)
class Scan:
    """``raw`` has the wanted columns, and ``__file``, ``__record`` and ``__reason`` (null for good records)."""

    raw: DataFrame
    names: tuple[str, ...]

    def _side(self, bad: bool) -> DataFrame:
        # Never false, but not known to be so: it keeps every wanted column in the scan.
        whole = F.xxhash64(*cols(self.names)) >= F.lit(-(1 << 63))
        reason = col(_REASON)
        return self.raw.where(whole & (reason.isNotNull() if bad else reason.isNull()))

    @property
    def rows(self) -> DataFrame:
        return self._side(False).select(*cols(self.names))

    @property
    def rejects(self) -> DataFrame:
        """``file``, ``reason`` and ``record`` (its text)."""
        return self._side(True).select(col(_FILE).alias("file"), col(_REASON).alias("reason"), col(_RECORD).alias("record"))

    def strict(self) -> DataFrame:
        """The rows; a malformed record is an error that names its file and text."""
        said = F.concat(col(_REASON), F.lit(" in "), col(_FILE), F.lit(": "), F.coalesce(col(_RECORD), F.lit("")))
        good = F.when(col(_REASON).isNotNull(), F.raise_error(said).cast("boolean")).otherwise(F.lit(True))
        whole = F.xxhash64(*cols(self.names)) >= F.lit(-(1 << 63))
        return self.raw.where(whole & good).select(*cols(self.names))

    def stored(self, target: str) -> Scan:
        """Both sides written below ``target`` in one pass over the source, and read back from there."""
        marked = self.raw.withColumn("rejected", col(_REASON).isNotNull())
        marked.write.partitionBy("rejected").parquet(target)
        back = self.raw.sparkSession.read.schema(marked.schema).parquet(target)
        return Scan(back.drop("rejected"), self.names)

    def refused(self, bad: Column, reason: str, record: Column) -> Scan:
        """Also reject good records for which ``bad`` holds, with ``record`` as their text."""
        now = col(_REASON).isNull() & F.coalesce(bad, F.lit(False))
        raw = self.raw.withColumn(_RECORD, F.when(now, record).otherwise(col(_RECORD)))
        return Scan(raw.withColumn(_REASON, F.when(now, F.lit(reason)).otherwise(col(_REASON))), self.names)


def as_schema(spark: SparkSession, schema) -> T.StructType:
    return schema if isinstance(schema, T.StructType) else spark.createDataFrame([], schema).schema


def _nothing(spark: SparkSession, wanted: T.StructType) -> DataFrame:
    return spark.createDataFrame([], T.StructType([*wanted.fields, T.StructField(_FILE, T.StringType()), T.StructField(_RECORD, T.StringType())]))


def first_lines(spark: SparkSession, paths: list[str]) -> dict[str, list[str]]:
    """Files by their first line. Each file is one task, which stops after that line.

    What comes to the driver is one line per distinct header and the file names,
    which the driver lists for any scan.
    """
    names = spark.read.text(paths).inputFiles()
    if len(names) < 2:
        found = spark.read.text(paths).first()
        return {found["value"]: list(names)} if found else {}
    session = spark.newSession()
    for key in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"):
        session.conf.set(key, _WHOLE_FILE)
    session.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 1)

    def first(batches):
        for batch in batches:
            if batch.num_rows:
                yield batch.slice(0, 1)
                return

    lines = session.read.text(paths).select("value", "_metadata.file_path")
    found = lines.mapInArrow(first, "value string, file_path string").groupBy("value")
    return {r["value"]: sorted(r["files"]) for r in found.agg(F.collect_list("file_path").alias("files")).collect()}


def _header(line: str, sep: str) -> list[str]:
    return next(csv.reader([line.removeprefix("﻿")], delimiter=sep), [])


def read_delimited(spark: SparkSession, path: str | Iterable[str], schema=None, sep: str = ",", **options) -> Scan:
    """Delimited files with a header each; columns are found by the names in their own file's header.

    ``schema`` names the wanted columns and their types; a file's other columns
    are skipped, a file without a wanted column is an error, and of a name that
    comes twice in a header the first counts. Without a schema all columns of the
    first header are wanted and their types are inferred, which reads its files twice.
    Files that share a header are one scan.
    """
    paths = name_list(path)
    layouts = {line: (_header(line, sep), files) for line, files in first_lines(spark, paths).items()}
    reader = {"header": True, "sep": sep, **options}
    if schema is None:
        if not layouts:
            raise ValueError(f"no header in {paths}")
        names, files = min(layouts.values(), key=lambda x: x[1][0])
        inferred = spark.read.options(**reader, inferSchema=True).csv(files).schema
        wanted = T.StructType([T.StructField(n, inferred[i].dataType) for i, n in enumerate(names) if n not in names[:i]])
    else:
        wanted = as_schema(spark, schema)
    scans = []
    for names, files in layouts.values():
        absent = [n for n in wanted.names if n not in names]
        if absent:
            raise ValueError(f"{files[0]}: no column {', '.join(absent)} in its header")
        fields = [
            T.StructField(n, wanted[n].dataType) if n in wanted.names and n not in names[:i] else T.StructField(f"__skip{i}", T.StringType())
            for i, n in enumerate(names)
        ]
        # Without columnPruning=False the reader takes short rows for whole ones.
        read = spark.read.schema(T.StructType([*fields, T.StructField(_RECORD, T.StringType())])).options(
            **reader, columnNameOfCorruptRecord=_RECORD, columnPruning=False, enforceSchema=True
        )
        scans.append(read.csv(files).select(*cols(wanted.names), F.col("_metadata.file_path").alias(_FILE), _RECORD))
    raw = reduce(DataFrame.unionByName, scans) if scans else _nothing(spark, wanted)
    return Scan(raw.withColumn(_REASON, F.when(F.col(_RECORD).isNotNull(), F.lit(MALFORMED))), tuple(wanted.names))


def read_json(spark: SparkSession, path: str | Iterable[str], schema, required: Iterable[str] = ()) -> Scan:
    """JSON lines of a declared schema; broken lines, values of another type and lines
    without a ``required`` field (or with a null there) are rejects."""
    wanted, paths = as_schema(spark, schema), name_list(path)
    if paths:
        read = spark.read.schema(T.StructType([*wanted.fields, T.StructField(_RECORD, T.StringType())]))
        raw = read.option("columnNameOfCorruptRecord", _RECORD).json(paths)
        raw = raw.select(*cols(wanted.names), F.col("_metadata.file_path").alias(_FILE), _RECORD)
    else:
        raw = _nothing(spark, wanted)
    scan = Scan(raw.withColumn(_REASON, F.when(F.col(_RECORD).isNotNull(), F.lit(MALFORMED))), tuple(wanted.names))
    for name in required:
        scan = scan.refused(col(name).isNull(), f"no {name}", F.to_json(F.struct(*cols(wanted.names))))
    return scan
