"""Committed outputs: a job that is run again with the same run id leaves one set of rows.

Every attempt writes a folder of its own below the target; when it is complete,
a manifest names its files. Readers take the files of the manifest and nothing else, so
files of a broken or repeated attempt are never read. A target that has a
manifest is not written again. Should two attempts commit at the same moment,
all readers take the one that sorts first.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from gaugeline.sources.files import list_files

_MANIFEST = "_committed"


def manifest(spark: SparkSession, target: str) -> dict | None:
    """``attempt`` and ``files`` (name and length) of what is committed at ``target``, or None."""
    try:
        lines = spark.read.text(f"{target.rstrip('/')}/{_MANIFEST}").collect()  # one line an attempt
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    return min((json.loads(r["value"]) for r in lines), key=lambda m: m["attempt"], default=None)


def committed_files(spark: SparkSession, target: str) -> list[str] | None:
    """Paths of the committed files; None where nothing is committed."""
    found = manifest(spark, target)
    return found and [f"{target.rstrip('/')}/{found['attempt']}/{f['name']}" for f in found["files"]]


def commit(spark: SparkSession, target: str, write: Callable[[str], None]) -> bool:
    """Call ``write`` with a new folder below ``target`` and commit what it wrote.

    False, and nothing written, if ``target`` is committed already.
    """
    target = target.rstrip("/")
    if manifest(spark, target) is not None:
        return False
    attempt = f"attempt-{uuid.uuid4().hex}"
    write(f"{target}/{attempt}")
    name = F.regexp_extract("path", f"{attempt}/(.*)$", 1)
    files = list_files(spark, f"{target}/{attempt}").select(name.alias("name"), "length").orderBy("name").collect()
    line = json.dumps({"attempt": attempt, "files": [f.asDict() for f in files]})
    spark.createDataFrame([(line,)], "value string").coalesce(1).write.mode("append").text(f"{target}/{_MANIFEST}")
    return True
