"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "gaugeline", master: str | None = None, **conf) -> SparkSession:
    """A session with the settings the plans rely on.

    Event times are wall-clock readings without a zone, so the session zone is
    pinned to UTC. Shuffle partition counts are left to AQE, which coalesces
    from whatever ``spark.sql.shuffle.partitions`` the cluster configures.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # Call-site capture costs a round trip to the JVM per column expression.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession) -> str:
    """A new path for a written hand-off, below the cluster's checkpoint folder.

    Only in local mode (tests on one machine) is a temporary one made, where no
    folder is configured, and recorded in the session. On a cluster executors
    would each write to a disk of their own, so that is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.conf.get("spark.master", "")
        if not (master == "local" or master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="gaugeline-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/gaugeline-{uuid.uuid4().hex}"


def written(df: DataFrame) -> DataFrame:
    """``df`` written below the shared folder and read back: computed once, lineage ends here."""
    path = scratch_dir(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
