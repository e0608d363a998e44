import pytest
from pyspark.sql import types as T

SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
    ]
)


@pytest.fixture(scope="session")
def make_docs(spark):
    """A ``documents`` table from ``(doc_id, text)`` pairs or full rows."""

    def make(rows, partitions=3):
        full = [r if len(r) == 5 else (*r, "en", "src", len(r[1] or "")) for r in rows]
        return spark.createDataFrame(full, SCHEMA).repartition(partitions)

    return make
