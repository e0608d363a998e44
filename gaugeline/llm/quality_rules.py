"""Quality rules with host verdicts.

Rules are counted on each whole text. Failures are aggregated by host, a host's
failure rate is shrunk towards an empirical beta prior fitted to all hosts by
moments, and the host's verdict goes back to its documents:

* ``rejected`` (shrunk rate at least ``REJECT_RATE``): all its documents go;
* ``watched``: documents that fail a soft rule go;
* ``trusted`` (shrunk rate below ``TRUST_RATE``): only the base rules count.

The base rules (``MIN_WORDS``, repeated words) reject a document on any host.
Host totals are summed on the map side, so a host with a third of all rows is
one row per task. Text is not shuffled to find the verdicts.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeline.llm.common import hand_off, slices, texts_of
from gaugeline.llm.text_stats import base_stats

MIN_WORDS = 50
#: Soft rules, in hundredths: symbols per word, lines that repeat, distinct words per word (counted in
#: stretches of ``DISTINCT_WINDOW`` words over the whole text, as the share falls with length in any text).
MAX_SYMBOLS, MAX_DUP_LINES, MIN_DISTINCT = 10, 40, 10
MIN_WORD_CHARS, MAX_WORD_CHARS = 2, 12
TRUST_RATE, REJECT_RATE = 0.02, 0.8
#: Bounds of the prior's weight in documents (hosts all alike would give an infinite one).
MIN_WEIGHT, MAX_WEIGHT = 1.0, 1e6

STATS = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_distinct_words"]
_P = "__rules_"


def host_of(source: Column) -> Column:
    """The host of a URL, else the whole source, in lower case; null gives the empty host."""
    bare = F.regexp_replace(F.coalesce(source.cast("string"), F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://", "")
    return F.lower(F.regexp_extract(bare, r"^(?:[^/@]*@)?([^/:?#]*)", 1))


def with_stats(docs: DataFrame, text_col: str = "text", prefix: str = _P) -> DataFrame:
    """``docs`` with the counts of ``STATS`` as long columns; all other columns pass through."""
    schema = T.StructType([*docs.schema.fields, *(T.StructField(prefix + s, T.LongType()) for s in STATS)])

    def count(batches):
        for batch in slices(batches, text_col):
            stats = base_stats(texts_of(batch, text_col))
            columns = [*batch.columns, *(pa.array(stats[s], pa.int64()) for s in STATS)]
            yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names, *(prefix + s for s in STATS)])

    return docs.mapInArrow(count, schema)


def _base_failed(p: str) -> Column:
    n = F.col(p + "n_words")
    return (n < MIN_WORDS) | (100 * F.col(p + "n_repeat_words") > 50 * n)


def _soft_failed(p: str) -> Column:
    n, c = F.col(p + "n_words"), F.col
    return (
        (100 * c(p + "n_symbols") > MAX_SYMBOLS * n)
        | (100 * c(p + "n_dup_lines") > MAX_DUP_LINES * c(p + "n_lines"))
        | (100 * c(p + "n_distinct_words") < MIN_DISTINCT * n)
        | (c(p + "word_chars") < MIN_WORD_CHARS * n)
        | (c(p + "word_chars") > MAX_WORD_CHARS * n)
    )


def host_verdicts(counted: DataFrame, p: str = _P) -> DataFrame:
    """``host, n_docs, n_failed, rate, verdict`` from rows with ``{p}host`` and counts."""
    hosts = hand_off(
        counted.groupBy(F.col(p + "host").alias("host")).agg(
            F.count(F.lit(1)).alias("n_docs"),
            F.sum((_base_failed(p) | _soft_failed(p)).cast("bigint")).alias("n_failed"),
        )
    )
    n, k, m = F.col("n_docs"), F.col("n_failed"), F.col("m")
    mean = hosts.agg(F.sum("n_failed") / F.sum("n_docs")).scalar()
    # Between hosts: the weighted variance of their rates, less what chance alone gives.
    off = n * (k / n - m) * (k / n - m)
    spread = F.sum(off) / F.sum(n) - F.max(m * (1 - m)) * F.count(F.lit(1)) / F.sum(n)
    prior = hosts.withColumn("m", mean).agg(spread.alias("var"), F.max(m * (1 - m)).alias("mm"))
    by_moments = F.least(F.lit(MAX_WEIGHT), F.greatest(F.lit(MIN_WEIGHT), F.col("mm") / F.col("var") - 1))
    weight = prior.select(F.when(F.col("var") > 0, by_moments).otherwise(F.lit(MAX_WEIGHT))).scalar()
    rate = (k + mean * weight) / (n + weight)
    return hosts.withColumn("rate", rate).withColumn(
        "verdict",
        F.when(F.col("rate") >= REJECT_RATE, "rejected").when(F.col("rate") < TRUST_RATE, "trusted").otherwise("watched"),
    )


def _judged(counted: DataFrame, hosts: DataFrame, p: str) -> DataFrame:
    """``counted`` with ``{p}base_failed``, ``{p}verdict`` and ``{p}kept``."""
    verdicts = hosts.select(F.col("host").alias(p + "of"), F.col("verdict").alias(p + "verdict"))
    joined = counted.join(verdicts, F.col(p + "host") == F.col(p + "of"), "left").drop(p + "of")
    rejected = (F.col(p + "verdict") == "rejected") | ((F.col(p + "verdict") == "watched") & _soft_failed(p))
    return joined.withColumn(p + "base_failed", _base_failed(p)).withColumn(
        p + "kept", ~_base_failed(p) & ~rejected
    )


def judge_documents(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source"
) -> DataFrame:
    """One row per document: its counts, ``base_failed``, its host's verdict and ``kept``.

    A null or empty text has no words and fails the base rules. A null source is
    the host with the empty name. Repeated rows count each time. An empty table
    gives an empty result. Other columns are not looked at.
    """
    narrow = docs.select(
        F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), host_of(F.col(source_col)).alias(_P + "host")
    )
    counted = hand_off(with_stats(narrow, "text").drop("text"))
    judged = _judged(counted, host_verdicts(counted), _P)
    return judged.select(
        "doc_id",
        *(F.col(_P + s).alias(s) for s in STATS),
        F.col(_P + "base_failed").alias("base_failed"),
        F.col(_P + "host").alias("host"),
        F.col(_P + "verdict").alias("host_verdict"),
        F.col(_P + "kept").alias("kept"),
    )


def keep_documents(docs: DataFrame, text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The rows of ``docs`` that are kept, with their columns as they are.

    Counts are taken twice, once for the hosts and once beside the text, so that
    the text stays in its task when the host table is small enough to broadcast
    (Spark checks its size; beyond that it is a sort-merge join).
    """
    host = host_of(F.col(source_col)).alias(_P + "host")
    narrow = docs.select(F.col(text_col).alias("text"), host)
    hosts = hand_off(host_verdicts(with_stats(narrow, "text").drop("text")))
    counted = with_stats(docs.select("*", host), text_col)
    return _judged(counted, hosts, _P).where(F.col(_P + "kept")).select(*docs.columns)
