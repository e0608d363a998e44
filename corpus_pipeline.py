"""The corpus pipeline: quality rules, line dedup, near-duplicate join, substring dedup, packing.

Each stage takes what the one before it kept. All but the last return the
columns of ``documents``; where a stage changes texts, ``n_chars`` follows.
Stages pass further columns through, whatever their names; tables without rows
give tables without rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeline.llm import line_align, packing, quality_rules, signature_join, substrings
from gaugeline.session import scratch_dir


def _measured(docs: DataFrame, columns: list[str]) -> DataFrame:
    n = F.char_length("text").cast("bigint")
    return docs.select(*(n.alias(c) if c == "n_chars" else F.col(c) for c in columns))


def apply_quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules and their hosts' verdicts keep.

    Null, empty and short texts fail the base rules; a null source is the host
    without a name. Repeated rows are judged, and count for their host, each.
    """
    return quality_rules.keep_documents(docs)


def align_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that align with an earlier document's are cut; documents that lose their last line go.

    Documents without an id come last. Rows of one id take nothing from each other.
    Null texts stay null, and texts that never had a line stay.
    """
    return _measured(line_align.dedup_lines(docs), docs.columns)


def join_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays: the one with the smallest id.

    All rows of that id stay. Rows without an id, a text or a word are in no group and stay.
    """
    return signature_join.keep_representatives(docs)


def cut_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that an earlier document has are cut; documents that were nothing else go.

    Documents without an id come last and, like rows of one id, take nothing from
    each other. Null and empty texts stay.
    """
    cut = substrings.remove_repeats(docs, prefix="__spans_")
    left = cut.where("__spans_n_words = 0 OR __spans_n_removed < __spans_n_words")
    return _measured(left, docs.columns)


def pack_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Length buckets with the least padding, and batches within a token budget.

    Every row, repeated ones and those without id or text (length 0) included, gets a slot.
    """
    return packing.pack(docs)


STAGES = [
    ("quality_rules", apply_quality_rules),
    ("line_dedup", align_lines),
    ("ngram_jaccard_join", join_near_duplicates),
    ("substring_dedup", cut_repeated_passages),
    ("packing", pack_documents),
]

#: Alignment, trees and the choice of boundaries have no SQL form: tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again before the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        if i:
            path = scratch_dir(spark)
            docs.write.option("compression", "zstd").parquet(path)
            docs = spark.read.parquet(path)
        docs = stage(spark, docs, sf_dir)
    return docs
