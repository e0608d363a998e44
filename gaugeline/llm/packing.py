"""Packing by optimal length buckets.

A histogram of all lengths is summed on the map side. Dynamic programming over
it chooses the bucket boundaries with the least padding, every document padded
to its bucket's boundary. Inside a bucket documents are dealt to shards of about
``SHARD_DOCS`` by hash and put into batches of as many as the token budget
holds, so no task numbers a whole bucket however many rows share one length.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gaugeline.llm.common import hand_off

BUCKETS = 16
#: Padded tokens of a batch. A longer document is a batch of its own, whole.
BUDGET = 32_768
SHARD_DOCS = 20_000
#: Lengths up to this many bits are a histogram bin each; longer ones keep so many leading bits,
#: which bounds the histogram (2^16 bins, and 2^15 for each further doubling) at any text length.
EXACT_BITS = 16


def n_tokens(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+``; a null text has none."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("bigint")


def choose_boundaries(longest: np.ndarray, count: np.ndarray, total: np.ndarray, buckets: int = BUCKETS) -> list[int]:
    """Upper lengths of at most ``buckets`` runs of bins with the least padding in all.

    Bins come in order of length: their longest length, documents, and summed
    length. Padding of a run is its last bin's longest length for each of its
    documents, less their lengths. That cost obeys the quadrangle inequality, so
    the best split moves to the right with the end and each layer is solved by
    divide and conquer. Fewer bins than buckets give a bucket each.
    """
    n = len(longest)
    if n == 0:
        return []
    docs = np.concatenate([[0], np.cumsum(count.astype(object))]).astype(np.float64)
    tokens = np.concatenate([[0], np.cumsum(total.astype(object))]).astype(np.float64)
    tops = longest.astype(np.float64)
    layers = min(buckets, n)
    best = tops * docs[1:] - tokens[1:]
    split = np.zeros((layers, n), np.int64)
    for layer in range(1, layers):
        before, best = best, np.full(n, np.inf)
        work = [(layer, n - 1, layer, n - 1)]
        while work:
            lo, hi, first, last = work.pop()
            if lo > hi:
                continue
            mid = (lo + hi) // 2
            starts = np.arange(first, min(mid, last) + 1)
            cost = before[starts - 1] + tops[mid] * (docs[mid + 1] - docs[starts]) - (tokens[mid + 1] - tokens[starts])
            at = int(cost.argmin())
            best[mid], split[layer, mid] = cost[at], starts[at]
            work += [(lo, mid - 1, first, int(starts[at])), (mid + 1, hi, int(starts[at]), last)]
    ends, end = [], n - 1
    for layer in range(layers - 1, -1, -1):
        ends.append(int(longest[end]))
        end = int(split[layer, end]) - 1
    return ends[::-1]


def histogram(lengths: DataFrame) -> DataFrame:
    """``bin, longest, count, total`` of a table with ``n_tokens``."""
    n = F.col("n_tokens")
    bits = F.length(F.bin(n))
    shift = F.greatest(bits - EXACT_BITS, F.lit(0))
    step = F.pow(F.lit(2.0), shift).cast("bigint")
    return lengths.groupBy((F.floor(n / step) * step).alias("bin")).agg(
        F.max(n).alias("longest"), F.count(F.lit(1)).alias("count"), F.sum(n).alias("total")
    )


def pack(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", buckets: int = BUCKETS, budget: int = BUDGET
) -> DataFrame:
    """One row per document: its length, bucket, boundary, batch and slot in the batch.

    ``doc_id, n_tokens, bucket, bucket_len, batch_id, slot``; a batch's documents
    times its boundary stay within ``budget``, but for batches of one longer
    document. Null and empty texts have length 0 and are packed too. Repeated
    rows get slots of their own. An empty table gives an empty result.
    """
    # The row's number is written with it: rows that are alike in everything are dealt to shards by it.
    lengths = hand_off(
        docs.select(F.col(id_col).alias("doc_id"), n_tokens(F.col(text_col)).alias("n_tokens")).withColumn("row", F.monotonically_increasing_id())
    )
    bins = histogram(lengths).orderBy("bin").toPandas()
    ends = choose_boundaries(bins["longest"].to_numpy(), bins["count"].to_numpy(), bins["total"].to_numpy(), buckets)
    held = np.zeros(max(1, len(ends)), np.int64)
    if ends:
        np.add.at(held, np.searchsorted(ends, bins["longest"].to_numpy()), bins["count"].to_numpy())

    def by_bucket(values) -> Column:
        chosen = F.lit(int(values[-1]) if len(values) else 0).cast("bigint")
        for end, value in list(zip(ends, values))[-2::-1]:
            chosen = F.when(F.col("n_tokens") <= end, F.lit(int(value)).cast("bigint")).otherwise(chosen)
        return chosen

    shards = by_bucket(-(-held // SHARD_DOCS))
    placed = lengths.select(
        "doc_id",
        "n_tokens",
        by_bucket(range(len(ends))).cast("int").alias("bucket"),
        by_bucket(ends).alias("bucket_len"),
        "row",
        F.pmod(F.xxhash64("doc_id", "n_tokens", "row"), F.greatest(shards, F.lit(1))).alias("shard"),
    )
    order = Window.partitionBy("bucket", "shard").orderBy("doc_id", "n_tokens", "row")
    place = F.row_number().over(order) - 1
    per = F.greatest(F.lit(1), F.floor(F.lit(budget) / F.greatest(F.col("bucket_len"), F.lit(1)))).cast("bigint")
    return placed.select("*", place.alias("place"), per.alias("per")).select(
        "doc_id", "n_tokens", "bucket", "bucket_len",
        F.concat_ws("-", "bucket", "shard", F.floor(F.col("place") / F.col("per"))).alias("batch_id"),
        (F.col("place") % F.col("per")).cast("int").alias("slot"),
    )
