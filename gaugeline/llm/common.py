"""Shared helpers: written hand-offs, slices of Arrow batches, words and hashes in NumPy.

All helpers work on one Arrow batch at a time; none keeps state between batches.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeline.session import scratch_dir

#: Text bytes that one slice of a batch holds at most (a longer text is a slice of its own).
SLICE_BYTES = 4 << 20
#: Order key of documents without an id: after all others.
NO_ID = (1 << 63) - 1

_ODD = np.uint64(0x9E3779B97F4A7C15)
_MIX1 = np.uint64(0xBF58476D1CE4E5B9)
_MIX2 = np.uint64(0x94D049BB133111EB)


def hand_off(df: DataFrame, partition_by: str | None = None) -> DataFrame:
    """Write ``df`` below the shared checkpoint folder and read it back: lineage ends here."""
    path = scratch_dir(df.sparkSession)
    writer = df.write.option("compression", "zstd")
    (writer.partitionBy(partition_by) if partition_by else writer).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def crc_of(doc_id: Column, buckets: int) -> Column:
    """crc32 of the id as text, modulo ``buckets``; a null id is hashed as the empty text."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))), F.lit(buckets))


def slices(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = SLICE_BYTES):
    """Cut batches so that the texts of a slice hold about ``limit`` bytes; no row is left out."""
    for batch in batches:
        size = pc.fill_null(pc.binary_length(batch.column(column)), 0)
        ends = np.cumsum(size.to_numpy(zero_copy_only=False), dtype=np.int64)
        start = 0
        while start < len(ends):
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + limit, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


def texts_of(batch: pa.RecordBatch, column: str = "text") -> pa.Array:
    return pc.fill_null(batch.column(column), "")


def words_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Words ``[^\\x20\\x09-\\x0D]+`` as codes, the texts' offsets into them, and the distinct words."""
    lists = pc.ascii_split_whitespace(pc.ascii_trim_whitespace(texts))
    flat, offsets = lists.flatten(), lists.offsets.to_numpy().astype(np.int64)
    filled = pc.greater(pc.binary_length(flat), 0)
    if not pc.all(filled, min_count=0).as_py():  # an empty text splits into one empty word
        offsets = np.concatenate([[0], np.cumsum(filled.to_numpy(zero_copy_only=False))])[offsets]
        flat = flat.filter(filled)
    coded = flat.dictionary_encode()
    return coded.indices.to_numpy().astype(np.int64), offsets, coded.dictionary


def owners(offsets: np.ndarray) -> np.ndarray:
    """For each item, the position of the text it belongs to."""
    return np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))


def sum_by(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sums over each text's items; 0 for a text without any."""
    total = np.concatenate([np.zeros(1, values.dtype), np.cumsum(values)])
    return total[offsets[1:]] - total[offsets[:-1]]


def hash_words(vocab: pa.Array) -> np.ndarray:
    """A fixed 64-bit hash of each word, the same in every process."""
    return pd.util.hash_array(
        vocab.to_numpy(zero_copy_only=False).astype(object), categorize=False
    ).astype(np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values evenly (an invertible finaliser)."""
    x = x ^ (x >> np.uint64(30))
    x = x * _MIX1
    x = x ^ (x >> np.uint64(27))
    x = x * _MIX2
    return x ^ (x >> np.uint64(31))


def ngram_hash(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of each run of ``n`` consecutive values; one entry for each start that fits."""
    count = max(0, len(hashes) - n + 1)
    out = np.full(count, _ODD, np.uint64)
    for i in range(n):
        out = mix(out * _ODD + hashes[i : i + count])
    return out


def starts_that_fit(offsets: np.ndarray, n: int) -> np.ndarray:
    """Mask over starts 0..len-n: those whose run of ``n`` stays inside one text."""
    total = int(offsets[-1])
    left = np.repeat(offsets[1:], np.diff(offsets)) - np.arange(total)
    return left[: max(0, total - n + 1)] >= n


def rows(schema: pa.Schema, **columns) -> pa.RecordBatch:
    """A batch of ``schema`` from NumPy or Arrow columns."""
    return pa.RecordBatch.from_arrays(
        [
            c if isinstance(c, pa.Array) else pa.array(c, type=f.type)
            for f, c in ((f, columns[f.name]) for f in schema)
        ],
        schema=schema,
    )
