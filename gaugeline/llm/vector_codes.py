"""Vector compression: one small codebook per part of the vector, by Lloyd rounds that skip unmoved entries.

Vectors become integers, so distances and means are exact. A round assigns every
part of every vector and sums the parts of each entry. The state (integers,
assigned entries and their distances) is written once a round, without a
shuffle, and the sums of a task travel in a column of the same write, so the
vectors are read once a round. A part whose entry did not move since its distance was
stored is still closer to it than to any other unmoved entry (or as close, with
the lower index), so only moved entries are compared with it; all other parts
look at the whole codebook.

The driver holds the codebooks: ``PARTS * entries`` short integer rows, whatever
the number of vectors.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeline.llm.common import hand_off, rows

PARTS = 16
ENTRIES = 64
ROUNDS = 2
SCALE = 256
#: Integer components are held to this range, so that no distance leaves 64 bits.
LIMIT = 1 << 27
#: Vectors that are compared with a codebook at a time.
_BLOCK = 4_096

_STATE = "vec_id bigint, label bigint, vector binary, codes binary, distances binary, sums array<bigint>"


def integers(values: np.ndarray) -> np.ndarray:
    """floor(SCALE * x), within ``LIMIT``."""
    return np.clip(np.floor(values.astype(np.float64) * SCALE), -LIMIT, LIMIT).astype(np.int32)


def distances(parts: np.ndarray, book: np.ndarray) -> np.ndarray:
    """Squared Euclidean distance of each row to each entry, exact."""
    out = np.zeros((len(parts), len(book)), np.int64)
    for k in range(parts.shape[1]):
        step = parts[:, k : k + 1].astype(np.int64) - book[:, k].astype(np.int64)
        out += step * step
    return out


def nearest(parts: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest entry of each row, ties to the lower index, and its distance."""
    every = distances(parts, book)
    best = every.argmin(axis=1)
    return best.astype(np.uint8), every[np.arange(len(parts)), best]


def reassigned(parts, book, moved, codes, stored) -> tuple[np.ndarray, np.ndarray]:
    """As ``nearest``, from the entries and distances of the last round; ``moved`` marks changed entries."""
    codes, stored = codes.copy(), stored.copy()
    stale = moved[codes]
    if stale.any():
        codes[stale], stored[stale] = nearest(parts[stale], book)
    fixed, active = np.flatnonzero(~stale), np.flatnonzero(moved)
    if len(fixed) and len(active):
        other, away = nearest(parts[fixed], book[active])
        other = active[other].astype(np.uint8)
        closer = (away < stored[fixed]) | ((away == stored[fixed]) & (other < codes[fixed]))
        codes[fixed[closer]], stored[fixed[closer]] = other[closer], away[closer]
    return codes, stored


def _matrix(column: pa.Array, dtype, width: int) -> np.ndarray:
    """A binary column of equally long values as one row of numbers each."""
    joined = b"".join(column.to_pylist())
    return np.frombuffer(joined, dtype).reshape(len(column), width)


def _binaries(matrix: np.ndarray) -> pa.Array:
    width, data = matrix.shape[1] * matrix.itemsize, np.ascontiguousarray(matrix).tobytes()
    return pa.array([data[i : i + width] for i in range(0, len(data), width)], pa.binary())


def _assign(batches: Iterator[pa.RecordBatch], books: np.ndarray, moved: np.ndarray | None, last: bool) -> Iterator[pa.RecordBatch]:
    """Assign the parts of all rows; unless it is the last time, a closing row has the sums of each entry."""
    parts, entries, width = books.shape
    schema = pa.schema(
        [("vec_id", pa.int64()), ("label", pa.int64()), ("code", pa.string()), ("error", pa.int64())]
        if last
        else [("vec_id", pa.int64()), ("label", pa.int64()), ("vector", pa.binary()), ("codes", pa.binary()), ("distances", pa.binary()), ("sums", pa.list_(pa.int64()))]
    )
    sums = np.zeros((parts, entries, width + 1), np.int64)
    seen = 0
    for batch in batches:
        for start in range(0, batch.num_rows, _BLOCK):
            block = batch.slice(start, _BLOCK)
            count = block.num_rows
            if moved is None:
                flat = block.column("embedding").flatten().to_numpy(zero_copy_only=False)
                whole = integers(flat).reshape(count, parts * width)
                codes, stored = np.zeros((count, parts), np.uint8), np.zeros((count, parts), np.int64)
            else:
                whole = _matrix(block.column("vector"), np.int32, parts * width)
                codes = _matrix(block.column("codes"), np.uint8, parts).copy()
                stored = _matrix(block.column("distances"), np.int64, parts).copy()
            for p in range(parts):
                part = whole[:, p * width : (p + 1) * width]
                if moved is None:
                    codes[:, p], stored[:, p] = nearest(part, books[p])
                else:
                    codes[:, p], stored[:, p] = reassigned(part, books[p], moved[p], codes[:, p], stored[:, p])
                if not last:
                    sums[p, :, 0] += np.bincount(codes[:, p], minlength=entries)
                    for k in range(width):
                        np.add.at(sums[p, :, k + 1], codes[:, p], part[:, k])
            seen += count
            if last:
                marks = codes.tobytes().hex()
                code = [marks[i : i + 2 * parts] for i in range(0, len(marks), 2 * parts)]
                yield rows(schema, vec_id=block.column("vec_id"), label=block.column("label"), code=code, error=stored.sum(axis=1))
            else:
                nothing = pa.nulls(count, pa.list_(pa.int64()))
                yield rows(
                    schema, vec_id=block.column("vec_id"), label=block.column("label"), vector=_binaries(whole),
                    codes=_binaries(codes), distances=_binaries(stored), sums=nothing,
                )
    if seen and not last:
        yield rows(schema, vec_id=[None], label=[None], vector=[None], codes=[None], distances=[None], sums=[sums.ravel().tolist()])


def _means(state: DataFrame, books: np.ndarray) -> np.ndarray:
    """Each entry as floor(sum / count) of its parts; unused entries as they were."""
    parts, entries, width = books.shape
    cells = state.filter(F.col("sums").isNotNull()).select(F.posexplode("sums").alias("at", "amount"))
    total = np.zeros(parts * entries * (width + 1), object)
    # One row per component of the codebooks, whatever the number of vectors.
    for r in cells.groupBy("at").agg(F.sum(F.col("amount").cast("decimal(38,0)")).alias("amount")).collect():
        total[r["at"]] = int(r["amount"])
    total = total.reshape(parts, entries, width + 1)
    new = books.copy()
    for p, e in zip(*np.nonzero(total[:, :, 0])):
        new[p, e] = [int(v) // int(total[p, e, 0]) for v in total[p, e, 1:]]
    return new


def usable(vectors: DataFrame, parts: int = PARTS) -> Column:
    """Rows that are coded: no null or non-finite component, and a length that ``parts`` divides."""
    x = F.col("embedding")
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == F.lit(float("inf"))))
    return x.isNotNull() & (F.size(x) > 0) & (F.size(x) % parts == 0) & ~bad


def compress(
    embeddings: DataFrame, id_col: str = "vec_id", vector: str = "embedding", label: str = "label",
    parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS,
) -> tuple[DataFrame, np.ndarray]:
    """``vec_id, label, code, error`` of every usable row, and the final codebooks (part, entry, component).

    Rows that are left out: see ``usable``; and vectors not as long as the one
    of the smallest id. Repeated rows are coded each; among equal ids the
    vector that sorts first counts first; null ids come last. Components beyond
    ``LIMIT / SCALE`` count as that. With fewer rows than ``entries``, codebooks
    are as short. Other columns are not read; an empty table gives no rows.
    """
    if not 0 < entries <= 256:
        raise ValueError("a code has two hex digits: 1 to 256 entries")
    kept = embeddings.select(
        F.col(id_col).cast("bigint").alias("vec_id"), F.col(vector).cast("array<float>").alias("embedding"), F.col(label).cast("bigint").alias("label")
    )
    kept = kept.filter(usable(kept, parts))
    order = [F.col("vec_id").asc_nulls_last(), F.col("embedding")]
    first = kept.orderBy(*order).limit(entries).collect()
    if first and any(len(r["embedding"]) != len(first[0]["embedding"]) for r in first):
        kept = kept.filter(F.size("embedding") == len(first[0]["embedding"]))
        first = kept.orderBy(*order).limit(entries).collect()
    if not first:
        return embeddings.sparkSession.createDataFrame([], "vec_id bigint, label bigint, code string, error bigint"), np.zeros((parts, 0, 0), np.int64)
    size = len(first[0]["embedding"])
    start = integers(np.array([r["embedding"] for r in first], np.float32))
    books = start.reshape(len(first), parts, size // parts).transpose(1, 0, 2).astype(np.int64)
    state, moved = kept.filter(F.size("embedding") == size), None
    for _ in range(rounds):
        state = hand_off(state.mapInArrow(lambda b, k=books, m=moved: _assign(b, k, m, False), _STATE))
        new = _means(state, books)
        moved, books = (new != books).any(axis=2), new
        state = state.filter(F.col("vector").isNotNull()).drop("sums")
    out = state.mapInArrow(lambda b, k=books, m=moved: _assign(b, k, m, True), "vec_id bigint, label bigint, code string, error bigint")
    return hand_off(out), books


def digest(books: np.ndarray) -> str:
    """sha256 of all components by part, entry and position, joined by commas."""
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def with_label_error(codes: DataFrame) -> DataFrame:
    """``codes`` with ``label_error``: the error summed over equal labels, nulls together.

    The sums, one row per label, are joined back; Spark broadcasts them only
    where they are few, and splits a label that holds many rows.
    """
    total = codes.groupBy(F.col("label").alias("__label")).agg(F.sum("error").alias("label_error"))
    return codes.join(total, F.col("label").eqNullSafe(F.col("__label"))).drop("__label")
