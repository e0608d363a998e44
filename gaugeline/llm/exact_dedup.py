"""Exact deduplication through a cuckoo-filter index of live digests.

The index is a table with one row per shard of the digest space: a cuckoo
filter of 16-bit fingerprints (four to a bucket) and, beside it, the shard's
bucketed content, the full 256-bit digests with what is stored of each. A
digest that the filter does not hold is new without a look at the content; a
hit is verified against the stored digests of its shard, so a false hit never
makes a duplicate. A live digest can be deleted: its fingerprint leaves the
filter, its content leaves the shard. A filter that overflows is doubled and
filled again from the stored digests. Shards are chosen from the number of
digests, so one task holds about ``SHARD_KEYS`` of them at any size.

Documents reach the index as one row per digest and batch of a map task, so a
text that a third of all documents share is a few rows of each task there. In
the shard the first of them is new, and each further one meets a live digest:
the filter, the verification and the update of its group decide which document
stays. Documents then read their group back through the filter. Text is never shuffled.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeline.llm.common import NO_ID, hand_off, mix, rows

#: Digests that a shard holds on average, at most.
SHARD_KEYS = 100_000
SLOTS = 4
_LOAD = 0.9
_ROUNDS = 500
_WHITE = "\x20\x09\x0a\x0b\x0c\x0d"

INDEX_SCHEMA = "shard int, buckets long, filter binary, digests binary, keep_id array<long>, keep_len array<long>, group_size array<long>"
_INDEX = pa.schema(
    [
        ("shard", pa.int32()), ("buckets", pa.int64()), ("filter", pa.binary()), ("digests", pa.binary()),
        ("keep_id", pa.list_(pa.int64())), ("keep_len", pa.list_(pa.int64())), ("group_size", pa.list_(pa.int64())),
    ]
)


# -- the filter -------------------------------------------------------------


def _places(digests: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """First bucket and fingerprint (never 0) of digests given as ``S32`` bytes."""
    words = digests.view(np.uint64).reshape(len(digests), 4)
    first = mix(words[:, 1]) & np.uint64(buckets - 1)
    mark = (words[:, 2] % np.uint64(65535) + np.uint64(1)).astype(np.uint16)
    return first.astype(np.int64), mark


def _other(bucket: np.ndarray, mark: np.ndarray, buckets: int) -> np.ndarray:
    """The second bucket of a fingerprint; of the second, the first."""
    return (bucket.astype(np.uint64) ^ mix(mark.astype(np.uint64))).astype(np.int64) & (buckets - 1)


class CuckooFilter:
    """Fingerprints in buckets of four slots; whole batches at a time."""

    def __init__(self, buckets: int, table: np.ndarray | None = None):
        self.buckets = buckets
        self.table = np.zeros((buckets, SLOTS), np.uint16) if table is None else table

    @staticmethod
    def of(digests: np.ndarray) -> CuckooFilter:
        """A filter that holds ``digests``, doubled until none overflows."""
        buckets = 1
        while buckets * SLOTS * _LOAD < len(digests):
            buckets *= 2
        while True:
            made = CuckooFilter(buckets)
            if made.insert(digests):
                return made
            buckets *= 2

    def contains(self, digests: np.ndarray) -> np.ndarray:
        at, mark = _places(digests, self.buckets)
        there = (self.table[at] == mark[:, None]).any(axis=1)
        return there | (self.table[_other(at, mark, self.buckets)] == mark[:, None]).any(axis=1)

    def _place(self, at: np.ndarray, mark: np.ndarray) -> np.ndarray:
        """Put fingerprints into free slots of their buckets; which of them found none."""
        order = np.argsort(at, kind="stable")
        at, mark = at[order], mark[order]
        rank = np.arange(len(at)) - np.searchsorted(at, at)
        free = self.table[at] == 0
        nth = np.cumsum(free, axis=1) == (rank + 1)[:, None]
        fits = (free & nth).any(axis=1)
        slot = (free & nth).argmax(axis=1)
        self.table[at[fits], slot[fits]] = mark[fits]
        left = np.zeros(len(order), bool)
        left[order] = ~fits
        return left

    def insert(self, digests: np.ndarray) -> bool:
        """Add all; False if some found no place, and the filter must then be made larger."""
        at, mark = _places(digests, self.buckets)
        left = self._place(at, mark)
        at, mark = at[left], mark[left]
        for turn in range(_ROUNDS):
            if not len(at):
                return True
            at = _other(at, mark, self.buckets)
            left = self._place(at, mark)
            at, mark = at[left], mark[left]
            # One item takes a slot of each full bucket; what it held moves to its other bucket.
            bucket, chosen = np.unique(at, return_index=True)
            slot = turn % SLOTS
            mark[chosen], self.table[bucket, slot] = self.table[bucket, slot], mark[chosen]
        return not len(at)

    def delete(self, digests: np.ndarray) -> None:
        """Take out one fingerprint of each digest; all of them must be held."""
        at, mark = _places(digests, self.buckets)
        left = self._clear(at, mark)
        self._clear(_other(at, mark, self.buckets)[left], mark[left])

    def _clear(self, at: np.ndarray, mark: np.ndarray) -> np.ndarray:
        """Empty one slot with the fingerprint in each bucket; which of them found none."""
        key = at * np.int64(1 << 16) + mark
        order = np.argsort(key, kind="stable")
        at, mark, key = at[order], mark[order], key[order]
        rank = np.arange(len(key)) - np.searchsorted(key, key)
        same = self.table[at] == mark[:, None]
        chosen = same & (np.cumsum(same, axis=1) == (rank + 1)[:, None])
        found = chosen.any(axis=1)
        self.table[at[found], chosen.argmax(axis=1)[found]] = 0
        left = np.zeros(len(order), bool)
        left[order] = ~found
        return left


# -- one shard --------------------------------------------------------------


class _Shard:
    """The filter of a shard and its content: sorted digests with what is stored of each."""

    def __init__(self, digests: np.ndarray, values: np.ndarray, made: CuckooFilter):
        self.digests, self.values, self.filter = digests, values, made

    @staticmethod
    def read(table: pa.Table) -> _Shard:
        if not table.num_rows:
            return _Shard(np.zeros(0, "S32"), np.zeros((3, 0), np.int64), CuckooFilter(1))
        row = {n: table.column(n)[0].as_py() for n in table.column_names}
        held = np.frombuffer(row["filter"], np.uint16).reshape(-1, SLOTS).copy()
        values = np.array([row["keep_id"], row["keep_len"], row["group_size"]], np.int64)
        return _Shard(np.frombuffer(row["digests"], "S32"), values, CuckooFilter(row["buckets"], held))

    def row(self, shard: int) -> pa.RecordBatch:
        return rows(
            _INDEX, shard=[shard], buckets=[self.filter.buckets], filter=[self.filter.table.tobytes()],
            digests=[self.digests.tobytes()], keep_id=[self.values[0]], keep_len=[self.values[1]],
            group_size=[self.values[2]],
        )

    def _find(self, digests: np.ndarray) -> np.ndarray:
        """Where each digest is stored, -1 if it is not: the filter first, then the content."""
        found = np.full(len(digests), -1)
        hit = np.flatnonzero(self.filter.contains(digests))
        if len(hit) and len(self.digests):
            at = np.minimum(np.searchsorted(self.digests, digests[hit]), len(self.digests) - 1)
            real = self.digests[at] == digests[hit]
            found[hit[real]] = at[real]
        return found

    def insert(self, digests: np.ndarray, values: np.ndarray) -> None:
        """Add groups; of a digest that comes several times, each further row meets the one before it."""
        order = np.argsort(digests, kind="stable")
        ranked = digests[order]
        turn = np.arange(len(order)) - np.searchsorted(ranked, ranked)
        by = order[np.argsort(turn, kind="stable")]
        ends = np.cumsum(np.bincount(turn)) if len(turn) else []
        for start, end in zip([0, *ends[:-1]], ends):
            self._insert_distinct(digests[by[start:end]], values[:, by[start:end]])

    def _insert_distinct(self, digests: np.ndarray, values: np.ndarray) -> None:
        found = self._find(digests)
        old = np.flatnonzero(found >= 0)
        if len(old):
            at = found[old]
            mine, its = self.values[:, at], values[:, old]
            better = (its[1] > mine[1]) | ((its[1] == mine[1]) & (its[0] < mine[0]))
            mine[:2] = np.where(better, its[:2], mine[:2])
            mine[2] += its[2]
            self.values[:, at] = mine
        new = np.flatnonzero(found < 0)
        if not len(new):
            return
        added = digests[new]
        every = np.concatenate([self.digests, added])
        order = np.argsort(every)
        self.digests = every[order]
        self.values = np.concatenate([self.values, values[:, new]], axis=1)[:, order]
        if len(every) > self.filter.buckets * SLOTS * _LOAD or not self.filter.insert(added):
            self.filter = CuckooFilter.of(self.digests)

    def delete(self, digests: np.ndarray) -> None:
        found = np.unique(self._find(digests))
        found = found[found >= 0]
        self.filter.delete(self.digests[found])
        self.digests = np.delete(self.digests, found)
        self.values = np.delete(self.values, found, axis=1)


def _digests(table: pa.Table) -> np.ndarray:
    """The ``digest`` column as one ``S32`` array, nul bytes at the end kept."""
    held = table.column("digest").combine_chunks()
    return np.frombuffer(b"".join(held.to_pylist()), "S32")


# -- the index --------------------------------------------------------------


def normalised(text: Column) -> Column:
    """The text without characters ``[\\x20\\x09-\\x0D]``; null counts as empty."""
    return F.translate(F.coalesce(text, F.lit("")), _WHITE, "")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_points, digest`` of every row: SHA-256 of the normalised text in UTF-8."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"),
        F.char_length(text).cast("bigint").alias("n_points"),
        F.unhex(F.sha2(normalised(text), 256)).alias("digest"),
    )


_GROUP = "digest binary, keep_id long, keep_len long, group_size long"
_GROUP_ARROW = pa.schema([("digest", pa.binary()), ("keep_id", pa.int64()), ("keep_len", pa.int64()), ("group_size", pa.int64())])


def _digest_list(digests: np.ndarray) -> list[bytes]:
    data = digests.tobytes()
    return [data[i : i + 32] for i in range(0, len(data), 32)]


def map_groups(marks: DataFrame) -> DataFrame:
    """``digest, keep_id, keep_len, group_size``: one row per digest and batch of a map task.

    The document that stays is the one with the most code points, then the
    smallest id; a null id comes after all others. Nothing is shuffled.
    """

    def gather(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            digests = np.frombuffer(b"".join(batch.column("digest").to_pylist()), "S32")
            ids = batch.column("doc_id").fill_null(NO_ID).to_numpy()
            points = batch.column("n_points").to_numpy()
            by = np.lexsort((ids, -points, digests))
            ranked = digests[by]
            head = np.flatnonzero(np.append(True, ranked[1:] != ranked[:-1]))
            best = by[head]
            yield rows(
                _GROUP_ARROW, digest=_digest_list(digests[best]), keep_id=pa.array(ids[best], mask=ids[best] == NO_ID),
                keep_len=points[best], group_size=np.diff(np.append(head, len(by))),
            )

    return marks.select("doc_id", "n_points", "digest").mapInArrow(gather, _GROUP)


class CuckooIndex:
    """Live digests in shards; every change gives a new index written to shared storage.

    ``entries()`` has one row per live digest. An empty table gives an index
    without rows. ``keep_id`` is null for a group whose documents have no id.
    """

    def __init__(self, table: DataFrame, shards: int):
        self.table, self.shards = table, shards

    @staticmethod
    def create(spark, expected: int) -> CuckooIndex:
        return CuckooIndex(spark.createDataFrame([], INDEX_SCHEMA), max(1, -(-expected // SHARD_KEYS)))

    def _shard(self) -> Column:
        return F.pmod(F.xxhash64("digest"), F.lit(self.shards)).cast("int").alias("shard")

    def _changed(self, batch: DataFrame, delete: bool) -> CuckooIndex:
        def apply(key, held, new):
            shard = _Shard.read(held)
            if new.num_rows:
                given = _digests(new)
                if delete:
                    shard.delete(given)
                else:
                    values = [
                        new.column(c).combine_chunks().fill_null(NO_ID).to_numpy()
                        for c in ("keep_id", "keep_len", "group_size")
                    ]
                    shard.insert(given, np.array(values, np.int64))
            return pa.Table.from_batches([shard.row(key[0].as_py())])

        sharded = batch.select("*", self._shard())
        table = self.table.groupBy("shard").cogroup(sharded.groupBy("shard")).applyInArrow(apply, INDEX_SCHEMA)
        return CuckooIndex(hand_off(table), self.shards)

    def insert(self, groups: DataFrame) -> CuckooIndex:
        """Add groups (see ``map_groups``; a digest may come in several rows); known digests' groups grow."""
        return self._changed(groups, delete=False)

    def delete(self, digests: DataFrame) -> CuckooIndex:
        """Take the digests out of the index; those that are not live change nothing."""
        return self._changed(digests.select("digest").distinct(), delete=True)

    def resized(self, expected: int) -> CuckooIndex:
        """The same entries dealt to as many shards as ``expected`` digests need."""
        return CuckooIndex.create(self.table.sparkSession, expected).insert(self.entries())

    def groups_of(self, marks: DataFrame) -> DataFrame:
        """The groups of the digests in ``marks`` that are live: through the filter, then the content.

        A map task asks for a digest once per batch, and a shard answers once.
        """

        def ask(batches):
            for batch in batches:
                yield rows(asked, digest=batch.column("digest").unique())

        def answer(key, held, new):
            if not held.num_rows or not new.num_rows:
                return _GROUP_ARROW.empty_table()
            shard, given = _Shard.read(held), np.unique(_digests(new))
            at = shard._find(given)
            given, at = given[at >= 0], at[at >= 0]
            keep = shard.values[0, at]
            row = rows(
                _GROUP_ARROW, digest=_digest_list(given), keep_id=pa.array(keep, mask=keep == NO_ID),
                keep_len=shard.values[1, at], group_size=shard.values[2, at],
            )
            return pa.Table.from_batches([row])

        asked = pa.schema([("digest", pa.binary())])
        wanted = marks.select("digest").mapInArrow(ask, "digest binary").select("*", self._shard())
        return self.table.groupBy("shard").cogroup(wanted.groupBy("shard")).applyInArrow(answer, _GROUP)

    def lookup(self, marks: DataFrame) -> DataFrame:
        """Rows of ``marks`` whose digest is live."""
        return marks.join(self.groups_of(marks), "digest", "left_semi")

    def entries(self) -> DataFrame:
        def unpack(batches):
            for batch in batches:
                for i in range(batch.num_rows):
                    shard = _Shard.read(pa.Table.from_batches([batch.slice(i, 1)]))
                    keep = pa.array(shard.values[0], mask=shard.values[0] == NO_ID)
                    yield rows(
                        _GROUP_ARROW, digest=_digest_list(shard.digests), keep_id=keep, keep_len=shard.values[1],
                        group_size=shard.values[2],
                    )

        return self.table.mapInArrow(unpack, _GROUP)


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document, dropped ones too: which document of its group stays.

    Nulls in other columns and further columns do not matter. A null text is an
    empty one. Rows with the same id and text are alike: all of them are kept if
    one is. A null ``doc_id`` is never chosen while its group has another id.
    """
    marks = hand_off(fingerprints(docs, id_col, text_col))
    index = CuckooIndex.create(docs.sparkSession, marks.count()).insert(map_groups(marks))
    # A hot digest makes one side of this join large; adaptive execution splits that side.
    return marks.join(index.groups_of(marks), "digest").select(
        "doc_id",
        "keep_id",
        "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )
