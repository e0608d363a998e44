"""Substring dedup through super-k-mers: repeated runs of words across documents.

A window is ``WINDOW`` consecutive words. Its minimiser is the smallest hash of
the ``SEED`` -word runs inside it; consecutive windows with the same minimiser
travel as one packed string (a super-k-mer) to the bucket of that minimiser.
Equal windows have equal minimisers, so a bucket sees every occurrence of its
windows; there they are sorted by hash and compared word by word.

Bounded tasks: a slice of text is packed once for each bucket, and of equal
super-k-mers in a slice only the first document's travels (the others are
decided there and then), so a text that a third of all documents share reaches
its buckets once per slice. Minimisers are counted first, over all documents;
the most frequent ones (at most ``MAX_FREQUENT``, a bounded broadcast) come last
in the order, so that the neighbourhoods of a passage found everywhere spread
over many buckets. What keeps a frequent minimiser meets in two steps: first in
salted groups, each of which lets the first of equal super-k-mers through, then
in the bucket. With as many salts as the root of the number of slices, neither
step holds a passage once per slice. The number of buckets follows the amount of
text.
"""

from __future__ import annotations

from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeline.llm.common import NO_ID, hand_off, hash_words, mix, ngram_hash, owners, slices, starts_that_fit, texts_of, words_of
from gaugeline.llm.packed import pack, small, unpack, word_arrays, words_from

WINDOW = 50
SEED = 5
#: Words that a bucket's windows come to, on average.
BUCKET_WORDS = 800_000
#: Text bytes that are packed together for the buckets.
PACK_BYTES = 6 << 20
#: Bytes of text that a word comes to, for the number of slices.
WORD_BYTES = 8
#: Frequent minimisers are those found in more than this many runs, and at most so many of them.
MIN_FREQUENT = 200
MAX_FREQUENT = 1 << 20
_P = "__spans_"
_BASE = np.uint64(0xD6E8FEB86659FD93)
_BACK = np.uint64(pow(int(_BASE), -1, 1 << 64))
_LAST = np.uint64(1 << 63)


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def run_hash(values: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """Hash of each run ``values[start:stop]``, from one running sum."""
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values * _powers(_BASE, len(values)))])
    return mix((total[stop] - total[start]) * _powers(_BACK, len(values) + 1)[start])


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Smallest of each ``width`` consecutive values."""
    held, size = values, 1
    while size * 2 <= width:
        held = np.minimum(held[:-size], held[size:])
        size *= 2
    rest = width - size
    return np.minimum(held[: len(held) - rest], held[rest:]) if rest else held


def super_kmers(codes, offsets, hashes, window: int, seed: int, frequent: np.ndarray):
    """Runs of windows: first word, end, minimiser. Windows never cross texts."""
    fits = np.flatnonzero(starts_that_fit(offsets, window))
    if not len(fits):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    seeds = ngram_hash(hashes[codes], seed) >> np.uint64(1)
    if len(frequent):
        at = np.minimum(np.searchsorted(frequent, seeds), len(frequent) - 1)
        seeds = np.where(frequent[at] == seeds, seeds | _LAST, seeds)
    least = sliding_min(seeds, window - seed + 1)[fits]
    new = np.ones(len(fits), bool)
    new[1:] = (fits[1:] != fits[:-1] + 1) | (least[1:] != least[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(fits)) - 1
    return fits[first], fits[last] + window, least[first]


def _ragged(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Positions of all items of runs given by start and length, run after run."""
    before = np.cumsum(length) - length
    return np.arange(int(length.sum())) + np.repeat(start - before, length)


def first_of_equal(codes: np.ndarray, start: np.ndarray, stop: np.ndarray, values: np.ndarray, order: np.ndarray) -> np.ndarray:
    """For each run, the run with the same words and the smallest ``order`` (itself if none is smaller)."""
    key = run_hash(values, start, stop) ^ (stop - start).astype(np.uint64)
    by = np.lexsort((order, key))
    head = np.ones(len(by), bool)
    head[1:] = key[by[1:]] != key[by[:-1]]
    leader = np.empty(len(by), np.int64)
    leader[by] = by[np.flatnonzero(head)[np.cumsum(head) - 1]]
    maybe = np.flatnonzero(leader != np.arange(len(by)))
    if len(maybe):  # equal hashes are only candidates
        length = (stop - start)[maybe]
        same_length = length == (stop - start)[leader[maybe]]
        leader[maybe[~same_length]] = maybe[~same_length]
        maybe, length = maybe[same_length], length[same_length]
        differ = codes[_ragged(start[maybe], length)] != codes[_ragged(start[leader[maybe]], length)]
        bad = np.add.reduceat(differ, np.cumsum(length) - length) > 0 if len(maybe) else np.zeros(0, bool)
        leader[maybe[bad]] = maybe[bad]
    return leader


def _prepared(batch: pa.RecordBatch, window: int, seed: int, frequent: np.ndarray):
    """A slice's super-k-mers, and for each the one that stands for it."""
    codes, offsets, vocab = words_of(texts_of(batch))
    hashes = hash_words(vocab)
    start, stop, least = super_kmers(codes, offsets, hashes, window, seed, frequent)
    doc = owners(offsets)[start] if len(start) else np.zeros(0, np.int64)
    order = batch.column("doc").to_numpy()[doc]
    leader = first_of_equal(codes, start, stop, hashes[codes], order)
    travels = order == order[leader] if len(start) else np.zeros(0, bool)
    return codes, offsets, vocab, start, stop, least, doc, order, travels


def repeated_windows(codes: np.ndarray, start: np.ndarray, length: np.ndarray, order: np.ndarray, window: int):
    """Of runs sorted by ``order``, the windows whose words also start in a run of smaller order.

    Returns the positions of these windows and the run of each.
    """
    count = length - window + 1
    at, run = _ragged(start, count), np.repeat(np.arange(len(start)), count)
    values = mix(codes.astype(np.uint64) + np.uint64(1))
    key = run_hash(values, at, at + window)
    by = np.argsort(key, kind="stable")
    head = np.ones(len(by), bool)
    head[1:] = key[by[1:]] != key[by[:-1]]
    leader = by[np.flatnonzero(head)[np.cumsum(head) - 1]]
    later = order[run[by]] > order[run[leader]]
    mine, its = by[later], leader[later]
    same = np.ones(len(mine), bool)
    for i in range(window):
        same &= codes[at[mine] + i] == codes[at[its] + i]
    if not same.all():  # a hash that two different windows share: compare all its windows in full
        wrong = np.unique(key[mine[~same]])
        good = [mine[same & ~np.isin(key[mine], wrong)]]
        for hashed in wrong:
            seen: dict[bytes, int] = {}
            for k in by[np.searchsorted(key[by], hashed) : np.searchsorted(key[by], hashed, "right")]:
                smallest = seen.setdefault(codes[at[k] : at[k] + window].tobytes(), order[run[k]])
                if order[run[k]] > smallest:
                    good.append(np.array([k]))
        mine = np.concatenate(good)
    mine = np.sort(mine)
    return at[mine], run[mine]


def _joined(first: np.ndarray, run: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows in order, joined to spans where they follow each other in a run: run, begin, end."""
    if not len(first):
        return run, first, first
    new = np.ones(len(first), bool)
    new[1:] = (first[1:] != first[:-1] + 1) | (run[1:] != run[:-1])
    head = np.flatnonzero(new)
    tail = np.append(head[1:], len(first)) - 1
    return run[head], first[head], first[tail] + window


def _order(doc_id: Column) -> Column:
    return F.coalesce(doc_id.cast("bigint"), F.lit(NO_ID))


_SPANS = pa.schema([("doc", pa.int64()), ("key", pa.int64()), ("begin", pa.int64()), ("end", pa.int64())])
_PIECES = pa.schema([("route", pa.int64()), ("bucket", pa.int64()), ("kind", pa.int32()), ("data", pa.binary())])
_MET = pa.schema([*_SPANS, ("bucket", pa.int64()), ("data", pa.binary()), ("kind", pa.int32())])
#: Kinds of pieces: super-k-mers, spans decided within a slice, super-k-mers of frequent minimisers.
_RUNS, _DECIDED, _FREQUENT = 0, 1, 2


class _Runs:
    """The super-k-mers of several packed pieces under one dictionary, by document."""

    def __init__(self, pieces: list[bytes]):
        parts = [unpack(x) for x in pieces]
        self.vocab, code, begins = words_from([(p[0], p[1]) for p in parts])
        self.codes = np.concatenate([code[b + p[2].astype(np.int64)] for p, b in zip(parts, begins)])
        length, order, keys, at = (np.concatenate([p[i] for p in parts]).astype(np.int64) for i in (3, 4, 5, 6))
        by = np.argsort(order, kind="stable")
        self.start = (np.cumsum(length) - length)[by]
        self.length, self.order, self.keys, self.at = length[by], order[by], keys[by], at[by]

    def repeats(self, window: int) -> list[np.ndarray]:
        """Columns of ``_SPANS``: windows that also start in a run of an earlier document."""
        first, run = repeated_windows(self.codes, self.start, self.length, self.order, window)
        run, lo, hi = _joined(first, run, window)
        shift = self.at[run] - self.start[run]
        return [self.order[run], self.keys[run], lo + shift, hi + shift]

    def thinned(self) -> tuple[list[np.ndarray], bytes]:
        """Spans of runs that an earlier document has whole, and the other runs packed again."""
        leader = first_of_equal(self.codes, self.start, self.start + self.length, mix(self.codes.astype(np.uint64) + np.uint64(1)), self.order)
        gone = self.order > self.order[leader]
        spans = [self.order[gone], self.keys[gone], self.at[gone], (self.at + self.length)[gone]]
        left = ~gone
        words, local = packed_words(self.vocab, self.codes[_ragged(self.start[left], self.length[left])])
        return spans, pack(*words, local, small(self.length[left]), self.order[left], self.keys[left], small(self.at[left]))


def packed_words(vocab: pa.Array, codes: np.ndarray) -> tuple[tuple[np.ndarray, np.ndarray], np.ndarray]:
    """The words that ``codes`` use, for ``pack``, and the codes within these."""
    used, local = np.unique(codes, return_inverse=True)
    return word_arrays(vocab.take(pa.array(used)).cast(pa.string())), small(local)


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, seed: int = SEED) -> DataFrame:
    """``doc, key, spans``: word ranges of each document that an earlier one also has.

    ``doc`` is the id (a stand-in after all others where it is null), ``key`` the
    text's hash, ``spans`` a list of ``begin, end``; spans may overlap.
    """
    spark = docs.sparkSession
    text = F.col(text_col).cast("string")
    narrow = docs.select(
        _order(F.col(id_col)).alias("doc"), F.xxhash64(F.coalesce(text, F.lit(""))).alias("key"), text.alias("text")
    )
    none = np.zeros(0, np.uint64)

    def count(batches):
        for batch in slices(batches, limit=PACK_BYTES):
            *_, start, stop, least, _, _, travels = _prepared(batch, window, seed, none)
            value, n = np.unique(least[travels], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(value.view(np.int64)), pa.array(n)], ["value", "n"])

    counted = hand_off(narrow.mapInArrow(count, "value long, n long").groupBy("value").agg(F.sum("n").alias("n")))
    runs = counted.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    per_run = (window - seed + 2) / 2  # windows of a run on average
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), int(runs * per_run / BUCKET_WORDS) + 1)
    limit = max(MIN_FREQUENT, runs // (8 * buckets), runs // MAX_FREQUENT)
    found = counted.where(F.col("n") > limit).select("value").toArrow().column("value").to_numpy()  # at most MAX_FREQUENT
    frequent = np.sort(found.view(np.uint64))
    salts = isqrt(int(runs * per_run) * WORD_BYTES // PACK_BYTES) + 1

    def cut(batches):
        for batch in slices(batches, limit=PACK_BYTES):
            codes, offsets, vocab, start, stop, least, doc, order, travels = _prepared(batch, window, seed, frequent)
            keys = batch.column("key").to_numpy()
            begin = offsets[:-1]
            done = ~travels
            out = []
            if done.any():  # decided here: an earlier document of the slice has all of it
                d = doc[done]
                to = (mix(keys[d].view(np.uint64)) % np.uint64(buckets)).astype(np.int64)
                columns = [order[done], keys[d], start[done] - begin[d], stop[done] - begin[d]]
                for b in np.unique(to):
                    out.append((b, b, _DECIDED, pack(*(c[to == b] for c in columns))))
            salt = int(mix(keys[:1].view(np.uint64))[0] % np.uint64(salts))
            own = np.flatnonzero(travels)
            hot = least[own] >= _LAST
            to = (mix(least[own]) % np.uint64(buckets)).astype(np.int64)
            by = np.lexsort((to, hot))
            own, to, hot = own[by], to[by], hot[by]
            edges = np.concatenate([[0], np.flatnonzero((to[1:] != to[:-1]) | (hot[1:] != hot[:-1])) + 1, [len(to)]])
            for lo, hi in zip(edges[:-1], edges[1:]):
                if lo == hi:
                    continue
                r, bucket = own[lo:hi], int(to[lo])
                length = stop[r] - start[r]
                words, local = packed_words(vocab, codes[_ragged(start[r], length)])
                data = pack(*words, local, small(length), order[r], keys[doc[r]], small(start[r] - begin[doc[r]]))
                out.append((buckets + bucket * salts + salt, bucket, _FREQUENT, data) if hot[lo] else (bucket, bucket, _RUNS, data))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), _PIECES)], schema=_PIECES)

    def meet(table):
        """One route: the spans of a bucket's runs, or of frequent runs the spans found so far and what is left."""
        kinds, data = table.column("kind").to_numpy(), table.column("data").to_pylist()
        of = lambda kind: [data[i] for i in np.flatnonzero(kinds == kind)]
        made = [[c.astype(np.int64) for c in unpack(x)] for x in of(_DECIDED)]
        left = None
        if runs := of(_RUNS):
            made.append(_Runs(runs).repeats(window))
        if runs := of(_FREQUENT):
            spans, left = _Runs(runs).thinned()
            made.append(spans)
        columns = [np.concatenate(c) for c in zip(*made)]
        n = len(columns[0])
        found = [*(pa.array(c) for c in columns), pa.nulls(n, pa.int64()), pa.nulls(n, pa.binary()), pa.array(np.full(n, _DECIDED, np.int32))]
        met = pa.Table.from_arrays(found, schema=_MET)
        if left is None:
            return met
        row = [*(pa.nulls(1, pa.int64()) for _ in _SPANS), table.column("bucket").combine_chunks()[:1], pa.array([left], pa.binary()), pa.array([_FREQUENT], pa.int32())]
        return pa.concat_tables([met, pa.Table.from_arrays(row, schema=_MET)])

    def last(table):
        columns = _Runs(table.column("data").to_pylist()).repeats(window)
        return pa.Table.from_arrays([pa.array(c) for c in columns], schema=_SPANS)

    pieces = narrow.mapInArrow(cut, "route long, bucket long, kind int, data binary")
    spans = "doc long, key long, begin long, end long"
    met = hand_off(pieces.groupBy("route").applyInArrow(meet, spans + ", bucket long, data binary, kind int"), "kind")
    rest = met.where(F.col("kind") == _FREQUENT).select("bucket", "data").groupBy("bucket").applyInArrow(last, spans)
    decided = met.where(F.col("kind") == _DECIDED).select("doc", "key", "begin", "end")
    spans = decided.union(hand_off(rest))
    return spans.groupBy("doc", "key").agg(F.collect_list(F.struct("begin", "end")).alias("spans"))


def remove_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, joined: bool = False, prefix: str = "",
    seed: int = SEED,
) -> DataFrame:
    """``docs`` with repeated words cut out of ``text``, and ``n_words``, ``n_removed`` (after ``prefix``) beside it.

    A word goes if a window that covers it also starts in a document with a
    smaller id. Documents without an id come last and, like rows of one id, take
    nothing from each other. Null texts stay null, with 0 words. White space
    beside a cut is taken with the words before it; texts without a cut stay as
    they are, or, with ``joined``, all remaining words are joined by one space.
    Columns of the table with the names of the two counts are replaced.
    """
    counts = [prefix + "n_words", prefix + "n_removed"]
    rest = docs.drop(*counts)
    spans = repeated_spans(docs, id_col, text_col, window, seed)
    spans = spans.select(F.col("doc").alias(_P + "doc"), F.col("key").alias(_P + "key"), F.col("spans").alias(_P + "at"))
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    same = (_order(F.col(id_col)) == F.col(_P + "doc")) & (F.xxhash64(text) == F.col(_P + "key"))
    # A sort-merge join at every size, as in line dedup.
    both = rest.join(spans.hint("merge"), same, "left").drop(_P + "doc", _P + "key")
    schema = T.StructType([*rest.schema.fields, *(T.StructField(c, T.LongType()) for c in counts)])
    names = rest.columns

    def cut(batches):
        import re

        word = re.compile(rb"[^\x20\x09-\x0D]+[\x20\x09-\x0D]*")
        for batch in slices(batches, text_col):
            texts = batch.column(text_col).to_pylist()
            total, gone = np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64)
            for k, (t, at) in enumerate(zip(texts, batch.column(_P + "at").to_pylist())):
                if t is None:
                    continue
                data = t.encode("utf-8", "surrogatepass")
                words = data.split()
                total[k] = len(words)
                if at:
                    edge = np.zeros(len(words) + 1, np.int64)
                    np.add.at(edge, [s["begin"] for s in at], 1)
                    np.add.at(edge, [s["end"] for s in at], -1)
                    kept = np.cumsum(edge)[:-1] == 0
                    gone[k] = len(words) - kept.sum()
                    if joined:
                        words = [w for w, keep in zip(words, kept) if keep]
                    else:
                        bare = data.lstrip(b"\x20\x09\x0a\x0b\x0c\x0d")
                        parts = [w for w, keep in zip(word.findall(bare), kept) if keep]
                        texts[k] = (data[: len(data) - len(bare)] + b"".join(parts)).decode("utf-8", "surrogatepass")
                if joined:
                    texts[k] = b" ".join(words).decode("utf-8", "surrogatepass")
            made = batch.set_column(batch.schema.names.index(text_col), text_col, pa.array(texts, pa.string())).select(names)
            yield pa.RecordBatch.from_arrays([*made.columns, pa.array(total), pa.array(gone)], [*names, *counts])

    return both.mapInArrow(cut, schema)
