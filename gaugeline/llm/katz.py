"""Katz backoff: bigrams with Good-Turing discounts and exactly normalised backoff weights.

    P(w | v) = D(c(v, w)) / c(v)      if the pair was seen
             = alpha(v) P(w)          else, if v was seen
             = P(w)                   else
    P(w)     = D(c(w)) / N            for known words; the rest is the one unknown word's

``D`` is the Good-Turing discount for counts up to ``K`` and ``count - HIGH`` above,
so every context keeps some mass. ``alpha(v)`` makes the sum over all words,
the unknown one included, exactly 1. A text begins in the context ``START`` and
ends with the word ``END``.

The tables are partitioned by hash: ``unigrams`` (word, count), ``bigrams`` by
word, ``contexts`` (word, count, log10 of alpha). Evaluation joins each token
with them without moving a row per token and table:

1. Words of each slice are counted, then summed by bucket: ``unigrams``, N, V.
2. All pairs (v, w) of a slice travel packed, with the places of their texts, to
   the bucket of w. A bucket knows c(w) and c(v, w) of its pairs. It returns
   per text what depends on them, the ``bigrams``, and the unseen pairs.
3. ``bigrams`` summed by context give ``contexts``.
4. Unseen pairs look up alpha(v); sums per text meet by block of texts.

Hot keys: words among the most frequent (at most ``MAX_FREQUENT``, a bounded
broadcast with their counts) are dealt to buckets by pair; hot pairs do not
travel at all, their counts are summed apart and applied to each block's list.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeline.llm.common import hand_off, hash_words, mix, owners, slices, texts_of, words_of
from gaugeline.llm.packed import pack, small, unpack, word_arrays, words_from

END, START = "\n", " "  # neither can be a word
K, HIGH = 5, 0.5
#: Tokens of a bucket, on average.
BUCKET_TOKENS = 2_500_000
PACK_BYTES = 5 << 20
MAX_FREQUENT = 1 << 16
MIN_FREQUENT = 64

_PART = "bucket long, kind int, block long, data binary"
_PART_ARROW = pa.schema([("bucket", pa.int64()), ("kind", pa.int32()), ("block", pa.int64()), ("data", pa.binary())])
#: Kinds of parts: pairs, texts of a block, hot counts, sums per text, bigrams, counts of counts, unseen
#: pairs by context and by block (those of frequent contexts), contexts, and what unseen pairs add to texts.
PAIRS, TEXTS, HOT, SUMS, BIGRAMS, COUNTS, UNSEEN, LATER, CONTEXTS, ADDED = range(10)


def discounts(counts_of_counts: list[int]) -> np.ndarray:
    """``D(1)..D(K)`` from how many types were seen 1..K+1 times.

    Katz's form with the largest cut-off up to ``K`` that gives values in
    (0, r); counts between the cut-off and ``K``, and all of them if there is no
    such cut-off, lose ``HIGH`` like higher ones.
    """
    n = [0, *counts_of_counts]
    out = np.arange(1, K + 1) - HIGH
    for k in range(K, 1, -1):
        if min(n[1 : k + 2]) <= 0:
            continue
        rest = (k + 1) * n[k + 1] / n[1]
        if rest >= 1:
            continue
        r = np.arange(1, k + 1)
        star = (r + 1) * np.array(n[2 : k + 2]) / np.array(n[1 : k + 1])
        made = r * (star / r - rest) / (1 - rest)
        if (made > 0).all() and (made < r).all():
            out[:k] = made
            break
    return out


def discounted(count: np.ndarray, low: np.ndarray) -> np.ndarray:
    """``D`` of counts of 1 and more."""
    return np.where(count <= K, low[np.clip(count, 1, K) - 1], count - HIGH)


@dataclass
class Unigrams:
    """What evaluation needs to know of all words: totals, discounts, and the frequent words."""

    tokens: int
    types: int
    docs: int
    low: np.ndarray
    unknown: float  # probability of the unknown word
    words: pa.Array
    counts: np.ndarray

    def plain(self) -> tuple:
        """Its fields, for a broadcast: workers need not know this class by name."""
        return self.tokens, self.types, self.docs, self.low, self.unknown, self.words, self.counts

    def log_p(self, count: np.ndarray) -> np.ndarray:
        """log10 P(w) from c(w)."""
        known = np.log10(discounted(np.maximum(count, 1), self.low) / max(self.tokens, 1))
        return np.where(count > 0, known, np.log10(self.unknown))

    def known_counts(self, vocab: pa.Array) -> np.ndarray:
        """c(w) of frequent words, -1 for others."""
        at = pc.fill_null(pc.index_in(vocab, value_set=self.words.cast(vocab.type)), -1).to_numpy(zero_copy_only=False)
        return np.where(at >= 0, self.counts[at], -1) if len(self.counts) else np.full(len(vocab), -1)


def _tokens(texts: pa.Array):
    """Targets and contexts of a slice as codes, the texts' offsets, and the vocabulary with END and START."""
    codes, offsets, vocab = words_of(pc.ascii_lower(texts))
    vocab = pa.concat_arrays([vocab.cast(pa.string()), pa.array([END, START])])
    ends = offsets + np.arange(len(offsets))
    target = np.full(ends[-1], len(vocab) - 2, np.int64)
    target[np.arange(len(codes)) + owners(offsets)] = codes
    context = np.empty(len(target), np.int64)
    context[1:] = target[:-1]
    context[ends[:-1]] = len(vocab) - 1
    return target, context, ends, vocab


def _emit(out: list[tuple]):
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), _PART_ARROW)], schema=_PART_ARROW)


def _split(to: np.ndarray):
    """Stretches of equal values of a sorted array."""
    edges = np.concatenate([[0], np.flatnonzero(to[1:] != to[:-1]) + 1, [len(to)]]) if len(to) else [0]
    return zip(edges[:-1], edges[1:])


def _bucket(hashes: np.ndarray, buckets: int) -> np.ndarray:
    return (mix(hashes) % np.uint64(buckets)).astype(np.int64)


def _group_sums(keys: np.ndarray, *values: np.ndarray):
    """Distinct keys in order and the sums of each of ``values`` over them."""
    used, at = np.unique(keys, return_inverse=True)
    return used, [np.bincount(at, v, len(used)) for v in values]


# -- 1. words ---------------------------------------------------------------


def _count_words(narrow: DataFrame, buckets: int) -> tuple[DataFrame, DataFrame]:
    """``unigrams`` (word, count) and pairs found often in some slice (word, other, count)."""
    schema = pa.schema([("word", pa.string()), ("other", pa.string()), ("count", pa.int64())])

    def count(batches):
        for batch in slices(batches, limit=PACK_BYTES):
            target, context, ends, vocab = _tokens(texts_of(batch))
            learned = ~batch.column("held_out").to_numpy(zero_copy_only=False)[owners(ends)]
            hashes = hash_words(vocab)
            used, n = np.unique(target[learned], return_counts=True)
            to = _bucket(hashes[used], buckets)
            by = np.argsort(to, kind="stable")
            used, n, to = used[by], n[by], to[by]
            yield from _emit([
                (int(to[a]), PAIRS, 0, pack(*word_arrays(vocab.take(pa.array(used[a:b]))), small(n[a:b])))
                for a, b in _split(to) if a < b
            ])
            pair, n = np.unique(context[learned] * len(vocab) + target[learned], return_counts=True)
            often = n >= max(8, int(learned.sum()) >> 16)
            pair, n = pair[often], n[often]
            if len(pair):
                w, v = vocab.take(pa.array(pair % len(vocab))), vocab.take(pa.array(pair // len(vocab)))
                to = _bucket(hashes[pair % len(vocab)] ^ mix(hashes[pair // len(vocab)]), buckets)
                by = np.argsort(to, kind="stable")
                w, v, n, to = w.take(pa.array(by)), v.take(pa.array(by)), n[by], to[by]
                yield from _emit([
                    (int(to[a]), HOT, 0, pack(*word_arrays(w[a:b]), *word_arrays(v[a:b]), small(n[a:b])))
                    for a, b in _split(to) if a < b
                ])

    def add(table):
        kinds = table.column("kind").to_pylist()
        parts = [unpack(x) for x in table.column("data").to_pylist()]
        words, hot = [p for p, k in zip(parts, kinds) if k == PAIRS], [p for p, k in zip(parts, kinds) if k == HOT]
        held, code, _ = words_from([(p[0], p[1]) for p in words])
        counts = np.bincount(code, np.concatenate([p[2] for p in words]) if words else None, len(held)).astype(np.int64)
        made = [pa.Table.from_arrays([held.cast(pa.string()), pa.nulls(len(held), pa.string()), pa.array(counts)], schema=schema)]
        if hot:
            w, wc, _ = words_from([(p[0], p[1]) for p in hot])
            v, vc, _ = words_from([(p[2], p[3]) for p in hot])
            used, (n,) = _group_sums(vc * len(w) + wc, np.concatenate([p[4] for p in hot]).astype(np.float64))
            made.append(pa.Table.from_arrays([
                w.take(pa.array(used % len(w))).cast(pa.string()), v.take(pa.array(used // len(w))).cast(pa.string()), pa.array(n.astype(np.int64)),
            ], schema=schema))
        return pa.concat_tables(made)

    counted = hand_off(narrow.mapInArrow(count, _PART).groupBy("bucket").applyInArrow(add, "word string, other string, count long"))
    return counted.where("other IS NULL AND count > 0").select("word", "count"), counted.where("other IS NOT NULL")


def _unigrams(words: DataFrame) -> Unigrams:
    n = F.col("count")
    classes = [F.coalesce(F.sum((n == r).cast("bigint")), F.lit(0)).alias(f"n{r}") for r in range(1, K + 2)]
    row = words.agg(
        F.coalesce(F.sum(n), F.lit(0)).alias("tokens"), F.count(F.lit(1)).alias("types"),
        F.coalesce(F.max(F.when(F.col("word") == END, n)), F.lit(0)).alias("docs"), *classes,
    ).first()
    low = discounts([row[f"n{r}"] for r in range(1, K + 2)])
    lost = sum(row[f"n{r}"] * (r - low[r - 1]) for r in range(1, K + 1))
    lost += (row["types"] - sum(row[f"n{r}"] for r in range(1, K + 1))) * HIGH
    # More than tokens / limit words cannot reach the limit: that bounds what is collected.
    limit = max(MIN_FREQUENT, row["tokens"] // MAX_FREQUENT)
    often = words.where(n >= limit).orderBy("word").toArrow()
    held = often.column("word").combine_chunks().cast(pa.string()) if often.num_rows else pa.array([], pa.string())
    unknown = lost / row["tokens"] if row["tokens"] else 1.0
    return Unigrams(row["tokens"], row["types"], row["docs"], low, unknown, held, often.column("count").to_numpy())


# -- 2. pairs ---------------------------------------------------------------


def _send_pairs(narrow: DataFrame, uni: Unigrams, hot: tuple[pa.Array, pa.Array], buckets: int) -> DataFrame:
    """Parts: the pairs of each slice by bucket, its texts with what is known of them already, hot counts."""
    shared = narrow.sparkSession.sparkContext.broadcast((uni.plain(), hot))

    def send(batches):
        known_words, (hot_w, hot_v) = shared.value
        uni = Unigrams(*known_words)
        task = TaskContext.get()
        number = (task.partitionId() if task else 0) << 32
        for batch in slices(batches, limit=PACK_BYTES):
            number += 1
            target, context, ends, vocab = _tokens(texts_of(batch))
            texts, held = owners(ends), batch.column("held_out").to_numpy(zero_copy_only=False)
            hashes, counts, out = hash_words(vocab), uni.known_counts(vocab), []
            hot_at = np.full(len(target), -1)
            if len(hot_w):
                w = pc.fill_null(pc.index_in(hot_w, value_set=vocab), -1).to_numpy(zero_copy_only=False).astype(np.int64)
                v = pc.fill_null(pc.index_in(hot_v, value_set=vocab), -1).to_numpy(zero_copy_only=False).astype(np.int64)
                here = np.flatnonzero((w >= 0) & (v >= 0))
                key = w[here] * len(vocab) + v[here]
                by = np.argsort(key)
                if len(key):
                    pair = target * len(vocab) + context
                    near = np.minimum(np.searchsorted(key[by], pair), len(key) - 1)
                    hot_at = np.where(key[by][near] == pair, here[by][near], -1)
            is_hot = hot_at >= 0
            # Texts: their ids and sizes, and of hot pairs the places and what c(w) alone decides.
            pair, times = np.unique(texts[is_hot] * (len(hot_w) + 1) + hot_at[is_hot], return_counts=True)
            c = counts[target[is_hot]]
            own = np.bincount(texts[is_hot], np.log10(c + 0.1), len(held))
            word = target[is_hot] != len(vocab) - 2
            less = np.bincount(texts[is_hot][word], np.log10(c[word]), len(held))
            known = np.bincount(texts[is_hot], minlength=len(held))
            ids = batch.column("doc")
            data = pack(
                pc.fill_null(ids, 0).to_numpy(), ids.is_valid().to_numpy(zero_copy_only=False).astype(np.uint8), held.astype(np.uint8),
                np.diff(ends), own, less, small(known), small(pair // (len(hot_w) + 1)), small(pair % (len(hot_w) + 1)), small(times),
            )
            out.append((number % buckets, TEXTS, number, data))
            seen, n = np.unique(hot_at[is_hot & ~held[texts]], return_counts=True)
            if len(seen):
                out.append((number % buckets, HOT, number, pack(small(seen), small(n))))
            # Pairs: to the bucket of the word, or of the pair where the word is frequent.
            rest = np.flatnonzero(~is_hot)
            w, v, text = target[rest], context[rest], texts[rest]
            to = _bucket(np.where(counts[w] >= 0, hashes[w] ^ mix(hashes[v]), hashes[w]), buckets)
            by = np.lexsort((v, w, to))
            w, v, text, to = w[by], v[by], text[by], to[by]
            for a, b in _split(to):
                if a < b:
                    used, local = np.unique(np.concatenate([w[a:b], v[a:b]]), return_inverse=True)
                    n = b - a
                    data = pack(*word_arrays(vocab.take(pa.array(used))), small(local[:n]), small(local[n:]), small(text[a:b]), held[text[a:b]].astype(np.uint8))
                    out.append((int(to[a]), PAIRS, number, data))
            yield from _emit(out)

    return narrow.mapInArrow(send, _PART)


def _in_buckets(parts: DataFrame, uni: Unigrams, buckets: int) -> DataFrame:
    """Parts: sums per text, bigrams, unseen pairs by context, counts of counts; texts pass through."""
    shared = parts.sparkSession.sparkContext.broadcast(uni.plain())

    def resolve(table):
        uni = Unigrams(*shared.value)
        kinds, blocks, data = (table.column(c).to_pylist() for c in ("kind", "block", "data"))
        bucket = table.column("bucket")[0].as_py()
        out = [(b, k, n, d) for b, k, n, d in zip([bucket] * len(kinds), kinds, blocks, data) if k != PAIRS]
        parts = [unpack(d) for d, k in zip(data, kinds) if k == PAIRS]
        if parts:
            numbers = [b for b, k in zip(blocks, kinds) if k == PAIRS]
            vocab, code, begins = words_from([(p[0], p[1]) for p in parts])
            code = code.astype(np.int32)
            w = np.concatenate([code[b + p[2].astype(np.int32)] for p, b in zip(parts, begins)])
            v = np.concatenate([code[b + p[3].astype(np.int32)] for p, b in zip(parts, begins)])
            learned = np.concatenate([p[5] for p in parts]) == 0
            ends = np.cumsum([len(p[4]) for p in parts])
            here = np.bincount(w[learned], minlength=len(vocab)).astype(np.int64)
            known = uni.known_counts(vocab)
            c = np.where(known >= 0, known, here)  # a rare word's pairs are all here
            pair, at = np.unique(w * np.int64(len(vocab)) + v, return_inverse=True)
            at = at.astype(np.int32)
            r_of = np.bincount(at[learned], minlength=len(pair)).astype(np.int64)
            unseen = (r_of == 0)[at]
            # By distinct word and distinct pair; tokens look these up part by part.
            is_word = ~np.asarray(pc.equal(vocab, END))
            log_base, log_count, log_p = np.log10(c + 0.1), is_word * np.log10(np.maximum(c, 1)), uni.log_p(c)
            high = (r_of > K) * np.log10(np.maximum(r_of, 1) - HIGH)
            for lo, hi, part, number in zip([0, *ends[:-1]], ends, parts, numbers):
                if lo == hi:
                    continue
                ww, pairs_at, (used, text) = w[lo:hi], at[lo:hi], np.unique(part[4], return_inverse=True)
                r = r_of[pairs_at]
                total = lambda x: np.bincount(text, x, len(used))
                a_sum = total(high[pairs_at] - log_count[ww] + np.where(r == 0, log_p[ww], 0.0))
                ints = [small(total(x).astype(np.int64)) for x in (c[ww] > 0, *((r == i) for i in range(1, K + 1)))]
                out.append((bucket, SUMS, number, pack(small(used.astype(np.int64)), total(log_base[ww]), a_sum, *ints)))
            live = np.flatnonzero(r_of)
            n = np.bincount(np.minimum(r_of[live], K + 2), minlength=K + 3)[1 : K + 2]
            out.append((bucket, COUNTS, 0, pack(n.astype(np.int64))))
            if len(live):
                words, local = np.unique(np.concatenate([pair[live] // len(vocab), pair[live] % len(vocab)]), return_inverse=True)
                lw, lv = local[: len(live)], local[len(live) :]
                cw_used = np.zeros(len(words), np.int64)
                cw_used[lw] = c[words[lw]]
                held = vocab.take(pa.array(words)).cast(pa.string())
                out.append((bucket, BIGRAMS, 0, pack(*word_arrays(held), small(lw), small(lv), small(r_of[live]), small(cw_used))))
            names = vocab.cast(pa.string())
            frequent = (known >= 0) | np.asarray(pc.equal(names, START))
            missed = np.flatnonzero(unseen)
            block = np.searchsorted(ends, missed, side="right")
            text = np.concatenate([p[4] for p in parts])[missed].astype(np.int64)
            mv = v[missed]
            for later in (True, False):
                mine = np.flatnonzero(frequent[mv] == later)
                if not len(mine):
                    continue
                # By block, to be resolved there, or by the bucket of the context.
                to = block[mine] if later else _bucket(hash_words(names), buckets)[mv[mine]]
                by = np.lexsort((mv[mine], to))
                mine, to = mine[by], to[by]
                for lo, hi in _split(to):
                    m = mine[lo:hi]
                    words, local = np.unique(mv[m], return_inverse=True)
                    number = np.array(numbers, np.int64)[block[m]]
                    body = pack(*word_arrays(names.take(pa.array(words))), small(local), small(number), small(text[m]))
                    out.append((bucket, LATER, int(number[0]), body) if later else (int(to[lo]), UNSEEN, 0, body))
        columns = [pa.array(c, f.type) for c, f in zip(zip(*out), _PART_ARROW)] if out else [pa.array([], f.type) for f in _PART_ARROW]
        return pa.Table.from_arrays(columns, schema=_PART_ARROW)

    return parts.groupBy("bucket").applyInArrow(resolve, _PART)


# -- 3. contexts ------------------------------------------------------------


def _contexts(bigrams: DataFrame, uni: Unigrams, low: np.ndarray, buckets: int) -> DataFrame:
    """One part per bucket: contexts with c(v) and log10 of alpha(v)."""
    shared = bigrams.sparkSession.sparkContext.broadcast(uni.plain())

    def spread(batches):
        uni = Unigrams(*shared.value)
        for batch in batches:
            for bucket_data in batch.column("data"):
                length, data, w, v, r, c = unpack(bucket_data.as_py())
                names, code, _ = words_from([(length, data)])
                w, v, r = code[w.astype(np.int64)], code[v.astype(np.int64)], r.astype(np.int64)
                count = np.zeros(len(names), np.int64)
                count[code] = c
                used, sums = _group_sums(v, r, discounted(r, low), 10.0 ** uni.log_p(count[w]))
                names = names.cast(pa.string())
                to = _bucket(hash_words(names)[used], buckets)
                by = np.argsort(to, kind="stable")
                used, to, sums = used[by], to[by], [x[by] for x in sums]
                yield from _emit([
                    (int(to[a]), CONTEXTS, 0, pack(*word_arrays(names.take(pa.array(used[a:b]))), small(sums[0][a:b].astype(np.int64)), sums[1][a:b], sums[2][a:b]))
                    for a, b in _split(to) if a < b
                ])

    def add(table):
        parts = [unpack(x) for x in table.column("data").to_pylist()]
        names, code, _ = words_from([(p[0], p[1]) for p in parts])
        count, kept, backed = (np.bincount(code, np.concatenate([p[i] for p in parts]), len(names)) for i in (2, 3, 4))
        alpha = np.log10((1 - kept / count) / (1 - backed))
        data = pack(*word_arrays(names.cast(pa.string())), small(count.astype(np.int64)), alpha)
        row = [[table.column("bucket")[0].as_py()], [CONTEXTS], [0], [data]]
        return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(row, _PART_ARROW)], schema=_PART_ARROW)

    return hand_off(bigrams.select("data").mapInArrow(spread, _PART).groupBy("bucket").applyInArrow(add, _PART))


def _read_contexts(data: list[bytes]) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Words, counts and log10 of alpha of context parts (a word is in one part only)."""
    parts = [unpack(d) for d in data]
    if not parts:
        return pa.array([], pa.string()), np.zeros(0, np.int64), np.zeros(0)
    names, code, _ = words_from([(p[0], p[1]) for p in parts])
    count, alpha = np.zeros(len(names), np.int64), np.zeros(len(names))
    count[code] = np.concatenate([p[2] for p in parts])
    alpha[code] = np.concatenate([p[3] for p in parts])
    return names.cast(pa.string()), count, alpha


def _added(names: pa.Array, table) -> np.ndarray:
    """What an unseen pair adds in each of the contexts ``names``: log10 of alpha(v) c(v), 0 if v is unknown."""
    words, count, alpha = table
    at = pc.fill_null(pc.index_in(names.cast(pa.string()), value_set=words), -1).to_numpy(zero_copy_only=False)
    if not len(words):
        return np.zeros(len(names))
    return np.where(at >= 0, alpha[at] + np.log10(np.maximum(count[at], 1)), 0.0)


# -- 4. texts ---------------------------------------------------------------


def _resolve_unseen(unseen: DataFrame, contexts: DataFrame) -> DataFrame:
    def resolve(key, found, held):
        out = []
        if found.num_rows:
            table = _read_contexts(held.column("data").to_pylist())
            parts = [unpack(x) for x in found.column("data").to_pylist()]
            names, code, begins = words_from([(p[0], p[1]) for p in parts])
            value = _added(names, table)
            v = np.concatenate([code[b + p[2].astype(np.int64)] for p, b in zip(parts, begins)])
            block, text = (np.concatenate([p[i] for p in parts]).astype(np.int64) for i in (3, 4))
            numbers, place = np.unique(block, return_inverse=True)
            used, (total,) = _group_sums(place.astype(np.int64) << np.int64(32) | text, value[v])
            for lo, hi in _split(used >> np.int64(32)):
                out.append((0, ADDED, int(numbers[int(used[lo] >> np.int64(32))]), pack(small(used[lo:hi] & np.int64(0xFFFFFFFF)), total[lo:hi])))
        columns = [pa.array(c, f.type) for c, f in zip(zip(*out), _PART_ARROW)] if out else [pa.array([], f.type) for f in _PART_ARROW]
        return pa.Table.from_arrays(columns, schema=_PART_ARROW)

    return unseen.groupBy("bucket").cogroup(contexts.groupBy("bucket")).applyInArrow(resolve, _PART)


_SCORES = pa.schema([
    ("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()),
    ("train_tokens", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64()),
])


def _by_block(parts: DataFrame, uni: Unigrams, low: np.ndarray, hot_counts: np.ndarray, frequent) -> DataFrame:
    shared = parts.sparkSession.sparkContext.broadcast((uni.plain(), low, hot_counts, frequent))

    def finish(table):
        known_words, low, hot_counts, frequent = shared.value
        uni = Unigrams(*known_words)
        kinds = table.column("kind").to_pylist()
        parts = [(k, unpack(d)) for k, d in zip(kinds, table.column("data").to_pylist())]
        ids, named, held, n, base, less, known, text, pair, times = next(p for k, p in parts if k == TEXTS)
        base, score, known = base.astype(float), -less.astype(float), known.astype(np.int64)
        if len(text):
            np.add.at(score, text.astype(np.int64), times * np.log10(hot_counts[pair.astype(np.int64)] - HIGH))
        for kind, p in parts:
            at = p[0].astype(np.int64)
            if kind == SUMS:
                base[at] += p[1]
                score[at] += p[2] + sum(p[3 + i] * np.log10(low[i - 1]) for i in range(1, K + 1))
                known[at] += p[3].astype(np.int64)
            elif kind == ADDED:
                score[at] += p[1]
            elif kind == LATER:
                names, code, _ = words_from([(p[0], p[1])])
                np.add.at(score, p[4].astype(np.int64), _added(names, frequent)[code[p[2].astype(np.int64)]])
        base -= n * np.log10(uni.tokens + 0.1 * (uni.types + 1))
        if uni.docs:
            score -= np.log10(uni.docs)  # the first word's context
        rows = [
            pa.array(ids, mask=named == 0), pa.array(held == 1), pa.array(n), pa.array(known),
            pa.array(np.full(len(ids), uni.tokens)), pa.array(base), pa.array(score),
        ]
        return pa.Table.from_arrays(rows, schema=_SCORES)

    return parts.select("block", "kind", "data").groupBy("block").applyInArrow(
        finish, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    )


@dataclass
class KatzModel:
    """The model's tables, written to shared storage, and its small constants."""

    unigrams: DataFrame
    packed_bigrams: DataFrame
    packed_contexts: DataFrame
    words: Unigrams
    low: np.ndarray

    def bigrams(self) -> DataFrame:
        """``context, word, count`` of every pair seen."""
        schema = pa.schema([("context", pa.string()), ("word", pa.string()), ("count", pa.int64())])

        def rows(batches):
            for batch in batches:
                for part in batch.column("data"):
                    length, data, w, v, r, _ = unpack(part.as_py())
                    names, code, _ = words_from([(length, data)])
                    pick = lambda x: names.take(pa.array(code[x.astype(np.int64)])).cast(pa.string())
                    yield pa.RecordBatch.from_arrays([pick(v), pick(w), pa.array(r.astype(np.int64))], schema=schema)

        return self.packed_bigrams.select("data").mapInArrow(rows, "context string, word string, count long")

    def contexts(self) -> DataFrame:
        """``context, count, log_alpha`` of every context seen."""
        schema = pa.schema([("context", pa.string()), ("count", pa.int64()), ("log_alpha", pa.float64())])

        def rows(batches):
            for batch in batches:
                for part in batch.column("data"):
                    yield pa.RecordBatch.from_arrays([pa.array(c) if isinstance(c, np.ndarray) else c for c in _read_contexts([part.as_py()])], schema=schema)

        return self.packed_contexts.select("data").mapInArrow(rows, "context string, count long, log_alpha double")


def fit_and_score(docs: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, KatzModel]:
    """Scores of all rows under the model learnt from the rows that ``held_out`` is false for.

    One row per document: ``doc_id, held_out, n_tokens, n_known, train_tokens,
    base_score, score``; the base is an add-0.1 unigram model. Words are
    lower-cased in A-Z only. Null and empty texts are the word ``END`` alone.
    Repeated rows count and are scored each. Without any row to learn from,
    every text has probability 1 of unknown words. No rows give no rows.
    """
    spark = docs.sparkSession
    narrow = docs.select(
        F.col(id_col).cast("bigint").alias("doc"), F.col(text_col).cast("string").alias("text"),
        F.coalesce(held_out, F.lit(True)).alias("held_out"),
    )
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    words, often = _count_words(narrow, max(least, 32))
    uni = _unigrams(words)
    buckets = max(least, uni.tokens // BUCKET_TOKENS + 1)
    # Pairs are hot from an eighth of a bucket on; at most MAX_FREQUENT can be.
    limit = max(MIN_FREQUENT, uni.tokens // (8 * buckets), uni.tokens // MAX_FREQUENT)
    hot = often.where(F.col("count") >= limit).orderBy("word", "other").toArrow()
    hot = [hot.column(c).combine_chunks().cast(pa.string()) if hot.num_rows else pa.array([], pa.string()) for c in ("word", "other")]
    sure = pa.array(uni.known_counts(hot[0]) >= 0)
    hot = tuple(h.filter(sure) for h in hot)

    found = hand_off(_in_buckets(_send_pairs(narrow, uni, hot, buckets), uni, buckets), "kind")
    of = lambda *kinds: found.where(F.col("kind").isin(*kinds))
    classes = np.zeros(K + 1, np.int64)
    hot_counts = np.zeros(len(hot[0]), np.int64)
    for part in _summed(of(COUNTS, HOT), len(hot_counts)).collect():
        classes += np.array(part["classes"])
        hot_counts += np.array(part["hot"], np.int64)
    low = discounts(classes.tolist())
    bigrams = of(BIGRAMS).select("data")
    if len(hot_counts):
        names = pa.concat_arrays(hot).dictionary_encode()
        code = names.indices.to_numpy().astype(np.int64)
        w, v = code[: len(hot_counts)], code[len(hot_counts) :]
        c = np.zeros(len(names.dictionary), np.int64)
        c[w] = uni.known_counts(hot[0])
        data = pack(*word_arrays(names.dictionary), small(w), small(v), small(hot_counts), small(c))
        bigrams = bigrams.union(spark.createDataFrame([(bytearray(data),)], "data binary"))
    contexts = _contexts(bigrams, uni, low, buckets)
    model = KatzModel(words, bigrams, contexts, uni, low)
    frequent = _frequent_contexts(model, uni)
    added = _resolve_unseen(of(UNSEEN), contexts)
    scores = _by_block(of(TEXTS, SUMS, LATER).select("bucket", "kind", "block", "data").unionByName(added), uni, low, hot_counts, frequent)
    return scores, model


def _summed(parts: DataFrame, hot: int) -> DataFrame:
    """Counts of counts and hot pairs' counts, one row per task."""
    schema = pa.schema([("classes", pa.list_(pa.int64())), ("hot", pa.list_(pa.int64()))])

    def add(batches):
        classes, held = np.zeros(K + 1, np.int64), np.zeros(hot, np.int64)
        for batch in batches:
            for kind, data in zip(batch.column("kind").to_pylist(), batch.column("data").to_pylist()):
                part = unpack(data)
                if kind == COUNTS:
                    classes += part[0]
                else:
                    held[part[0].astype(np.int64)] += part[1].astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array([classes], schema.field(0).type), pa.array([held], schema.field(1).type)], schema=schema)

    tasks = parts.select("kind", "data").mapInArrow(add, "classes array<long>, hot array<long>")
    # A second level keeps what reaches the driver to a few rows.
    both = tasks.select(F.posexplode("classes").alias("i", "n"), F.lit(0).alias("k")).union(
        tasks.select(F.posexplode("hot").alias("i", "n"), F.lit(1).alias("k"))
    ).groupBy("k", "i").agg(F.sum("n").alias("n"))
    pick = lambda k: F.transform(F.array_sort(F.collect_list(F.when(F.col("k") == k, F.struct("i", "n")))), lambda x: x["n"])
    return both.groupBy().agg(pick(0).alias("classes"), pick(1).alias("hot")).where(F.size("classes") > 0)


def _frequent_contexts(model: KatzModel, uni: Unigrams):
    """Contexts that are frequent words, and START: at most ``MAX_FREQUENT`` and one more."""
    asked = pa.concat_arrays([uni.words, pa.array([START])])
    spark = model.packed_contexts.sparkSession
    names = spark.createDataFrame(pa.table({"context": asked}))
    found = model.contexts().join(F.broadcast(names), "context", "left_semi").toArrow()
    if not found.num_rows:
        return pa.array([], pa.string()), np.zeros(0, np.int64), np.zeros(0)
    return found.column("context").combine_chunks().cast(pa.string()), found.column("count").to_numpy(), found.column("log_alpha").to_numpy()
