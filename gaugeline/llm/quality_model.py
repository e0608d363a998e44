"""Quality classifier: a factorisation machine over hashed words, structure and metadata.

A document's features are its lower-cased words hashed to ``BUCKETS`` (weight
``1 + log(count)``, scaled to length 1), statistics of its structure, and what
the table says of its length. The score is the logistic function of

    w0 + sum_i w_i x_i + 1/2 sum_f [(sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2],

all pairwise interactions in time linear in the features. Fitting takes at most
``SAMPLE`` labelled documents, those with the smallest hashes of their ids; they
are a bounded amount for the driver. Everything else covers all rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeline.llm.common import hash_words, owners, slices, sum_by, texts_of, words_of
from gaugeline.llm.text_stats import base_stats

BUCKETS = 1 << 13
RANK = 8
#: Labelled documents that fitting uses at most.
SAMPLE = 12_000
EPOCHS = 10
STRUCTURE = (
    "log_words", "word_chars", "symbols", "dup_lines", "repeat_words", "distinct_words", "log_lines",
    "line_words", "upper", "digits", "marks", "few_words", "n_chars", "no_n_chars",
)
WIDTH = BUCKETS + len(STRUCTURE)


def _structure(texts: pa.Array, n_chars: np.ndarray) -> np.ndarray:
    """One row of bounded statistics per text; ``n_chars`` is NaN where the table has none."""
    s = base_stats(texts)
    share = lambda pattern: pc.count_substring_regex(texts, pattern).to_numpy(zero_copy_only=False)
    n, lines = np.maximum(s["n_words"], 1), np.maximum(s["n_lines"], 1)
    points = np.maximum(s["word_chars"], 1)
    known = np.nan_to_num(np.maximum(n_chars, 0))
    return np.column_stack(
        [
            np.log1p(s["n_words"]) / 8, np.minimum(s["word_chars"] / n, 20) / 8, np.minimum(s["n_symbols"] / n, 3),
            s["n_dup_lines"] / lines, s["n_repeat_words"] / n, s["n_distinct_words"] / n, np.log1p(s["n_lines"]) / 5,
            np.log1p(n / lines) / 6, share(r"\p{Lu}") / points, share(r"\p{Nd}") / points,
            share(r"[.,;:!?]") / n, np.exp(-s["n_words"] / 20), np.log1p(known) / 12, np.isnan(n_chars),
        ]
    )


def features(texts: pa.Array, n_chars: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sparse rows: feature ids, weights, and the texts' offsets into both."""
    codes, offsets, vocab = words_of(texts)
    bucket = (hash_words(pc.utf8_lower(vocab)) % np.uint64(BUCKETS)).astype(np.int64)
    key, count = np.unique(owners(offsets) * BUCKETS + bucket[codes], return_counts=True)
    doc, ids, weight = key // BUCKETS, key % BUCKETS, 1 + np.log(count)
    size = np.bincount(doc, weights=weight * weight, minlength=len(texts))
    weight = weight / np.sqrt(size)[doc]
    held = np.bincount(doc, minlength=len(texts))
    extra = len(STRUCTURE)
    ends = np.concatenate([[0], np.cumsum(held + extra)])
    all_ids, all_weights = np.empty(ends[-1], np.int32), np.empty(ends[-1])
    at = np.arange(len(key)) + doc * extra
    all_ids[at], all_weights[at] = ids, weight
    tail = ends[1:, None] - extra + np.arange(extra)
    all_ids[tail], all_weights[tail] = BUCKETS + np.arange(extra), _structure(texts, n_chars)
    return all_ids, all_weights, ends


@dataclass
class FactorisationMachine:
    bias: float
    linear: np.ndarray
    factors: np.ndarray

    @staticmethod
    def fresh() -> FactorisationMachine:
        draw = np.random.default_rng(7)
        return FactorisationMachine(0.0, np.zeros(WIDTH), draw.normal(0, 0.05, (WIDTH, RANK)))

    def margin(self, ids: np.ndarray, x: np.ndarray, ends: np.ndarray) -> np.ndarray:
        total = self.bias + sum_by(self.linear[ids] * x, ends)
        for f in range(self.factors.shape[1]):
            part = self.factors[ids, f] * x
            total += 0.5 * (sum_by(part, ends) ** 2 - sum_by(part * part, ends))
        return total

    def score(self, ids: np.ndarray, x: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(ids, x, ends), -50, 50)))

    def fit(self, ids, x, ends, y, epochs: int = EPOCHS, batch: int = 256, rate: float = 0.02, decay: float = 1e-5):
        """Logistic loss, Adam, fixed order of shuffles."""
        draw = np.random.default_rng(11)
        held = [np.zeros(1), self.linear, self.factors]
        held[0][0] = self.bias
        first, second = [np.zeros_like(p) for p in held], [np.zeros_like(p) for p in held]
        step = 0
        for _ in range(epochs):
            order = draw.permutation(len(y))
            for lo in range(0, len(y), batch):
                rows = order[lo : lo + batch]
                length = (ends[1:] - ends[:-1])[rows]
                own = np.concatenate([[0], np.cumsum(length)])
                at = np.arange(own[-1]) + np.repeat(ends[rows] - own[:-1], length)
                i, v, doc = ids[at], x[at], owners(own)
                self.bias = float(held[0][0])
                off = (self.score(i, v, own) - y[rows]) / len(rows)
                push = off[doc] * v
                grads = [np.array([off.sum()]), np.bincount(i, push, WIDTH) + decay * self.linear, decay * self.factors]
                for f in range(self.factors.shape[1]):
                    part = self.factors[i, f] * v
                    grads[2][:, f] += np.bincount(i, push * (sum_by(part, own)[doc] - part), WIDTH)
                step += 1
                for p, g, m, s in zip(held, grads, first, second):
                    m += 0.1 * (g - m)
                    s += 0.001 * (g * g - s)
                    p -= rate * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.999**step)) + 1e-8)
        self.bias = float(held[0][0])
        return self


def _narrow(docs: DataFrame, id_col: str, text_col: str, chars_col: str | None) -> DataFrame:
    chars = F.col(chars_col).cast("double") if chars_col else F.lit(None).cast("double")
    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"), chars.alias("n_chars"))


def _rows(batch: pa.RecordBatch):
    return features(texts_of(batch), batch.column("n_chars").to_numpy(zero_copy_only=False).astype(float))


def fit(
    docs: DataFrame, labels: DataFrame, where: Column, id_col: str = "doc_id", text_col: str = "text",
    chars_col: str | None = "n_chars", label_col: str = "quality", sample: int = SAMPLE,
) -> FactorisationMachine:
    """Fit to labelled documents whose (label table's) id passes ``where``.

    Rows with a null id or label are not used. Of documents with one id, the text
    of the smallest hash is used, so that no more than ``sample`` rows are
    collected. Without any row the model gives 0.5 plus nothing learned; with
    one class only it learns that class.
    """
    chosen = (
        labels.where(where & F.col(id_col).isNotNull() & F.col(label_col).isNotNull())
        .select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(label_col).cast("double").alias("y"))
        .orderBy(F.xxhash64("doc_id"), "doc_id", "y")
        .limit(sample)
    )
    own = pa.schema([("doc_id", pa.int64()), ("y", pa.float64()), ("ids", pa.list_(pa.int32())), ("x", pa.list_(pa.float64()))])

    def make(batches):
        for batch in slices(batches):
            ids, x, ends = _rows(batch)
            at = pa.array(ends.astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("y"), pa.ListArray.from_arrays(at, pa.array(ids)), pa.ListArray.from_arrays(at, pa.array(x))],
                schema=own,
            )

    # At most ``sample`` rows of two numbers: a proven bound for the broadcast.
    found = (
        _narrow(docs, id_col, text_col, chars_col)
        .join(F.broadcast(chosen), "doc_id")
        .groupBy("doc_id", "y")
        .agg(F.min(F.struct(F.xxhash64("text").alias("__hash"), "text", "n_chars")).alias("__row"))
        .select("doc_id", "y", "__row.text", "__row.n_chars")
        .mapInArrow(make, "doc_id long, y double, ids array<int>, x array<double>")
        .toArrow()
        .sort_by([("doc_id", "ascending"), ("y", "ascending")])
    )
    model = FactorisationMachine.fresh()
    if not found.num_rows:
        return model
    ids, x = found.column("ids").combine_chunks(), found.column("x").combine_chunks()
    ends = ids.offsets.to_numpy().astype(np.int64)
    return model.fit(
        ids.values.to_numpy(), x.values.to_numpy(), ends, (found.column("y").to_numpy() > 0).astype(float)
    )


def score(
    docs: DataFrame, model: FactorisationMachine, id_col: str = "doc_id", text_col: str = "text",
    chars_col: str | None = "n_chars",
) -> DataFrame:
    """``doc_id, score`` for every row; null texts are scored as empty ones.

    Repeated rows are scored alike; further columns are not looked at. The
    weights (well under a megabyte) are broadcast.
    """
    own = pa.schema([("doc_id", pa.int64()), ("score", pa.float64())])
    shared = docs.sparkSession.sparkContext.broadcast((model.bias, model.linear, model.factors))

    def apply(batches):
        held = FactorisationMachine(*shared.value)
        for batch in slices(batches):
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(held.score(*_rows(batch)))], schema=own)

    return _narrow(docs, id_col, text_col, chars_col).mapInArrow(apply, "doc_id long, score double")
