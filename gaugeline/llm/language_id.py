"""Language identification: multinomial naive Bayes over hashed character n-grams.

Fitting sums one count table per map task by (language, chunk of buckets), so
what is shuffled and collected is bounded by languages times buckets, however
many documents are read. The log-probability matrix (``BUCKETS`` x languages,
half a megabyte a language) goes to the workers, where the n-grams of a slice
of texts are looked up and summed per text in NumPy.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeline.llm.common import slices, sum_by, texts_of

ORDERS = (1, 2, 3)
BUCKETS = 1 << 16
#: Languages that a model may have; more are an error, as the matrix goes to every worker.
MAX_LANGS = 1_000
SMOOTHING = 0.5
_CHUNK = 1 << 12
_LETTER = re.compile(r"[^\W\d_]")
_SEEDS = (0x9E3779B1, 0x85EBCA6B, 0xC2B2AE35)


def gram_buckets(texts: list[str]) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """For each order, the buckets of all n-grams of all texts, and the texts' offsets into them.

    Texts are lower-cased, runs of white space, digits and other signs count as
    they stand, and a space stands before and after each text.
    """
    padded = [f" {t.lower()} " for t in texts]
    length = np.fromiter(map(len, padded), np.int64, len(padded))
    ends = np.cumsum(length)
    points = np.frombuffer("".join(padded).encode("utf-32-le", "surrogatepass"), np.uint32)
    found, offsets = [], []
    for n in ORDERS:
        total = max(0, len(points) - n + 1)
        code = np.full(total, np.uint32(n * 0x27D4EB2F & 0xFFFFFFFF), np.uint32)
        for i in range(n):
            code = (code ^ points[i : i + total]) * np.uint32(_SEEDS[i])
            code ^= code >> np.uint32(15)
        if n > 1 and len(ends) > 1:  # n-grams that would cross into the next text
            inside = np.ones(total, bool)
            for i in range(1, n):
                at = ends[:-1] - i
                inside[at[(at >= 0) & (at < total)]] = False
            code = code[inside]
        found.append((code % np.uint32(BUCKETS)).astype(np.int32))
        offsets.append(np.concatenate([[0], np.cumsum(np.maximum(length - n + 1, 0))]))
    return found, offsets


@dataclass
class LanguageModel:
    """Languages in name order, log probability of each bucket, log prior."""

    langs: list[str]
    table: np.ndarray
    prior: np.ndarray

    @staticmethod
    def from_counts(langs: list[str], counts: np.ndarray, docs: np.ndarray) -> LanguageModel:
        smooth = counts + SMOOTHING
        table = np.log(smooth) - np.log(smooth.sum(axis=1, keepdims=True))
        return LanguageModel(langs, table, np.log(docs / max(1, docs.sum())))

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        """The likeliest language of each text and its share of the probability.

        Ties go to the first name. Without a letter: ``und`` with score 0.
        """
        grams, offsets = gram_buckets(texts)
        scores = np.zeros((len(texts), len(self.langs)))
        for codes, ends in zip(grams, offsets):
            for j in range(len(self.langs)):
                scores[:, j] += sum_by(self.table[j][codes], ends)
        scores += self.prior
        scores = np.exp(scores - scores.max(axis=1, keepdims=True))
        scores /= scores.sum(axis=1, keepdims=True)
        best = scores.argmax(axis=1)
        letters = np.array([bool(_LETTER.search(t)) for t in texts], bool)
        names = [self.langs[b] if ok else "und" for b, ok in zip(best, letters)]
        return names, np.where(letters, scores[np.arange(len(best)), best], 0.0)


def fit(docs: DataFrame, where: Column, text_col: str = "text", lang_col: str = "lang") -> LanguageModel | None:
    """A model from all rows that ``where`` lets through and whose language is not null.

    Null texts count as documents without n-grams. None if no row is left.
    """
    schema = "lang string, chunk int, counts array<long>, docs long"
    own = pa.schema([("lang", pa.string()), ("chunk", pa.int32()), ("counts", pa.list_(pa.int64())), ("docs", pa.int64())])

    def count(batches):
        totals: dict[str, np.ndarray] = {}
        seen: dict[str, int] = {}
        for batch in slices(batches):
            langs = np.array(batch.column("lang").to_pylist(), object)
            texts = np.array(texts_of(batch).to_pylist(), object)
            for lang in sorted(set(langs)):
                mine = texts[langs == lang]
                if lang not in totals and len(totals) >= MAX_LANGS:
                    raise ValueError(f"more than {MAX_LANGS} languages")
                held = totals.setdefault(lang, np.zeros(BUCKETS, np.int64))
                seen[lang] = seen.get(lang, 0) + len(mine)
                for codes in gram_buckets(list(mine))[0]:
                    held += np.bincount(codes, minlength=BUCKETS)
        for lang, held in totals.items():
            for c in range(BUCKETS // _CHUNK):
                part = held[c * _CHUNK : (c + 1) * _CHUNK]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang]), pa.array([c], pa.int32()), pa.array([part], own.field(2).type), pa.array([seen[lang] if c == 0 else 0])],
                    schema=own,
                )

    def add(table):
        held = np.zeros(_CHUNK, np.int64)
        for batch in table.to_batches():
            held += batch.column("counts").flatten().to_numpy().reshape(-1, _CHUNK).sum(axis=0)
        first = table.slice(0, 1)
        return pa.Table.from_arrays(
            [first.column("lang"), first.column("chunk"), pa.array([held], own.field(2).type), pa.array([sum(table.column("docs").to_pylist())])],
            schema=own,
        )

    read = docs.where(where & F.col(lang_col).isNotNull()).select(
        F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang")
    )
    summed = read.mapInArrow(count, schema).groupBy("lang", "chunk").applyInArrow(add, schema)
    found = summed.toArrow()
    langs = sorted(set(found.column("lang").to_pylist()))
    if not langs:
        return None
    if len(langs) > MAX_LANGS:
        raise ValueError(f"more than {MAX_LANGS} languages")
    counts, ndocs = np.zeros((len(langs), BUCKETS)), np.zeros(len(langs))
    for lang, chunk, part, n in zip(*(found.column(c).to_pylist() for c in ("lang", "chunk", "counts", "docs"))):
        i = langs.index(lang)
        counts[i, chunk * _CHUNK : (chunk + 1) * _CHUNK] = part
        ndocs[i] += n
    return LanguageModel.from_counts(langs, counts, ndocs)


def identify(docs: DataFrame, model: LanguageModel | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, lang_pred, score`` for every row, from its whole text alone.

    Null and letterless texts are ``und`` with score 0, and so is every text if
    there is no model. Repeated rows and further columns change nothing.
    """
    own = pa.schema([("doc_id", pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64())])
    parts = (model.langs, model.table, model.prior) if model else None
    shared = docs.sparkSession.sparkContext.broadcast(parts)

    def score(batches):
        parts = shared.value
        held = LanguageModel(*parts) if parts else None
        for batch in slices(batches):
            texts = texts_of(batch).to_pylist()
            names, scores = held.predict(texts) if held else (["und"] * len(texts), np.zeros(len(texts)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(names, pa.string()), pa.array(scores)], schema=own)

    narrow = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    return narrow.mapInArrow(score, "doc_id long, lang_pred string, score double")
