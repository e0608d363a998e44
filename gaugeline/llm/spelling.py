"""Spelling variant grouping with PartEnum signatures over letter multisets.

Words one edit apart have letter multisets that, as binary vectors over (letter,
how often so far), differ in two places at most: a replaced letter moves two, an
inserted one moves one. The letters are dealt to ``PARTS`` parts, so the vectors
agree in all parts but two (words of equal length) or one (lengths that differ by
one). Each word has a signature for every choice of parts left out: the letters
of the others, sorted. Words that share a signature meet in an equi-join, and
only pairs that are one edit apart leave it. Letters are dealt by how often they
occur, so that the parts left out hold about the same number of them.

All of it is DataFrame functions. What is collected is one row per letter (at
most 122, the letters a run may have) and one row per round of following forms.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeline.llm.common import hand_off

#: Parts of the alphabet; a signature leaves one or two of them out.
PARTS = 5
MIN_LENGTH = 5
MIN_COUNT = 3
#: One in so many (document, run) pairs loses a letter.
SLIP_EVERY = 97
_RUN = "[A-Za-zÀ-ÿ]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lower_ascii(run: Column) -> Column:
    """Only A-Z lower-cased. Where no other letter has a case, ``lower`` does it, on bytes."""
    return F.when(run.rlike("[À-Þ]"), F.translate(run, _UPPER, _LOWER)).otherwise(F.lower(run))


def slipped(doc_id: Column, run: Column) -> Column:
    """The run without one code point, if the crc32 of ``<doc_id>:<run>`` is a multiple of ``SLIP_EVERY``."""
    code = F.crc32(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), run))
    at = F.pmod(code, F.length(run)).cast("int")
    cut = F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.length(run)))
    return F.when(code % SLIP_EVERY == 0, cut).otherwise(run)


def corpus_words(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``word, n``: words of ``MIN_LENGTH`` code points or more, found ``MIN_COUNT`` times or more.

    Occurrences are counted per task before they are shuffled.
    """
    runs = docs.select(F.col(doc_id).alias("__id"), F.explode(F.regexp_extract_all(F.col(text), F.lit(_RUN), F.lit(0))).alias("__run"))
    low = runs.select("__id", lower_ascii(F.col("__run")).alias("__run"))
    words = low.select(slipped(F.col("__id"), F.col("__run")).alias("word"))
    counted = words.filter(F.length("word") >= MIN_LENGTH).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counted.filter(F.col("n") >= MIN_COUNT)


def letter_parts(words: DataFrame) -> list[str]:
    """The letters of each part: the most frequent letter first, each to the lightest part."""
    letters = words.select(F.explode(F.split("word", "")).alias("letter")).filter("letter <> ''")
    found = letters.groupBy("letter").count().collect()  # one row per letter of the alphabet
    parts, weight = [""] * PARTS, [0] * PARTS
    for r in sorted(found, key=lambda r: (-r["count"], r["letter"])):
        lightest = weight.index(min(weight))
        parts[lightest] += r["letter"]
        weight[lightest] += r["count"]
    return parts


def _signatures(words: DataFrame, parts: list[str], longer: bool) -> DataFrame:
    """Rows ``key, head, tail, word, n``: a word under each of its signatures.

    Both sides have those for equal lengths, with two parts left out. For lengths
    that differ by one, one part is left out, and the longer side counts as one
    letter shorter. ``head`` and ``tail`` are hashes of the two halves cut where
    the shorter word has its middle: one edit leaves one of them as it was.
    """
    sorted_letters = F.array_join(F.array_sort(F.split("word", "")), "")
    held = [F.translate(sorted_letters, "".join(p for j, p in enumerate(parts) if j != i), "") for i in range(PARTS)]
    base = words.select("word", "n", F.length("word").alias("size"), *(h.alias(f"p{i}") for i, h in enumerate(held)))

    def signature(kind: int, out: tuple[int, ...], less: int) -> Column:
        size = F.col("size") - less
        half = F.floor(size / 2).cast("int")
        kept = [F.col(f"p{i}") for i in range(PARTS) if i not in out]
        return F.struct(
            F.xxhash64(F.lit(kind), size, *kept).alias("key"),
            F.hash(F.substring("word", F.lit(1), half)).alias("head"),
            F.hash(F.substring(F.col("word"), half + 1 + less, F.col("size"))).alias("tail"),
        )

    equal = [signature(k, out, 0) for k, out in enumerate(combinations(range(PARTS), 2))]
    one = [signature(100 + i, (i,), int(longer)) for i in range(PARTS)]
    return base.select("word", "n", F.inline(F.array(*equal, *one)))


def near_pairs(words: DataFrame) -> DataFrame:
    """``a, a_n, b, b_n``: each pair of words one edit apart, once."""
    parts = letter_parts(words)
    left, right = (_signatures(words, parts, longer).alias(side) for side, longer in (("x", False), ("y", True)))
    same_half = (F.col("x.head") == F.col("y.head")) | (F.col("x.tail") == F.col("y.tail"))
    ordered = (F.length("x.word") < F.length("y.word")) | (F.col("x.word") < F.col("y.word"))
    met = left.join(
        right,
        (F.col("x.key") == F.col("y.key")) & same_half & ordered & (F.levenshtein("x.word", "y.word", 1) == 1),
    )
    return met.select(
        F.col("x.word").alias("a"), F.col("x.n").alias("a_n"), F.col("y.word").alias("b"), F.col("y.n").alias("b_n")
    ).distinct()


def _roots(forms: DataFrame) -> DataFrame:
    """``word, root``: where following forms ends. Each round doubles the steps taken.

    A form is at least twice as frequent as its word, so a path has at most
    log2(largest count) steps, and the rounds are at most six for any corpus.
    """
    links = hand_off(forms.select("word", F.col("form").alias("root"), F.lit(True).alias("moved")))
    while not links.filter("moved").isEmpty():
        ahead = links.select(F.col("word").alias("root"), F.col("root").alias("__next"))
        step = links.join(ahead, "root", "left")
        links = hand_off(
            step.select("word", F.coalesce("__next", "root").alias("root"), F.col("__next").isNotNull().alias("moved"))
        )
    return links.select("word", "root")


def variant_groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``word, form, root, n, n_near, form_n`` for every word of the corpus.

    A null text has no words; a null id is hashed as the empty text; repeated
    rows count as often as they stand; ties between near words go to the smaller
    word in code-point order; other columns are not read; an empty table gives no rows.
    """
    words = hand_off(corpus_words(docs, doc_id, text))
    pairs = near_pairs(words)
    both = pairs.select("a", "a_n", "b", "b_n").union(pairs.select("b", "b_n", "a", "a_n"))
    best = F.min(F.struct((-F.col("b_n")).alias("__less"), F.col("b").alias("__form"))).alias("__best")
    near = hand_off(both.groupBy(F.col("a").alias("word")).agg(F.count(F.lit(1)).alias("n_near"), best))
    joined = words.join(near, "word", "left").select("word", "n", "n_near", "__best")
    is_form = -F.col("__best.__less") >= 2 * F.col("n")
    formed = joined.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(is_form, F.col("__best.__form")).alias("form"),
        F.when(is_form, -F.col("__best.__less")).alias("form_n"),
    )
    formed = hand_off(formed)
    roots = _roots(formed.filter(F.col("form").isNotNull()))
    return formed.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
