"""Line dedup by pairwise alignment: patience diff between documents that share rare lines.

1. A document is its sequence of line hashes. Documents with the same sequence
   are one class; only its first document takes part in what follows.
2. Two classes are a pair if the lines they share are rare together: the sum of
   ``ln(classes / classes with the line)`` over all of them is at least
   ``EVIDENCE``. Two documents that share only boilerplate are no pair; a large
   group of near copies is, as it shares many lines.
3. Each pair is aligned with patience diff, and the aligned blocks of common
   lines with at least ``BLOCK_WORDS`` words are deleted from the later document.
   A document loses what any earlier one takes from it.

Pairs that cannot take anything are left out, by two exact bounds:

* Ordered by rarity, both members of a pair have a shared line in their prefix:
  the lines before the rest sums to less than ``EVIDENCE``. Boilerplate alone
  is in no prefix.
* A line is open while it is not deleted and stands in a run of lines of
  ``BLOCK_WORDS`` words that an earlier document has too. A document without
  open lines is done.

The documents with a line in their prefix are numbered in order. Documents that
are not done meet the holders of their prefix lines in rounds, the first of them
and then four times as many in all each time, until all are done or have met all
earlier holders; a round reads only what still waits and the holders it meets. A near copy is done once it has met the few that hold its variants, so
large groups do not make all their pairs. The first copy of everything stays.
Hot lines meet in plain equi-joins, which adaptive execution splits, and are
numbered in ranges of documents.
"""

from __future__ import annotations

import math
from bisect import bisect_left, bisect_right
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeline.llm.common import NO_ID, hand_off, hash_words, mix, slices, sum_by, texts_of

#: Summed rarity, in nats, of the lines that a pair shares.
EVIDENCE = 4.0
#: Words that a deleted block has at least.
BLOCK_WORDS = 8
#: Prefix lines in a range of documents, on average.
RANGE_ROWS = 200_000
_P = "__lines_"


# -- patience diff ----------------------------------------------------------


def _rising(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The longest run of pairs, in order of their first items, whose second items rise."""
    tails: list[int] = []
    ends: list[int] = []
    back = [-1] * len(pairs)
    for k, (_, j) in enumerate(pairs):
        at = bisect_left(tails, j)
        back[k] = ends[at - 1] if at else -1
        tails[at : at + 1] = [j]
        ends[at : at + 1] = [k]
    chain, k = [], ends[-1] if ends else -1
    while k >= 0:
        chain.append(pairs[k])
        k = back[k]
    return chain[::-1]


def patience_diff(a: list[int], b: list[int]) -> list[tuple[int, int]]:
    """Positions ``(i, j)`` of aligned equal items, rising in both.

    Equal heads and tails are aligned first. Between them, items found once on
    either side are anchors, as many as rise in both; the gaps between anchors
    are aligned in the same way. A gap without anchors is left unaligned.
    """
    out: list[tuple[int, int]] = []
    work = [(0, len(a), 0, len(b))]
    while work:
        i, m, j, n = work.pop()
        while i < m and j < n and a[i] == b[j]:
            out.append((i, j))
            i, j = i + 1, j + 1
        while i < m and j < n and a[m - 1] == b[n - 1]:
            m, n = m - 1, n - 1
            out.append((m, n))
        if i == m or j == n:
            continue
        here, there = Counter(a[i:m]), Counter(b[j:n])
        where = {x: k for k, x in enumerate(b[j:n], j) if there[x] == 1}
        anchors = _rising([(k, where[x]) for k, x in enumerate(a[i:m], i) if here[x] == 1 and x in where])
        if not anchors:
            continue
        out += anchors
        for (i0, j0), (i1, j1) in zip([(i - 1, j - 1), *anchors], [*anchors, (m, n)]):
            work.append((i0 + 1, i1, j0 + 1, j1))
    return sorted(out)


def common_blocks(aligned: list[tuple[int, int]]) -> list[list[int]]:
    """Runs of aligned lines that follow each other in both documents, as positions in the first."""
    blocks: list[list[int]] = []
    for k, (i, j) in enumerate(aligned):
        if k and aligned[k - 1] == (i - 1, j - 1):
            blocks[-1].append(i)
        else:
            blocks.append([i])
    return blocks


def lines_to_delete(later: list[int], words: list[int], earlier: list[int], least: int = BLOCK_WORDS) -> list[int]:
    """Positions in ``later`` of the lines in aligned blocks with at least ``least`` words."""
    blocks = common_blocks(patience_diff(later, earlier))
    return [i for block in blocks if sum(words[i] for i in block) >= least for i in block]


def least_runs(words: list[int], least: int) -> set[tuple[int, int]]:
    """Ranges of lines: the shortest from each line on, and up to each line, with ``least`` words.

    Whatever block of ``least`` words a line stands in, one of these ranges lies in
    the block and has the line.
    """
    ends = [0]
    for n in words:
        ends.append(ends[-1] + n)
    out = set()
    for i in range(len(words)):
        stop = bisect_left(ends, ends[i] + least, i + 1)
        if stop < len(ends):
            out.add((i, stop))
        start = bisect_right(ends, ends[i + 1] - least, 0, i + 1) - 1
        if start >= 0:
            out.add((start, i + 1))
    return out


def prefix_lines(lines: list[int], held: list[int], classes: int, evidence: float) -> list[int]:
    """The rarest of the shared ``lines`` (in ``held`` classes each); the others' evidence is too small."""
    left, out = 0.0, []
    for h, x in sorted(zip(held, lines), reverse=True):
        left += math.log(classes / h)
        if left >= evidence - 1e-6:
            out.append(x)
    return out


# -- documents as lines -----------------------------------------------------


def _order(doc_id: Column) -> Column:
    return F.coalesce(doc_id.cast("bigint"), F.lit(NO_ID))


def line_table(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``doc, key, seq, lines, words`` of every row that has a line with a word.

    ``lines`` and ``words`` have an item for each such line in order: the hash of
    the line without white space at its ends, and its number of words. ``key``
    tells texts of one id apart, ``seq`` stands for the whole sequence.
    """
    own = pa.schema([("doc", pa.int64()), ("key", pa.int64()), ("seq", pa.int64()), ("lines", pa.list_(pa.int64())), ("words", pa.list_(pa.int32()))])

    def split(batches):
        for batch in slices(batches):
            lists = pc.split_pattern(texts_of(batch), "\n")
            trimmed = pc.ascii_trim_whitespace(lists.flatten()).dictionary_encode()
            vocab, codes = trimmed.dictionary, trimmed.indices.to_numpy()
            filled = pc.binary_length(vocab).to_numpy() > 0
            count = pc.list_value_length(pc.ascii_split_whitespace(vocab)).to_numpy()
            kept = filled[codes]
            ends = np.concatenate([[0], np.cumsum(kept)])[lists.offsets.to_numpy()]
            codes = codes[kept]
            hashes = hash_words(vocab)[codes]
            place = (np.arange(len(codes)) - np.repeat(ends[:-1], np.diff(ends))).astype(np.uint64)
            seq = sum_by(mix(hashes + mix(place + np.uint64(1))), ends)
            at = pa.array(ends.astype(np.int32))
            made = pa.RecordBatch.from_arrays(
                [
                    batch.column("doc"), batch.column("key"), pa.array(seq.view(np.int64)),
                    pa.ListArray.from_arrays(at, pa.array(hashes.view(np.int64))),
                    pa.ListArray.from_arrays(at, pa.array(count[codes].astype(np.int32))),
                ],
                schema=own,
            )
            yield made.filter(pa.array(np.diff(ends) > 0))

    text = F.col(text_col).cast("string")
    narrow = docs.select(
        _order(F.col(id_col)).alias("doc"), F.xxhash64(F.coalesce(text, F.lit(""))).alias("key"), text.alias("text")
    )
    return narrow.mapInArrow(split, "doc long, key long, seq long, lines array<long>, words array<int>")


def in_ranges(posts: DataFrame) -> DataFrame:
    """``posts`` with the number of their ``range`` of documents, written once so that it stays.

    Ranges grow in number with the posts and not in size; documents without an id
    share one order key and are told apart by ``key``. A document is in one range.
    """
    ranges = posts.count() // RANGE_ROWS + 1
    return hand_off(posts.repartitionByRange(ranges, "doc", "key").withColumn("range", F.spark_partition_id()))


def numbered(posts: DataFrame) -> DataFrame:
    """``line, doc, key, at``: each document's number, from 1, among those with the line.

    Numbers are counted in ranges of documents and summed over ranges, so no task
    numbers all documents of a frequent line.
    """
    place = F.struct("doc", "key")
    posts = in_ranges(posts)
    inner = posts.withColumn("within", F.row_number().over(Window.partitionBy("line", "range").orderBy(place)))
    sizes = posts.groupBy("line", "range").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.partitionBy("line").orderBy("range")) - F.col("n")
    sizes = sizes.select(F.col("line").alias("l"), F.col("range").alias("r"), before.alias("before"))
    both = inner.join(sizes, (F.col("line") == F.col("l")) & (F.col("range") == F.col("r")))
    return both.select("line", "doc", "key", (F.col("before") + F.col("within")).alias("at"))


def aligned_deletions(firsts: DataFrame, classes: int, evidence: float, block_words: int) -> DataFrame:
    """``doc, key, gone``: positions of lines, in one row or more of each class that loses any."""
    spark = firsts.sparkSession
    classes, least = max(classes, 2), max(block_words, 1)
    ids = ["doc", "key"]
    held = firsts.select(*ids, F.explode(F.array_distinct("lines")).alias("line"))
    counts = held.groupBy("line").agg(F.count(F.lit(1)).alias("df")).where(F.col("df") > 1)
    common = (
        held.join(counts, "line").groupBy(*ids)
        .agg(F.collect_list(F.struct("line", "df")).alias("common"), F.sum(F.log(F.lit(float(classes)) / F.col("df"))).alias("most"))
        .where(F.col("most") >= evidence - 1e-6)
    )
    docs = firsts.join(common, ids).select(*ids, "lines", "words", F.col("common.line").alias("shared"), F.col("common.df").alias("held"))
    docs = hand_off(docs)

    def to_runs(batches):
        for batch in batches:
            doc, key, runs, start, stop = [], [], [], [], []
            for d, k, lines, words in zip(*(batch.column(c).to_pylist() for c in ("doc", "key", "lines", "words"))):
                for i, j in least_runs(words, least):
                    doc.append(d), key.append(k), start.append(i), stop.append(j)
                    runs.append(hash(tuple(lines[i:j])))  # of integers: the same in every process
            yield pa.RecordBatch.from_arrays(
                [pa.array(doc, pa.int64()), pa.array(key, pa.int64()), pa.array(runs, pa.int64()), pa.array(start, pa.int32()), pa.array(stop, pa.int32())],
                names=["doc", "key", "run", "start", "stop"],
            )

    me = F.struct(*ids)
    runs = hand_off(docs.select(*ids, "lines", "words").mapInArrow(to_runs, "doc long, key long, run long, start int, stop int"))
    earliest = runs.groupBy("run").agg(F.min(me).alias("first"), F.max(me).alias("last")).where(F.col("first") < F.col("last"))
    spans = F.flatten(F.collect_list(F.sequence(F.col("start"), F.col("stop") - 1)))
    open_lines = hand_off(
        runs.join(earliest, "run").where(F.col("first") < me).groupBy(*ids).agg(F.array_sort(F.array_distinct(spans)).alias("open"))
    )

    def to_prefix(batches):
        for batch in batches:
            doc, key, line = [], [], []
            for d, k, lines, df in zip(*(batch.column(c).to_pylist() for c in ("doc", "key", "shared", "held"))):
                for x in prefix_lines(lines, df, classes, evidence):
                    doc.append(d), key.append(k), line.append(x)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (line, doc, key)], names=["line", "doc", "key"])

    posts = hand_off(docs.select(*ids, "shared", "held").mapInArrow(to_prefix, "line long, doc long, key long"))
    holders = hand_off(numbered(posts))

    def align(batches):
        for batch in batches:
            doc, key, found = [], [], []
            names = ("doc", "key", "lines", "words", "shared", "held", "open", "other")
            for d, k, lines, words, shared, df, still, other in zip(*(batch.column(c).to_pylist() for c in names)):
                there = set(other)
                if not any(lines[i] in there for i in still):
                    continue
                if math.fsum(math.log(classes / h) for x, h in zip(shared, df) if x in there) < evidence:
                    continue
                if gone := lines_to_delete(lines, words, other, block_words):
                    doc.append(d), key.append(k), found.append(gone)
            yield pa.RecordBatch.from_arrays(
                [pa.array(doc, pa.int64()), pa.array(key, pa.int64()), pa.array(found, pa.list_(pa.int32()))], names=["doc", "key", "gone"]
            )

    lost, low, top = [], 1, 1
    waiting = holders
    later = hand_off(docs.join(open_lines.select(*ids), ids, "left_semi"))
    theirs = docs.select(F.col("doc").alias("other_doc"), F.col("key").alias("other_key"), F.col("lines").alias("other"))
    while True:
        waiting = hand_off(waiting.where(F.col("at") > low).join(open_lines.select(*ids), ids, "left_semi"))
        if waiting.isEmpty():
            break
        places = F.sequence(F.lit(low).cast("long"), F.least(F.lit(top).cast("long"), F.col("at") - 1))
        met = holders.where(F.col("at").between(low, top)).select(
            F.col("line").alias("l"), F.col("at").alias("p"), F.col("doc").alias("other_doc"), F.col("key").alias("other_key")
        )
        # Estimates do not see what explode makes: a merge join, or it might be broadcast.
        pairs = waiting.select(*ids, "line", F.explode(places).alias("place")).hint("merge")
        pairs = pairs.join(met, (F.col("line") == F.col("l")) & (F.col("place") == F.col("p")))
        pairs = hand_off(pairs.select(*ids, "other_doc", "other_key").distinct())
        both = pairs.join(later.join(open_lines, ids), ids).join(theirs, ["other_doc", "other_key"])
        found = both.select(*ids, "lines", "words", "shared", "held", "open", "other").mapInArrow(align, "doc long, key long, gone array<int>")
        found = hand_off(found.groupBy(*ids).agg(F.array_distinct(F.flatten(F.collect_list("gone"))).alias("gone")))
        lost.append(found)
        open_lines = open_lines.join(found, ids, "left")
        still = F.array_except("open", F.coalesce("gone", F.array().cast("array<int>")))
        open_lines = hand_off(open_lines.select(*ids, still.alias("open")).where(F.size("open") > 0))
        low, top = top + 1, 4 * top + 3
    out = spark.createDataFrame([], "doc long, key long, gone array<int>") if not lost else lost[0]
    for more in lost[1:]:
        out = out.union(more)
    return out


def deletions(table: DataFrame, evidence: float = EVIDENCE, block_words: int = BLOCK_WORDS) -> DataFrame:
    """``doc, key, gone``: positions of the lines that each document loses."""
    me = F.struct("doc", "key")
    classes = hand_off(table.groupBy("seq").agg(F.min(me).alias("first")))
    firsts = hand_off(
        table.join(classes.select(F.col("seq").alias("s"), "first"), (F.col("seq") == F.col("s")) & (me == F.col("first")))
        .dropDuplicates(["seq"]).select("doc", "key", "seq", "lines", "words")
    )
    found = aligned_deletions(firsts, firsts.count(), evidence, block_words)
    lost = found.groupBy("doc", "key").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("gone")))).alias("gone"))
    # A later document with the same sequence loses all of it, whatever its lines.
    copies = (
        table.join(classes.select(F.col("seq").alias("s"), "first"), F.col("seq") == F.col("s"))
        .where((F.col("first.doc") < F.col("doc")) & (F.aggregate("words", F.lit(0), lambda a, x: a + x) >= block_words))
        .select("doc", "key", F.sequence(F.lit(0), F.size("lines") - 1).alias("gone"))
    )
    same = lost.join(copies.select("doc", "key"), ["doc", "key"], "left_anti")
    return same.unionByName(copies.dropDuplicates(["doc", "key"])).where(F.size("gone") > 0)


def dedup_lines(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", evidence: float = EVIDENCE,
    block_words: int = BLOCK_WORDS, drop_emptied: bool = True,
) -> DataFrame:
    """``docs`` without the lines found in an earlier document's aligned blocks.

    Earlier means a smaller id; documents without an id come last. Documents of
    one id never lose lines to each other, and repeated rows lose the same lines.
    Null and empty texts have no lines and stay as they are. A document that
    loses all its lines is dropped unless ``drop_emptied`` is false (its text is
    then empty). Lines are compared without white space at their ends; other
    lines keep theirs. Further columns pass through.
    """
    gone = hand_off(deletions(hand_off(line_table(docs, id_col, text_col)), evidence, block_words))
    gone = gone.select(F.col("doc").alias(_P + "doc"), F.col("key").alias(_P + "key"), F.col("gone").alias(_P + "gone"))
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    same = (_order(F.col(id_col)) == F.col(_P + "doc")) & (F.xxhash64(text) == F.col(_P + "key"))
    # A sort-merge join at every size: broadcasting depends on how much was deleted, not on the corpus.
    joined = docs.join(gone.hint("merge"), same, "left").drop(_P + "doc", _P + "key")

    names = docs.columns

    def cut(batches):
        for batch in slices(batches, text_col):
            hit = batch.column(_P + "gone")
            texts, emptied = batch.column(text_col).to_pylist(), np.zeros(batch.num_rows, bool)
            for k in np.flatnonzero(hit.is_valid().to_numpy(zero_copy_only=False)):
                lost, at, left, some = set(hit[k].as_py()), 0, [], False
                for line in texts[k].split("\n"):
                    filled = bool(line.strip("\x20\x09\x0a\x0b\x0c\x0d"))
                    if not (filled and at in lost):
                        left.append(line)
                        some |= filled
                    at += filled
                texts[k], emptied[k] = ("\n".join(left) if some else ""), not some
            made = batch.set_column(batch.schema.names.index(text_col), text_col, pa.array(texts, pa.string()))
            made = made.select(names)
            yield made.filter(pa.array(~emptied)) if drop_emptied else made

    return joined.mapInArrow(cut, docs.schema)
