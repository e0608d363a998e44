"""SentencePiece encoding and decoding through one table of distinct chunks.

A chunk is a whitespace marker, or a run of them, with what follows up to the
next one. Where no piece of the vocabulary holds a marker after another
character, pieces cannot cross chunks, so a chunk is segmented alike wherever it
stands:

1. texts are cut into slices of ``SLICE_BYTES``; a slice is its distinct chunks,
   numbered by ranges of their hash, and, for every place, the number of its
   chunk, all packed;
2. the chunks of all slices meet in ranges of the hash, where every distinct one
   is segmented once;
3. the ids return to their slice, where places turn numbers into ids.

Chunks and places are read off the texts in one pass each, as writing them down
would cost more disk than reading twice. A slice is named after its place and
its chunks, so should a source give its rows in other slices the second time,
that is an error and no wrong result; write such a source first.

Texts are not shuffled. A chunk travels once for each slice that has it, however
frequent it is; there is a hash range for every ``RANGE_SLICES`` slices' bytes, so that
a range holds about as many chunks as that many slices at any size of the
corpus. A vocabulary whose pieces do cross markers, or that rewrites texts, is
encoded text by text.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeline.llm.common import hash_words, slices, texts_of
from gaugeline.llm.packed import pack, small, unpack, word_arrays, words_from

#: Text bytes of a slice, and slices to one hash range.
SLICE_BYTES = 4 << 20
RANGE_SLICES = 8
#: Chunks that the library segments at a time.
BLOCK_CHUNKS = 20_000
MARK = "▁"
_CHUNK = re.compile(r" +[^ ]*")
_IDS = pa.list_(pa.int32())
_SCHEMA = pa.schema([("doc_id", pa.int64()), ("ids", _IDS), ("decoded", pa.string())])
_PLACES = pa.schema([("slice", pa.string()), ("docs", pa.list_(pa.int64())), ("places", pa.binary())])
_PARTS = pa.schema([("range", pa.int64()), ("slice", pa.string()), ("part", pa.binary())])


def _load(model: bytes):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_proto=model)


def chunks_stand_alone(model: bytes) -> bool:
    """Whether no piece has a marker after another character, and the marks are plain:
    one is put before a text, each space gives one and nothing else changes."""
    own = _load(model)
    pieces = (own.id_to_piece(i) for i in range(own.get_piece_size()))
    plain = all(MARK not in p.lstrip(MARK) for p in pieces)
    probe = "  a  b\n\t c "
    return plain and own.normalize(probe) == MARK + probe.replace(" ", MARK)


def chunks_of(text: str) -> list[str]:
    """A marker stands before every text but an empty one; a literal marker is a space."""
    return _CHUNK.findall(" " + text.replace(MARK, " ")) if text else []


def segment(own, chunks: list[str]) -> list[list[int]]:
    """Ids of chunks. The library adds the first marker itself; a marker alone is its own piece."""
    alone = [own.piece_to_id(MARK)]
    return [alone if c == " " else ids for c, ids in zip(chunks, own.encode([c[1:] for c in chunks], num_threads=1))]


def _cut(batches, ranges: int):
    """For each slice: name, batch, number of chunks by text, codes, distinct chunks and the order
    that numbers them (by hash range, then by bytes), and the ranges in that order."""
    task, number = TaskContext.get(), 0
    partition = task.partitionId() if task else 0
    for batch in slices(batches, "text", SLICE_BYTES):
        # Text by text, so that one text's chunks are Python strings at a time.
        parts = [pa.array(chunks_of(t.as_py()), pa.string()) for t in texts_of(batch)]
        coded = pa.chunked_array(parts, pa.string()).combine_chunks().dictionary_encode()
        at = (hash_words(coded.dictionary) >> np.uint64(32)) * np.uint64(ranges) >> np.uint64(32)
        by_bytes = pc.sort_indices(coded.dictionary).to_numpy()
        order = by_bytes[np.argsort(at[by_bytes], kind="stable")]
        chunks = coded.dictionary.take(pa.array(order))
        name = f"{partition}-{number}-{zlib.crc32(word_arrays(chunks)[1])}"
        yield name, batch, [len(p) for p in parts], coded.indices.to_numpy(), chunks, order, at[order]
        number += 1


def _place_rows(ranges: int):
    """Of every slice: ids of its documents, chunks of each text, chunk number of each place."""

    def rows(batches):
        for name, batch, lengths, codes, chunks, order, _ in _cut(batches, ranges):
            rank = np.empty(len(order), np.int64)
            rank[order] = np.arange(len(order))
            places = pack(small(np.array(lengths, np.int64)), small(rank[codes]))
            docs = pa.ListArray.from_arrays(pa.array([0, batch.num_rows], pa.int32()), batch.column("doc_id"))
            yield pa.RecordBatch.from_arrays([pa.array([name]), docs, pa.array([places], pa.binary())], schema=_PLACES)

    return rows


def _chunk_rows(ranges: int):
    """Of every slice and hash range: the slice's distinct chunks in that range."""

    def rows(batches):
        for name, _, _, _, chunks, _, at in _cut(batches, ranges):
            found, begin = np.unique(at, return_index=True)
            lengths, data = word_arrays(chunks)
            ends = np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)])
            parts = [
                pack(lengths[i:j], data[ends[i] : ends[j]]) for i, j in zip(begin, [*begin[1:], len(at)])
            ]
            yield pa.RecordBatch.from_arrays(
                [pa.array(found.astype(np.int64)), pa.array([name] * len(found), pa.string()), pa.array(parts, pa.binary())],
                schema=_PARTS,
            )

    return rows


def _segment_range(model: bytes):
    """All slices' chunks of one hash range: every distinct chunk is segmented once."""

    def work(table: pa.Table) -> pa.Table:
        chunks, codes, begins = words_from([unpack(p) for p in table.column("part").to_pylist()])
        own, blocks = _load(model), range(0, len(chunks), BLOCK_CHUNKS)
        made = [pa.array(segment(own, chunks.slice(at, BLOCK_CHUNKS).to_pylist()), _IDS) for at in blocks]
        ids = pa.chunked_array(made, _IDS).combine_chunks()
        parts = []
        for i, j in zip(begins[:-1], begins[1:]):
            mine = ids.take(pa.array(codes[i:j]))
            parts.append(pack(small(np.diff(mine.offsets.to_numpy())), small(mine.flatten().to_numpy())))
        return pa.table([table.column("range"), table.column("slice"), pa.array(parts, pa.binary())], schema=_PARTS)

    return work


def _joined_ids(places: bytes, parts: list[bytes]) -> pa.ListArray:
    """The ids of every text of a slice: its places looked up in the ids of its chunks."""
    lengths, codes = (x.astype(np.int64) for x in unpack(places))
    tables = [unpack(p) for p in parts]
    sizes = np.concatenate([np.zeros(0, np.int64), *(t[0].astype(np.int64) for t in tables)])
    flat = np.concatenate([np.zeros(0, np.int32), *(t[1].astype(np.int32) for t in tables)])
    if len(codes) and codes.max() >= len(sizes):
        raise ValueError("the texts came in other slices when read again: write them to a table first")
    starts = np.cumsum(sizes) - sizes
    count = sizes[codes]
    ends = np.concatenate([[0], np.cumsum(count)])
    at = np.repeat(starts[codes] - ends[:-1], count)
    at += np.arange(ends[-1])
    texts = np.concatenate([[0], np.cumsum(lengths)])
    return pa.ListArray.from_arrays(pa.array(ends[texts].astype(np.int32)), pa.array(flat[at]))


def _through_table(narrow: DataFrame, model: bytes) -> DataFrame:
    size = narrow.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    ranges = size // (SLICE_BYTES * RANGE_SLICES) + 1
    columns = "range long, slice string, part binary"
    parts = narrow.mapInArrow(_chunk_rows(ranges), columns)
    back = (
        parts.groupBy("range").applyInArrow(_segment_range(model), columns)
        .groupBy("slice").agg(F.sort_array(F.collect_list(F.struct("range", "part"))).getField("part").alias("parts"))
    )
    # A sort-merge join at every size: neither side is bounded.
    places = narrow.mapInArrow(_place_rows(ranges), "slice string, docs array<long>, places binary")
    whole = places.join(back.hint("merge"), "slice", "left")

    def join_ids(batches):
        own = _load(model)
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1)
                coded = _joined_ids(row.column("places")[0].as_py(), row.column("parts")[0].as_py() or [])
                decoded = [own.decode(ids.as_py()) for ids in coded]
                docs = row.column("docs").flatten()
                yield pa.RecordBatch.from_arrays([docs, coded, pa.array(decoded, pa.string())], schema=_SCHEMA)

    return whole.select("docs", "places", "parts").mapInArrow(join_ids, "doc_id long, ids array<int>, decoded string")


def _text_by_text(narrow: DataFrame, model: bytes) -> DataFrame:
    def code(batches):
        own = _load(model)
        for batch in slices(batches, "text"):
            ids = own.encode(texts_of(batch).to_pylist(), num_threads=1)
            decoded = own.decode(ids, num_threads=1)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(ids, _IDS), pa.array(decoded, pa.string())], schema=_SCHEMA
            )

    return narrow.mapInArrow(code, "doc_id long, ids array<int>, decoded string")


def round_trip(docs: DataFrame, model: bytes, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, ids, decoded`` for every row: its ids, and the text they decode to.

    A null text is an empty one, without ids and with an empty decoded text.
    Rows are independent: repeated rows, null ids and further columns change
    nothing. An empty table gives an empty result.
    """
    narrow = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    return _through_table(narrow, model) if chunks_stand_alone(model) else _text_by_text(narrow, model)


def encode_documents(docs: DataFrame, model: bytes, **columns) -> DataFrame:
    """``doc_id, ids``."""
    return round_trip(docs, model, **columns).select("doc_id", "ids")


def decode_documents(coded: DataFrame, model: bytes) -> DataFrame:
    """``doc_id, text`` from ``doc_id, ids``; null ids decode to an empty text."""
    schema = pa.schema([("doc_id", pa.int64()), ("text", pa.string())])

    def decode(batches):
        import sentencepiece

        own = sentencepiece.SentencePieceProcessor(model_proto=model)
        for batch in batches:
            ids = [x or [] for x in batch.column("ids").to_pylist()]
            texts = own.decode(ids, num_threads=1) if ids else []
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], schema=schema)

    return coded.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("ids").cast("array<int>").alias("ids")).mapInArrow(
        decode, "doc_id long, text string"
    )
