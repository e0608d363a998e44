"""Packed byte strings: several NumPy arrays and a list of distinct words in one compressed value."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

_TYPES = "BHIQlqdf"


def small(values: np.ndarray) -> np.ndarray:
    """Non-negative integers in the narrowest unsigned type that holds them."""
    top = int(values.max()) if len(values) else 0
    return values.astype(np.uint8 if top < 1 << 8 else np.uint16 if top < 1 << 16 else np.uint32 if top < 1 << 32 else np.uint64)


def pack(*arrays: np.ndarray, level: int = 3) -> bytes:
    import zstandard

    head = np.array([[_TYPES.index(a.dtype.char if a.dtype.char != "L" else "Q"), len(a)] for a in arrays], np.int64)
    body = b"".join([np.int64(len(arrays)).tobytes(), head.tobytes(), *(np.ascontiguousarray(a).tobytes() for a in arrays)])
    return zstandard.ZstdCompressor(level=level).compress(body)


def unpack(data: bytes) -> list[np.ndarray]:
    import zstandard

    body = zstandard.ZstdDecompressor().decompress(data)
    count = int(np.frombuffer(body, np.int64, 1)[0])
    head = np.frombuffer(body, np.int64, 2 * count, 8).reshape(count, 2)
    at, out = 8 + 16 * count, []
    for kind, length in head:
        made = np.frombuffer(body, np.dtype(_TYPES[kind]), int(length), at)
        out.append(made)
        at += made.nbytes
    return out


def word_arrays(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Byte lengths and bytes of words, for ``pack``."""
    offsets = np.frombuffer(words.buffers()[1], np.int32)[words.offset : words.offset + len(words) + 1] if len(words) else np.zeros(1, np.int32)
    data = np.frombuffer(words.buffers()[2], np.uint8)[offsets[0] : offsets[-1]] if len(words) and offsets[-1] > offsets[0] else np.zeros(0, np.uint8)
    return small(np.diff(offsets)), data


def words_from(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """One dictionary for several packed word lists: distinct words, the code of
    each listed word, and where each list begins among those codes."""
    length = np.concatenate([p[0].astype(np.int64) for p in parts]) if parts else np.zeros(0, np.int64)
    data = np.concatenate([p[1] for p in parts]) if parts else np.zeros(0, np.uint8)
    offsets = np.concatenate([[0], np.cumsum(length)])
    held = pa.LargeStringArray.from_buffers(len(length), pa.py_buffer(offsets), pa.py_buffer(data.tobytes()))
    coded = held.dictionary_encode()
    begins = np.concatenate([[0], np.cumsum([len(p[0]) for p in parts])]).astype(np.int64)
    return coded.dictionary, coded.indices.to_numpy().astype(np.int64), begins
