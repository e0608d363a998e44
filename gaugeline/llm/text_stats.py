"""Counts over the words, lines and characters of whole texts, a batch at a time."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from gaugeline.llm.common import hash_words, ngram_hash, owners, starts_that_fit, sum_by, words_of

SYMBOLS = "[#*$%&|<>]"
#: Words of a stretch in which distinct words are counted, so that a text's length does not decide.
DISTINCT_WINDOW = 4_000


def repeated_window_words(codes: np.ndarray, offsets: np.ndarray, vocab: pa.Array, n: int = 3) -> np.ndarray:
    """Words of each text that lie in an ``n``-word window found twice or more in it."""
    fits = starts_that_fit(offsets, n)
    at = np.flatnonzero(fits)
    covered = np.zeros(len(codes), bool)
    if len(at):
        doc = owners(offsets)[at]
        key = ngram_hash(hash_words(vocab)[codes], n)[at] + doc.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        order = np.argsort(key)
        same = key[order[1:]] == key[order[:-1]]
        maybe = np.zeros(len(at), bool)
        maybe[order[1:][same]] = maybe[order[:-1][same]] = True
        at, doc = at[maybe], doc[maybe]
    if len(at):  # equal hashes are only candidates: compare the words themselves
        windows = np.column_stack([doc, *(codes[at + i] for i in range(n))])
        _, which, found = np.unique(windows, axis=0, return_inverse=True, return_counts=True)
        at = at[found[which.reshape(-1)] > 1]
        for i in range(n):
            covered[at + i] = True
    return sum_by(covered.astype(np.int64), offsets)


def duplicate_lines(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Lines with a word, and those of them equal to an earlier line of the text."""
    lists = pc.split_pattern(texts, "\n")
    flat, offsets = lists.flatten(), lists.offsets.to_numpy().astype(np.int64)
    filled = pc.greater(pc.binary_length(pc.ascii_trim_whitespace(flat)), 0).to_numpy(zero_copy_only=False)
    code = flat.dictionary_encode().indices.to_numpy().astype(np.int64)
    doc = owners(offsets)
    distinct = np.unique((doc * (len(flat) + 1) + code)[filled]) // (len(flat) + 1)
    count = sum_by(filled.astype(np.int64), offsets)
    return count, count - np.bincount(distinct, minlength=len(texts)).astype(np.int64)


def distinct_in_stretches(codes: np.ndarray, offsets: np.ndarray, window: int) -> np.ndarray:
    """Per text: the distinct words of each stretch of ``window`` words (the last may be shorter), summed."""
    n = np.diff(offsets)
    first = np.concatenate([[0], np.cumsum(-(-n // window))])  # stretches before each text
    of = owners(offsets)
    stretch = first[of] + (np.arange(len(codes)) - offsets[:-1][of]) // window
    width = int(codes.max(initial=0)) + 1
    used = np.unique(stretch * width + codes) // width
    return sum_by(np.bincount(used, minlength=int(first[-1])).astype(np.int64), first)


def base_stats(texts: pa.Array) -> dict[str, np.ndarray]:
    """Per text: words, code points in words, symbols, lines, duplicate lines, repeated words, distinct words by stretch."""
    codes, offsets, vocab = words_of(texts)
    lines, repeated = duplicate_lines(texts)
    length = pc.utf8_length(vocab).to_numpy(zero_copy_only=False).astype(np.int64)
    symbols = pc.count_substring_regex(texts, SYMBOLS).to_numpy(zero_copy_only=False)
    return {
        "n_words": np.diff(offsets),
        "word_chars": sum_by(length[codes], offsets),
        "n_symbols": symbols.astype(np.int64),
        "n_lines": lines,
        "n_dup_lines": repeated,
        "n_repeat_words": repeated_window_words(codes, offsets, vocab),
        "n_distinct_words": distinct_in_stretches(codes.astype(np.int64), offsets.astype(np.int64), DISTINCT_WINDOW),
    }
