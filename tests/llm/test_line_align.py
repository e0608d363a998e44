"""Line alignment against a plain version over all documents in memory."""

import math
import random
from collections import defaultdict

from gaugeline.llm import line_align as la

WHITE = " \t\n\v\f\r"


def lines_of(text):
    return [x for x in (text or "").split("\n") if x.strip(WHITE)]


def brute(rows):
    """The rules of the module without hashes, joins or partitions: each document is aligned with all earlier ones."""
    seqs = {}
    for i, t in sorted(rows):
        seqs.setdefault(tuple(x.strip(WHITE) for x in lines_of(t)), i)
    seqs.pop((), None)
    held = defaultdict(list)
    for seq, i in seqs.items():
        for x in set(seq):
            held[x].append(i)
    of = {i: seq for seq, i in seqs.items()}
    out = {}
    for i, t in rows:
        seq = tuple(x.strip(WHITE) for x in lines_of(t))
        words, gone = [len(x.split()) for x in seq], set()
        if seq and seqs[seq] < i:
            gone = set(range(len(seq))) if sum(words) >= la.BLOCK_WORDS else gone
        else:
            evidence = defaultdict(float)
            for x in set(seq):
                for p in held[x]:
                    if p < i:
                        evidence[p] += math.log(max(len(seqs), 2) / len(held[x]))
            for p, e in evidence.items():
                if e >= la.EVIDENCE:
                    gone |= set(la.lines_to_delete(list(seq), words, list(of[p])))
        at, left = 0, []
        for line in (t or "").split("\n"):
            filled = bool(line.strip(WHITE))
            if not (filled and at in gone):
                left.append(line)
            at += filled
        out[i] = t if not gone else "\n".join(left) if lines_of("\n".join(left)) else ""
    return out


def corpus(seed):
    draw = random.Random(seed)
    line = lambda: " ".join(draw.choice("abcdefgh") * draw.randint(1, 3) for _ in range(draw.randint(3, 12)))
    texts = ["\n".join(line() for _ in range(draw.randint(1, 9))) for _ in range(90)]
    for _ in range(60):
        base = draw.choice(texts).split("\n")
        for _ in range(draw.randint(0, 3)):
            base.insert(draw.randrange(len(base) + 1), draw.choice([line(), "", "  " + draw.choice(base)]))
        if draw.random() < 0.4:
            base = base[draw.randrange(len(base)) :] + ["all rights reserved by the owner of this very page"]
        texts.append("\n".join(base))
    draw.shuffle(texts)
    return list(enumerate(texts))


def test_same_as_brute_force(make_docs):
    for seed in (1, 2):
        rows = corpus(seed)
        got = {r.doc_id: r.text for r in la.dedup_lines(make_docs(rows), drop_emptied=False).collect()}
        assert got == brute(rows)
        assert sum(got[i] != t for i, t in rows) > 20


def test_patience_diff_is_an_alignment():
    draw = random.Random(5)
    for _ in range(300):
        a = [draw.randrange(8) for _ in range(draw.randrange(12))]
        b = [draw.randrange(8) for _ in range(draw.randrange(12))]
        pairs = la.patience_diff(a, b)
        assert all(a[i] == b[j] for i, j in pairs)
        assert all(x[0] < y[0] and x[1] < y[1] for x, y in zip(pairs, pairs[1:]))
    assert la.patience_diff([1, 2, 3, 9, 4, 5], [1, 2, 3, 8, 4, 5]) == [(0, 0), (1, 1), (2, 2), (4, 4), (5, 5)]


def test_edges(spark, make_docs):
    copy = "one two three four five six seven eight nine ten\nanother line that is long enough to count here"
    rows = [(1, copy), (2, copy), (2, copy), (None, copy), (3, None), (4, ""), (5, " \n\n"), (None, None), (6, "x" * 200_000)]
    docs = make_docs(rows).withColumnRenamed("lang", "gone").withColumnRenamed("source", "key")
    left = la.dedup_lines(docs).collect()
    assert sorted((r.doc_id or -1) for r in left) == [-1, 1, 3, 4, 5, 6]
    assert left[0].asDict().keys() == set(docs.columns)
    assert la.dedup_lines(make_docs([])).count() == 0
