"""Line alignment against a plain version that compares with every earlier document."""

from collections import Counter

from gaugeline.llm import line_align as la
from gaugeline.llm.common import NO_ID
from test_line_align import brute, corpus


def same(make_docs, rows):
    got = {r.doc_id: r.text for r in la.dedup_lines(make_docs(rows), drop_emptied=False).collect()}
    assert got == brute(rows)
    return got


def test_every_earlier_document(make_docs, monkeypatch):
    monkeypatch.setattr(la, "RANGE_ROWS", 40)
    same(make_docs, corpus(2))


def test_ranges_grow_in_number_not_in_size(spark, monkeypatch):
    """A line of all documents, more than 1,000 ranges of them, an eighth of them without an id."""
    monkeypatch.setattr(la, "RANGE_ROWS", 2)
    n = 2_400
    rows = [(7, NO_ID if i % 8 == 0 else i, i * 7919 % n) for i in range(n)] + [(9, 1, 7919 % n)]
    posts = spark.createDataFrame(rows, "line long, doc long, key long").repartition(3)
    held = Counter(r["range"] for r in la.in_ranges(posts).collect())
    assert len(held) > 1_000 and max(held.values()) <= 8
    got = sorted(map(tuple, la.numbered(posts).collect()))
    places = sorted({r[1:] for r in rows if r[0] == 7})
    assert got == sorted([*((7, *p, i) for i, p in enumerate(places, 1)), (9, 1, 7919 % n, 1)])


def test_evidence_of_one_pair_from_lines_first_seen_elsewhere(make_docs):
    """Documents 60 and 61 share two lines; each was first seen in another document."""
    one, two = "first shared line of quite a few words here", "second shared line of quite a few words here"
    rows = [(i, f"own line number {i} with some more words in it") for i in range(60)]
    rows[3] = (3, f"{one}\nsomething that only the third has")
    rows[5] = (5, f"{two}\nsomething that only the fifth has")
    rows += [(60, f"{one}\n{two}\ntail sixty"), (61, f"{one}\n{two}\ntail sixty-one")]
    got = same(make_docs, rows)
    assert got[61] == "tail sixty-one" and got[60] == rows[60][1]


def test_near_copy_of_a_document_that_reorders(make_docs):
    """The owner of all lines aligns with few of them; the reordered document takes the rest."""
    lines = [f"line {i} of a document that has a number of words" for i in range(8)]
    back = lines[::-1]
    rows = [(0, "\n".join(lines)), (1, "\n".join(back)), (2, "\n".join([*back, "one more line at the end"]))]
    rows += [(i, f"own line number {i} with some more words in it") for i in range(3, 40)]
    assert same(make_docs, rows)[2] == "one more line at the end"
