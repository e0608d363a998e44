"""Vector codes: full rescans as brute force, and the cases SQL over the given tables does not have."""

import math
import random

import numpy as np
from gaugeline.llm import vector_codes as vc


def plain(rows, parts, entries, rounds):
    """Codes, errors and codebooks by comparing everything with everything."""
    good = [r for r in rows if r[1] and len(r[1]) % parts == 0 and all(x is not None and math.isfinite(x) for x in r[1])]
    good.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    good = [r for r in good if len(r[1]) == len(good[0][1])]
    whole = [[math.floor(256 * float(np.float32(x))) for x in r[1]] for r in good]
    width = len(whole[0]) // parts
    cut = [[tuple(v[p * width : (p + 1) * width]) for p in range(parts)] for v in whole]
    books = [[v[p] for v in cut[:entries]] for p in range(parts)]
    away = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    for left in range(rounds, -1, -1):
        codes = [[min(range(len(books[p])), key=lambda e: (away(v[p], books[p][e]), e)) for p in range(parts)] for v in cut]
        if left:
            for p in range(parts):
                for e in range(len(books[p])):
                    own = [v[p] for v, c in zip(cut, codes) if c[p] == e]
                    if own:
                        books[p][e] = tuple(sum(x) // len(own) for x in zip(*own))
    out = [(r[0], bytes(c).hex(), sum(away(v[p], books[p][c[p]]) for p in range(parts))) for r, c, v in zip(good, codes, cut)]
    return sorted(out, key=str), books


def table(spark, rows):
    return spark.createDataFrame([(*r, 9) for r in rows], "vec_id bigint, embedding array<float>, label int, codes int").repartition(3)


def test_same_as_full_rescans(spark):
    draw = random.Random(2)
    for trial in range(3):
        centers = [[draw.choice([-1.0, 0.0, 0.5]) for _ in range(8)] for _ in range(6)]
        rows = [(i, [x + draw.choice([0, 0, 0.25]) for x in draw.choice(centers)], i % 3) for i in range(150)]
        rows += [(3, None, 1), (4, [1.0] * 7 + [None], 1), (5, [math.nan] * 8, 1), (6, [math.inf] * 8, 0), (7, [], 0), (8, [1.0] * 7, 0), (9, [1.0] * 16, 0)]
        rows += [(None, [0.5] * 8, None), (11, rows[11][1], 2), (11, [9.0] * 8, 2)]
        codes, books = vc.compress(table(spark, rows), parts=4, entries=9, rounds=2)
        want, want_books = plain(rows, 4, 9, 2)
        assert sorted(((r.vec_id, r.code, r.error) for r in codes.collect()), key=str) == want
        assert books.tolist() == [[list(e) for e in b] for b in want_books]


def test_moved_entries_only():
    """Fixed parts meet moved entries alone, and a tie goes to the lower index on either side."""
    draw = np.random.default_rng(5)
    for _ in range(300):
        parts = draw.integers(-3, 4, (40, 2)).astype(np.int32)
        book = draw.integers(-3, 4, (6, 2))
        codes, stored = vc.nearest(parts, book)
        moved = draw.random(6) < 0.4
        new = np.where(moved[:, None], draw.integers(-3, 4, (6, 2)), book)
        got, away = vc.reassigned(parts, new, moved, codes, stored)
        want, far = vc.nearest(parts, new)
        assert (got == want).all() and (away == far).all()


def test_few_rows_nulls_and_empty(spark):
    rows = [(2, [0.1, 0.2], 1), (1, [3e9, -3e9], None), (1, [3e9, -3e9], None)]
    codes, books = vc.compress(table(spark, rows), parts=2)
    assert books.shape == (2, 3, 1) and abs(books).max() == vc.LIMIT
    got = vc.with_label_error(codes).collect()
    assert sorted((r.vec_id, r.error, r.label_error) for r in got) == [(1, 0, 0), (1, 0, 0), (2, 0, 0)]
    none, _ = vc.compress(table(spark, rows).limit(0), parts=2)
    assert none.count() == 0 and vc.with_label_error(none).count() == 0


def test_label_error_sums_equal_labels(spark):
    codes = spark.createDataFrame([(1, 7, "00", 5), (2, 7, "01", 6), (3, None, "00", 1), (4, None, "00", 2)], "vec_id bigint, label bigint, code string, error bigint")
    assert sorted((r.vec_id, r.label_error) for r in vc.with_label_error(codes).collect()) == [(1, 11), (2, 11), (3, 3), (4, 3)]
