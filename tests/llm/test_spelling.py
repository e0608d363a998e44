"""Spelling variants against all pairs on small corpora."""

import random
import re
import zlib
from collections import Counter

from gaugeline.llm import spelling


def words_of(rows):
    low = {i: i + 32 for i in range(65, 91)}
    n = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", (text or "").translate(low)):
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            n[run] += 1
    return {w: c for w, c in n.items() if len(w) >= spelling.MIN_LENGTH and c >= spelling.MIN_COUNT}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(rows):
    n = words_of(rows)
    near = {w: [v for v in n if one_edit(w, v)] for w in n}
    form = {}
    for w in n:
        best = min(near[w], key=lambda v: (-n[v], v), default=None)
        if best is not None and n[best] >= 2 * n[w]:
            form[w] = best
    out = []
    for w in n:
        root = w
        while root in form:
            root = form[root]
        out.append((w, form.get(w), root, n[w], len(near[w]), n[form[w]] if w in form else None))
    return sorted(out, key=str)


def grouped(docs):
    return sorted((tuple(r) for r in spelling.variant_groups(docs).select("word", "form", "root", "n", "n_near", "form_n").collect()), key=str)


def test_same_as_all_pairs(make_docs):
    draw = random.Random(11)
    base = ["".join(draw.choices("abcéßÉ×", k=draw.randrange(4, 9))) for _ in range(40)]

    def noisy(w):
        at = draw.randrange(len(w))
        return draw.choice([w, w.upper(), w[:at] + w[at + 1 :], w[:at] + "b" + w[at:], w[:at] + "c" + w[at + 1 :]])

    for trial in range(2):
        rows = [(i if i % 9 else None, " ".join(noisy(draw.choice(base)) + draw.choice(["", ".", "1", "中"]) for _ in range(60))) for i in range(60)]
        rows += [(70, None), (71, ""), (72, "..."), (73, rows[3][1]), (73, rows[3][1])]
        assert grouped(make_docs(rows)) == brute(rows)


def test_long_chain_of_forms_and_ties(make_docs):
    chain = ["aaaaa", "aaaab", "aaabb", "aabbb", "abbbb", "bbbbb"]
    text = " ".join(w for k, w in enumerate(chain) for _ in range(3 * 2**k)) + " zzzzz" * 3 + " zzzzy" * 6 + " zzzyz" * 6
    rows = [(1, text)]
    got = {r[0]: r for r in grouped(make_docs(rows))}
    assert sorted(got.values(), key=str) == brute(rows)
    assert got["aaaaa"][2] == "bbbbb" and got["zzzzz"][1] == "zzzyz"


def test_empty_table_and_clashing_names(make_docs):
    docs = make_docs([(1, "hello hello hello hallo")])
    assert spelling.variant_groups(docs.limit(0)).count() == 0
    assert spelling.variant_groups(docs.withColumn("word", docs.lang).withColumn("n", docs.lang)).count() == 1
