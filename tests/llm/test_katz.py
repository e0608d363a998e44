"""The Katz model against a plain version in dictionaries, and its normalisation."""

import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from gaugeline.llm import katz
from gaugeline.llm.common import crc_of
from pyspark.sql import functions as F


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def words(text):
    for c in "\t\n\v\f\r":
        text = text.replace(c, " ")
    return [w for w in text.split(" ") if w]


def brute(rows):
    held = [zlib.crc32(str(i).encode() if i is not None else b"") % 10 == 0 for i, _ in rows]
    tokens = [[*words(lower(t)), katz.END] for _, t in rows]
    uni, bi, ctx = Counter(), Counter(), Counter()
    for h, ts in zip(held, tokens):
        if not h:
            uni.update(ts)
            bi.update(zip([katz.START, *ts], ts))
            ctx.update([katz.START, *ts[:-1]])
    n, v = sum(uni.values()), len(uni)
    classes = lambda c: [sum(x == r for x in c.values()) for r in range(1, katz.K + 2)]
    low1, low2 = katz.discounts(classes(uni)), katz.discounts(classes(bi))
    cut = lambda r, low: low[r - 1] if r <= katz.K else r - katz.HIGH
    p1 = {w: cut(c, low1) / n for w, c in uni.items()}
    rest = 1 - math.fsum(p1.values()) if n else 1.0
    seen = defaultdict(list)
    for (a, b), r in bi.items():
        seen[a].append((b, r))
    alpha = {
        a: (1 - math.fsum(cut(r, low2) for _, r in s) / ctx[a]) / (1 - math.fsum(p1[b] for b, _ in s)) for a, s in seen.items()
    }
    out = []
    for (i, _), h, ts in zip(rows, held, tokens):
        score = 0.0
        for a, b in zip([katz.START, *ts], ts):
            if bi[a, b]:
                score += math.log10(cut(bi[a, b], low2) / ctx[a])
            else:
                score += math.log10(p1.get(b, rest)) + (math.log10(alpha[a]) if a in alpha else 0)
        base = sum(math.log10((uni[t] + 0.1) / (n + 0.1 * (v + 1))) for t in ts)
        out.append((i, h, len(ts), sum(uni[t] > 0 for t in ts), n, base, score))
    return out


def corpus(seed, n=300):
    draw = random.Random(seed)
    vocab = ["".join(draw.choices("abcdeéß", k=draw.randint(1, 6))) for _ in range(400)]
    pick = lambda: vocab[min(int(draw.expovariate(0.02)), 399)]
    texts = [draw.choice([" ", "\n", "  "]).join(pick().title() for _ in range(draw.randint(0, 60))) for _ in range(n)]
    texts += ["of the " * 400, "of the " * 300, "the", "", None, "Of THE\t\vthe", "x" * 100_000]
    return list(enumerate(texts))


def close(got, want):
    assert [g[:5] for g in got] == [w[:5] for w in want]
    for g, w in zip(got, want):
        assert g[5] == pytest.approx(w[5], rel=1e-6, abs=1e-5) and g[6] == pytest.approx(w[6], rel=1e-6, abs=1e-5)


@pytest.mark.parametrize("seed, frequent", [(1, 64), (2, 3), (3, 10**9)])
def test_same_as_brute_force(make_docs, monkeypatch, seed, frequent):
    """With many, few and no frequent words and hot pairs."""
    monkeypatch.setattr(katz, "MIN_FREQUENT", frequent)
    rows = corpus(seed)
    docs = make_docs(rows, 5).withColumnRenamed("source", "block")
    scores, _ = katz.fit_and_score(docs, crc_of(F.col("doc_id"), 10) == 0)
    close(sorted(map(tuple, scores.collect())), brute(rows))


def test_probabilities_sum_to_one(make_docs):
    rows = corpus(4)
    _, model = katz.fit_and_score(make_docs(rows), crc_of(F.col("doc_id"), 10) == 0)
    uni = {r.word: r["count"] for r in model.unigrams.collect()}
    p1 = {w: 10 ** float(model.words.log_p(np.array([c]))[0]) for w, c in uni.items()}
    assert math.fsum(p1.values()) + model.words.unknown == pytest.approx(1, abs=1e-12)
    pairs = defaultdict(dict)
    for r in model.bigrams().collect():
        pairs[r.context][r.word] = r["count"]
    contexts = {r.context: r for r in model.contexts().collect()}
    assert set(contexts) == set(pairs)
    for v, seen in pairs.items():
        assert sum(seen.values()) == contexts[v]["count"]
        kept = sum(float(katz.discounted(np.array([r]), model.low)[0]) for r in seen.values()) / contexts[v]["count"]
        backed = 10 ** contexts[v].log_alpha * (1 - math.fsum(p1[w] for w in seen))
        assert kept + backed == pytest.approx(1, abs=1e-9)


def test_edges(make_docs):
    same = [(1, "a b"), (1, "a b"), (None, "a c"), (None, None)]
    docs = make_docs(same)
    scores, _ = katz.fit_and_score(docs, F.lit(False))
    assert sorted((r.doc_id or -1, r.n_tokens) for r in scores.collect()) == [(-1, 1), (-1, 3), (1, 3), (1, 3)]
    nothing, _ = katz.fit_and_score(docs, F.lit(True))
    assert {(r.score, r.base_score, r.n_known, r.train_tokens) for r in nothing.collect()} == {(0.0, 0.0, 0, 0)}
    assert katz.fit_and_score(make_docs([]), F.lit(False))[0].count() == 0
