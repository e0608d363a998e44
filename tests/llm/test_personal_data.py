"""Personal data: base entities against plain patterns, the scored graph against a plain replay."""

import math
import random
import re
from collections import defaultdict

import pytest
from gaugeline.llm import personal_data as pd_

PLAIN = (
    r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    r"[0-9]([\x20-]?[0-9])+",
    r"\+[0-9][\x20().0-9-]+[0-9]",
)


def plain_luhn(number):
    total = 0
    for i, d in enumerate(int(c) for c in reversed(number)):
        total += d if i % 2 == 0 else 2 * d - 9 * (d > 4)
    return total % 10 == 0


def plain_base(text):
    out = []
    for kind, pattern in enumerate(PLAIN):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            ok = (
                True,
                kind == 1 and all(int(p) <= 255 for p in m[0].split(".")),
                14 <= len(digits) <= 19 and plain_luhn(digits),
                10 <= len(digits) <= 15,
            )[kind]
            if ok:
                out.append((m.start(), kind, m.end()))
    return sorted(out)


def test_base_same_as_plain_patterns():
    draw = random.Random(7)
    pieces = ["@", ".", "+", "-", " ", "a", "Z9", "%", "(", ")", "12", "4929348385146306", "255", "0256", "1.2.3.4", "é", "\n", "@b.c", "_x", "+1 (377) 555-0271"]
    for _ in range(20_000):
        text = "".join(draw.choices(pieces, k=draw.randrange(1, 14)))
        assert pd_.base_spans(text) == plain_base(text), text


@pytest.mark.parametrize("text", ["a" * 300_000, "1" * 300_000, "1." * 150_000, "1 " * 150_000 + "x", "@" * 100_000, "a@" * 100_000, "+1(" * 100_000, " at b" * 60_000])
def test_long_texts_take_linear_time(text):
    spans = pd_.base_spans(text)
    assert len(pd_.candidates(text, spans)) < 10 and len(spans) < 100_000


def corpus():
    draw = random.Random(3)
    word = lambda: "".join(draw.choices("abcdefgh", k=5))
    number = lambda: f"{draw.randrange(100, 999)}) 555-{draw.randrange(1000, 9999)}"
    rows = []
    for _ in range(12):  # seeds in a context of their own
        rows.append(f"{word()} please call +1 ({number()} {word()}")
        rows.append(f"{word()} write to {word()}@{word()}.com now {word()}")
    unseen = [f"{word()} please call ({number()} {word()}" for _ in range(4)]
    spelled = [f"{word()} write to {word()} (at) {word()} dot com now" for _ in range(3)]
    clean = [f"{word()} invoice no {draw.randrange(100, 999)}-{draw.randrange(10000, 99999)} {word()}" for _ in range(6)]
    second = [f"{word()} dial ({number()} {word()}" for _ in range(3)]
    chained = [f"{t} and dial {t.split('call ')[1][:14]} {word()}" for t in unseen]
    return list(enumerate([*rows, *unseen, *spelled, *clean, *second, *chained, None, "", rows[0], rows[0]]))


def replay(rows, rounds=pd_.ROUNDS):
    """The documented scores with dictionaries: spans of every document."""
    cells = []
    for i, text in rows:
        base = plain_base(text or "")
        cells += [(i, s, k, e, True, (k, pd_.normalised(k, text[s:e])), pd_.patterns(text, s, e)) for s, k, e in base]
        cells += [(i, s, k, e, False, (k, n), pd_.patterns(text, s, e)) for s, k, e, n in pd_.candidates(text or "", base)]
    edges, holders = {}, defaultdict(set)
    for _, _, _, _, seed, inst, found in cells:
        for p in found:
            edges[p, inst] = edges.get((p, inst), False) or seed
            holders[p].add(inst)
    often = {p for p, held in holders.items() if len(held) >= pd_.SUPPORT and any(edges[p, x] for x in held)}
    score = {}
    for _ in range(rounds):
        taken = {}
        for p in often:
            for kind in {k for k, _ in holders[p]}:
                own = [x for x in holders[p] if x[0] == kind]
                has = sum(1.0 if edges[p, x] else score.get(x, 0.0) for x in own)
                conf = has / (has + len(holders[p]) - len(own) + (len(own) - has) / 2)
                if has >= pd_.SUPPORT and conf >= pd_.CONFIDENCE:
                    taken[p, kind] = conf
        new = {}
        for (p, inst), seed in edges.items():
            if (p, inst[0]) in taken and not seed:
                new[inst] = new.get(inst, 0.0) + math.log(max(1 - taken[p, inst[0]], 1e-9))
        score = {x: 1 - math.exp(v) for x, v in new.items()}
    seeds = {inst for *_, seed, inst, _ in cells if seed}
    out = {i: [] for i, _ in rows}
    for i, s, k, e, seed, inst, _ in cells:
        if seed or inst in seeds or score.get(inst, 0.0) >= pd_.CONFIDENCE:
            out[i].append((s, k, e))
    return {i: pd_.spelled(sorted(v)) for i, v in out.items()}


def test_contexts_find_what_base_misses(make_docs):
    rows = corpus()
    got = {r.doc_id: r for r in pd_.find_personal_data(make_docs(rows)).collect()}
    want = replay(rows)
    assert {i: r.spans for i, r in got.items()} == want
    assert all(r.base == pd_.spelled(plain_base(t or "")) for (i, t) in rows for r in [got[i]])
    texts = dict(rows)
    found = {i for i, r in got.items() if r.spans != r.base}
    assert {i for i, t in rows if t and ("please call (" in t or "(at)" in t)} <= found
    assert not [i for i in found if "invoice" in texts[i]]


def test_edges(spark, make_docs):
    same = make_docs([(None, "mail a@b.c"), (1, None), (1, ""), (1, "x 10.0.0.1 y"), (1, "x 10.0.0.1 y")])
    got = sorted(((r.doc_id, r.spans, r.n_email, r.n_ip) for r in pd_.find_personal_data(same.withColumn("found", same.lang)).collect()), key=str)
    assert got == sorted([(None, "email:5:10", 1, 0), (1, "", 0, 0), (1, "", 0, 0), (1, "ip:2:10", 0, 1), (1, "ip:2:10", 0, 1)], key=str)
    assert pd_.find_personal_data(make_docs([(1, "x")]).limit(0)).count() == 0
