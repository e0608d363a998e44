"""The other operators against plain versions on small fixtures, with edge cases."""

import hashlib
import random
from collections import Counter, defaultdict
from itertools import combinations_with_replacement

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
import sentencepiece
from gaugeline.llm import (
    exact_dedup, language_id, packing, pieces, quality_model, quality_rules, signature_join, substrings,
)
from gaugeline.llm import queries as Q
from oracle_check import compare, connect
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"
ODD = [(1, None), (2, ""), (2, ""), (None, None), (None, "a b c"), (3, "x" * 150_000), (4, " \n\t "), (5, "a b c"), (5, "d e f")]


@pytest.mark.parametrize("name", sorted(Q.ORACLES))
def test_same_rows_as_sql(spark, name):
    rows, wanted, differ, schema = compare(Q.QUERIES[name](spark, SF), connect(SF), Q.ORACLES[name])
    assert (rows, differ, schema) == (wanted, 0, "")


def words(text):
    return (text or "").encode().split()


# -- exact dedup ------------------------------------------------------------


def test_index_inserts_deletes_and_grows(spark):
    digest = lambda i: bytearray(hashlib.sha256(str(i).encode()).digest())
    batch = lambda ids: spark.createDataFrame([(digest(i), i, 1, 1) for i in ids], "digest binary, keep_id long, keep_len long, group_size long")
    index = exact_dedup.CuckooIndex.create(spark, 100).insert(batch(range(100)))
    index = index.insert(batch(range(50, 3000)))  # far over the first filter's room
    found = {r.keep_id: r.group_size for r in index.entries().collect()}
    assert len(found) == 3000 and all(found[i] == (2 if 50 <= i < 100 else 1) for i in found)
    index = index.delete(batch([*range(1000), 9999])).insert(batch([7]))
    live = index.lookup(batch(range(3000))).collect()
    assert sorted(r.keep_id for r in live) == [7, *range(1000, 3000)]
    assert index.resized(10**6).shards == 10 and index.resized(10**6).entries().count() == 2001


def test_filter_never_misses():
    draw = np.random.default_rng(1)
    digests = np.frombuffer(draw.bytes(32 * 50_000), "S32")
    held = exact_dedup.CuckooFilter.of(digests)
    assert held.contains(digests).all()
    assert held.contains(np.frombuffer(draw.bytes(32 * 50_000), "S32")).mean() < 0.01
    held.delete(digests[:100])
    assert held.contains(digests[100:]).all()


def test_exact_dedup_edges(make_docs):
    docs = make_docs(ODD).withColumnRenamed("lang", "digest").withColumnRenamed("source", "kept")
    got = sorted((r.doc_id or -1, r.keep_id, r.group_size, r.kept) for r in exact_dedup.exact_dedup(docs).collect())
    # The longest of the blank texts stays, then the smallest id; a null id only where there is no other.
    assert got == [
        (-1, 4, 5, False), (-1, 5, 2, False), (1, 4, 5, False), (2, 4, 5, False), (2, 4, 5, False),
        (3, 3, 1, True), (4, 4, 5, True), (5, 5, 1, True), (5, 5, 2, True),
    ]
    assert exact_dedup.exact_dedup(make_docs([])).count() == 0


# -- packing ----------------------------------------------------------------


def test_boundaries_are_optimal():
    draw = random.Random(3)
    for _ in range(40):
        lengths = sorted(draw.choices(range(1, 30), k=draw.randint(1, 25)))
        count = Counter(lengths)
        at = np.array(sorted(count))
        ends = packing.choose_boundaries(at, np.array([count[x] for x in at]), np.array([x * count[x] for x in at]), 3)
        pad = lambda ends: sum(min(e for e in ends if e >= x) - x for x in lengths)
        best = min(pad({*e, lengths[-1]}) for e in combinations_with_replacement(at.tolist(), 2))
        assert len(ends) <= 3 and ends[-1] == lengths[-1] and pad(ends) == best


def test_batches(make_docs):
    draw = random.Random(4)
    rows = [(i % 150, " ".join(["w"] * draw.randint(0, 400))) for i in range(200)] + ODD + [(7, "w " * 5000)]
    got = packing.pack(make_docs(rows), buckets=4, budget=1000).toPandas()
    assert sorted(got.n_tokens) == sorted(len(words(t)) for _, t in rows)
    assert (got.n_tokens <= got.bucket_len).all() and got.bucket.nunique() == 4
    for _, batch in got.groupby("batch_id"):
        assert batch.slot.nunique() == len(batch) and batch.bucket.nunique() == 1
        assert len(batch) * batch.bucket_len.iloc[0] <= 1000 or len(batch) == 1
    assert packing.pack(make_docs([])).count() == 0


# -- quality, language ------------------------------------------------------


def test_rules_edges(make_docs):
    good = " ".join(f"word{i}" for i in range(80))
    rows = [(10 + i, good + f" n{i}", "en", "https://Good.org/a", 1) for i in range(30)]
    rows += [(100 + i, "buy $$$ " * 60, "en", "bad.com", 1) for i in range(30)] + [(200, good, None, "http://bad.com:80/x", None)]
    rows += [(300, None, None, None, None), (301, good, None, None, None), (301, good, None, None, None)]
    docs = make_docs(rows).withColumn("n_words", F.lit(1)).withColumn("host", F.lit("x"))
    got = {r.doc_id: r for r in quality_rules.judge_documents(docs).collect()}
    assert {r.host for r in got.values()} == {"good.org", "bad.com", ""}
    assert got[10].kept and got[10].host_verdict == "trusted"
    assert not got[200].kept and not got[200].base_failed and got[200].host_verdict == "rejected"
    assert got[300].base_failed and not got[300].kept and got[301].kept
    kept = quality_rules.keep_documents(docs)
    assert kept.columns == docs.columns and kept.count() == 32
    assert quality_rules.judge_documents(make_docs([])).count() == 0 and quality_rules.keep_documents(make_docs([])).count() == 0


def test_length_does_not_decide_distinct_words(make_docs):
    """A book of clean stretches stays, one that says little more than its first words goes."""
    rng = np.random.default_rng(5)
    book = " ".join(f"word{i}" for i in rng.integers(0, 1500, 120_000))  # a share of 0.0125 over all, 0.35 a stretch
    poor = " ".join(f"word{i}" for i in rng.integers(0, 300, 120_000))
    rows = [(1, book, "en", "watched.org", 1), (2, poor, "en", "watched.org", 1), (3, book + "\n" + poor, "en", "watched.org", 1)]
    got = {r.doc_id: r for r in quality_rules.judge_documents(make_docs(rows)).collect()}
    assert all(r.host_verdict == "watched" and not r.base_failed and r.n_words % 120_000 == 0 for r in got.values())
    stretches = lambda t: sum(len(set(words(t)[i : i + 4000])) for i in range(0, len(words(t)), 4000))
    assert [got[i].n_distinct_words for i in (1, 2, 3)] == [stretches(r[1]) for r in rows]
    assert got[1].kept and not got[2].kept and got[3].kept


def test_machine_equals_all_pairs():
    """The sum-of-squares form is the sum over all pairs, and fitting lowers the loss."""
    texts = pa.array(["Good words stand here", "", "junk ### $$$ junk | junk", "Numbers 12 and 13."])
    ids, x, ends = quality_model.features(texts, np.array([20.0, np.nan, 5.0, 0.0]))
    model = quality_model.FactorisationMachine.fresh()
    model.linear[:] = np.random.default_rng(2).normal(0, 1, quality_model.WIDTH)
    got = model.margin(ids, x, ends)
    for d in range(4):
        i, v = ids[ends[d] : ends[d + 1]], x[ends[d] : ends[d + 1]]
        pairs = sum(model.factors[i[a]] @ model.factors[i[b]] * v[a] * v[b] for a in range(len(i)) for b in range(a))
        assert got[d] == pytest.approx(model.linear[i] @ v + pairs)
    y = np.array([1.0, 0.0, 0.0, 1.0])
    fitted = quality_model.FactorisationMachine.fresh().fit(ids, x, ends, y, epochs=60)
    assert ((fitted.score(ids, x, ends) > 0.5) == y).all()


def test_quality_held_out(spark):
    scored = Q.QUERIES["op5_factorisation_machine"](spark, "/root/testdata/sf0.01").toPandas()
    labels = Q.table(spark, "/root/testdata/sf0.01", "labels").toPandas()
    both = scored.merge(labels, on="doc_id")
    both = both[both.held_out]
    assert len(scored) == 1000 and scored.score.between(0, 1).all()
    assert (both.predicted == both.quality).mean() > 0.93


def test_quality_edges(spark, make_docs):
    docs = make_docs(ODD)
    none = spark.createDataFrame([(1, None)], "doc_id long, quality int")
    model = quality_model.fit(docs, none, F.lit(True))
    assert quality_model.score(docs, model).where("score BETWEEN 0 AND 1").count() == len(ODD)
    one = spark.createDataFrame([(5, 1), (5, 1), (None, 0)], "doc_id long, quality int")
    assert quality_model.score(docs, quality_model.fit(docs, one, F.lit(True))).count() == len(ODD)
    assert quality_model.score(make_docs([]), model).count() == 0


def test_language_against_plain_bayes():
    """Counts and scores of the vectorised form equal a plain one over the same n-grams."""
    draw = random.Random(6)
    texts = ["".join(draw.choices("abcÄé 😀\n1", k=draw.randint(0, 30))) for _ in range(40)]
    grams, offsets = language_id.gram_buckets(texts)
    for t in range(40):
        alone, ends = language_id.gram_buckets([texts[t]])
        for n in range(3):
            mine = grams[n][offsets[n][t] : offsets[n][t + 1]]
            assert mine.tolist() == alone[n].tolist() and len(mine) == max(0, len(texts[t].lower()) + 2 - n)
    counts = np.zeros((2, language_id.BUCKETS))
    for t in range(20):
        for n in range(3):
            np.add.at(counts[t % 2], grams[n][offsets[n][t] : offsets[n][t + 1]], 1)
    model = language_id.LanguageModel.from_counts(["x", "y"], counts, np.array([10.0, 10.0]))
    names, scores = model.predict(texts)
    for t in range(40):
        hits = np.concatenate([grams[n][offsets[n][t] : offsets[n][t + 1]] for n in range(3)])
        logs = np.array([np.log((counts[k][hits] + 0.5) / (counts[k] + 0.5).sum()).sum() for k in range(2)])
        if any(c.isalpha() for c in texts[t]):
            assert names[t] == "xy"[int(logs.argmax())] and 0.5 <= scores[t] <= 1
        else:
            assert names[t] == "und" and scores[t] == 0


def test_language_held_out(spark, make_docs):
    sf = "/root/testdata/sf0.01"
    got = Q.QUERIES["op7_language_id"](spark, sf).toPandas().merge(Q.table(spark, sf, "documents").select("doc_id", "lang").toPandas())
    held = got[got.held_out]
    assert len(got) == 1000 and (held.lang_pred == held.lang).mean() > 0.97
    odd = make_docs([(1, None), (2, "12 ?"), (3, "abc"), (3, "abc")])
    assert language_id.fit(odd.where("false"), F.lit(True)) is None
    assert {r.lang_pred for r in language_id.identify(odd, None).collect()} == {"und"}
    model = language_id.fit(odd, F.lit(True))
    assert sorted((r.doc_id, r.lang_pred) for r in language_id.identify(odd, model).collect()) == [(1, "und"), (2, "und"), (3, "en"), (3, "en")]
    assert language_id.identify(make_docs([]), model).count() == 0


# -- pieces -----------------------------------------------------------------


def test_pieces_equal_the_library(make_docs):
    path = public_tokenizers.path("piece_bpe_32k.model")
    own, data = sentencepiece.SentencePieceProcessor(model_file=path), open(path, "rb").read()
    draw = random.Random(8)
    texts = ["".join(draw.choices(" ▁ab\n\tthé{}\r😀", k=draw.randint(0, 40))) for _ in range(300)] + ["", " ", "   a  ", "▁"]
    rows = [*enumerate(texts), (1000, None), (None, "null id"), (5, texts[5])]
    got = pieces.round_trip(make_docs(rows).withColumnRenamed("lang", "ids"), data).collect()
    assert len(got) == len(rows)
    of = {i: t or "" for i, t in rows}
    for r in got:
        assert r.ids == own.encode(of[r.doc_id]) and r.decoded == own.decode(r.ids)
    coded = pieces.encode_documents(make_docs(rows), data)
    assert Counter(r.text for r in pieces.decode_documents(coded, data).collect()) == Counter(r.decoded for r in got)
    spread = make_docs(rows).repartition(9)
    for way in (pieces.round_trip(spread, data), pieces._text_by_text(spread.select("doc_id", "text"), data)):
        assert Counter((r.doc_id, *r.ids) for r in way.collect()) == Counter((r.doc_id, *r.ids) for r in got)
    empty = make_docs([(1, None), (2, "")])
    assert [list(r.ids) for r in pieces.round_trip(empty, data).collect()] == [[], []]
    assert pieces.chunks_stand_alone(data) and pieces.round_trip(make_docs([]), data).count() == 0


# -- substrings -------------------------------------------------------------


@pytest.mark.parametrize("least, run", [(substrings.MIN_FREQUENT, substrings.SEED), (1, 2)])
def test_substrings_same_as_brute_force(make_docs, monkeypatch, least, run):
    """With ``least`` 1 and short seeds many minimisers are frequent and meet in salted groups first."""
    monkeypatch.setattr(substrings, "MIN_FREQUENT", least)
    monkeypatch.setattr(substrings, "WORD_BYTES", 1 << 16)
    for seed, window in ((1, 6), (2, 9)):
        draw = random.Random(seed)
        base = [draw.choices("abcdefg", k=draw.randint(0, 40)) for _ in range(60)]
        base += [base[draw.randrange(60)][draw.randrange(10) :] + draw.choices("xyz", k=5) for _ in range(40)] + [["a"] * 80] * 3
        rows = [(i // 2 if i % 9 == 0 else i, " ".join(b) + "\n") for i, b in enumerate(base)]
        first = {}
        for i, t in sorted(rows):
            for k in range(len(words(t)) - window + 1):
                first.setdefault(tuple(words(t)[k : k + window]), i)
        want = []
        for i, t in rows:
            ws, gone = words(t), set()
            for k in range(len(ws) - window + 1):
                if first[tuple(ws[k : k + window])] < i:
                    gone |= set(range(k, k + window))
            want.append((i, len(ws), len(gone), b" ".join(w for k, w in enumerate(ws) if k not in gone).decode()))
        got = substrings.remove_repeats(make_docs(rows, 4), window=window, joined=True, seed=run)
        assert sorted((r.doc_id, r.n_words, r.n_removed, r.text) for r in got.collect()) == sorted(want)


def test_frequent_runs_are_thinned():
    """Of equal runs in a salted group the one of the smallest document goes on; the others are decided."""
    small = substrings.small

    def piece(runs):  # (document, first word, words)
        vocab, length = pa.array(sorted({w for _, _, ws in runs for w in ws})), np.array([len(ws) for _, _, ws in runs])
        codes = np.array([vocab.to_pylist().index(w) for _, _, ws in runs for w in ws])
        found, local = substrings.packed_words(vocab, codes)
        doc, at = np.array([d for d, _, _ in runs]), np.array([a for _, a, _ in runs])
        return substrings.pack(*found, local, small(length), doc, doc * 10, small(at))

    runs = substrings._Runs([piece([(7, 2, "abc"), (3, 0, "abcd")]), piece([(5, 4, "abc"), (5, 9, "abc"), (9, 1, "bcd")])])
    (doc, key, begin, end), left = runs.thinned()
    assert [tuple(map(int, x)) for x in zip(doc, key, begin, end)] == [(7, 70, 2, 5)]
    again = substrings._Runs([left])
    assert sorted(zip(again.order.tolist(), again.at.tolist(), again.length.tolist())) == [(3, 0, 4), (5, 4, 3), (5, 9, 3), (9, 1, 3)]
    spelled = ["".join(again.vocab.take(pa.array(again.codes[a : a + n])).to_pylist()) for a, n in zip(again.start, again.length)]
    assert sorted(spelled) == ["abc", "abc", "abcd", "bcd"]


def test_substrings_edges(make_docs):
    passage = " ".join(f"p{i}" for i in range(60))
    rows = [*ODD, (20, "  keep  this\n" + passage + "  and this "), (21, "other " + passage), (None, passage), (22, passage), (22, passage)]
    docs = make_docs(rows).withColumnRenamed("lang", "spans").withColumnRenamed("source", "key")
    got = [(r.doc_id, r.n_removed, r.text) for r in substrings.remove_repeats(docs).collect()]
    assert (20, 0, "  keep  this\n" + passage + "  and this ") in got
    assert (21, 60, "other ") in got and got.count((22, 60, "")) == 2 and (None, 60, "") in got
    assert (1, 0, None) in got and len(got) == len(rows)
    assert substrings.remove_repeats(make_docs([])).count() == 0


# -- near duplicates --------------------------------------------------------


def shingles(text):
    ws = ["".join(chr(c + 32) if 65 <= c <= 90 else chr(c) for c in w) for w in words(text)]
    return {tuple(ws[i : i + 5]) for i in range(len(ws) - 4)} if len(ws) >= 5 else ({tuple(ws)} if ws else set())


def groups_of(rows):
    sets = defaultdict(list)
    for i, t in rows:
        if i is not None:
            sets[i].append(shingles(t))
    label = {i: i for i in sets}
    links = [(a, b) for a in sets for b in sets if a < b and any(x and y and 100 * len(x & y) >= 80 * len(x | y) for x in sets[a] for y in sets[b])]
    changed = True
    while changed:
        changed = False
        for a, b in links:
            low = min(label[a], label[b])
            changed |= label[a] != low or label[b] != low
            label[a] = label[b] = low
    return sorted((i, len(shingles(t)), label.get(i)) for i, t in rows if i is not None)


def near_corpus(seed):
    draw = random.Random(seed)
    vocab = [f"w{i}" for i in range(200)]
    texts = [draw.choices(vocab, k=draw.randint(1, 120)) for _ in range(70)]
    for _ in range(110):
        t = list(draw.choice(texts))
        for _ in range(draw.choice([0, 1, 1, 2, 3])):
            t[draw.randrange(len(t))] = draw.choice(vocab)
        texts.append(t + draw.choices(vocab, k=draw.choice([0, 0, 2, 10])))
    return [(i, " ".join(w.title() if draw.random() < 0.1 else w for w in t)) for i, t in enumerate(texts)]


@pytest.mark.parametrize("seed, chunk", [(1, 2000), (2, 4)])
def test_near_duplicates_same_as_brute_force(make_docs, monkeypatch, seed, chunk):
    """With whole stars and with stars dealt to chunks of four."""
    monkeypatch.setattr(signature_join, "CHUNK", chunk)
    rows = [*near_corpus(seed), (500, None), (501, ""), (502, "one two"), (503, "One  two"), (503, "other text of five words"), (None, "one two")]
    got = signature_join.similar_documents(make_docs(rows, 5).withColumnRenamed("lang", "center")).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got if r.doc_id is not None) == groups_of(rows)
    assert [(r.n_shingles, r.component_id) for r in got if r.doc_id is None] == [(1, None)]
    assert len({r.component_id for r in got}) < len(rows) - 40


def test_trees_lose_no_pair():
    draw = np.random.default_rng(9)
    base = [draw.integers(0, 1 << 62, n).astype(np.uint64) for n in (1, 2, 5, 30, 60, 130, 300)]
    sets = [np.unique(np.concatenate([b[draw.random(len(b)) > 0.1], draw.integers(0, 1 << 62, 1 + len(b) // 20).astype(np.uint64)])) for b in base for _ in range(12)]
    left, right = signature_join.possible_pairs(np.array([len(s) for s in sets]), [signature_join.bitmap(s) for s in sets], 80)
    found = set(zip(left.tolist(), right.tolist()))
    want = {(i, j) for i in range(len(sets)) for j in range(i + 1, len(sets)) if signature_join.linked(sets[i], sets[j], 80)}
    assert want and want <= found and len(found) < len(sets) ** 2 / 4


def test_near_duplicates_empty(make_docs):
    assert signature_join.similar_documents(make_docs([])).count() == 0
    rows = near_corpus(3)
    kept = signature_join.keep_representatives(make_docs(rows))
    assert sorted(r.doc_id for r in kept.collect()) == [i for i, _, c in groups_of(rows) if i == c]
