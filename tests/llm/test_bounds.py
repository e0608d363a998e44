"""Bounds that hold for repeated keys, results that do not depend on length, workers without the package."""

import hashlib
import random
import subprocess
import sys
from collections import defaultdict
from pathlib import Path

import numpy as np
import pytest
from gaugeline.llm import exact_dedup, language_id, packing, quality_model
from pyspark.sql import functions as F

WHITE = "\x20\x09\x0a\x0b\x0c\x0d"


def groups(rows):
    held = defaultdict(list)
    for i, t in rows:
        held["".join(c for c in t or "" if c not in WHITE)].append((-len(t or ""), i))
    return {hashlib.sha256(k.encode()).hexdigest(): (min(v)[1], len(v)) for k, v in held.items()}


def entries(index):
    return {bytes(r.digest).hex(): (r.keep_id, r.group_size) for r in index.entries().collect()}


def test_index_against_brute_force_over_documents(spark, make_docs, monkeypatch):
    """Four inserts meet live digests, a delete takes a third out, an insert overflows the filters."""
    monkeypatch.setattr(exact_dedup, "SHARD_KEYS", 50)
    draw = random.Random(8)
    texts = [f"text {k} " + "x" * (k % 5) for k in range(120)]
    rows = [(i, draw.choice(texts).replace(" ", " " * draw.randint(1, 3))) for i in range(900)]
    grown, seen = None, []
    for part in (rows[:200], rows[200:210], rows[210:600], rows[600:]):
        marks = exact_dedup.fingerprints(make_docs(part, 4))
        grown = (grown or exact_dedup.CuckooIndex.create(spark, 120)).insert(exact_dedup.map_groups(marks))
        seen += part
        assert entries(grown) == groups(seen)
    gone = [t for t in texts[::3]]
    left = grown.delete(exact_dedup.fingerprints(make_docs(list(enumerate(gone)))))
    out = set(groups(list(enumerate(gone))))
    assert entries(left) == {k: v for k, v in groups(rows).items() if k not in out}
    many = [(5000 + i, f"new {i}") for i in range(3000)]
    over = left.insert(exact_dedup.map_groups(exact_dedup.fingerprints(make_docs(many))))
    assert entries(over) == {k: v for k, v in groups(rows).items() if k not in out} | groups(many)
    asked = exact_dedup.fingerprints(make_docs([(1, gone[0]), (2, "new 7"), (3, "never"), (4, " new  7")]))
    assert sorted(r.doc_id for r in over.lookup(asked).collect()) == [2, 4]


def test_one_digest_in_many_rows_of_one_insert():
    draw = random.Random(1)
    digests = np.frombuffer(b"".join(hashlib.sha256(str(draw.randrange(40)).encode()).digest() for _ in range(500)), "S32")
    values = np.array([[draw.randrange(1000) for _ in digests], [draw.randrange(4) for _ in digests], [1] * 500])
    shard = exact_dedup._Shard(np.zeros(0, "S32"), np.zeros((3, 0), np.int64), exact_dedup.CuckooFilter(1))
    shard.insert(digests, values)
    want = {}
    for d, keep, length in zip(digests.tolist(), *values[:2].tolist()):
        best, n = want.get(d, ((9, 0), 0))
        want[d] = (min(best, (-length, keep)), n + 1)
    assert {d: ((-v[1], v[0]), v[2]) for d, v in zip(shard.digests.tolist(), shard.values.T.tolist())} == want


def test_deleting_in_batches_empties_the_filter():
    digests = np.frombuffer(np.random.default_rng(3).bytes(32 * 20_000), "S32")
    held = exact_dedup.CuckooFilter.of(digests)
    held.delete(digests)
    assert not held.table.any()


def test_plain_naive_bayes_for_long_texts_and_unequal_priors(make_docs):
    """The prediction is the plain posterior, however long a text is."""
    draw = random.Random(6)
    word = {"aa": "abcde", "bb": "cdefg", "cc": "defgh"}
    text = lambda lang, n: " ".join("".join(draw.choices(word[lang], k=4)) for _ in range(n))
    rows = [(i, text(lang, draw.randint(1, 400)), lang, "s", 0) for i, lang in enumerate(["aa"] * 150 + ["bb"] * 8 + ["cc"] * 2)]
    rows += [(1000 + i, " ".join(text(draw.choice("abc") * 2, 30) for _ in range(draw.randint(1, 12))), None, "s", 0) for i in range(60)]
    docs = make_docs(rows)
    model = language_id.fit(docs, F.lit(True))
    got = {r.doc_id: (r.lang_pred, r.score) for r in language_id.identify(docs, model).collect()}
    for i, t, *_ in rows:
        codes, _ = language_id.gram_buckets([t])
        total = [float(model.prior[j]) + sum(float(model.table[j][c].sum()) for c in codes) for j in range(3)]
        share = np.exp(np.array(total) - max(total))
        assert got[i][0] == model.langs[int(np.argmax(total))]
        assert got[i][1] == pytest.approx(share.max() / share.sum(), rel=1e-6)


def test_rows_of_one_id_do_not_raise_the_sample(spark, make_docs, monkeypatch):
    fitted = []
    monkeypatch.setattr(quality_model.FactorisationMachine, "fit", lambda self, ids, x, ends, y: fitted.append(len(y)) or self)
    docs = make_docs([(1, f"some text number {i}") for i in range(3000)])
    labels = spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, quality int")
    quality_model.fit(docs, labels, F.lit(True), sample=1)
    assert fitted in ([1], [])


def test_rows_alike_in_everything_are_dealt_to_shards(make_docs, monkeypatch):
    monkeypatch.setattr(packing, "SHARD_DOCS", 100)
    docs = make_docs([(None, "one two three")] * 3000 + [(7, "one two three")] * 3000)
    packed = packing.pack(docs)
    shards = packed.groupBy(F.split("batch_id", "-")[1].alias("s")).count().collect()
    assert sum(r["count"] for r in shards) == 6000 and max(r["count"] for r in shards) < 300
    assert packed.select("batch_id", "slot").distinct().count() == 6000


def test_language_model_needs_no_package_on_the_workers(tmp_path):
    """The driver alone has the package, as on a cluster: it is put on the path after Python has started."""
    root = Path(__file__).resolve().parents[2]
    code = f"""
import sys
sys.path.insert(0, {str(root)!r})
from gaugeline import build_session
from gaugeline.llm import katz
from pyspark.sql import functions as F
spark = build_session('t', 'local[2]', spark__ui__enabled='false', spark__sql__shuffle__partitions='2')
docs = spark.createDataFrame([(1, 'a b a b c'), (2, 'a b d')], 'doc_id long, text string')
scores, _ = katz.fit_and_score(docs, F.col('doc_id') == 2)
print('rows', scores.count())
"""
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, timeout=300)
    assert "rows 2" in done.stdout, done.stderr[-2000:]
