"""The whole pipeline against plain versions of its stages, one after another."""

import corpus_pipeline
from pyspark.sql import functions as F
from gaugeline.llm import queries as Q
from oracle_check import connect
from test_line_align import brute, lines_of
from test_operators import SF, groups_of, words


def test_pipeline_same_as_plain_stages(spark):
    con = connect(SF)
    keep = {r[0] for r in con.execute(f"SELECT doc_id FROM ({Q.ORACLES['op4_quality_rules']}) WHERE kept").fetchall()}
    rows = [r for r in con.execute("SELECT doc_id, text FROM documents ORDER BY 1").fetchall() if r[0] in keep]
    had = {i for i, t in rows if lines_of(t)}
    rows = [(i, t) for i, t in brute(rows).items() if lines_of(t) or i not in had]
    same = {i for i, _, c in groups_of(rows) if i == c}
    rows = [(i, t) for i, t in rows if i in same]
    first = {}
    for i, t in sorted(rows):
        for k in range(len(words(t)) - 49):
            first.setdefault(tuple(words(t)[k : k + 50]), i)
    want = []
    for i, t in rows:
        ws, gone = words(t), set()
        for k in range(len(ws) - 49):
            if first[tuple(ws[k : k + 50])] < i:
                gone |= set(range(k, k + 50))
        if len(gone) < len(ws) or not ws:
            want.append((i, len(ws) - len(gone)))
    got = corpus_pipeline.run(spark, SF).collect()
    assert sorted((r.doc_id, r.n_tokens) for r in got) == sorted(want)
    assert 0 < len(want) < 200 and [n for n, _ in corpus_pipeline.STAGES] == [
        "quality_rules", "line_dedup", "ngram_jaccard_join", "substring_dedup", "packing",
    ]


CLASHING = ["doc", "key", "line", "lines", "words", "range", "host", "n_words", "n_tokens", "bucket", "row", "text_sha256"]


def clean(name, n):
    return "\n".join(" ".join(f"{name}{10 * i + j}" for j in range(10)) for i in range(n))


def test_pipeline_edges(spark, make_docs, tmp_path):
    """Nulls, a very long text, repeated rows, ties and columns named like the stages' own."""
    rows = [
        (1, clean("a", 10), "en", "https://one.org/x", None), (2, clean("a", 10), None, "two.org", 1), (3, clean("b", 12), "en", None, 1),
        (3, clean("b", 12), "en", None, 1), (None, clean("c", 9), None, None, None), (None, clean("a", 10), "en", "one.org", 1),
        (4, None, None, None, None), (5, "", "en", "", 0), (6, " \n\t", "en", "two.org", 3), (7, clean("long", 20_000), "en", "one.org", 1),
        (8, clean("b", 11) + "\n" + clean("d", 30), "en", "two.org", 1),
    ]
    docs = make_docs(rows)
    for i, name in enumerate(CLASHING):
        docs = docs.withColumn(name, F.lit(None if i % 3 == 0 else f"x{i}"))
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, str(tmp_path)).columns == docs.columns, name
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    # Document 8 loses the lines it shares with 3; copies of 1 go whole, with or without an id.
    want = [(1, 100), (3, 120), (3, 120), (None, 90), (7, 200_000), (8, 300)]
    key = lambda p: (p[0] is None, p[0] or 0, p[1])
    assert sorted(((r.doc_id, r.n_tokens) for r in got), key=key) == sorted(want, key=key)


def test_pipeline_of_no_documents(spark, make_docs, tmp_path):
    make_docs([]).write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
