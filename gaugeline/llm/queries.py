"""The registered queries of the subpackage and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable
from pathlib import Path

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeline.llm import (
    exact_dedup, katz, language_id, line_align, packing, personal_data, pieces, quality_model, quality_rules, signature_join, spelling,
    substrings, vector_codes,
)
from gaugeline.llm.common import crc_of
from gaugeline.llm.text_stats import DISTINCT_WINDOW

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

_WORDS = "list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '')"


def query(name: str, sql: str | None = None):
    def add(build):
        QUERIES[name] = build
        if sql is not None:
            ORACLES[name] = sql
        return build

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query(
    "op1_exact_dedup",
    """WITH d AS (
      SELECT doc_id, length(coalesce(text, '')) AS n,
             sha256(regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]', '', 'g')) AS h
      FROM documents)
    SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY h) AS group_size,
           doc_id = first_value(doc_id) OVER w AS kept, h AS text_sha256
    FROM d WINDOW w AS (PARTITION BY h ORDER BY n DESC, doc_id)""",
)
def op1_exact_dedup(spark, sf_dir):
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents"))


_RULES_SQL = f"""WITH d AS (
  SELECT doc_id, lower(coalesce(source, '')) AS host, coalesce(text, '') AS text, {_WORDS} AS words FROM documents),
lines AS (
  SELECT doc_id, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS ls FROM d),
windows AS (
  SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, words[i], words[i + 1], words[i + 2]) AS c
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 1)) AS i FROM d)),
repeats AS (
  SELECT doc_id, count(DISTINCT p) AS n
  FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM windows WHERE c > 1) GROUP BY 1),
s AS (
  SELECT d.doc_id, host, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols, len(ls) AS n_lines,
         len(ls) - len(list_distinct(ls)) AS n_dup_lines, coalesce(n, 0) AS n_repeat_words,
         list_sum(list_transform(range(0, len(words), {DISTINCT_WINDOW}), lambda i: len(list_distinct(words[i + 1 : i + {DISTINCT_WINDOW}])))) AS n_distinct_words
  FROM d JOIN lines USING (doc_id) LEFT JOIN repeats USING (doc_id)),
f AS (
  SELECT *, n_words < {quality_rules.MIN_WORDS} OR 100 * n_repeat_words > 50 * n_words AS base_failed,
         100 * n_symbols > {quality_rules.MAX_SYMBOLS} * n_words OR 100 * n_dup_lines > {quality_rules.MAX_DUP_LINES} * n_lines
         OR 100 * coalesce(n_distinct_words, 0) < {quality_rules.MIN_DISTINCT} * n_words
         OR word_chars < {quality_rules.MIN_WORD_CHARS} * n_words OR word_chars > {quality_rules.MAX_WORD_CHARS} * n_words AS soft_failed
  FROM s),
hosts AS (SELECT host, count(*) AS n, sum((base_failed OR soft_failed)::BIGINT) AS k FROM f GROUP BY 1),
mean AS (SELECT sum(k) / sum(n) AS m FROM hosts),
moments AS (
  SELECT m, sum(n * (k / n - m) * (k / n - m)) / sum(n) - m * (1 - m) * count(*) / sum(n) AS var FROM hosts, mean GROUP BY m),
prior AS (
  SELECT m, CASE WHEN var > 0 THEN least({quality_rules.MAX_WEIGHT}, greatest({quality_rules.MIN_WEIGHT}, m * (1 - m) / var - 1))
         ELSE {quality_rules.MAX_WEIGHT} END AS weight FROM moments),
verdicts AS (
  SELECT host, CASE WHEN rate >= {quality_rules.REJECT_RATE} THEN 'rejected' WHEN rate < {quality_rules.TRUST_RATE} THEN 'trusted'
         ELSE 'watched' END AS host_verdict
  FROM (SELECT host, (k + m * weight) / (n + weight) AS rate FROM hosts, prior))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, host_verdict,
       NOT base_failed AND host_verdict <> 'rejected' AND NOT (host_verdict = 'watched' AND soft_failed) AS kept
FROM f JOIN verdicts USING (host)"""


@query("op4_quality_rules", _RULES_SQL)
def op4_quality_rules(spark, sf_dir):
    return quality_rules.judge_documents(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "host_verdict", "kept",
    )


@query("op7_language_id")
def op7_language_id(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    held_out = crc_of(F.col("doc_id"), 4) == 2
    model = language_id.fit(docs, ~held_out)
    return language_id.identify(docs, model).select(
        "doc_id", held_out.alias("held_out"), "lang_pred", "score"
    )


@query("op10_sentencepiece")
def op10_sentencepiece(spark, sf_dir, model_path=None):
    model = Path(model_path or public_tokenizers.path("piece_bpe_32k.model")).read_bytes()
    coded = pieces.round_trip(table(spark, sf_dir, "documents"), model)
    return coded.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query("op2_length_packing")
def op2_length_packing(spark, sf_dir):
    return packing.pack(table(spark, sf_dir, "documents"))


@query("op5_factorisation_machine")
def op5_factorisation_machine(spark, sf_dir):
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = quality_model.fit(docs, labels, crc_of(F.col("doc_id"), 3) != 1)
    return quality_model.score(docs, model).select(
        "doc_id",
        (crc_of(F.col("doc_id"), 3) == 1).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


@query("op3_line_alignment")
def op3_line_alignment(spark, sf_dir):
    """What is left of every document: its lines with a word, and the hash of its text."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    left = line_align.dedup_lines(docs, drop_emptied=False)
    filled = F.filter(F.split("text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    return left.select(
        "doc_id",
        F.coalesce(F.size(filled), F.lit(0)).cast("bigint").alias("n_lines"),
        F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256"),
    )


@query(
    "op8_super_kmers",
    f"""WITH d AS (SELECT doc_id, {_WORDS} AS words FROM documents),
    windows AS (
      SELECT doc_id, i, md5(array_to_string(words[i : i + 49], ' ')) AS h
      FROM (SELECT doc_id, words, unnest(range(1, len(words) - 48)) AS i FROM d)),
    hits AS (
      SELECT doc_id, i FROM (SELECT *, min(doc_id) OVER (PARTITION BY h) AS first FROM windows) WHERE first < doc_id),
    gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS p FROM hits),
    lost AS (SELECT doc_id, list(p) AS ps FROM gone GROUP BY 1)
    SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(len(ps), 0)::BIGINT AS n_removed,
           sha256(array_to_string(CASE WHEN ps IS NULL THEN words
             ELSE list_filter(words, lambda w, i: NOT list_contains(ps, i)) END, ' ')) AS kept_sha256
    FROM d LEFT JOIN lost USING (doc_id)""",
)
def op8_super_kmers(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return substrings.remove_repeats(docs, joined=True).select(
        "doc_id", "n_words", "n_removed", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256")
    )


@query(
    "op9_signature_trees",
    f"""WITH RECURSIVE d AS (
      SELECT doc_id, {_WORDS.replace("coalesce(text, '')", "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} AS words
      FROM documents),
    s AS (
      SELECT DISTINCT doc_id, md5(array_to_string(words[i : i + 4], ' ')) AS h
      FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 3, 2))) AS i FROM d WHERE len(words) > 0)),
    n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
    links AS (
      SELECT a, b FROM (
        SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y USING (h) WHERE x.doc_id <> y.doc_id GROUP BY 1, 2)
      JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * c >= 80 * (na.n + nb.n - c)),
    reach AS (
      SELECT a AS doc_id, a AS other FROM links
      UNION SELECT r.doc_id, l.b FROM reach r JOIN links l ON l.a = r.other)
    SELECT d.doc_id, coalesce(max(n.n), 0)::BIGINT AS n_shingles, coalesce(min(other), d.doc_id) AS component_id
    FROM d LEFT JOIN n USING (doc_id) LEFT JOIN reach USING (doc_id) GROUP BY d.doc_id""",
)
def op9_signature_trees(spark, sf_dir):
    return signature_join.similar_documents(table(spark, sf_dir, "documents"))


@query("op6_katz_backoff")
def op6_katz_backoff(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    scores, _ = katz.fit_and_score(docs, crc_of(F.col("doc_id"), 10) == 0)
    return scores


_CRC_SQL = """tab AS (
      SELECT list(c ORDER BY i) AS t
      FROM (SELECT i, list_reduce([i] || [0, 0, 0, 0, 0, 0, 0, 0],
                                  lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c
            FROM range(256) r(i)))"""


@query(
    "op13_partenum",
    f"""WITH RECURSIVE {_CRC_SQL},
    found AS (
      SELECT doc_id, unnest(regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-z\\x{{C0}}-\\x{{FF}}]+')) AS run
      FROM documents),
    runs AS (SELECT doc_id, run, count(*) AS c FROM found GROUP BY ALL),
    coded AS (SELECT *, hex(encode(coalesce(doc_id::VARCHAR, '') || ':' || run)) AS x FROM runs),
    hashed AS (
      SELECT run, c, xor(list_reduce(
        [4294967295::BIGINT] || list_transform(range(0, length(x) // 2), lambda i: ('0x' || substr(x, 2 * i + 1, 2))::BIGINT),
        lambda h, b: xor(h >> 8, t[(xor(h, b) & 255) + 1])), 4294967295) AS h
      FROM coded, tab),
    said AS (
      SELECT CASE WHEN h % 97 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, c
      FROM hashed),
    w AS (
      SELECT word, sum(c)::BIGINT AS n FROM said WHERE length(word) >= {spelling.MIN_LENGTH} GROUP BY 1
      HAVING sum(c) >= {spelling.MIN_COUNT}),
    gaps AS (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM w),
    cuts AS (SELECT word, n, i, substr(word, 1, i - 1) AS a, substr(word, i + 1) AS b FROM gaps),
    less AS (SELECT DISTINCT c.word AS long, c.n AS long_n, w.word AS short, w.n AS short_n FROM cuts c JOIN w ON w.word = c.a || c.b),
    near AS (
      SELECT x.word, x.n, y.word AS other, y.n AS other_n FROM cuts x JOIN cuts y ON x.a = y.a AND x.b = y.b AND x.i = y.i
      WHERE x.word <> y.word
      UNION ALL SELECT long, long_n, short, short_n FROM less UNION ALL SELECT short, short_n, long, long_n FROM less),
    best AS (
      SELECT word, count(*) AS n_near, first(other ORDER BY other_n DESC, other) AS top, max(other_n) AS top_n
      FROM near GROUP BY word),
    formed AS (
      SELECT w.word, w.n, coalesce(n_near, 0)::BIGINT AS n_near, CASE WHEN top_n >= 2 * w.n THEN top END AS form,
             CASE WHEN top_n >= 2 * w.n THEN top_n END AS form_n
      FROM w LEFT JOIN best USING (word)),
    path AS (
      SELECT word, word AS at, form AS next FROM formed
      UNION ALL SELECT p.word, f.word, f.form FROM path p JOIN formed f ON f.word = p.next)
    SELECT formed.word, form, path.at AS root, n, n_near, form_n
    FROM formed JOIN path ON path.word = formed.word AND path.next IS NULL""",
)
def op13_partenum(spark, sf_dir):
    return spelling.variant_groups(table(spark, sf_dir, "documents"))


def _lloyd_sql() -> str:
    """Full rescans in every round, in SQL: the rule that the rounds of the operator must keep."""
    near = """a{k} AS MATERIALIZED (
      SELECT vec_id, label, p, v, arg_min(e, d) AS e, min(d) AS d
      FROM (SELECT vec_id, label, x.p, v, e, list_sum(list_transform(list_zip(v, c), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT * 64 + e AS d
            FROM x JOIN b{k} USING (p)) GROUP BY ALL)"""
    mean = """s{k} AS (
      SELECT p, e, i, floor(sum(v[i]) / count(*))::BIGINT AS m FROM a{k}, range(1, 5) r(i) GROUP BY ALL),
    b{n} AS MATERIALIZED (
      SELECT b{k}.p, b{k}.e, coalesce(f.c, b{k}.c) AS c
      FROM b{k} LEFT JOIN (SELECT p, e, list(m ORDER BY i) AS c FROM s{k} GROUP BY ALL) f USING (p, e))"""
    steps = ",\n    ".join(t.format(k=k, n=k + 1) for k in range(vector_codes.ROUNDS) for t in (near, mean))
    last = vector_codes.ROUNDS
    return f"""WITH kept AS (
      SELECT vec_id, label, list_transform(embedding, lambda y: floor(256 * y::DOUBLE)::BIGINT) AS z FROM embeddings
      WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda y: y IS NULL OR isnan(y) OR isinf(y))) = 0),
    x AS MATERIALIZED (SELECT vec_id, label, p, z[4 * p + 1 : 4 * p + 4] AS v FROM kept, range(16) r(p)),
    b0 AS MATERIALIZED (
      SELECT p, e, v AS c FROM x JOIN (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS e FROM kept ORDER BY vec_id LIMIT 64) USING (vec_id)),
    {steps},
    {near.format(k=last)},
    coded AS (
      SELECT vec_id, label, string_agg(printf('%02x', e), '' ORDER BY p) AS code, sum((d - e) // 64)::BIGINT AS error
      FROM a{last} GROUP BY ALL),
    book AS (
      SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, e)) AS h FROM b{last})
    SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error, h AS codebooks_sha256
    FROM coded, book"""


@query("op11_active_lloyd", _lloyd_sql())
def op11_active_lloyd(spark, sf_dir):
    codes, books = vector_codes.compress(table(spark, sf_dir, "embeddings"))
    return vector_codes.with_label_error(codes).select(
        "vec_id", "code", "error", "label_error", F.lit(vector_codes.digest(books)).alias("codebooks_sha256")
    )


@query("op12_bootstrapped_contexts")
def op12_bootstrapped_contexts(spark, sf_dir):
    return personal_data.find_personal_data(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_email", "n_ip", "n_card", "n_phone", F.sha2("base", 256).alias("base_sha256"), "spans"
    )
