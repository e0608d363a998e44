"""Personal data: fixed patterns find seeds, and bootstrapped contexts find what they miss.

One pass over the texts finds the base entities (four kinds) and candidates:
strings of the shape of a kind that the base patterns do not take, such as a
telephone number without its plus sign or an address with "(at)". Each stands in
up to three lexical patterns, made of the words around it. Spark then scores the
graph of patterns and instances (an instance is a kind and its normalised
string, however often it occurs):

* a pattern's confidence for a kind is P / (P + N + U / 2), where P is the sum of
  the scores of its instances of that kind, N the number of its instances of
  other kinds and U what its instances lack to a score of one; it is taken if P is
  ``SUPPORT`` or more and the confidence ``CONFIDENCE`` or more;
* a base entity has score 1, a candidate 1 - product of (1 - confidence) over
  the patterns taken for its kind.

After ``ROUNDS`` rounds, candidates of a score of ``CONFIDENCE`` or more become
spans, wherever they occur. Texts are read once and never shuffled; the graph
holds only patterns with ``SUPPORT`` instances or more.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeline.llm.common import hand_off, rows, slices, texts_of

KINDS = ("email", "ip", "card", "phone")
ROUNDS = 3
SUPPORT = 3.0
CONFIDENCE = 0.7
#: Code points before and after an entity in which its context words are looked for.
REACH = 60

_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A match can only begin where a run of digits does: the one before it took its run whole.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"(?<![0-9])[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
# Candidates: the shapes in which people write the same things by other rules.
_SPELLED_AT = re.compile(r"(?: ?[\[({] ?(?:at|@) ?[\])}] ?| (?:at|@) |@)(?=[^\W_])", re.I)
_SPELLED_DOMAIN = re.compile(r"[^\W_][\w-]*+(?:(?: ?[\[({] ?(?:dot|\.) ?[\])}] ?| dot |\.)[^\W_][\w-]*+)+", re.I)
_SPELLED_LOCAL = re.compile(r"[\w.%+-]")
_NUMBER = re.compile(r"(?<![\w.,:/-])\(?[0-9](?:[ ().,/-]{0,2}[0-9])++")
_GOES_ON = re.compile(r"[\w/]")
_DIGIT = re.compile(r"[0-9]")

_TABLE = """__row bigint, doc_id bigint, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base string,
 found array<struct<kind:int, start:int, stop:int, seed:boolean, instance:bigint, patterns:array<bigint>>>"""


def luhn(digits: str) -> bool:
    doubled = (int(d) if i % 2 == 0 else sum(divmod(2 * int(d), 10)) for i, d in enumerate(reversed(digits)))
    return sum(doubled) % 10 == 0


def digits_of(text: str) -> str:
    return "".join(_DIGIT.findall(text))


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Around each @: the run of local characters before it, as far as the last match left it."""
    after, at = 0, text.find("@")
    while at >= 0:
        local = text[after:at]
        start = after + len(local.rstrip(_LOCAL))
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield start, domain.end()
            after = domain.end()
        else:
            after = at + 1
        at = text.find("@", after)


def _in_byte(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 3 or (len(part) == 3 and part <= "255")


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``(start, kind, end)`` of the base entities, by start, then kind."""
    spans = [(s, 0, e) for s, e in _emails(text)]
    if _DIGIT.search(text):
        spans += [(m.start(), 1, m.end()) for m in _IP.finditer(text) if all(map(_in_byte, m[0].split(".")))]
        for m in _CARD.finditer(text):
            # Every second code point at least is a digit: longer matches need no count.
            if 14 <= m.end() - m.start() <= 37:
                number = digits_of(m[0])
                if 14 <= len(number) <= 19 and luhn(number):
                    spans.append((m.start(), 2, m.end()))
        for m in _PHONE.finditer(text):
            if 10 <= sum(map(m[0].count, "0123456789")) <= 15:
                spans.append((m.start(), 3, m.end()))
    return sorted(spans)


def _spelled_emails(text: str) -> Iterator[tuple[int, int, int, str]]:
    for m in _SPELLED_AT.finditer(text):
        domain = _SPELLED_DOMAIN.match(text, m.end())
        start = m.start()
        while start and m.start() - start < REACH and _SPELLED_LOCAL.match(text, start - 1):
            start -= 1
        if domain and start < m.start():
            plain = re.sub(r"[\[\](){} ]", "", re.sub(r"(?i)[\[({ ]dot[\])} ]", ".", domain[0]))
            yield start, 0, domain.end(), f"{text[start:m.start()]}@{plain}".lower()


def _numbers(text: str) -> Iterator[tuple[int, int, int, str]]:
    for m in _NUMBER.finditer(text):
        if m.end() - m.start() > 3 * 19 + 1 or _GOES_ON.match(text, m.end()):
            continue
        number = digits_of(m[0])
        if re.fullmatch(r"[0-9]{1,3}(?:[ ,.]{1,2}[0-9]{1,3}){3}", m[0]) and all(_in_byte(p) for p in re.split(r"[ ,.]+", m[0])):
            yield m.start(), 1, m.end(), ".".join(re.split(r"[ ,.]+", m[0]))
        elif 12 <= len(number) <= 19 and luhn(number):
            yield m.start(), 2, m.end(), number
        elif 7 <= len(number) <= 15 and len(number) < m.end() - m.start():
            yield m.start(), 3, m.end(), number


def candidates(text: str, taken: list[tuple[int, int, int]]) -> list[tuple[int, int, int, str]]:
    """``(start, kind, end, normalised)`` of the right shape that overlap no base entity and no earlier one."""
    found = list(_spelled_emails(text)) + (list(_numbers(text)) if _DIGIT.search(text) else [])
    if not found:
        return []
    out, at, free, busy = [], 0, 0, sorted((s, e) for s, _, e in taken)
    for c in sorted(found):
        while at < len(busy) and busy[at][0] < c[2]:  # entities that begin before it ends
            free = max(free, busy[at][1])
            at += 1
        if c[0] >= free:
            out.append(c)
            free = c[2]
    return out


def normalised(kind: int, text: str) -> str:
    return text.lower() if kind == 0 else text if kind == 1 else digits_of(text)


def _code(*parts: str) -> int:
    return int.from_bytes(hashlib.blake2b("\x00".join(parts).encode("utf-8", "surrogatepass"), digest_size=8).digest(), "big", signed=True)


def patterns(text: str, start: int, end: int) -> list[int]:
    """Up to three contexts: two words before; the word before; the words on both sides. Digits are all alike."""
    before = _DIGIT.sub("0", text[max(0, start - REACH) : start].lower()).split()
    after = _DIGIT.sub("0", text[end : end + REACH].lower()).split()[:1]
    out = []
    if before:
        out.append(_code("1", before[-1]))
        if len(before) > 1:
            out.append(_code("2", *before[-2:]))
        if after:
            out.append(_code("3", before[-1], after[0]))
    return out


def spelled(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def _found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext

    cell = pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("stop", pa.int32()), ("seed", pa.bool_()), ("instance", pa.int64()), ("patterns", pa.list_(pa.int64()))])
    schema = pa.schema(
        [("__row", pa.int64()), ("doc_id", pa.int64())] + [(f"n_{k}", pa.int64()) for k in KINDS] + [("base", pa.string()), ("found", pa.list_(cell))]
    )
    # Numbers rows within the written table: of a partition's attempts, one is committed.
    row = TaskContext.get().partitionId() << 40
    for part in slices(batches):
        base, cells, counts = [], [], [[], [], [], []]
        for text in map(lambda x: x.as_py(), texts_of(part)):
            spans = base_spans(text)
            others = candidates(text, spans)
            base.append(spelled(spans))
            for k in range(4):
                counts[k].append(sum(s[1] == k for s in spans))
            cells.append(
                [
                    {"kind": k, "start": s, "stop": e, "seed": seed, "instance": _code(str(k), n), "patterns": patterns(text, s, e)}
                    for seed, group in ((True, [(*s, normalised(s[1], text[s[0] : s[2]])) for s in spans]), (False, others))
                    for s, k, e, n in group
                ]
            )
        yield rows(
            schema, __row=range(row, row + len(base)), doc_id=part.column("doc_id"), base=base, found=cells,
            **{f"n_{k}": c for k, c in zip(KINDS, counts)},
        )
        row += len(base)


def _graph(cells: DataFrame) -> DataFrame:
    """``pattern, kind, instance, seed``: distinct edges of patterns with ``SUPPORT`` instances or more."""
    edges = cells.select("kind", "instance", "seed", F.explode("patterns").alias("pattern"))
    edges = edges.groupBy("pattern", "kind", "instance").agg(F.max("seed").alias("seed"))
    often = edges.groupBy("pattern").agg(F.count(F.lit(1)).alias("__n"), F.max("seed").alias("__any"))
    often = often.filter((F.col("__n") >= SUPPORT) & F.col("__any")).select("pattern")
    return edges.join(often, "pattern", "left_semi")


def _taken(scored: DataFrame) -> DataFrame:
    """``pattern, kind, confidence`` of the patterns that are taken, from edges with a ``score``."""
    per_kind = scored.groupBy("pattern", "kind").agg(F.sum("score").alias("__p"), F.count(F.lit(1)).alias("__n"))
    total = scored.groupBy("pattern").agg(F.count(F.lit(1)).alias("__all"))
    both = per_kind.join(total, "pattern")
    part = F.col("__p") + (F.col("__all") - F.col("__n")) + (F.col("__n") - F.col("__p")) / 2
    return both.select("pattern", "kind", "__p", (F.col("__p") / part).alias("confidence")).filter(
        (F.col("__p") >= SUPPORT) & (F.col("confidence") >= CONFIDENCE)
    ).drop("__p")


def score_instances(cells: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """``kind, instance, score`` of every instance with a score above 0."""
    edges = hand_off(_graph(cells))
    seeds = cells.filter("seed").select("kind", "instance").distinct()
    scored = edges.withColumn("score", F.col("seed").cast("double"))
    known = None
    for left in range(rounds, 0, -1):
        taken = _taken(scored)
        # 1 - product(1 - c), in logarithms; a confidence of one counts as almost one.
        miss = F.sum(F.log(F.greatest(1 - F.col("confidence"), F.lit(1e-9))))
        known = edges.filter(~F.col("seed")).join(taken, ["pattern", "kind"]).groupBy("kind", "instance")
        known = hand_off(known.agg((1 - F.exp(miss)).alias("score")))
        if left > 1:
            scored = edges.join(known, ["kind", "instance"], "left").select(
                "pattern", "kind", "instance", "seed",
                F.when(F.col("seed"), 1.0).otherwise(F.coalesce("score", F.lit(0.0))).alias("score"),
            )
    return seeds.withColumn("score", F.lit(1.0)).union(known).groupBy("kind", "instance").agg(F.max("score").alias("score"))


def find_personal_data(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", rounds: int = ROUNDS) -> DataFrame:
    """``doc_id, n_email, n_ip, n_card, n_phone, base, spans``, one row per row of ``docs``.

    Counts and ``base`` are of the base entities, ``spans`` adds the discovered
    ones; both are ``kind:start:end`` by start, then kind, in code points. A
    null or empty text has none; a null id stays null; rows are judged one by one, so
    repeated rows have the same spans, and a repeated string is one instance of the
    graph; other columns are not read; an empty table gives no rows.
    """
    plain = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    table = hand_off(plain.mapInArrow(_found, _TABLE))
    cells = table.select("__row", F.explode("found").alias("c")).select("__row", "c.*")
    accepted = score_instances(cells, rounds).filter(F.col("score") >= CONFIDENCE).select("kind", "instance")
    more = cells.filter(~F.col("seed")).join(accepted, ["kind", "instance"])
    more = more.groupBy("__row").agg(F.collect_list(F.struct("start", "kind", "stop")).alias("__more"))
    base = F.transform(
        F.filter("found", lambda c: c["seed"]), lambda c: F.struct(c["start"].alias("start"), c["kind"].alias("kind"), c["stop"].alias("stop"))
    )
    every = F.array_sort(F.concat(base, F.coalesce("__more", F.array().cast("array<struct<start:int,kind:int,stop:int>>"))))
    name = F.array(*map(F.lit, KINDS))
    spans = F.array_join(F.transform(every, lambda c: F.concat_ws(":", F.get(name, c["kind"]), c["start"], c["stop"])), ",")
    return table.join(more, "__row", "left").select("doc_id", *(f"n_{k}" for k in KINDS), "base", spans.alias("spans"))
