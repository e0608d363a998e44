"""Compare registered queries with their SQL, as multisets of rows.

``python tests/oracle_check.py [sf_dir] [name ...]`` prints one line per query.
"""

from __future__ import annotations

import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _kind(arrow_type) -> str:
    text = str(arrow_type)
    return {"large_string": "string"}.get(text, text)


def _multiset(table) -> Counter:
    names = sorted(table.column_names)
    columns = [table.column(n).to_pylist() for n in names]
    return Counter(zip(*columns))


def compare(df, con, sql: str) -> tuple[int, int, int, str]:
    """(rows, sql rows, rows that differ, schema difference)."""
    ours = df.toArrow()
    theirs = con.execute(sql).to_arrow_table()
    a = {f.name: _kind(f.type) for f in ours.schema}
    b = {f.name: _kind(f.type) for f in theirs.schema}
    schema = "" if a == b else f"{a} / {b}"
    if set(a) != set(b):
        return ours.num_rows, theirs.num_rows, -1, schema
    left, right = _multiset(ours), _multiset(theirs)
    return ours.num_rows, theirs.num_rows, sum(((left - right) + (right - left)).values()), schema


def main(sf_dir: str, names: list[str]) -> int:
    import __spark_entry__ as contract
    from gaugeline import build_session

    spark = build_session(
        "oracle-check", "local[8]", spark__ui__enabled="false", spark__sql__shuffle__partitions="8",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, oracles, bad = connect(sf_dir), contract.oracle_sql(), 0
    for name, build in contract.queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            if name in oracles:
                rows, want, off, schema = compare(build(spark, sf_dir), con, oracles[name])
                ok = off == 0 and not schema
                note = f"rows {rows} sql {want} differ {off} {schema}"
            else:
                rows = build(spark, sf_dir).count()
                ok, note = rows > 0, f"rows {rows} (no SQL)"
        except Exception as error:  # report and go on with the next query
            ok, note = False, repr(error)[:600]
        bad += not ok
        print(f"{'ok ' if ok else 'BAD'} {name:28s} {time.time() - start:5.1f}s {note}", flush=True)
    spark.stop()
    return bad


if __name__ == "__main__":
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    sys.exit(1 if main(folder, sys.argv[2:]) else 0)
