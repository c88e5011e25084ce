"""Run registered queries next to their oracles: python -m checks.compare [sf_dir] [name ...]"""

from __future__ import annotations

import math
import sys
import time

import duckdb

from checks.oracles import oracle_sql
from checks.queries import queries
from shopgrain.session import build_session

GIVEN = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def oracle_rows(sf_dir: str, sql: str) -> tuple[list[str], list[tuple]]:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in GIVEN:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    cur = con.execute(sql)
    return [d[0] for d in cur.description], cur.fetchall()


def _sorted(names: list[str], rows: list[tuple]) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    out = [
        tuple(
            "NaN" if isinstance(r[i], float) and math.isnan(r[i]) else r[i] for i in order
        )
        for r in rows
    ]
    return [names[i] for i in order], sorted(out, key=repr)


def difference(got: tuple[list[str], list[tuple]], want: tuple[list[str], list[tuple]]) -> str:
    """Empty when both hold the same columns and the same bag of rows, value for value."""
    (gn, gr), (wn, wr) = _sorted(*got), _sorted(*want)
    if gn != wn:
        return f"columns differ: only here {set(gn) - set(wn)}, only oracle {set(wn) - set(gn)}"
    if len(gr) != len(wr):
        return f"{len(gr)} rows, oracle {len(wr)}"
    bad = [(g, w) for g, w in zip(gr, wr) if repr(g) != repr(w)]
    if bad:
        cells = [(n, a, b) for n, a, b in zip(gn, *bad[0]) if repr(a) != repr(b)]
        return f"{len(bad)} of {len(gr)} rows differ, first: {cells}"
    return ""


def main() -> int:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    chosen = sys.argv[2:]
    spark = build_session(
        master="local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false",
        spark__driver__memory="8g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    oracles, failed = oracle_sql(), 0
    for name, query in queries().items():
        if chosen and name not in chosen:
            continue
        start = time.time()
        try:
            df = query(spark, sf_dir)
            rows = [tuple(r) for r in df.collect()]
            took = time.time() - start
            if name in oracles:
                note = difference((df.columns, rows), oracle_rows(sf_dir, oracles[name]))
            else:
                note = "" if rows else "no rows"
        except Exception as error:  # keep going, report at the end
            note, rows, took = f"{type(error).__name__}: {str(error)[:1500]}", [], time.time() - start
        failed += bool(note)
        print(f"{'FAIL' if note else 'ok  '} {name:28} {len(rows):7} rows {took:6.2f}s {note}", flush=True)
    return failed


if __name__ == "__main__":
    sys.exit(main())
