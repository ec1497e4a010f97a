"""Run queries and their SQL checks on one folder of test tables and compare the rows."""

from __future__ import annotations

import math
import sys
import time

import duckdb

from fcbias.catalog import ORACLES, QUERIES
from fcbias.session import build_session

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def reference_rows(folder: str, sql: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{folder}/{name}.parquet'")
    cursor = con.execute(sql)
    return [d[0] for d in cursor.description], cursor.fetchall()


def canonical(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])

    def value(v):
        if isinstance(v, bool):
            return str(v)
        if isinstance(v, (int, float)):
            return "nan" if isinstance(v, float) and math.isnan(v) else repr(float(v))
        return str(v)

    return [names[i] for i in order], sorted(tuple(value(r[i]) for i in order) for r in rows)


def difference(name: str, spark, folder: str) -> str | None:
    """None if a query and its check agree, else what differs."""
    df = QUERIES[name](spark, folder)
    got_names, got = canonical(df.columns, df.collect())
    if name not in ORACLES:
        return None if got else "no rows"
    want_names, want = canonical(*reference_rows(folder, ORACLES[name]))
    if got_names != want_names:
        return f"columns {got_names} against {want_names}"
    if len(got) != len(want):
        return f"{len(got)} rows against {len(want)}"
    wrong = [(g, w) for g, w in zip(got, want) if g != w]
    if wrong:
        return f"{len(wrong)} of {len(got)} rows differ, first {got_names}: {wrong[0][0]} against {wrong[0][1]}"
    return None if got else "no rows (both)"


if __name__ == "__main__":
    folder = sys.argv[1]
    names = sys.argv[2:] or list(QUERIES)
    spark = build_session(cores=8)
    bad = 0
    for name in names:
        start = time.time()
        try:
            problem = difference(name, spark, folder)
        except Exception as e:  # noqa: BLE001
            problem = f"{type(e).__name__}: {str(e)[:600]}"
        bad += problem is not None
        kind = "O" if name in ORACLES else "R"
        print(f"{'ok  ' if problem is None else 'FAIL'} {kind} {time.time() - start:6.1f}s {name} {problem or ''}", flush=True)
    print(f"{len(names) - bad} of {len(names)} agree")
