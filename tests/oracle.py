"""Runs registered queries against their SQL on the given tables and compares values.

Usage: python -m tests.oracle [name-prefix ...] ; SF_DIR selects the tables.
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(folder: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def normal(value):
    if isinstance(value, float):
        return None if math.isnan(value) else value + 0.0
    return value


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    out = [tuple(normal(r[i]) for i in order) for r in rows]
    return [names[i] for i in order], sorted(out, key=lambda r: tuple((v is None, str(type(v)), v if v is not None else 0) for v in r))


def compare(name, df, con, sql):
    got_names, got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    rel = con.execute(sql)
    want_names, want = rows_of([c[0] for c in rel.description], rel.fetchall())
    if got_names != want_names:
        return f"columns differ: {set(got_names) ^ set(want_names)}"
    if len(got) != len(want):
        return f"rows {len(got)} vs {len(want)}"
    bad = [(g, w) for g, w in zip(got, want) if g != w]
    if bad:
        g, w = bad[0]
        cells = [(n, a, b) for n, a, b in zip(got_names, g, w) if a != b]
        return f"{len(bad)} of {len(got)} rows differ, first {cells[:4]}"
    return None


def main(prefixes):
    from tallyframe.plans import registry
    from tallyframe.session import spark_session
    folder = os.environ.get("SF_DIR", "/root/testdata/sf0.01")
    spark = spark_session(master="local[8]", spark__sql__shuffle__partitions="8", spark__driver__memory="8g")
    spark.sparkContext.setLogLevel("ERROR")
    con, oracles, failed = connect(folder), registry.oracles(), []
    for name, run in registry.queries().items():
        if prefixes and not any(name.startswith(p) for p in prefixes):
            continue
        start = time.time()
        try:
            if name in oracles:
                fault = compare(name, run(spark, folder), con, oracles[name])
            else:
                rows = run(spark, folder).collect()
                fault = None if rows else "no rows"
        except Exception as e:  # noqa: BLE001
            fault = f"{type(e).__name__}: {str(e)[:600]}"
        print(f"{'FAIL' if fault else 'ok  '} {name} {time.time() - start:.1f}s {'' if name in oracles else '(rows only) '}{fault or ''}", flush=True)
        failed += [name] if fault else []
    print("failed:", failed)


if __name__ == "__main__":
    main(sys.argv[1:])
