"""Run registered queries against DuckDB and compare names, types, row counts and values.

    python -m suite.check [--sf 0.01] [name ...]
"""

from __future__ import annotations

import sys
import time
from collections import Counter

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
SAME_TYPE = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN"}


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def compare(df, con, sql: str) -> str | None:
    """None if both give the same rows, else what differs."""
    got = [tuple(r) for r in df.collect()]
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    kinds = {d[0]: str(d[1]) for d in cur.description}
    want = cur.fetchall()
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    for name, kind in df.dtypes:
        if SAME_TYPE.get(kind) != kinds[name]:
            return f"type of {name}: {kind} != {kinds[name]}"
    if len(got) != len(want):
        extra = f"rows {len(got)} != {len(want)}"
    else:
        extra = ""
    order = sorted(names)
    a = Counter(tuple(row[df.columns.index(n)] for n in order) for row in got)
    b = Counter(tuple(row[names.index(n)] for n in order) for row in want)
    if a == b:
        return None
    return f"{extra} spark only {list((a - b).items())[:3]} duckdb only {list((b - a).items())[:3]}"


def main(argv: list[str]) -> int:
    from colsight.plans.staging import release
    from colsight.session import local_session
    from suite import ORACLES, QUERIES

    sf = "0.01"
    if argv[:1] == ["--sf"]:
        sf, argv = argv[1], argv[2:]
    sf_dir = f"/root/testdata/sf{sf}"
    spark = local_session(8)
    spark.sparkContext.setLogLevel("OFF")
    con = duck(sf_dir)
    bad = []
    for name, query in QUERIES.items():
        if argv and not any(name.startswith(a) for a in argv):
            continue
        start = time.time()
        try:
            df = query(spark, sf_dir)
            if name in ORACLES:
                result = compare(df, con, ORACLES[name])
            else:
                result = None if df.count() else "no rows"
        except Exception as e:  # report and go on with the next query
            result = f"{type(e).__name__}: {str(e)[:600]}"
        release()
        took = time.time() - start
        rows = "" if name in ORACLES else " (no SQL)"
        print(f"{'ok  ' if result is None else 'FAIL'} {took:6.2f}s {name}{rows} {'' if result is None else result[:900]}", flush=True)
        if result is not None:
            bad.append(name)
    print(f"{len(bad)} failed: {bad}")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
