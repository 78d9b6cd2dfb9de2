"""Runs registered queries against DuckDB on the same files: python tests/oracle.py [sf] [name ...]."""

from __future__ import annotations

import math
import sys
import time
import traceback
from collections import Counter
from decimal import Decimal
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, (int, Decimal)):
        value = float(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    if isinstance(value, dict):
        return tuple(sorted((k, plain(v)) for k, v in value.items()))
    return str(value)


def rows(columns: list[str], data) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(plain(r[i]) for i in order) for r in data)


def compare(spark, con, name: str, sf_dir: str) -> tuple[bool, str]:
    from tideline.plans import ORACLE_SQL, QUERIES

    df = QUERIES[name](spark, sf_dir)
    got = rows(df.columns, df.collect())
    if name not in ORACLE_SQL:
        return sum(got.values()) > 0, f"{sum(got.values())} rows, no oracle"
    result = con.execute(ORACLE_SQL[name])
    columns = [d[0] for d in result.description]
    if sorted(columns) != sorted(df.columns):
        return False, f"columns {sorted(df.columns)} != {sorted(columns)}"
    want = rows(columns, result.fetchall())
    if got == want:
        return sum(got.values()) > 0, f"{sum(got.values())} rows"
    extra, missing = got - want, want - got
    return False, (
        f"{sum(got.values())} rows vs {sum(want.values())}; {sorted(columns)}\n"
        f"   spark only {sum(extra.values())}: {[str(r)[:300] for r in list(extra)[:2]]}\n"
        f"   duckdb only {sum(missing.values())}: {[str(r)[:300] for r in list(missing)[:2]]}"
    )


def main(argv: list[str]) -> int:
    from tideline.plans import QUERIES
    from tideline.session import local_session

    sf = argv[0] if argv else "0.01"
    sf_dir = f"/root/testdata/sf{sf}"
    spark, con, failed = local_session(), connect(sf_dir), []
    spark.sparkContext.setLogLevel("ERROR")
    for name in argv[1:] or QUERIES:
        start = time.time()
        try:
            ok, note = compare(spark, con, name, sf_dir)
        except Exception as error:  # report and go on with the next query
            ok, note = False, f"{type(error).__name__}: {str(error)[:600]}"
            if len(argv) > 1:
                traceback.print_exc()
        print(f"{'ok  ' if ok else 'FAIL'} {name} {time.time() - start:.1f}s {note}", flush=True)
        if not ok:
            failed.append(name)
    print(f"{len(failed)} failed: {failed}")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
