"""Run a registered query and its SQL twin and compare all values.

    python -m suite.compare [--sf DIR] [name ...]
"""

from __future__ import annotations

import argparse
import datetime as dt
import decimal
import math
import sys
import time

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def duck(sf: str):
    import duckdb

    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf}/{name}.parquet')")
    return con


def plain(value):
    """A value in a form that both engines share."""
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, (float, decimal.Decimal)):
        number = float(value)
        return None if math.isnan(number) else round(number, 6)
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, dt.date):
        return value.isoformat()
    return value


def normalise(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    names = [columns[i] for i in order]
    return names, sorted(repr(tuple(plain(row[i]) for i in order)) for row in rows)


def difference(frame, con, sql: str) -> str | None:
    """None when equal, else what differs first."""
    spark_names, spark_rows = normalise(frame.columns, [tuple(r) for r in frame.collect()])
    cursor = con.execute(sql)
    duck_names, duck_rows = normalise([d[0] for d in cursor.description], cursor.fetchall())
    if spark_names != duck_names:
        return f"columns {spark_names} != {duck_names}"
    if len(spark_rows) != len(duck_rows):
        return f"{len(spark_rows)} rows != {len(duck_rows)}"
    for a, b in zip(spark_rows, duck_rows):
        if a != b:
            return f"\n  spark {a[:1500]}\n  duck  {b[:1500]}"
    return None


def main() -> int:
    from coverlens.session import build_session
    from suite.registry import ORACLE, QUERIES
    import suite.all_queries  # noqa: F401

    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="/root/testdata/sf0.01")
    parser.add_argument("--zone", default="UTC", help="session time zone; no result may depend on it")
    parser.add_argument("names", nargs="*")
    args = parser.parse_args()
    spark = build_session(master="local[8]", spark__sql__shuffle__partitions="8",
                          spark__sql__session__timeZone=args.zone,
                          spark__ui__showConsoleProgress="false")
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = duck(args.sf), []
    for name in args.names or QUERIES:
        start = time.time()
        try:
            frame = QUERIES[name](spark, args.sf)
            if name in ORACLE:
                problem = difference(frame, con, ORACLE[name])
                n = frame.count()
            else:
                n, problem = frame.count(), None
        except Exception as error:  # report and go on with the next query
            n, problem = -1, f"{type(error).__name__}: {str(error)[:1500]}"
        took = time.time() - start
        mark = "ok  " if problem is None else "FAIL"
        print(f"{mark} {name:28s} {n:8d} rows {took:6.2f}s {'' if name in ORACLE else '(rows only)'} {problem or ''}", flush=True)
        if problem:
            bad.append(name)
    print(f"{len(bad)} failed: {bad}")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
