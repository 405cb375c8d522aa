"""Compare registered queries with their SQL, the way the correctness gate does.

Run as a script for a report: ``python tests/oracle_check.py [sf] [key-prefix ...]``.
"""

from __future__ import annotations

import decimal
import glob
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def connect(sf_dir: str):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _plain(value):
    if isinstance(value, decimal.Decimal):
        value = int(value) if value == value.to_integral_value() else float(value)
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6)
    if isinstance(value, (list, tuple)):
        return tuple(_plain(v) for v in value)
    return value


def normalise(columns: list[str], rows) -> list[str]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(repr(tuple(_plain(r[i]) for i in order)) for r in rows)


def compare(spark, con, sf_dir: str, fn, sql: str) -> str | None:
    """None when equal, else what differs."""
    df = fn(spark, sf_dir)
    spark_rows = [tuple(r) for r in df.collect()]
    cur = con.execute(sql)
    duck_cols = [d[0] for d in cur.description]
    duck_rows = cur.fetchall()
    if sorted(df.columns) != sorted(duck_cols):
        return f"columns {sorted(df.columns)} != {sorted(duck_cols)}"
    a, b = normalise(df.columns, spark_rows), normalise(duck_cols, duck_rows)
    if a == b:
        return None
    sa, sb = set(a), set(b)
    return f"rows {len(a)} vs {len(b)}; spark only {sorted(sa - sb)[:2]}; sql only {sorted(sb - sa)[:2]}"


def main(argv: list[str]) -> int:
    from warcloom.plans import catalogue
    from warcloom.session import get_spark

    sf_dir = f"/root/testdata/sf{argv[0] if argv else '0.01'}"
    prefixes = tuple(argv[1:])
    spark = get_spark("oracle-check", "local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    bad = 0
    for key, fn in catalogue.QUERIES.items():
        if prefixes and not key.startswith(prefixes):
            continue
        start = time.time()
        try:
            sql = catalogue.ORACLES.get(key)
            if sql is None:
                result = None
                n = len(fn(spark, sf_dir).collect())
                note = f"rows only ({n})"
            else:
                result = compare(spark, con, sf_dir, fn, sql)
                note = "ok"
        except Exception as error:  # report and go on
            result, note = f"{type(error).__name__}: {str(error)[:700]}", ""
        took = time.time() - start
        if result is None:
            print(f"{key}: {note} {took:.2f}s", flush=True)
        else:
            bad += 1
            print(f"FAIL {key}: {result} {took:.2f}s", flush=True)
    print(f"{bad} failing")
    spark.stop()
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
