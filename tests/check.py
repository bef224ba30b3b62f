"""Compare every query with its SQL statement on one folder of test tables.

``python tests/check.py [sf_dir] [name ...]``
"""

from __future__ import annotations

import glob
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def connect(sf_dir):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(value):
    return tuple(_plain(v) for v in value) if isinstance(value, (list, tuple)) else value


def compare(df, con, statement):
    """'' when equal, else what differs.  Types must agree, not only values."""
    cursor = con.execute(statement)
    names = [d[0] for d in cursor.description]
    expected = cursor.fetchall()
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    order = sorted(names)
    actual = [_plain([row[c] for c in order]) for row in df.select(*[f"`{c}`" for c in order]).collect()]
    at = [names.index(c) for c in order]
    expected = [_plain([row[i] for i in at]) for row in expected]
    if len(actual) != len(expected):
        return f"rows {len(actual)} != {len(expected)}"
    key = lambda row: tuple((v is None, type(v).__name__, repr(v)) for v in row)
    for a, e in zip(sorted(actual, key=key), sorted(expected, key=key)):
        if key(a) != key(e):
            return f"{dict(zip(order, a))} != {dict(zip(order, e))}"
    return ""


def session(cores=8):
    from pyspark.sql import SparkSession

    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def main():
    import __spark_entry__ as entry

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    spark, con, oracles, failed = session(), connect(sf_dir), entry.oracle_sql(), []
    for name, build in entry.queries().items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            df = build(spark, sf_dir)
            if name in oracles:
                problem = compare(df, con, oracles[name])
                shown = problem or "equal"
            else:
                problem, shown = "", f"rows only: {len(df.collect())}"
        except Exception as error:  # noqa: BLE001 - report and go on with the next query
            problem = shown = f"{type(error).__name__}: {str(error)[:1500]}"
        if problem:
            failed.append(name)
        print(f"{'FAIL' if problem else 'ok  '} {name} {time.time() - start:.1f}s {shown}", flush=True)
    print(f"failed: {failed}" if failed else "all equal")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
