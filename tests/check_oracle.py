"""Runs registered queries next to their SQL and reports every difference.

    python tests/check_oracle.py [sf0.01] [name ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def value(x):
    if x is None or (isinstance(x, float) and math.isnan(x)):
        return None
    if isinstance(x, bool):
        return x
    if isinstance(x, (int, float, decimal.Decimal)):
        return round(float(x), 6)
    if isinstance(x, (dt.datetime, dt.date)):
        return str(x)
    return x


def normal(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(value(row[i]) for i in order) for row in rows), key=repr)


def oracle_rows(sf_dir, sql):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    cursor = con.execute(sql)
    names = [c[0] for c in cursor.description]
    return names, cursor.fetchall()


def compare(df, sf_dir, sql):
    """None if the rows agree, else a text saying how they differ."""
    names, expected = oracle_rows(sf_dir, sql)
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} but SQL has {sorted(names)}"
    got = normal(df.columns, df.collect())
    want = normal(names, expected)
    if got == want:
        return None
    missing = [row for row in want if row not in set(got)][:3]
    extra = [row for row in got if row not in set(want)][:3]
    return f"{len(got)} rows but SQL has {len(want)}; only SQL {missing}; only Spark {extra}"


def main(args):
    import __spark_entry__ as entry
    from tidebook.session import build_session

    scale = args[0] if args else "sf0.01"
    sf_dir = f"/root/testdata/{scale}"
    spark = build_session("check", "local[8]", **{"spark.sql.shuffle.partitions": 8, "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    oracle = entry.oracle_sql()
    bad = 0
    for name, run in entry.queries().items():
        if args[1:] and name not in args[1:]:
            continue
        begin = time.time()
        try:
            df = run(spark, sf_dir)
            if name in oracle:
                verdict = compare(df, sf_dir, oracle[name])
                rows = ""
            else:
                verdict, rows = None, f"{df.count()} rows, no SQL"
        except Exception as error:  # noqa: BLE001
            verdict, rows = f"{type(error).__name__}: {str(error)[:1500]}", ""
        bad += verdict is not None
        print(f"{'ok  ' if verdict is None else 'FAIL'} {name} {time.time() - begin:.1f}s {rows} {verdict or ''}", flush=True)
    print("failures:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
