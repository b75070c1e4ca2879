"""Run registered queries beside their SQL and compare rows, names and values.

    python tools/check.py [--sf 0.01] [name-prefix ...]
"""

from __future__ import annotations

import argparse
import datetime
import decimal
import os
import sys
import time
import traceback
from collections import Counter

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from riskframe.session import local_session  # noqa: E402
from riskframe.workload import load_all  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def normal(value):
    if isinstance(value, float) and value != value:
        return None
    if isinstance(value, (datetime.date, datetime.datetime)):
        return str(value)
    if isinstance(value, (bool, int, float, decimal.Decimal)):
        return round(float(value), 9) + 0.0
    return value


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], Counter(
        tuple(normal(r[i]) for i in order) for r in map(tuple, rows)
    )


def compare(spark, connection, query, sf_dir):
    """None when equal, else what differs."""
    df = query.run(spark, sf_dir)
    got = rows_of(df.columns, df.collect())
    if query.sql is None:
        return "no SQL to compare with"
    result = connection.execute(query.sql)
    names = [d[0] for d in result.description]
    want = rows_of(names, result.fetchall())
    if got[0] != want[0]:
        return f"columns {got[0]} != {want[0]}"
    if got[1] != want[1]:
        extra, lacking = got[1] - want[1], want[1] - got[1]
        return (
            f"{sum(got[1].values())} rows, expected {sum(want[1].values())}; "
            f"extra {list(extra.items())[:3]}; lacking {list(lacking.items())[:3]}"
        )
    return None


def connect(sf_dir):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def main():
    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="0.01")
    parser.add_argument("prefixes", nargs="*")
    args = parser.parse_args()
    sf_dir = f"/root/testdata/sf{args.sf}"
    spark, connection = local_session(int(os.environ.get("CORES", "8"))), connect(sf_dir)
    bad = 0
    for name, query in load_all().items():
        if args.prefixes and not name.startswith(tuple(args.prefixes)):
            continue
        started = time.time()
        try:
            problem = compare(spark, connection, query, sf_dir)
        except Exception as error:
            problem = f"{type(error).__name__}: {str(error)[:600]}"
            if os.environ.get("TRACE"):
                traceback.print_exc()
        bad += problem is not None
        kind = "ok" if query.sql else "rows"
        print(f"{kind if problem is None else 'BAD':4} {time.time() - started:6.2f}s {name}"
              + (f"\n     {problem}" if problem else ""), flush=True)
    print(f"{bad} bad", flush=True)
    sys.exit(bad > 0)


if __name__ == "__main__":
    main()
