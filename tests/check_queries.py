"""Run registered queries against their check SQL: python tests/check_queries.py [names...]"""

from __future__ import annotations

import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

import __spark_entry__ as entry  # noqa: E402
from siltworks.queries.inputs import TABLES  # noqa: E402


def connect(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return con


def canonical(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted([tuple(repr(r[i]) for i in order) for r in rows])


def compare(spark, con, name, sf_dir):
    df = entry.queries()[name](spark, sf_dir)
    got = [tuple(r) for r in df.collect()]
    relation = con.sql(entry.oracle_sql()[name])
    want = relation.fetchall()
    columns, expected = df.columns, relation.columns
    if sorted(columns) != sorted(expected):
        return f"columns {sorted(columns)} != {sorted(expected)}"
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}"
    a, b = canonical(got, columns), canonical(want, expected)
    if a != b:
        missing = [x for x in a if x not in set(b)][:2]
        surplus = [x for x in b if x not in set(a)][:2]
        return f"values differ: {missing} / {surplus} ({sorted(columns)})"
    return None


if __name__ == "__main__":
    from conftest import make_session

    spark = make_session()
    sf = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.01")
    con = connect(sf)
    bad = 0
    for name in sys.argv[1:] or entry.queries():
        t = time.time()
        try:
            problem = compare(spark, con, name, sf)
        except Exception as e:  # noqa: BLE001
            problem = f"{type(e).__name__}: {str(e)[:1500]}"
        bad += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {name} {time.time() - t:.1f}s {problem or ''}", flush=True)
    print("failures:", bad)
