"""Run queries and their SQL side by side: ``python tests/compare.py [folder] [query ...]``."""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def plain(value):
        if isinstance(value, float):
            return "nan" if math.isnan(value) else repr(value + 0.0)
        return repr(value)

    return sorted(tuple(plain(row[i]) for i in order) for row in rows)


def kinds(names, types):
    groups = {"bigint": "bigint", "int": "integer", "double": "double", "string": "varchar", "boolean": "boolean"}
    return sorted((n, groups.get(t, t)) for n, t in zip(names, types))


def difference(frame, con, sql) -> str | None:
    """What differs between a DataFrame and a SQL result, or None."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    types = [str(d[1]).lower() for d in result.description]
    expected = result.fetchall()
    actual = [tuple(row) for row in frame.collect()]
    ours = kinds(frame.columns, [f.dataType.simpleString() for f in frame.schema.fields])
    if ours != kinds(names, types):
        return f"schema {ours} against {kinds(names, types)}"
    left, right = canonical(frame.columns, actual), canonical(names, expected)
    if len(left) != len(right):
        return f"{len(left)} rows against {len(right)}"
    wrong = [(a, b) for a, b in zip(left, right) if a != b]
    return f"{len(wrong)} of {len(left)} rows, e.g. {wrong[0][0]} against {wrong[0][1]}" if wrong else None


def main() -> int:
    from __spark_entry__ import oracle_sql, queries
    from changeloom.session import build_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session(cores=8, partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    con, sql, failed = connect(folder), oracle_sql(), 0
    for name, query in ((n, q) for n, q in queries().items() if n in sql):
        if len(sys.argv) > 2 and name not in sys.argv[2:]:
            continue
        start = time.time()
        try:
            problem = difference(query(spark, folder), con, sql[name])
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        failed += problem is not None
        print(f"{'FAIL' if problem else 'ok':5}{time.time() - start:7.1f}s {name} {problem or ''}", flush=True)
    return failed


if __name__ == "__main__":
    sys.exit(main())
