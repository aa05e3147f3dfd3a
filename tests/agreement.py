"""Compare registered queries with their SQL, run by DuckDB on the same tables.

As a script: ``python tests/agreement.py <folder> [query ...]``.
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


#: Plan nodes that compare all rows with all rows, or leave the JVM.
UNWANTED = ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "InPandas", "InArrow")


def open_tables(folder: str):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return connection


def _kind(value) -> str:
    return "null" if value is None else type(value).__name__


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    return repr(value)


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    out = [tuple(_cell(r[i]) for i in order) for r in rows]
    return sorted(out)


def _kinds(names, rows):
    kinds = {n: set() for n in names}
    for row in rows:
        for n, v in zip(names, row):
            if v is not None:
                kinds[n].add(_kind(v))
    return kinds


def differences(spark, connection, query, sql, folder, unwanted=UNWANTED) -> list[str]:
    """What differs between a query and its SQL, and plans that would not scale; else nothing."""
    df = query(spark, folder)
    plan = df._jdf.queryExecution().executedPlan().toString()
    unwanted = [word for word in unwanted if word in plan]
    if unwanted:
        return [f"plan has {', '.join(unwanted)}"]
    got = [tuple(r) for r in df.collect()]
    cursor = connection.execute(sql)
    names = [d[0] for d in cursor.description]
    want = cursor.fetchall()
    found = []
    if sorted(df.columns) != sorted(names):
        return [f"columns: {sorted(df.columns)} != {sorted(names)}"]
    if len(got) != len(want):
        found.append(f"rows: {len(got)} != {len(want)}")
    a, b = _kinds(df.columns, got), _kinds(names, want)
    for n in names:
        if a[n] != b[n]:
            found.append(f"type of {n}: {a[n]} != {b[n]}")
    left, right = _rows(df.columns, got), _rows(names, want)
    if left != right:
        only = sorted(set(left) - set(right))[:2]
        other = sorted(set(right) - set(left))[:2]
        found.append(f"values {sorted(names)}: {only} != {other}")
    return found


def main() -> int:
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as registered
    from tidegate.plans import catalog
    from tidegate.session import build_session

    folder, wanted = sys.argv[1], sys.argv[2:]
    spark = build_session(
        "agreement",
        "local[8]",
        {
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection = open_tables(folder)
    queries, oracles = registered.queries(), registered.oracle_sql()
    bad = 0
    for name in wanted or queries:
        started = time.monotonic()
        try:
            if name in oracles:
                words = UNWANTED if name in catalog.QUERIES else UNWANTED[:2]
                found = differences(spark, connection, queries[name], oracles[name], folder, words)
            else:
                found = [] if queries[name](spark, folder).count() else ["no rows"]
        except Exception as failure:  # noqa: BLE001
            found = [f"{type(failure).__name__}: {str(failure)[:1500]}"]
        bad += bool(found)
        mark = "BAD" if found else ("ok " if name in oracles else "ok*")
        print(f"{mark} {time.monotonic() - started:6.2f}s {name} {' | '.join(found)}", flush=True)
    print(f"{bad} of {len(wanted or queries)} differ")
    return bad


if __name__ == "__main__":
    sys.exit(main())
