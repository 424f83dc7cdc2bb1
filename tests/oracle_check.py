"""Runs registered queries against their DuckDB texts and prints every difference.

Usage: python tests/oracle_check.py SF_DIR [--large-plans] [name-prefix ...]

``--large-plans`` turns broadcasting off, so the plans that large inputs get are the ones compared.
"""

from __future__ import annotations

import math
import pathlib
import sys
import time

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck(folder):
    import duckdb

    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return con


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else f"f{value!r}"
    return f"{type(value).__name__}:{value}"


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def compare(spark, con, name, run, sql, folder):
    frame = run(spark, folder)
    got_columns, got = frame.columns, [tuple(r) for r in frame.collect()]
    if sql is None:
        return None if got else f"{name}: no rows"
    result = con.execute(sql)
    want_columns = [c[0] for c in result.description]
    want = result.fetchall()
    if sorted(got_columns) != sorted(want_columns):
        return f"{name}: columns {sorted(got_columns)} != {sorted(want_columns)}"
    left, right = rows_of(got_columns, got), rows_of(want_columns, want)
    if left != right:
        only_left = [r for r in left if r not in set(right)][:2]
        only_right = [r for r in right if r not in set(left)][:2]
        return f"{name}: {len(left)} vs {len(right)} rows\n   spark  {only_left}\n   oracle {only_right}"
    return None


if __name__ == "__main__":
    import __spark_entry__ as entry
    from ledgerloom.session import build_session

    large = "--large-plans" in sys.argv
    folder, *prefixes = [a for a in sys.argv[1:] if a != "--large-plans"]
    prefixes = tuple(prefixes)
    extra = {}
    if large:
        extra = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    spark = build_session(
        master="local[4]",
        **extra,
        **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g", "spark.ui.enabled": "false",
           "spark.ui.showConsoleProgress": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(folder)
    oracles, bad, total, bare = entry.oracle_sql(), 0, 0, 0
    for name, run in entry.queries().items():
        if prefixes and not name.startswith(prefixes):
            continue
        start = time.time()
        try:
            problem = compare(spark, con, name, run, oracles.get(name), folder)
        except Exception as error:  # report and go on to the next query
            problem = f"{name}: {type(error).__name__} {str(error)[:1500]}"
        total += 1
        bare += name not in oracles
        took = time.time() - start
        if problem:
            bad += 1
            print("BAD ", problem, flush=True)
        elif took > 4:
            print(f"slow {name} {took:.1f}s", flush=True)
    print(f"{total} queries, {bad} bad, {bare} without oracle", flush=True)
