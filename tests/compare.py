"""Run registered queries beside their SQL and report differences.

Usage: python tests/compare.py [folder] [query …]
"""

from __future__ import annotations

import datetime
import glob
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as entry  # noqa: E402


def database(folder: str):
    connection = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def normal(value):
    if isinstance(value, float) and math.isnan(value):
        return "NaN"
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    return value


def sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    picked = [tuple(normal(row[i]) for i in order) for row in rows]
    return [columns[i] for i in order], sorted(picked, key=repr)


KINDS = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE",
         "boolean": "BOOLEAN"}


def difference(spark, connection, folder: str, name: str) -> str | None:
    """None if both sides agree in column names, types and all values."""
    df = entry.queries()[name](spark, folder)
    columns, rows = sorted_rows(df.columns, [tuple(r) for r in df.collect()])
    result = connection.execute(entry.oracle_sql()[name])
    kinds = {d[0]: str(d[1]) for d in result.description}
    wanted_columns, wanted = sorted_rows([d[0] for d in result.description], result.fetchall())
    if columns != wanted_columns:
        return f"columns {columns} != {wanted_columns}"
    types = {c: KINDS.get(k, k) for c, k in df.dtypes}
    if types != kinds:
        return f"types {[(c, types[c], kinds[c]) for c in types if types[c] != kinds[c]]}"
    if len(rows) != len(wanted):
        return f"{len(rows)} rows != {len(wanted)}"
    unequal = [(a, b) for a, b in zip(rows, wanted) if a != b]
    if unequal:
        a, b = unequal[0]
        cells = [(c, x, y) for c, x, y in zip(columns, a, b) if x != y]
        return f"{len(unequal)} of {len(rows)} rows differ, first: {cells}"
    return None


def main() -> None:
    from tranche.session import local_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(entry.queries())
    spark = local_session("tranche-compare")
    spark.sparkContext.setLogLevel("ERROR")
    connection = database(folder)
    failed = 0
    for name in names:
        started = time.time()
        if name not in entry.oracle_sql():
            rows = entry.queries()[name](spark, folder).count()
            print(f"ROWS {name}: {rows} ({time.time() - started:.1f}s)", flush=True)
            continue
        try:
            found = difference(spark, connection, folder, name)
        except Exception as error:  # report and go on with the next query
            found = f"{type(error).__name__}: {str(error)[:600]}"
        failed += found is not None
        print(f"{'ok  ' if found is None else 'FAIL'} {name} ({time.time() - started:.1f}s) {found or ''}",
              flush=True)
    print(f"{failed} failed of {len(names)}")


if __name__ == "__main__":
    main()
