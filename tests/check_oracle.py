"""Runs queries and their SQL side by side and compares names, types, rows and values.

    python tests/check_oracle.py [folder of tables] [query …]
"""

from __future__ import annotations

import glob
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

import __spark_entry__ as entry  # noqa: E402

QUERIES, ORACLES = entry.queries(), entry.oracle_sql()

TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN", "date": "DATE"}


def connect(sf_dir: str):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.splitext(os.path.basename(path))[0]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _order(row):
    return tuple((v is None, str(type(v)), round(v, 3) if isinstance(v, float) else v if v is not None else 0) for v in row)


def _same(a, b) -> bool:
    if isinstance(a, float) and isinstance(b, float):
        return a == b or math.isclose(a, b, rel_tol=1e-12, abs_tol=1e-12)
    return a == b


def compare(spark, con, name: str, sf_dir: str) -> list[str]:
    df = QUERIES[name](spark, sf_dir)
    columns = sorted(df.columns)
    got = [tuple(row[c] for c in columns) for row in df.collect()]
    if name not in ORACLES:
        return [] if got else ["no rows"]
    cursor = con.execute(ORACLES[name])
    described = {d[0]: str(d[1]) for d in con.execute("DESCRIBE " + ORACLES[name]).fetchall()}
    cursor = con.execute(ORACLES[name])
    names = [d[0] for d in cursor.description]
    place = {n: i for i, n in enumerate(names)}
    problems = []
    if sorted(names) != columns:
        return [f"columns {columns} against {sorted(names)}"]
    for column, dtype in df.dtypes:
        if TYPES.get(dtype, dtype) != described[column]:
            problems.append(f"type of {column}: {dtype} against {described[column]}")
    want = [tuple(row[place[c]] for c in columns) for row in cursor.fetchall()]
    if len(got) != len(want):
        return problems + [f"{len(got)} rows against {len(want)}"]
    differing = inexact = 0
    for a, b in zip(sorted(got, key=_order), sorted(want, key=_order)):
        if not all(_same(x, y) for x, y in zip(a, b)):
            differing += 1
            if differing <= 3:
                problems.append(f"{[(c, x, y) for c, x, y in zip(columns, a, b) if not _same(x, y)]}")
        elif a != b:
            inexact += 1
    if differing:
        problems.append(f"{differing} of {len(got)} rows differ")
    if inexact:
        problems.append(f"(last-digit differences in {inexact} rows)")
    return problems


def main(argv: list[str]) -> int:
    from carbonloom.session import local_session

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    names = argv[1:] or list(QUERIES)
    spark, con = local_session("check"), connect(sf_dir)
    bad = 0
    for name in names:
        start = time.time()
        try:
            problems = compare(spark, con, name, sf_dir)
        except Exception as error:  # report and go on with the next query
            problems = [f"{type(error).__name__}: {str(error)[:600]}"]
        bad += any(not p.startswith("(") for p in problems)
        print(f"{'ok ' if not problems else 'BAD'} {name} {time.time() - start:.2f}s", *problems, sep="\n      " if problems else " ", flush=True)
    print(f"{len(names) - bad} of {len(names)} agree; without SQL: {sorted(set(QUERIES) - set(ORACLES))}")
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
