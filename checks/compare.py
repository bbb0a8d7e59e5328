"""Run queries next to their SQL: python -m checks.compare [sf_dir] [name ...]"""

from __future__ import annotations

import math
import sys
import time
from collections import Counter

import duckdb

from checks.oracle import ORACLE
from checks.queries import QUERIES
from topicloom.session import build_session

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def canonical(rows, columns) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def cell(v):
        if isinstance(v, float):
            return "nan" if math.isnan(v) else v + 0.0
        return v

    return Counter(tuple(cell(r[i]) for i in order) for r in rows)


def compare(spark, con, sf_dir: str, name: str) -> tuple[bool, str]:
    start = time.time()
    df = QUERIES[name](spark, sf_dir)
    rows = [tuple(r) for r in df.collect()]
    spark_time = time.time() - start
    if name not in ORACLE:
        return len(rows) > 0, f"rows only: {len(rows)} rows {spark_time:.2f}s {df.columns}"
    start = time.time()
    result = con.execute(ORACLE[name])
    columns = [d[0] for d in result.description]
    expected = result.fetchall()
    duck_time = time.time() - start
    if sorted(columns) != sorted(df.columns):
        return False, f"columns differ: {df.columns} / {columns}"
    left, right = canonical(rows, df.columns), canonical(expected, columns)
    detail = f"{len(rows)} rows, spark {spark_time:.2f}s, duckdb {duck_time:.2f}s"
    if left == right:
        return True, detail
    return False, (
        f"{detail}; {len(expected)} expected; only spark {sum((left - right).values())}: "
        f"{list((left - right).items())[:2]} only sql {sum((right - left).values())}: "
        f"{list((right - left).items())[:2]}"
    )


def main(argv: list[str]) -> int:
    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    names = argv[1:] or list(QUERIES)
    spark, con = build_session("local[8]"), duck(sf_dir)
    failures = 0
    for name in names:
        try:
            ok, detail = compare(spark, con, sf_dir, name)
        except Exception as error:  # report and go on with the next query
            ok, detail = False, f"{type(error).__name__}: {str(error)[:600]}"
        failures += not ok
        print("ok  " if ok else "FAIL", name, detail, flush=True)
    print(f"{len(names) - failures} of {len(names)} agree")
    return failures


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
