"""Compare every catalogue query with its SQL statement on one table folder.

Usage: python tests/oracle_check.py /root/testdata/sf0.01 [query ...]
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from __spark_entry__ import oracle_sql, queries  # noqa: E402
from municipia import build_session  # noqa: E402


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in sorted(Path(folder).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value + 0.0
    return value


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=repr)


def compare(spark, con, folder: str, name: str) -> str | None:
    """None if equal, else what differs."""
    df = queries()[name](spark, folder)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    sql = oracle_sql().get(name)
    if sql is None:
        return None if got[1] else "no rows"
    result = con.execute(sql)
    expected = rows_of([d[0] for d in result.description], result.fetchall())
    if got[0] != expected[0]:
        return f"columns {got[0]} != {expected[0]}"
    if len(got[1]) != len(expected[1]):
        return f"{len(got[1])} rows != {len(expected[1])}"
    for mine, theirs in zip(got[1], expected[1]):
        if mine != theirs or [type(x) for x in mine] != [type(x) for x in theirs]:
            return f"{mine} != {theirs}"
    return None


if __name__ == "__main__":
    folder, *chosen = sys.argv[1:]
    spark = build_session(master="local[8]", shuffle_partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    failed = 0
    for name in chosen or queries():
        begin = time.time()
        try:
            problem = compare(spark, con, folder, name)
        except Exception as error:  # a report, not a handler: every query gets its line
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        failed += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {name} {time.time() - begin:.2f}s {problem or ''}", flush=True)
    print(f"{failed} failed")
    sys.exit(failed > 0)
