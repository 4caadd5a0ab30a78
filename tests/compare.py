"""Run registered queries beside their SQL and compare rows as multisets."""

from __future__ import annotations

import datetime as dt
import math
import sys
import time
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _value(v):
    if isinstance(v, bool) or v is None:
        return v
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return f"{v:.12g}"
    if isinstance(v, int):
        return f"{float(v):.12g}" if abs(v) < 10**12 else str(v)
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    return v


def rows_of(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_value(r[i]) for i in order) for r in rows)


def compare(spark, con, sf_dir: str, run, sql: str) -> list[str]:
    """Differences between the Spark result and the SQL result; empty when they agree."""
    frame = run(spark, sf_dir)
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    if sorted(names) != sorted(frame.columns):
        return [f"columns: {sorted(frame.columns)} against {sorted(names)}"]
    left = rows_of(frame.columns, frame.collect())
    right = rows_of(names, cursor.fetchall())
    if left == right:
        return []
    only_left, only_right = left - right, right - left
    return [
        f"rows: {sum(left.values())} against {sum(right.values())}",
        f"columns: {sorted(names)}",
        *[f"only Spark: {r}" for r in list(only_left)[:3]],
        *[f"only SQL:   {r}" for r in list(only_right)[:3]],
    ]


def main() -> None:
    import __spark_entry__ as entry
    from tickbars.session import local_session

    sf_dir = sys.argv[1]
    wanted = sys.argv[2:]
    spark = local_session(8)
    con = connect(sf_dir)
    sql = entry.oracle_sql()
    bad = 0
    for name, run in entry.queries().items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            found = compare(spark, con, sf_dir, run, sql[name]) if name in sql else ["no SQL"]
        except Exception as error:  # noqa: BLE001
            found = [f"{type(error).__name__}: {str(error)[:1500]}"]
        bad += bool(found)
        print(f"{'ok ' if not found else 'BAD'} {name} {time.time() - start:.1f}s", *found, sep="\n    ", flush=True)
    print("differing:", bad)


if __name__ == "__main__":
    main()
