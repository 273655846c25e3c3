"""Compare every report with its SQL on the driver tables.

Usage: python tests/compare.py [folder] [name ...]
"""

from __future__ import annotations

import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()


def sql_rows(folder: str, sql: str):
    import duckdb

    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(
            f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'"
        )
    found = connection.execute(sql)
    names = [d[0] for d in found.description]
    return names, found.fetchall()


def canonical(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(
        (tuple(row[i] for i in order) for row in rows),
        key=lambda r: tuple((v is None, str(type(v)), v) for v in r),
    )


def differences(spark, folder: str, name: str, queries, oracles) -> str | None:
    df = queries[name](spark, folder)
    rows = [tuple(r) for r in df.collect()]
    names, expected = sql_rows(folder, oracles[name])
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    got, want = canonical(df.columns, rows), canonical(names, expected)
    if len(got) != len(want):
        return f"{len(got)} rows, expected {len(want)}"
    for a, b in zip(got, want):
        if a != b:
            return f"{a} != {b}"
    return None


def main() -> int:
    import __spark_entry__ as entry
    from tidemark.session import build_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session(
        master="local[8]",
        settings={
            "spark.sql.shuffle.partitions": "8",
            "spark.driver.memory": "12g",
            "spark.ui.enabled": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries, oracles = entry.queries(), entry.oracle_sql()
    bad = 0
    for name in sys.argv[2:] or queries:
        started = time.time()
        try:
            problem = differences(spark, folder, name, queries, oracles)
        except Exception as error:  # report and go on with the next one
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        bad += problem is not None
        print(f"{time.time() - started:6.2f}s {name}: {problem or 'ok'}", flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(main())
