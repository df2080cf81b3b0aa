"""Run registered queries against their SQL in DuckDB: ``python tests/compare.py [sf_dir] [name...]``."""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb

from __spark_entry__ import oracle_sql, queries

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def rows_of(records, columns) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(r[i] for i in order) for r in records), key=repr)


def mismatch(spark, con, sf_dir: str, name: str) -> str | None:
    """None when both engines agree on columns, types of values and rows, else what differs."""
    df = queries()[name](spark, sf_dir)
    ours = rows_of([tuple(r) for r in df.collect()], df.columns)
    result = con.execute(oracle_sql()[name])
    names = [d[0] for d in result.description]
    theirs = rows_of(result.fetchall(), names)
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} and {sorted(names)}"
    if ours != theirs:
        odd = [(a, b) for a, b in zip(ours, theirs) if a != b][:2]
        return f"rows {len(ours)} and {len(theirs)}; first differences {odd}"
    return None


def main() -> None:
    from tidemark.session import build_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session(
        "compare", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    bad = 0
    for name in sys.argv[2:] or queries():
        started = time.monotonic()
        found = mismatch(spark, con, sf_dir, name)
        bad += found is not None
        print(f"{name}: {found or 'same'} ({time.monotonic() - started:.1f} s)", flush=True)
    print(f"{bad} differ")
    sys.exit(bool(bad))


if __name__ == "__main__":
    main()
