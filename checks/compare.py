"""Run registered queries and their SQL side by side: ``python -m checks.compare [sf_dir] [name ...]``."""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

from checks import catalog
from tableloom.session import build_session

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str):
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return connection


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 9) + 0.0
    if hasattr(value, "item"):
        return plain(value.item())
    return value


def sorted_rows(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def compare(spark, connection, sf_dir: str, name: str) -> str:
    started = time.time()
    df = catalog.QUERIES[name](spark, sf_dir)
    rows = df.collect()
    took = time.time() - started
    if name not in catalog.ORACLES:
        return f"rows only ({len(rows)}), {took:.1f} s"
    result = connection.execute(catalog.ORACLES[name])
    columns = [d[0] for d in result.description]
    expected = result.fetchall()
    if sorted(columns) != sorted(df.columns):
        return f"DIFFERENT columns {sorted(df.columns)} against {sorted(columns)}"
    ours, theirs = sorted_rows(df.columns, rows), sorted_rows(columns, expected)
    if ours != theirs:
        differing = [(a, b) for a, b in zip(ours, theirs) if a != b][:2]
        return f"DIFFERENT {len(ours)} against {len(theirs)} rows, {differing}"
    types = {type(v).__name__ for r in theirs for v in r}
    return f"same ({len(ours)} rows), {took:.1f} s {sorted(types)}"


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(catalog.QUERIES)
    spark = build_session(master=f"local[{os.environ.get('BENCH_CPUS', '8')}]", **{
        "spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g", "spark.ui.enabled": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(sf_dir)
    for name in names:
        try:
            print(name, compare(spark, connection, sf_dir, name), flush=True)
        except Exception as error:
            print(name, "FAILED", type(error).__name__, str(error)[:600], flush=True)


if __name__ == "__main__":
    main()
