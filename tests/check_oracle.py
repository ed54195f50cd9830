"""Compare every query with its SQL: ``python tests/check_oracle.py [sf dir] [query ...]``."""

from __future__ import annotations

import glob
import math
import os
import sys
import time
from decimal import Decimal

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def canonical(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, (Decimal, float)):
        return float(value)
    return value


def bag(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(canonical(r[i]) for i in order) for r in rows), key=repr)


def oracle_connection(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def compare(spark, con, query, sql, sf_dir) -> str | None:
    """None when equal, else what differs."""
    df = query(spark, sf_dir)
    got = bag(df.columns, [tuple(r) for r in df.collect()])
    rel = con.sql(sql)
    want = bag(rel.columns, rel.fetchall())
    if sorted(df.columns) != sorted(rel.columns):
        return f"columns {sorted(df.columns)} != {sorted(rel.columns)}"
    if len(got) != len(want):
        return f"{len(got)} rows, expected {len(want)}"
    for g, w in zip(got, want, strict=True):
        if g != w:
            return f"{sorted(df.columns)}\n  got  {g}\n  want {w}"
    kinds = {f.name: f.dataType.simpleString() for f in df.schema}
    other = dict(zip(rel.columns, map(str, rel.types), strict=True))
    odd = [
        (n, kinds[n], other[n])
        for n in kinds
        if (kinds[n], other[n])
        not in {("string", "VARCHAR"), ("bigint", "BIGINT"), ("int", "INTEGER"), ("double", "DOUBLE"), ("boolean", "BOOLEAN")}
    ]
    return f"types {odd}" if odd else None


def main(sf_dir: str, names: list[str]) -> int:
    import __spark_entry__ as driver
    from waybill import session

    spark = session.build(
        "check",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "8g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, failed = oracle_connection(sf_dir), 0
    queries, sql = driver.queries(), driver.oracle_sql()
    for name in names or queries:
        start = time.time()
        if name not in sql:
            print(f"{name:28s} rows only {queries[name](spark, sf_dir).count()}", flush=True)
            continue
        try:
            problem = compare(spark, con, queries[name], sql[name], sf_dir)
        except Exception as e:
            problem = f"{type(e).__name__} {str(e)[:800]}"
        failed += problem is not None
        print(f"{name:28s} {time.time() - start:6.2f} {problem or 'ok'}", flush=True)
    return failed


if __name__ == "__main__":
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    sys.exit(main(sf, sys.argv[2:]))
