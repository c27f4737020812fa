"""Compare all queries with their expected SQL: ``python -m tests.check SF_DIR [prefix ...]``."""

from __future__ import annotations

import sys
import time

import __spark_entry__ as entry
from tests import compare
from wardlight.session import build_session


def main(sf_dir: str, prefixes: list[str]) -> int:
    spark = build_session(master="local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "12g"})
    spark.sparkContext.setLogLevel("OFF")
    con, queries, expected, bad = compare.connect(sf_dir), entry.queries(), entry.oracle_sql(), 0
    for name, query in queries.items():
        if prefixes and not name.startswith(tuple(prefixes)):
            continue
        start = time.time()
        try:
            df = query(spark, sf_dir)
            columns, rows = compare.spark_rows(df)
            spent = time.time() - start
            found = compare.difference(df, con, expected[name]) if name in expected else None
            found = found and str(found)
        except Exception as error:
            rows, spent, found = [], time.time() - start, f"error {str(error)[:600]}".replace("\n", " ")
        bad += found is not None
        print(f"\n{'BAD ' if found else 'ok  '} {name:40s} {len(rows):8d} rows {spent:6.2f}s {found or ''}", flush=True)
    print(f"\n{bad} differ")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1], sys.argv[2:]) else 0)
