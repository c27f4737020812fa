"""Run a query on Spark and its expected SQL elsewhere, and compare rows."""

from __future__ import annotations

import datetime
import decimal
import math

import duckdb

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _plain(value):
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, bool):
        return value
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return int(value) if value == int(value) and abs(value) < 1e15 else value
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, datetime.date):
        return value.isoformat()
    return value


def normal(columns: list[str], rows: list) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=repr)


def spark_rows(df) -> tuple[list[str], list[tuple]]:
    return sorted(df.columns), normal(df.columns, df.collect())


def duck_rows(con, sql: str) -> tuple[list[str], list[tuple]]:
    cur = con.execute(sql)
    columns = [c[0] for c in cur.description]
    return sorted(columns), normal(columns, cur.fetchall())


def difference(df, con, sql: str) -> str | None:
    """None when both give the same rows, else what differs."""
    cols_a, a = spark_rows(df)
    cols_b, b = duck_rows(con, sql)
    if cols_a != cols_b:
        return f"columns: only spark {sorted(set(cols_a) - set(cols_b))}, only sql {sorted(set(cols_b) - set(cols_a))}"
    if a == b:
        return None
    out = [f"rows: spark {len(a)}, sql {len(b)}"]
    only_a, only_b = sorted(set(a) - set(b), key=repr), sorted(set(b) - set(a), key=repr)
    for x, y in list(zip(only_a, only_b))[:2]:
        out.append("; ".join(f"{c}: {u!r} | {v!r}" for c, u, v in zip(cols_a, x, y) if u != v))
    if not only_a or not only_b:
        out.append(f"spark only {only_a[:2]} sql only {only_b[:2]}")
    return " // ".join(out)[:900]
