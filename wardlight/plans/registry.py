"""The named queries: each takes the warehouse of a source folder and gives a DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardlight.plans.warehouse import Warehouse, open_warehouse
from wardlight.session import RUNTIME, TABLES, settle

Query = Callable[[Warehouse], DataFrame]
QUERIES: dict[str, Query] = {}


def query(name: str) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is there already")
        QUERIES[name] = fn
        return fn

    return add


def plain(df: DataFrame) -> DataFrame:
    """Without the technical columns."""
    return df.select(*[c for c in df.columns if not c.startswith("_")])


def tables(names: dict[str, str]) -> None:
    """Queries that are whole tables of the warehouse."""
    for query_name, table in names.items():
        query(query_name)(lambda w, t=table: plain(w[t]))


def run(name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    """One query over one source folder; exact money is given out as doubles."""
    df = QUERIES[name](open_warehouse(settle(spark, RUNTIME | TABLES), sf_dir))
    money = {f.name: F.col(f.name).cast("double") for f in df.schema.fields if isinstance(f.dataType, T.DecimalType)}
    return df.withColumns(money) if money else df
