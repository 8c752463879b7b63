"""Registry of checkable queries: a Spark form and, where SQL can state it, a SQL form."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.functions.values import is_floating
from ledgerlens.workload.derive import SQL_PREFIX, SQL_SNAPSHOTS, Warehouse, warehouse

Query = Callable[[Warehouse], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def register(
    name: str, body: str | None = None, ctes: str = "", snapshots: bool = False
) -> Callable[[Query], Query]:
    """Register a query; ``body`` is the SELECT that follows the shared derivation."""

    def add(query: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name!r} is registered twice")
        QUERIES[name] = query
        if body is not None:
            parts = [SQL_PREFIX] + ([SQL_SNAPSHOTS] if snapshots else []) + ([ctes] if ctes else [])
            SQL[name] = ",\n".join(p.rstrip() for p in parts) + "\n" + body.strip()
        return query

    return add


def runnable(name: str) -> Callable[[SparkSession, str], DataFrame]:
    query = QUERIES[name]

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return query(warehouse(spark, sf_dir))

    run.__name__ = name
    return run


def rounded(df: DataFrame, digits: int = 6, skip: Sequence[str] = ()) -> DataFrame:
    """Round floating-point columns, as sums and powers differ in the last bits."""

    def cell(field):
        if is_floating(field.dataType) and field.name not in skip:
            return F.round(field.name, digits).alias(field.name)
        return F.col(field.name)

    return df.select(*[cell(f) for f in df.schema.fields])


def round_sql(columns: Sequence[str], digits: int = 6) -> str:
    """``* REPLACE`` list that rounds the columns."""
    return "* REPLACE (" + ", ".join(f"ROUND({c}, {digits}) AS {c}" for c in columns) + ")"
