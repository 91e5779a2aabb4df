"""Registration of queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Tables = Callable[[str], DataFrame]
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Registers f(t), where t(table) reads a table, as a query; sql is its oracle."""

    def register(f: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        QUERIES[name] = lambda spark, sf_dir: f(lambda table: spark.read.parquet(f"{sf_dir}/{table}.parquet"))
        if sql is not None:
            SQL[name] = sql
        return f

    return register


def cents(column: str):
    """Money as whole cents, which add up the same in any order."""
    return F.round(F.col(column) * 100).cast("long")


def day(column: str):
    """A timestamp as the number of days since 1970-01-01."""
    return F.datediff(F.to_date(F.col(column)), F.lit("1970-01-01").cast("date")).cast("long")


def second(column: str):
    """A timestamp without a zone as whole seconds since 1970-01-01."""
    return F.expr(f"timestampdiff(SECOND, TIMESTAMP_NTZ '1970-01-01 00:00:00', {column})")
