"""Registry of bound queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def bound(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function name, with its SQL if there is one."""
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = sql
        return f
    return add


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


#: rows of one task where work is heavy per row
ROWS_PER_TASK = 50_000


def spread(df: DataFrame, key: str, rows: int = ROWS_PER_TASK) -> DataFrame:
    """Narrow rows dealt out before work that is heavy per row: to all cores, ``rows`` to a task.

    A scan deals out bytes, and a file's row groups as a whole.  Narrow rows are so many to a
    byte that a few tasks would have all the work, however many splits there are.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(max(cores, -(-df.count() // rows)), key)
