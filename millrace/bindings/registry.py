"""Queries over the test tables, each with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from millrace.session import tune
from millrace.sources.tables import parquet_table

Query = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Binding:
    run: Query
    sql: str | None


REGISTRY: dict[str, Binding] = {}


def query(key: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its key, with its oracle if SQL can express it."""

    def register(run: Query) -> Query:
        if key in REGISTRY:
            raise ValueError(f"query {key} is registered twice")

        def tuned(spark: SparkSession, folder: str) -> DataFrame:
            return run(tune(spark), folder)

        REGISTRY[key] = Binding(tuned, sql)
        return run

    return register


def tables(spark: SparkSession, folder: str, *names: str) -> list[DataFrame]:
    return [parquet_table(spark, folder, n) for n in names]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return parquet_table(spark, folder, name)


#: The fixed "now" of all queries over time.
AS_OF = "2024-01-31 00:00:00"
EXACT = "yyyy-MM-dd HH:mm:ss.SSSSSS"
EXACT_SQL = "%Y-%m-%d %H:%M:%S.%f"
