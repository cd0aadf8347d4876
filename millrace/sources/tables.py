"""Table scans."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def parquet_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def table_projected_scan(df: DataFrame, columns: Sequence[str] | str) -> DataFrame:
    """Only the listed columns; also takes a quoted comma list from a control row."""
    if isinstance(columns, str):
        columns = [c.strip().strip('"') for c in columns.split(",")]
    return df.select(*[F.col(f"`{c}`") for c in columns])


def control_table_scan(control: DataFrame, source_db: str) -> DataFrame:
    """Tables to extract and their column lists: active rows of one source."""
    return control.where(
        (F.col("Extract_Process_Active_Ind") == "Y") & (F.col("Source_Db_Nm") == source_db)
    ).select("Source_Table_Nm", "Source_Column_Names")


def jdbc_options(
    url: str, table: str, *, columns: Sequence[str] | None = None, where: str | None = None,
    partition_column: str | None = None, lower: object = None, upper: object = None,
    partitions: int = 32, fetch_size: int = 10_000,
) -> dict[str, str]:
    """Options of a parallel JDBC read; without a partition column it is one task."""
    options = {"url": url, "fetchsize": str(fetch_size)}
    if columns or where:
        picked = ", ".join(columns) if columns else "*"
        condition = f" WHERE {where}" if where else ""
        options["dbtable"] = f"(SELECT {picked} FROM {table}{condition}) src"
    else:
        options["dbtable"] = table
    if partition_column is not None:
        if lower is None or upper is None:
            raise ValueError("a partition column needs its lower and upper bound")
        options.update(
            partitionColumn=partition_column, lowerBound=str(lower), upperBound=str(upper),
            numPartitions=str(partitions),
        )
    return options


def jdbc_scan(spark: SparkSession, url: str, table: str, **kwargs) -> DataFrame:
    """Full or projected scan of a database table, split by ranges of one column."""
    return spark.read.format("jdbc").options(**jdbc_options(url, table, **kwargs)).load()
