"""Column choices: subset, rename, drop, add."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.fixed_values import (
    INACTIVE_TABLES,
    PRIVATE_COLUMNS,
    PRIVATE_NOTE_COLUMN,
    PRIVATE_NOTE_TABLES,
)


def project(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Subset and order of columns."""
    return df.select(*columns)


def rename_map(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Rename by header; names that do not occur are ignored."""
    return df.withColumnsRenamed(dict(names))


def upper_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.upper() for c in df.columns])


def all_null_columns(df: DataFrame) -> list[str]:
    """Names of columns without any value: one pass, one row to the driver.

    A table without rows keeps its columns.
    """
    counts = [F.count(F.col(f"`{c}`")) for c in df.columns]
    n_rows, *seen = df.agg(F.count(F.lit(1)), *counts).first()
    return [c for c, n in zip(df.columns, seen) if n == 0 < n_rows]


def drop_all_null_columns(df: DataFrame) -> DataFrame:
    return df.drop(*all_null_columns(df))


def drop_identity_columns(df: DataFrame, identity: Iterable[str]) -> DataFrame:
    """Drop the columns the target numbers itself; an empty list drops nothing."""
    return df.drop(*identity)


def constant_columns(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    return df.withColumns({c: F.lit(v) for c, v in values.items()})


def with_batch_id(df: DataFrame, column: str = "Batch_Run_Id") -> DataFrame:
    """The name of the file a row was read from."""
    return df.withColumn(column, F.col("_metadata.file_name"))


def add_default_columns(df: DataFrame, copied: Mapping[str, str], blank: Sequence[str]) -> DataFrame:
    """Working columns: ``copied`` maps new to existing ones, ``blank`` start as ''."""
    added: dict[str, Column] = {new: F.col(old) for new, old in copied.items()}
    added.update({c: F.lit("") for c in blank})
    return df.withColumns(added)


def is_private(table: Column, column: Column) -> Column:
    """Private columns, and the note column of tables about people."""
    return column.isin(PRIVATE_COLUMNS) | (
        table.isin(PRIVATE_NOTE_TABLES) & (column == PRIVATE_NOTE_COLUMN)
    )


def exclude_private_columns(
    metadata: DataFrame, rules: DataFrame | None = None
) -> DataFrame:
    """Column metadata without private columns.

    ``rules`` has ``table_name`` (NULL: any table) and ``column_name`` and replaces
    the built-in list.
    """
    if rules is None:
        return metadata.where(~is_private(F.col("table_name"), F.col("column_name")))
    anywhere = rules.where("table_name is null").select("column_name").distinct()
    in_table = rules.where("table_name is not null").select("table_name", "column_name").distinct()
    return metadata.join(anywhere, "column_name", "left_anti").join(
        in_table, ["table_name", "column_name"], "left_anti"
    ).select(*metadata.columns)


def build_column_list(
    metadata: DataFrame, inactive: Sequence[str] = tuple(INACTIVE_TABLES)
) -> DataFrame:
    """One quoted, comma-separated column list per table, with its active flag."""
    listed = F.array_sort(F.collect_list(F.struct("position", "column_name")))
    quoted = F.transform(listed, lambda c: F.concat(F.lit('"'), c["column_name"], F.lit('"')))
    return metadata.groupBy("table_name").agg(
        F.array_join(quoted, ",").alias("Source_Column_Names"),
    ).select(
        F.col("table_name").alias("Source_Table_Nm"),
        "Source_Column_Names",
        F.col("table_name").alias("Target_Table_Nm"),
        F.when(F.col("table_name").isin(list(inactive)), "N")
        .otherwise("Y").alias("Extract_Process_Active_Ind"),
        F.lit("N").alias("Extract_Processed_Ind"),
    )
