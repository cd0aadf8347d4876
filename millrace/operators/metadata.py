"""Work on column metadata: type names, drift and DDL reports.

A metadata frame has ``table_name, position, column_name, type, size, precision,
scale``, one row per column.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.fixed_values import (
    ALLOWED_WIDENING,
    NO_COLUMN,
    NO_TABLE,
    NUMERIC_TYPE,
    OTHER_TYPE,
    PRIVATE_COLUMNS,
    SIZED_TYPE,
    SMALLER_SIZE,
    UNKNOWN_TYPE,
    UNLIMITED_TYPE,
    UNSIZED_TYPES,
)
from millrace.functions.cleansing import standardise_type

#: Never reported, neither as drift nor in DDL.
SKIPPED_COLUMN = PRIVATE_COLUMNS[0]


def standardise_types(metadata: DataFrame) -> DataFrame:
    return metadata.where(F.col("column_name") != SKIPPED_COLUMN).withColumn(
        "type", standardise_type(F.col("type"))
    )


def _sized() -> Column:
    """A type with its size; a size that is NULL is unlimited."""
    return F.when(F.col("size").isNull(), F.format_string(UNLIMITED_TYPE, "type")).otherwise(F.format_string(SIZED_TYPE, "type", "size"))


def schema_drift_report(source: DataFrame, target: DataFrame) -> DataFrame:
    """What the target lacks: tables, columns, compatible types, sufficient sizes.

    Both sides carry canonical types.  Only real differences are reported.
    """
    tables = target.select("table_name").distinct().withColumn("_has_table", F.lit(True))
    theirs = target.select(
        "table_name", "column_name",
        *[F.col(c).alias(f"t_{c}") for c in ("type", "size", "precision", "scale")],
    )
    missing_tables = source.select("table_name").distinct().join(
        tables, "table_name", "left_anti"
    ).select(
        "table_name", F.lit(None).cast("string").alias("column_name"),
        F.lit(NO_TABLE).alias("issue"), F.col("table_name").alias("detail"),
    )

    both = source.join(tables.drop("_has_table"), "table_name", "left_semi").join(
        theirs, ["table_name", "column_name"], "left"
    )
    absent = F.col("t_type").isNull()
    widened = F.lit(False)
    for old, new in ALLOWED_WIDENING:
        widened = widened | ((F.col("type") == old) & (F.col("t_type") == new))
    mismatch = (F.col("type") != F.col("t_type")) & ~widened
    # A size that is NULL is unlimited, so it fits in no other.
    unlimited = F.lit((1 << 31) - 1)
    shrink = F.coalesce("size", unlimited) - F.coalesce("t_size", unlimited)
    tolerance = F.when(F.col("type") == "NUMERIC", 1).otherwise(0)
    too_small = (
        (F.col("type") == F.col("t_type")) & ~F.col("type").isin(UNSIZED_TYPES)
        & (shrink > tolerance)
    )
    sized = F.when(
        F.col("type").isin(UNSIZED_TYPES), F.col("type")
    ).when(
        F.col("type") == "NUMERIC",
        F.format_string(NUMERIC_TYPE, "type", "precision", "scale"),
    ).otherwise(_sized())
    issue = F.when(absent, NO_COLUMN).when(mismatch, OTHER_TYPE).when(too_small, SMALLER_SIZE)
    detail = F.when(mismatch, F.concat_ws(" ", "type", F.lit("->"), "t_type")).otherwise(sized)
    columns = both.select(
        "table_name", "column_name", issue.alias("issue"), detail.alias("detail")
    ).where(F.col("issue").isNotNull())
    return columns.unionByName(missing_tables)


def column_ddl(metadata: DataFrame) -> DataFrame:
    """``[name] TYPE(...)`` per column, from canonical types."""
    name = F.concat(F.lit("["), "column_name", F.lit("] "))
    plain = F.col("type").isin("DATETIME", "INTEGER", "BIT", "FLOAT", "DATE")
    ddl = (
        F.when(plain, F.concat(name, "type"))
        .when(F.col("type") == "NUMERIC",
              F.concat(name, F.format_string(NUMERIC_TYPE, "type", "precision", "scale")))
        .when(F.col("type") == "VARCHAR", F.concat(name, _sized()))
        .otherwise(F.concat(F.lit(UNKNOWN_TYPE), name, "type"))
    )
    return metadata.withColumn("ddl", ddl)


def ddl_report(metadata: DataFrame, tables: list[str] | None = None) -> DataFrame:
    """One column list per table, for all tables or the named ones."""
    if tables is not None:
        metadata = metadata.where(F.col("table_name").isin(tables))
    listed = F.array_sort(F.collect_list(F.struct("position", "ddl")))
    return column_ddl(metadata).groupBy("table_name").agg(
        F.array_join(F.transform(listed, lambda c: c["ddl"]), "\n,").alias("ddl")
    )
