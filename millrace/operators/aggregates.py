"""Aggregations.  All of them combine on the map side first."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def max_high_water(df: DataFrame, column: str, start: object = 0) -> DataFrame:
    """The largest loaded key; ``start`` for an empty table."""
    return df.agg(F.coalesce(F.max(column), F.lit(start)).alias("high_water"))


def max_per_key(df: DataFrame, keys: Sequence[str], column: str, alias: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.max(column).alias(alias))


def max_filtered(df: DataFrame, column: str, condition: Column, keys: Sequence[str] = ()) -> DataFrame:
    """The newest value among the rows that carry the marker."""
    return df.groupBy(*keys).agg(F.max(F.when(condition, F.col(column))).alias("newest"))


def count_rows(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n_rows"))


def distinct_keys(df: DataFrame, *columns: str) -> DataFrame:
    return df.select(*columns).distinct()


def count_distinct_compare(left: DataFrame, right: DataFrame, column: str) -> DataFrame:
    """Distinct keys on both sides, and whether the left has more of them."""
    sides = left.select(column).distinct().select(F.lit("l").alias("side")).unionByName(
        right.select(column).distinct().select(F.lit("r").alias("side"))
    )
    counted = sides.agg(
        F.count(F.when(F.col("side") == "l", 1)).alias("n_left"),
        F.count(F.when(F.col("side") == "r", 1)).alias("n_right"),
    )
    return counted.withColumn("left_has_more", F.col("n_left") > F.col("n_right"))


def collect_distinct_per_group(df: DataFrame, keys: Sequence[str], column: str, alias: str) -> DataFrame:
    """Sorted distinct values per group.

    Repeats are removed before the lists are built, so a hot group moves no more
    than its distinct values.
    """
    return df.select(*keys, column).distinct().groupBy(*keys).agg(
        F.sort_array(F.collect_list(column)).alias(alias)
    )


def any_value_per_group(df: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """One value per column and group; the smallest, so that reruns agree."""
    return df.groupBy(*keys).agg(*[F.min(c).alias(c) for c in columns])


def concat_accumulate(df: DataFrame, keys: Sequence[str], order: str, column: str, alias: str) -> DataFrame:
    """Pipe list per group, each item put in front of the earlier ones: ``c|b|a|``."""
    items = F.reverse(F.array_sort(F.collect_list(F.struct(order, column))))
    joined = F.array_join(F.transform(items, lambda i: F.concat(i[column], F.lit("|"))), "")
    return df.select(*keys, order, column).distinct().groupBy(*keys).agg(joined.alias(alias))


def batch_row_counters(
    read: DataFrame, written: DataFrame, table: str, processed: Column | None = None
) -> DataFrame:
    """Rows read, processed, offered and written per table."""
    ok = processed if processed is not None else F.lit(True)
    source = read.groupBy(table).agg(
        F.count(F.lit(1)).alias("Num_Rows_Read"),
        F.count(F.when(ok, 1)).alias("Num_Rows_Processed"),
    )
    target = written.groupBy(table).agg(F.count(F.lit(1)).alias("Total_Rows_To_Target"))
    return source.join(target, table, "left").select(
        table, "Num_Rows_Read", "Num_Rows_Processed",
        F.col("Num_Rows_Read").alias("Total_Rows_From_Source"),
        F.coalesce("Total_Rows_To_Target", F.lit(0)).alias("Total_Rows_To_Target"),
    )


def reconcile_counts(pairs: Mapping[str, tuple[DataFrame, DataFrame]]) -> DataFrame:
    """Source and loaded rows per table, the missing ones and the percentage."""
    tagged = None
    for name, (source, target) in pairs.items():
        for side, df in (("s", source), ("t", target)):
            part = df.select(F.lit(name).alias("table_name"), F.lit(side).alias("side"))
            tagged = part if tagged is None else tagged.unionByName(part)
    counts = tagged.groupBy("table_name").agg(
        F.count(F.when(F.col("side") == "s", 1)).alias("source_rows"),
        F.count(F.when(F.col("side") == "t", 1)).alias("loaded_rows"),
    )
    share = F.col("loaded_rows").cast("decimal(20,0)") * 100 / F.nullif("source_rows", F.lit(0))
    return counts.select(
        "table_name", "source_rows", "loaded_rows",
        (F.col("source_rows") - F.col("loaded_rows")).alias("missing_rows"),
        F.round(share, 2).cast("decimal(20,2)").alias("percent_loaded"),
    )
