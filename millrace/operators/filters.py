"""Row choices."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.fixed_values import PLAN_FILE_PATTERN
from millrace.functions.dates import days_before, epoch_seconds


def filter_batch(df: DataFrame, column: str, batch: str) -> DataFrame:
    return df.where(F.col(column) == batch)


def filter_not_null(df: DataFrame, *columns: str) -> DataFrame:
    return df.dropna("any", subset=list(columns))


def filter_non_empty(df: DataFrame, column: str) -> DataFrame:
    """Neither NULL nor ''."""
    return df.where(F.col(column) != "")


def filter_unprocessed(
    df: DataFrame, flag: str, placeholder: DataFrame | None = None, pending: str = "N"
) -> DataFrame:
    """Pending rows; if there are none, the placeholder row instead."""
    rows = df.where(F.col(flag) == pending)
    if placeholder is None:
        return rows
    return rows.unionByName(placeholder.where(~rows.exists()))


def top_level(key: Column, thread: Column) -> Column:
    """A message itself, not a reply in its thread."""
    return thread.isNull() | (key == thread)


def filter_top_level(df: DataFrame, key: str = "SRC_TS", thread: str = "SRC_THRD_TS") -> DataFrame:
    return df.where(top_level(F.col(key), F.col(thread)))


def filter_recent(df: DataFrame, version: str, as_of: Column, days: int) -> DataFrame:
    """Rows whose version time lies in the last ``days`` days before ``as_of``."""
    return df.where(F.col(version) >= days_before(as_of, days))


def filter_recent_epoch(df: DataFrame, key: str, as_of: Column, days: int) -> DataFrame:
    """The same for a key that holds epoch seconds as text."""
    bound = epoch_seconds(days_before(as_of, days))
    return df.where(F.col(key).try_cast("decimal(20,6)") > bound)


def filter_contains(df: DataFrame, column: str, code: str) -> DataFrame:
    """Literal containment: ``_`` and ``%`` in the code have no special meaning."""
    return df.where(F.contains(F.col(column), F.lit(code)))


def split_by_file_name(df: DataFrame, column: str) -> tuple[DataFrame, DataFrame]:
    """Rows from files named by the rule, and the quarantined rest."""
    good = F.coalesce(F.col(column).rlike(PLAN_FILE_PATTERN), F.lit(False))
    return df.where(good), df.where(~good)


def drop_any_null(df: DataFrame) -> DataFrame:
    return df.dropna("any")


def filter_any_value_equals(df: DataFrame, marker: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows in which any field equals the marker."""
    fields = [F.col(f"`{c}`").cast("string") for c in (columns or df.columns)]
    return df.where(F.exists(F.array(*fields), lambda x: x.eqNullSafe(F.lit(marker))))
