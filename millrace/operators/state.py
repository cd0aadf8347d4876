"""Deletes and updates as new table states.

Parquet tables take no DELETE or UPDATE: each function returns the rows the table
should hold afterwards, and a sink commits them.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.dates import days_before
from millrace.operators.joins import anti_join, semi_join


def delete_batch(df: DataFrame, column: str, batch: str) -> DataFrame:
    """All rows but those of one batch; rows without a batch stay."""
    return df.where((F.col(column) != batch) | F.col(column).isNull())


def replace_batch(df: DataFrame, incoming: DataFrame, column: str) -> DataFrame:
    """A re-delivered batch takes the place of its earlier rows."""
    return anti_join(df, incoming, {column: column}).unionByName(incoming)


@dataclass(frozen=True)
class Child:
    """A table below another one: ``key`` maps its column to the parent's."""

    table: str
    parent: str
    key: Mapping[str, str]


def cascade_delete(
    tables: Mapping[str, DataFrame], root: str, doomed: Column, children: Sequence[Child]
) -> dict[str, DataFrame]:
    """New states of all tables after deleting root rows and everything below them.

    ``children`` lists parents before their children.
    """
    gone = {root: tables[root].where(doomed)}
    state = {root: tables[root].where(~F.coalesce(doomed, F.lit(False)))}
    for child in children:
        df = tables[child.table]
        gone[child.table] = semi_join(df, gone[child.parent], child.key)
        state[child.table] = anti_join(df, gone[child.parent], child.key)
    return state


def update_flag(df: DataFrame, flag: str, matched: Column, value: str = "Y") -> DataFrame:
    return df.withColumn(flag, F.when(matched, F.lit(value)).otherwise(F.col(flag)))


def mark_claimed(df: DataFrame, claimed: DataFrame, key: str, flag: str, value: str = "Y") -> DataFrame:
    """Set the flag of claimed rows only; rows that came later keep theirs."""
    keys = claimed.select(F.col(key).alias("_claimed")).distinct()
    joined = df.join(keys, df[key] == keys["_claimed"], "left")
    new = F.when(F.col("_claimed").isNotNull(), F.lit(value)).otherwise(df[flag])
    return joined.select(*[new.alias(c) if c == flag else df[c] for c in df.columns])


def drop_orphans(child: DataFrame, parent: DataFrame, on: Mapping[str, str]) -> DataFrame:
    """Child rows that still have their parent."""
    return semi_join(child, parent, on)


def retention_delete(
    main: DataFrame, details: Mapping[str, DataFrame], key: str, flag: str, time: str,
    as_of: Column, days: int = 1, done: str = "Y",
) -> tuple[DataFrame, dict[str, DataFrame]]:
    """Drop old processed rows, then old detail rows whose main row is gone."""
    bound = days_before(as_of, days)
    expired = (F.col(time) < bound) & (F.col(flag) == done)
    kept = main.where(~F.coalesce(expired, F.lit(False)))
    states = {}
    for name, df in details.items():
        old = F.coalesce(F.col(time) < bound, F.lit(False))
        states[name] = df.where(~old).unionByName(semi_join(df.where(old), kept, {key: key}))
    return kept, states
