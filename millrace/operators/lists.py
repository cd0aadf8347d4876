"""Lists inside a column: one row per item, and lists looked up item by item."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.text import mention_ids, pipe_items, valid_user_id
from millrace.operators.joins import unique_rows


def explode_delimited(df: DataFrame, column: str, position: str = "pos", item: str = "item") -> DataFrame:
    """One row per item of a pipe list with its position from 1; empty slots stay."""
    rest = [c for c in df.columns if c != column]
    return df.select(*rest, F.posexplode(pipe_items(F.col(column))).alias("_p", item)).select(
        *rest, (F.col("_p") + 1).alias(position), item
    )


def zip_recipients(
    df: DataFrame, ids: str, partners: str, legacy_ids: bool = False,
    id_name: str = "to_id", partner_name: str = "partner",
) -> DataFrame:
    """Pair two pipe lists slot by slot and drop the slots with an invalid id."""
    rest = [c for c in df.columns if c not in (ids, partners)]
    zipped = F.arrays_zip(
        pipe_items(F.col(ids)).alias("i"), pipe_items(F.col(partners)).alias("p")
    )
    rows = df.select(*rest, F.posexplode(zipped).alias("_p", "_z")).select(
        *rest, (F.col("_p") + 1).alias("pos"),
        F.col("_z.i").alias(id_name), F.col("_z.p").alias(partner_name),
    )
    return rows.where(valid_user_id(F.col(id_name), legacy_ids))


def mention_lists(
    messages: DataFrame, directory: DataFrame, keys: Sequence[str], text: str
) -> DataFrame:
    """Messages with their mentioned ids, names and addresses as pipe lists.

    Unknown ids leave an empty slot; messages without a mention get NULL.  Looked up
    by a join on the id, so the directory may be of any size; only rows with a
    mention take part.  ``keys`` identify a message.
    """
    ids = messages.select(*keys, F.posexplode(mention_ids(F.col(text))).alias("_p", "_id"))
    people = unique_rows(
        directory.where(F.col("email").isNotNull())
        .select(F.col("id").alias("_id"), F.col("name").alias("_name"), F.col("email").alias("_email")),
        ["_id"],
    )
    known = ids.join(people, "_id", "left")
    # A set, so that copies of a message collapse before they are shuffled.
    slots = F.array_sort(F.collect_set(F.struct(
        "_p", "_id", F.coalesce("_name", F.lit("")).alias("_name"),
        F.coalesce("_email", F.lit("")).alias("_email"),
    )))
    lists = known.groupBy(*keys).agg(slots.alias("_s"))

    def pipe(field: str) -> Column:
        return F.array_join(F.transform("_s", lambda s: s[field]), "|")

    lists = lists.select(
        *keys, pipe("_id").alias("TO_USR_SRC_ID"), pipe("_name").alias("TO_USRNM"),
        pipe("_email").alias("TO_USR_EMAIL"),
    )
    return messages.join(lists, list(keys), "left")
