"""Exact de-duplication by progressive refinement."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import Sealed
from millrace.session import settle

#: Characters that the prefix hash reads.
PREFIX = 64


def exact_groups(df: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Each row with ``keep_id``, ``group_size`` and ``kept``; of equal texts the row with the largest id stays.

    Rows are grouped by byte length, those whose length is not unique by a hash of their
    first characters, and only the rows that still share a group have their full content
    hashed (SHA-256) and compared.  The first two steps work on a slim frame of 16 bytes a
    row, which is written once; what they leave are keys, joined with the rows at every
    size.  Rows that are alone with their key are done then.  The others get a row number,
    pinned in a file, that tells repeated rows apart.

    Null texts count as empty.  A null id is smaller than any other.  Of rows that agree
    in id and text, one stays.  An empty table gives an empty one; old columns with the
    names of new ones are replaced.
    """
    sealed = Sealed(df, id, text)
    whole = F.coalesce(F.col(text), F.lit(""))
    keyed = sealed.inner.withColumns({
        "_length": F.octet_length(whole), "_prefix": F.xxhash64(F.substring(whole, 1, PREFIX)),
    })
    slim = settle(keyed.select("_length", "_prefix"), "prefixes")

    def shared(rows: DataFrame, *keys: str) -> DataFrame:
        return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select(*keys)

    same_length = slim.join(shared(slim, "_length"), "_length", "left_semi")
    # Written before the join, which can split a hot key only if nothing is aggregated beside it.
    many = settle(shared(same_length, "_length", "_prefix").withColumn("_many", F.lit(True)), "shared_prefixes")
    tagged = settle(
        keyed.join(many, ["_length", "_prefix"], "left").drop("_length", "_prefix")
        .withColumn("_row", F.monotonically_increasing_id()), "tagged")
    columns = sealed.inner.columns
    alone = tagged.where("_many IS NULL").select(
        *columns, F.col(id).alias("keep_id"), F.lit(1).cast("bigint").alias("group_size"), F.lit(True).alias("kept")
    )
    full = tagged.where("_many").withColumn("_sha", F.sha2(whole, 256))
    groups = full.groupBy("_sha").agg(
        F.max(F.struct(F.col(id).alias("id"), F.col("_row").alias("row"))).alias("_best"),
        F.count(F.lit(1)).alias("group_size"),
    )
    rest = full.join(settle(groups, "equal_texts"), "_sha").select(
        *columns, F.col("_best.id").alias("keep_id"), "group_size", (F.col("_row") == F.col("_best.row")).alias("kept")
    )
    return sealed.open(alone.unionByName(rest), "keep_id", "group_size", "kept")


def exact_dedup(df: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each group of equal texts, with the columns of ``df``."""
    sealed = Sealed(df, id, text)
    return sealed.open(exact_groups(sealed.inner, id, text).where("kept"))


def one_per_key(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row per key; rows are limited before the shuffle."""
    w = Window.partitionBy(*keys).orderBy(*keys)
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")
