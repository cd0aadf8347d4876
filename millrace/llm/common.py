"""Helpers shared by the operators of this package."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.session import tune

#: Rows and bytes of the batches that Python workers get, so that their memory does not follow the text lengths.
BATCH_ROWS = 256
BATCH_BYTES = 4 << 20

#: Sub-groups that ``numbered`` cuts each group into, and rows from which on one of them is too large for a task.
SALTS, SALT_ROWS = 16, 1_000_000


def salts_by_count(counts: Mapping[int | str, int], key: Column) -> Column:
    """How many sub-groups a group gets: ``SALTS``, and more where that would leave over ``SALT_ROWS`` in each.

    Only the groups that need more are part of the plan, one for each 16 million rows at most.
    """
    heavy = {k: -(-n // SALT_ROWS) for k, n in counts.items() if n > SALTS * SALT_ROWS}
    if not heavy:
        return F.lit(SALTS)
    entries = F.create_map(*[F.lit(x) for pair in heavy.items() for x in pair])
    return F.coalesce(F.try_element_at(entries, key), F.lit(SALTS))


def prepare(spark: SparkSession) -> SparkSession:
    """The library's SQL settings, and small batches for Python workers.

    Both hold for the whole session from then on, as frames are run after the operators
    have returned them: give jobs with other needs a session of their own (``newSession``).
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return tune(spark)


class Sealed:
    """A frame whose other columns travel in one struct, so that no name of theirs can clash with an operator's own.

    ``inner`` has the ``needed`` columns and the struct.  ``open`` gives the columns of
    the original frame back, followed by the ``added`` ones; an original column with the
    name of an added one is replaced by it.
    """

    def __init__(self, df: DataFrame, *needed: str) -> None:
        self._columns = df.columns
        self.needed = list(dict.fromkeys(needed))
        others = [c for c in df.columns if c not in self.needed]
        rest = F.struct(*[F.col(f"`{c}`") for c in others]) if others else F.struct(F.lit(0).alias("none"))
        self.inner = df.select(*[F.col(f"`{c}`") for c in self.needed], rest.alias("__rest"))

    def open(self, out: DataFrame, *added: str) -> DataFrame:
        new = {n.lower() for n in added}
        return out.select(*[
            F.col(f"`{c}`") if c in self.needed else F.col("__rest").getField(c).alias(c)
            for c in self._columns if c.lower() not in new
        ], *added)


def numbered(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], alias: str,
    extra: DataFrame | None = None, salts: Column | None = None,
) -> DataFrame:
    """Rows numbered from 0 within their group, where one group may hold most of the rows.

    Each group is cut into ``salts`` sub-groups (``salts_by_count``) by a hash of ``order``; a window numbers
    the rows of a sub-group and the counts of the sub-groups before it (combined on the
    map side) are added.  The order within a group is therefore (salt, ``order``):
    arbitrary but fixed.  Rows that tie on all of ``order`` may swap numbers, so list
    enough columns to tell different rows apart.  ``keys`` must not be null.  Columns of
    ``extra`` (one row per group, keyed by ``keys``) come along with the counts.
    """
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(*order), F.lit(SALTS) if salts is None else salts).cast("int"))
    group = [*keys, "_salt"]
    before = Window.partitionBy(*keys).orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)
    offsets = salted.groupBy(*group).agg(F.count(F.lit(1)).alias("_n")).select(
        *group, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before")
    )
    if extra is not None:
        offsets = offsets.join(extra, list(keys), "left")
    within = Window.partitionBy(*group).orderBy(*[F.col(c).asc_nulls_first() for c in order])
    ranked = salted.withColumn("_place", F.row_number().over(within) - 1)
    return ranked.join(offsets, group).withColumn(alias, F.col("_before") + F.col("_place")).drop(
        "_salt", "_before", "_place"
    )
