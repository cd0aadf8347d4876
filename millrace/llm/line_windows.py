"""Line de-duplication by overlapping windows of three lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import Sealed
from millrace.session import settle

#: Lines of a window.
LINES = 3


def _pairs(text: Column) -> Column:
    """(position, line) of the non-blank lines."""
    return F.filter(
        F.transform(F.split(text, "\n", -1), lambda line, i: F.struct(i.alias("i"), line.alias("line"))),
        lambda p: p["line"] != "",
    )


def _windows(pairs: Column) -> Column:
    """All windows of a column of pairs: the positions of their lines and two 64-bit hashes."""

    def window(p: Column, k: Column) -> Column:
        second, third = F.get(pairs, k + 1), F.get(pairs, k + 2)
        content = [p["line"], F.lit("\n"), second["line"], F.lit("\n"), third["line"]]
        return F.struct(
            p["i"].alias("i"), second["i"].alias("i2"), third["i"].alias("i3"),
            F.xxhash64(*content).alias("h1"), F.xxhash64(F.lit(1), *content).alias("h2"),
        )

    return F.transform(F.slice(pairs, F.lit(1), F.greatest(F.size(pairs) - (LINES - 1), F.lit(0))), window)


def drop_repeated_lines(df: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Each row with ``removed`` (positions of dropped lines, from 0), ``n_lines`` and ``clean_text``.

    Every three consecutive non-blank lines (blank ones between them are skipped) are
    hashed; of a window that occurs more than once in the whole table, all occurrences
    but the first are later ones, first by id (nulls last), then by a hash of the text,
    then by position.  A line covered by any later occurrence goes, the others stay, blank
    ones among them.  Texts with fewer than three non-blank lines have no window and stay
    as they are; null texts give null.  Rows with equal id and text count as one document
    and are cleaned alike; old columns with the names of new ones are replaced.  Lines are split at ``\\n`` and compared exactly.

    Only hashes and positions are shuffled on the way; a very common window is counted
    on the map side, and the join that finds its later occurrences splits hot keys.
    """
    sealed = Sealed(df, id, text)
    key = F.struct(F.col(id).isNull().alias("no_id"), F.col(id).alias("id"), F.xxhash64(text).alias("h"))
    windows = (
        df.where(F.col(text).contains("\n"))
        .select(key.alias("_doc"), _pairs(F.col(text)).alias("_pairs"))
        .select("_doc", F.explode(_windows(F.col("_pairs"))).alias("w"))
        .select("_doc", "w.*")
    )
    first = windows.groupBy("h1", "h2").agg(
        F.min(F.struct("_doc", "i")).alias("first"), F.count(F.lit(1)).alias("n")
    ).where("n > 1").select("h1", "h2", "first")
    # Written before the join, which can split a hot window only if nothing is aggregated beside it.
    later = windows.join(settle(first, "repeated"), ["h1", "h2"]).where(
        (F.col("_doc") != F.col("first._doc")) | (F.col("i") != F.col("first.i"))
    )
    # Windows may overlap; the set of positions merges what they cover.
    covered = later.select("_doc", F.explode(F.array("i", "i2", "i3")).alias("i")).groupBy("_doc").agg(
        F.sort_array(F.collect_set("i")).alias("removed")
    )
    kept = F.array_except(F.sequence(F.lit(0), F.col("n_lines") - 1), F.col("removed"))
    out = (
        sealed.inner.withColumn("_doc", key).join(covered, "_doc", "left")
        .withColumn("_lines", F.split(F.col(text), "\n", -1))
        .withColumn("n_lines", F.when(F.col(text).isNotNull(), F.size("_lines")))
        .withColumn("clean_text", F.when(F.col("removed").isNull(), F.col(text)).otherwise(
            F.array_join(F.transform(kept, lambda i: F.get(F.col("_lines"), i)), "\n")))
        .withColumn("removed", F.coalesce("removed", F.array().cast("array<int>")))
    )
    return sealed.open(out, "removed", "n_lines", "clean_text")
