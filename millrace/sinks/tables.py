"""Writes.  Every one may be repeated after a failure without changing the result,
except a plain append."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators.joins import anti_join, semi_join
from millrace.session import scratch_path, settle
from millrace.sources.files import csv_scan

#: Partition column of bucketed tables.
BUCKET = "batch_bucket"


def truncate_load(df: DataFrame, path: str) -> DataFrame:
    """Full refresh; returns the loaded table.  ``df`` must not read from ``path``."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def append_load(df: DataFrame, path: str) -> DataFrame:
    df.write.mode("append").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def commit_state(state: DataFrame, path: str) -> DataFrame:
    """Replace a table by a state computed from it.

    The state is written beside the table first, since a path cannot be overwritten
    while it is read.
    """
    staged = truncate_load(state, scratch_path(state.sparkSession, "state"))
    return truncate_load(staged, path)


def bucketed_load(df: DataFrame, name: str, path: str, keys: Sequence[str], buckets: int) -> DataFrame:
    """Full refresh of a catalog table bucketed and sorted by its join keys.

    Tables bucketed alike are joined, grouped and ranked by these keys without a shuffle.
    """
    (
        df.repartition(buckets, *keys).write.mode("overwrite").option("path", path)
        .bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(name)
    )
    return df.sparkSession.table(name)


def replace_partitions(df: DataFrame, path: str, partitions: Sequence[str]) -> DataFrame:
    """Overwrite only the partitions that occur in ``df``; all others stay untouched.

    Rows are gathered by partition value before the write, so that each partition
    gets few files; adaptive execution splits a partition value that is too large.
    """
    (
        df.hint("rebalance", *partitions).write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic").partitionBy(*partitions).parquet(path)
    )
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _existing(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame | None:
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def _delete_folder(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(folder))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def replace_batches(df: DataFrame, path: str, batch: str, delivered: DataFrame | None = None) -> DataFrame:
    """Replace whole batches in a table with a partition for each.

    Batches of ``delivered`` without a row in ``df`` are emptied: a partition that is not
    written is not overwritten, so its folder is deleted after the write.  Repeating the
    call after a failure at any point gives the same table.
    """
    spark = df.sparkSession
    table = replace_partitions(df, path, [batch])
    if delivered is None:
        return table
    gone = anti_join(delivered.select(batch), df, {batch: batch})
    folders = semi_join(
        table.select(F.col(batch), F.regexp_replace("_metadata.file_path", "/[^/]*$", "").alias("folder")), gone, {batch: batch}
    ).select("folder").distinct()
    for row in folders.toLocalIterator():
        _delete_folder(spark, row["folder"])
    return spark.read.schema(df.schema).parquet(path)


def replace_in_buckets(
    df: DataFrame, path: str, batch: str, buckets: int = 1024, delivered: DataFrame | None = None
) -> DataFrame:
    """Replace whole batches in a table partitioned by a hash of the batch.

    For tables with too many batches for a folder each.  Only the buckets of the
    incoming batches are read and rewritten; other batches in them are carried over.
    Batches of ``delivered`` without a row in ``df`` are emptied.  Old files go when the
    new ones are committed, so a repeated task finds them.
    """
    spark = df.sparkSession
    number = F.pmod(F.xxhash64(batch), F.lit(buckets)).cast("int").alias(BUCKET)
    incoming = settle(df.select("*", number), "incoming")
    old = _existing(spark, path, incoming.schema)
    if old is None:
        return replace_partitions(incoming, path, [BUCKET]).drop(BUCKET)
    cleared = incoming.select(batch, BUCKET)
    if delivered is not None:
        cleared = cleared.unionByName(delivered.select(batch, number))
    # At most ``buckets`` numbers; as literals they prune the partitions read.
    touched = {r[0] for r in cleared.select(BUCKET).distinct().collect()}
    kept = anti_join(old.where(F.col(BUCKET).isin(list(touched))), cleared, {batch: batch})
    result = settle(kept.unionByName(incoming), "buckets")
    left = {r[0] for r in result.select(BUCKET).distinct().collect()}
    table = replace_partitions(result, path, [BUCKET])
    if touched <= left:
        return table.drop(BUCKET)
    for emptied in sorted(touched - left):
        _delete_folder(spark, f"{path}/{BUCKET}={emptied}")
    return spark.read.schema(result.schema).parquet(path).drop(BUCKET)


def rewrite_touched(
    spark: SparkSession, path: str, schema: T.StructType, partition: str, changed: DataFrame, on: Mapping[str, str],
    state: Callable[[DataFrame], DataFrame],
) -> DataFrame:
    """Update or delete rows of a table partitioned by ``partition`` without touching other partitions' files.

    ``changed`` has the keys whose rows change; ``on`` maps the table's columns to its own.
    The partitions that hold such rows are found by a semi-join on the key columns alone;
    only they are read, and ``state``, a function from rows to their new state, replaces
    them in one commit of dynamic partition overwrite.  A partition that ``state`` leaves
    empty is deleted after it.  Repeating the call gives the same table.
    """
    table = spark.read.schema(schema).parquet(path)
    # At most one value per partition of the table; as literals they prune what is read.
    touched = {r[0] for r in semi_join(table.select(*{partition, *on}), changed, on).select(partition).distinct().collect()}
    if not touched:
        return table
    own = F.col(partition).isin([v for v in touched if v is not None])
    old = table.where(own | F.col(partition).isNull() if None in touched else own)
    written = Observation()
    new = state(old).select(*schema.fieldNames()).observe(written, F.collect_set(partition).alias("left"))
    # The old files go when the new ones are committed, so a repeated task finds them.
    replace_partitions(new, path, [partition])
    for value in touched - {None} - set(written.get["left"]):
        _delete_folder(spark, f"{path}/{partition}={value}")
    return spark.read.schema(schema).parquet(path)


def gzip_csv_stage(df: DataFrame, path: str) -> DataFrame:
    """Stage as gzipped CSV with a header and read the staged files back."""
    (
        df.write.mode("overwrite").option("header", True).option("compression", "gzip")
        .option("escape", '"').csv(path)
    )
    return csv_scan(df.sparkSession, path, df.schema)


def land_then_main(
    df: DataFrame, land_path: str, main_path: str, columns: Sequence[str]
) -> DataFrame:
    """Load everything into a landing table, then the wanted columns into the main one."""
    return truncate_load(truncate_load(df, land_path).select(*columns), main_path)


def temp_table(df: DataFrame, name: str) -> DataFrame:
    """Name an intermediate result for SQL; it stays lazy."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def write_batches(
    frames: Mapping[str, DataFrame], root: str, batch: str = "Batch_Run_Id", buckets: int | None = None,
    delivered: DataFrame | None = None,
) -> dict[str, DataFrame]:
    """Write each frame below ``root``; batches delivered again replace their rows.

    ``delivered`` has the batches of this delivery in its column ``batch``; they are cleared
    in every table, also where a frame has no row of them.  Without it a batch is replaced
    only in the tables that it has rows for.  One partition per batch, or ``buckets`` of them
    where there are very many batches.
    """
    if buckets is not None:
        return {n: replace_in_buckets(df, f"{root}/{n}", batch, buckets, delivered) for n, df in frames.items()}
    return {n: replace_batches(df, f"{root}/{n}", batch, delivered) for n, df in frames.items()}


def batch_tables(spark: SparkSession, root: str, schemas: Mapping[str, str]) -> dict[str, DataFrame]:
    return {n: spark.read.schema(s).parquet(f"{root}/{n}") for n, s in schemas.items()}
