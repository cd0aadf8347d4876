"""Streaming jobs: folder ingest, de-duplication, latest version per key."""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator, Mapping, Sequence
from functools import reduce
from operator import or_

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from millrace.operators.windows import latest_row_per_key
from millrace.session import settle


def read_folder(
    spark: SparkSession, folder: str, schema: T.StructType, file_format: str = "parquet",
    archive: str | None = None, files_per_batch: int = 1000, **options: str,
) -> DataFrame:
    """New files of a folder; with ``archive`` they are moved there once read."""
    reader = spark.readStream.format(file_format).schema(schema).option(
        "maxFilesPerTrigger", files_per_batch
    )
    if archive is not None:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    return reader.options(**options).load(folder)


def stream_file_ingest(stream: DataFrame, target: str, checkpoint: str) -> StreamingQuery:
    """Append everything that has arrived, exactly once, then stop."""
    return (
        stream.writeStream.format("parquet").option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start(target)
    )


#: Name of the column that ``with_arrival`` adds.
ARRIVAL = "_arrival"


def with_arrival(stream: DataFrame) -> DataFrame:
    """A parquet file stream with the place at which each row arrived: file time, file, row in the file."""
    return stream.withColumn(ARRIVAL, F.struct("_metadata.file_modification_time", "_metadata.file_path", "_metadata.row_index"))


def _bucket(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def _apart(times: list[int], time: int, least: int) -> bool:
    """Insert ``time`` into sorted ``times`` unless one of them is at most ``least`` away."""
    i = bisect_left(times, time)
    if i < len(times) and times[i] - time <= least or i and time - times[i - 1] <= least:
        return False
    times.insert(i, time)
    return True


def _kept_rows(least: int):
    """Row numbers to keep, from rows sorted by key, stored ones first, then by arrival.

    What is held is the kept times of one key, which lie more than ``least`` apart.
    """

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, times, empty = None, [], False
        for batch in batches:
            kept = []
            for k, time, row in zip(*[batch.column(c).to_pylist() for c in ("key", "time", "row")], strict=True):
                if k != key:
                    key, times, empty = k, [], False
                if row is None:
                    # Stored: kept before, whatever is near it.
                    if time is None:
                        empty = True
                    else:
                        insort(times, time)
                elif time is None:
                    kept += [] if empty else [row]
                    empty = True
                elif _apart(times, time, least):
                    kept.append(row)
            yield pa.RecordBatch.from_arrays([pa.array(kept, pa.int64())], names=["row"])

    return fold


def stream_dedup_versions(
    stream: DataFrame, keys: Sequence[str], event_time: str, target: str, checkpoint: str,
    look_back: str = "30 days", arrival: Sequence[str] = (), buckets: int = 64,
) -> StreamingQuery:
    """Append re-polled history without its repeats, however late a row arrives.

    Rows are taken one after the other in order of ``arrival``, those that tie by time.  A row
    is a repeat if a row of the same keys (NULL equals NULL; without a time: one without a
    time) was kept before it and is at most ``look_back`` apart; any other row is kept.  A row
    that was dropped hides nothing.  As rows are compared with kept ones only, the cut into
    micro-batches changes nothing, if batches follow the arrival (``with_arrival``) or, without
    ``arrival``, the time.

    The target is in ``buckets`` by key.  A batch reads the stored keys and times of its own
    buckets and around its own times only, and writes its own partition, which a replay
    overwrites.  One key's kept times are all that a task holds.
    """
    apart = F.expr(f"interval {look_back}")
    # Exact to the microsecond, so that different keys have different texts.
    exact = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}
    key = F.sha2(F.to_json(F.struct(*keys), exact), 256)

    def write(batch: DataFrame, batch_id: int) -> None:
        spark, time = batch.sparkSession, F.col(event_time)
        micros = F.unix_micros(time.cast("timestamp"))
        least = spark.range(1).select(F.unix_micros(F.timestamp_seconds(F.lit(0)) + apart)).first()[0]
        order = F.struct(*[F.col(c) for c in arrival], micros.alias("micros")) if arrival else F.struct(micros.alias("micros"))
        rows = settle(batch.withColumns({
            "_row": F.monotonically_increasing_id(), "_key": key, "_time": micros, "_order": order, "bucket": _bucket(keys, buckets),
        }), "delivery")
        asked = rows.select(F.col("_key").alias("key"), F.col("_time").alias("time"), F.col("_row").alias("row"), F.col("_order").alias("order"))
        # Of rows that agree in key and time, the first to arrive is kept or none.
        asked = asked.groupBy("key", "time").agg(F.min(F.struct("order", "row")).alias("f")).select("key", "time", "f.row", "f.order")
        if batch_id > 0:
            first, last, touched = rows.agg(F.min(event_time) - apart, F.max(event_time) + apart, F.collect_set("bucket")).first()
            fields = [*[f for f in batch.schema if f.name not in arrival], T.StructField("batch_id", T.LongType()), T.StructField("bucket", T.IntegerType())]
            stored = spark.read.schema(T.StructType(fields)).parquet(target)
            near = time.isNull() if first is None else time.isNull() | time.between(F.lit(first), F.lit(last))
            side = stored.where((F.col("batch_id") < batch_id) & F.col("bucket").isin(touched)).where(near).select(
                key.alias("key"), micros.alias("time"), F.lit(None).cast("long").alias("row"), F.lit(None).cast(asked.schema["order"].dataType).alias("order"))
            asked = asked.unionByName(side)
        # Stored rows have no row number, so they come first within their key.
        ordered = asked.repartition("key").sortWithinPartitions("key", F.col("row").isNotNull(), "order", "row").select("key", "time", "row")
        kept = settle(ordered.mapInArrow(_kept_rows(least), "row long"), "kept")
        new = rows.join(kept, F.col("_row") == F.col("row"), "left_semi").drop("_row", "_key", "_time", "_order", *arrival)
        new.write.mode("overwrite").partitionBy("bucket").parquet(f"{target}/batch_id={batch_id}")

    return (
        stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )


#: Batch number of the empty list that every target begins with.
BEGIN = -2


def _begin(spark: SparkSession, target: str, mode: str) -> None:
    spark.createDataFrame([], "bucket int").write.mode(mode).parquet(f"{target}/lists/batch_id={BEGIN}")


def _versions(spark: SparkSession, target: str, before: int | None = None) -> dict[int, int]:
    """The batch that last wrote each bucket; one row a bucket and batch, from the batches' own lists."""
    lists = spark.read.schema("bucket int, batch_id long").parquet(f"{target}/lists")
    if before is not None:
        lists = lists.where(F.col("batch_id") < before)
    return {r["bucket"]: r["batch"] for r in lists.groupBy("bucket").agg(F.max("batch_id").alias("batch")).collect()}


def _read_versions(spark: SparkSession, target: str, schema: T.StructType, versions: Mapping[int, int]) -> DataFrame:
    paths = [f"{target}/rows/batch_id={batch}/bucket={bucket}" for bucket, batch in sorted(versions.items())]
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def _put_versions(rows: DataFrame, touched: Sequence[int], target: str, batch_id: int) -> None:
    """New versions of buckets, then the list that makes them current."""
    spark = rows.sparkSession
    rows.repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{target}/rows/batch_id={batch_id}")
    spark.createDataFrame([(b,) for b in touched], "bucket int").coalesce(1).write.mode("overwrite").parquet(
        f"{target}/lists/batch_id={batch_id}")


def stream_upsert_latest(
    stream: DataFrame, keys: Sequence[str], newest_first: Sequence[Column], target: str, checkpoint: str, buckets: int = 64,
) -> StreamingQuery:
    """Keep a table of the latest row per key; :func:`read_latest` reads it.

    The table is in ``buckets`` by key.  A batch merges its rows into the buckets that they
    touch and writes those as new versions; its list of them, written last, makes them
    current.  A batch that is run again starts from the versions before it, so a replay
    changes nothing, and readers see a batch whole or not at all.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        new = settle(latest_row_per_key(batch, keys, newest_first), "delivery")
        touched = sorted(r["b"] for r in new.select(_bucket(keys, buckets).alias("b")).distinct().collect())
        old = _versions(spark, target, batch_id)
        current = _read_versions(spark, target, batch.schema, {b: old[b] for b in touched if b in old})
        merged = latest_row_per_key(current.unionByName(new), keys, newest_first)
        _put_versions(merged.withColumn("bucket", _bucket(keys, buckets)), touched, target, batch_id)

    _begin(stream.sparkSession, target, "ignore")
    return (
        stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )


def read_latest(spark: SparkSession, target: str, schema: T.StructType) -> DataFrame:
    """The latest row per key: the current version of every bucket, nothing else is read."""
    return _read_versions(spark, target, schema, _versions(spark, target))


def compact(spark: SparkSession, source: str, schema: T.StructType, target: str) -> None:
    """Start a new target from the current versions of another, to leave older ones behind.

    A stream with a fresh checkpoint goes on from batch 0, so the versions get batch -1.
    ``target`` must not exist (an error otherwise), as the table may still be read from the old one.
    """
    _begin(spark, target, "error")
    versions = _versions(spark, source)
    fields = T.StructType([*schema, T.StructField("batch_id", T.LongType()), T.StructField("bucket", T.IntegerType())])
    rows = spark.read.schema(fields).parquet(f"{source}/rows")
    current = rows.where(reduce(or_, [(F.col("bucket") == b) & (F.col("batch_id") == v) for b, v in versions.items()], F.lit(False)))
    _put_versions(current.drop("batch_id"), sorted(versions), target, -1)
