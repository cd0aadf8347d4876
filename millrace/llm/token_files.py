"""Token ids in files of blocks with Elias-Fano coded document boundaries."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.llm.words import word_tokenizer

#: A block is closed when it holds this many ids or documents.
BLOCK_IDS = 1 << 18
BLOCK_DOCS = 1 << 12
#: Every how many boundaries the select structure notes a position.
SAMPLE = 64

BLOCK_SCHEMA = (
    "part int, block int, base long, first_id long, last_id long, doc_ids array<long>, n_ids long, width int, ids binary, "
    "low_bits int, low binary, high binary, samples binary"
)


@dataclass(frozen=True)
class EliasFano:
    """A rising sequence of n numbers up to u in about 2 + log2(u / n) bits each.

    The low bits of each number lie packed in ``low``.  The high parts are written in
    unary in ``high``: number i sets bit (high part + i).  ``samples`` has the bit
    position of every ``SAMPLE``-th number, from which ``select`` counts on, so one
    number is read without decoding those before it.
    """

    n: int
    low_bits: int
    low: bytes
    high: bytes
    samples: bytes

    @staticmethod
    def of(values: np.ndarray) -> EliasFano:
        values = np.asarray(values, dtype=np.int64)
        n, top = len(values), int(values[-1]) if len(values) else 0
        low_bits = max(0, (top // max(n, 1)).bit_length() - 1)
        ones = (values >> low_bits) + np.arange(n)
        high = np.zeros(int(ones[-1]) + 1 if n else 0, dtype=np.uint8)
        high[ones] = 1
        low = (values[:, None] >> np.arange(low_bits)) & 1
        return EliasFano(
            n, low_bits, np.packbits(low.astype(np.uint8), bitorder="little").tobytes(),
            np.packbits(high, bitorder="little").tobytes(), ones[::SAMPLE].astype("<u4").tobytes(),
        )

    def _select(self, i: int) -> int:
        """The position of the i-th set bit of ``high``."""
        at = int(np.frombuffer(self.samples, "<u4")[i // SAMPLE])
        left, byte = i % SAMPLE, at >> 3
        word = self.high[byte] & (0xFF << (at & 7)) & 0xFF
        while word.bit_count() <= left:
            left -= word.bit_count()
            byte += 1
            word = self.high[byte]
        for _ in range(left):
            word &= word - 1
        return 8 * byte + (word & -word).bit_length() - 1

    def __getitem__(self, i: int) -> int:
        high, at = self._select(i) - i, i * self.low_bits
        first, last = at >> 3, (at + self.low_bits + 7) >> 3
        low = int.from_bytes(self.low[first:last], "little") >> (at & 7) & ((1 << self.low_bits) - 1)
        return high << self.low_bits | low

    def all(self) -> np.ndarray:
        """The whole sequence at once, for scans."""
        ones = np.flatnonzero(np.unpackbits(np.frombuffer(self.high, np.uint8), bitorder="little"))
        bits = np.unpackbits(np.frombuffer(self.low, np.uint8), bitorder="little")[: self.n * self.low_bits]
        low = (bits.reshape(self.n, self.low_bits).astype(np.int64) << np.arange(self.low_bits)).sum(axis=1)
        return ((ones[: self.n] - np.arange(self.n)) << self.low_bits) | low


def write_ids(
    docs: DataFrame, path: str, tokenizer: str, end: int, id: str = "doc_id", text: str = "text",
) -> None:
    """Encode all texts and write their ids in ascending id order (nulls first, ties by a hash of the text).

    The table is range-partitioned by id; each task encodes its range and cuts it into
    blocks.  A block is one row: the concatenated ids as little-endian integers of 2 or 4
    bytes, the document ids with the first and last of them, and the n + 1 document boundaries within the block as an
    ``EliasFano`` sequence.  Offsets of 64 bits exist once per block only (``base``: ids of
    the part before it).  Rows are stored by Spark's own writer as Parquet, so a lost task
    leaves nothing behind and any store will do.  Null texts count as empty; a long text
    is a block of its own.
    """
    placed = docs.select(F.col(id).cast("long").alias("id"), F.col(text).alias("text"), F.xxhash64(text).alias("h"))

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, part = None, TaskContext.get().partitionId()
        block, base, size, names, parts = 0, 0, 0, [], []

        def close() -> pa.RecordBatch:
            nonlocal block, base, size, names, parts
            ends = np.cumsum([0, *map(len, parts)])
            ef = EliasFano.of(ends)
            ids = np.concatenate(parts).astype(f"<u{coder.width}").tobytes()
            row = pa.RecordBatch.from_pylist([{
                "part": part, "block": block, "base": base, "first_id": next((n for n in names if n is not None), None),
                "last_id": names[-1], "doc_ids": names, "n_ids": size, "width": coder.width,
                "ids": ids, "low_bits": ef.low_bits, "low": ef.low, "high": ef.high, "samples": ef.samples,
            }], schema=_BLOCK)
            block, base, size, names, parts = block + 1, base + size, 0, [], []
            return row

        for batch in batches:
            if coder is None:
                coder = word_tokenizer(tokenizer, end)
            texts = batch.column("text").to_pylist()
            for name, ids in zip(batch.column("id").to_pylist(), coder.encode(texts), strict=True):
                if parts and (size + len(ids) > BLOCK_IDS or len(parts) >= BLOCK_DOCS):
                    yield close()
                names.append(name)
                parts.append(ids)
                size += len(ids)
        if parts:
            yield close()

    order = [F.col("id").asc_nulls_first(), F.col("h")]
    sorted_docs = placed.repartitionByRange(*order).sortWithinPartitions(*order).select("id", "text")
    sorted_docs.mapInArrow(blocks, BLOCK_SCHEMA).write.parquet(path)


_BLOCK = pa.schema([
    ("part", pa.int32()), ("block", pa.int32()), ("base", pa.int64()), ("first_id", pa.int64()), ("last_id", pa.int64()), ("doc_ids", pa.list_(pa.int64())),
    ("n_ids", pa.int64()), ("width", pa.int32()), ("ids", pa.binary()), ("low_bits", pa.int32()),
    ("low", pa.binary()), ("high", pa.binary()), ("samples", pa.binary()),
])


def read_ids(spark: SparkSession, path: str, id: str = "doc_id") -> DataFrame:
    """Per document of the files: its id, ``start`` (ids of all documents before it), ``n_tokens`` and ``ids``.

    ``ids`` holds little-endian unsigned 32-bit integers.  The starts of the parts are
    summed up from one row per part of the write, which bounds the broadcast.
    """
    stored = spark.read.schema(BLOCK_SCHEMA).parquet(path)

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                r = {n: batch.column(n)[row].as_py() for n in batch.schema.names}
                ends = EliasFano(len(r["doc_ids"]) + 1, r["low_bits"], r["low"], r["high"], r["samples"]).all()
                ids = np.frombuffer(r["ids"], f"<u{r['width']}").astype("<u4")
                yield pa.RecordBatch.from_arrays([
                    pa.array([r["part"]] * len(r["doc_ids"]), pa.int32()), pa.array(r["doc_ids"], pa.int64()),
                    pa.array(r["base"] + ends[:-1]), pa.array(np.diff(ends)),
                    pa.array([ids[a:b].tobytes() for a, b in zip(ends[:-1], ends[1:], strict=True)], pa.binary()),
                ], names=["part", id, "local", "n_tokens", "ids"])

    read = stored.mapInArrow(documents, f"part int, `{id}` long, local long, n_tokens long, ids binary")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    totals = stored.groupBy("part").agg(F.sum("n_ids").alias("n"))
    starts = totals.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    return read.join(F.broadcast(starts), "part").select(
        id, (F.col("first") + F.col("local")).alias("start"), "n_tokens", "ids"
    )


def read_document(spark: SparkSession, path: str, id: int) -> np.ndarray | None:
    """The ids of one document, found through the select structure; None if it is not there.

    Blocks are sorted by id, so the reader passes over all but those whose bounds hold it.
    """
    wanted = F.lit(id).cast("long")
    blocks = spark.read.schema(BLOCK_SCHEMA).parquet(path).where((F.col("first_id") <= wanted) & (F.col("last_id") >= wanted))
    row = blocks.where(F.array_contains("doc_ids", wanted)).first()
    if row is None:
        return None
    at = row["doc_ids"].index(id)
    ef = EliasFano(len(row["doc_ids"]) + 1, row["low_bits"], bytes(row["low"]), bytes(row["high"]), bytes(row["samples"]))
    return np.frombuffer(bytes(row["ids"]), f"<u{row['width']}")[ef[at]:ef[at + 1]].astype(np.uint32)
