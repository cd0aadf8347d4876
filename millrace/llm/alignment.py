"""Alignment of two tokenizers: links between their ids, counted by inverted bitmaps of documents."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.token_bytes import TokenBytes, gather
from millrace.llm.words import byte_letters, word_tokenizer
from millrace.session import settle

#: Documents that one bitmap covers, and the bytes of one that is written bit by bit.
BLOCK = 1 << 16
DENSE = BLOCK // 8
#: Links that a task gathers before it writes their bitmaps.
GATHERED = 1 << 19
#: Rows of bitmaps that go to a Python worker at a time; their bytes are bounded besides.
SLIM_ROWS = 1 << 14

ALIGNED = (
    "row long, id long, n_a long, n_b long, n_groups long, groups string, "
    "a int, b int, block long, plane int, bitmap binary"
)
_DOCUMENT = ("row", "id", "n_a", "n_b", "n_groups", "groups")
_BITMAP = pa.schema([("a", pa.int32()), ("b", pa.int32()), ("block", pa.int64()), ("plane", pa.int32()), ("bitmap", pa.binary())])


class Aligner:
    """Encodes texts by both tokenizers and links the ids that end at the same byte."""

    def __init__(self, a: str, b: str) -> None:
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self._a = word_tokenizer(a, 0)
        self._b = SentencePieceProcessor(model_file=b)
        byte_of = {chr(byte): byte for byte in range(256)} | {letter: byte for byte, letter in byte_letters().items()}
        names = Tokenizer.from_file(a)
        self._bytes_a = TokenBytes([
            bytes(byte_of.get(c, 0x3F) for c in names.id_to_token(i) or "") for i in range(names.get_vocab_size())
        ])
        self._bytes_b = TokenBytes([self._piece(i) for i in range(self._b.vocab_size())])
        # Decimal numbers, each with a byte for what follows it.
        self._digits = TokenBytes([b"%d," % i for i in range(max(len(self._bytes_a), len(self._bytes_b)))])

    def _piece(self, i: int) -> bytes:
        name = self._b.id_to_piece(i)
        return bytes([int(name[3:5], 16)]) if self._b.is_byte(i) else name.replace("▁", " ").encode()

    def _encoded(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Ids of both, one text after the other, and their numbers per text; none where the bytes differ from the text's."""
        a = [ids[:-1] for ids in self._a.encode(texts, led=True)]
        b = self._b.encode(texts, num_threads=1)
        b = [np.array(ids, dtype=np.int64) for ids in b]
        for i, text in enumerate(texts):
            whole = b" " + text.encode()
            if not text or self._bytes_a.of(a[i]).tobytes() != whole or self._bytes_b.of(b[i]).tobytes() != whole:
                a[i], b[i] = a[i][:0], b[i][:0]
        none = np.zeros(0, dtype=np.int64)
        n_a, n_b = (np.fromiter(map(len, x), dtype=np.int64, count=len(x)) for x in (a, b))
        return np.concatenate([none, *a]).astype(np.int64), np.concatenate([none, *b]), n_a, n_b

    def align(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[str], np.ndarray, np.ndarray, np.ndarray]:
        """Numbers of ids of a, of b, of groups; the groups as text; and per link its text, a and b."""
        a, b, n_a, n_b = self._encoded(texts)
        if not len(a):
            return n_a, n_b, np.zeros_like(n_a), [""] * len(texts), *[np.zeros(0, dtype=np.int64)] * 3
        # Both tokenizers give each text the same bytes, so their ends compare over all texts at once.
        end_a, end_b = np.cumsum(self._bytes_a.size[a]), np.cumsum(self._bytes_b.size[b])
        at = np.minimum(np.searchsorted(end_b, end_a), len(end_b) - 1)
        last_a = end_b[at] == end_a
        last_b = np.zeros(len(b), dtype=bool)
        last_b[at[last_a]] = True
        text_of = np.repeat(np.arange(len(texts)), n_a)[last_a]
        groups = self._groups(a, b, last_a, last_b)
        upto = np.concatenate([[0], np.cumsum(n_a + n_b)])
        ends = np.concatenate([[0], np.cumsum(groups[1])])[upto]
        written = groups[0].tobytes()
        strings = [written[low:max(low, high - 1)].decode("ascii") for low, high in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]
        return n_a, n_b, np.bincount(text_of, minlength=len(texts)), strings, text_of, a[last_a], b[at[last_a]]

    def _groups(self, a: np.ndarray, b: np.ndarray, last_a: np.ndarray, last_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``a1,a2|b1;a3|b2,b3;`` as bytes, and how many bytes each id of both takes there."""
        group_a = np.cumsum(last_a) - last_a
        group_b = np.cumsum(last_b) - last_b
        before_a = np.concatenate([[0], np.flatnonzero(last_a) + 1])
        before_b = np.concatenate([[0], np.flatnonzero(last_b) + 1])
        place_a = np.arange(len(a)) + before_b[group_a]
        place_b = np.arange(len(b)) + before_a[group_b + 1]
        ids, follows = np.empty(len(a) + len(b), dtype=np.int64), np.empty(len(a) + len(b), dtype=np.uint8)
        ids[place_a], ids[place_b] = a, b
        follows[place_a] = np.where(last_a, ord("|"), ord(","))
        follows[place_b] = np.where(last_b, ord(";"), ord(","))
        out, sizes = self._digits.of(ids), self._digits.size[ids]
        out[np.cumsum(sizes) - 1] = follows
        return out, sizes


@lru_cache(maxsize=1)
def aligner(a: str, b: str) -> Aligner:
    return Aligner(a, b)


def _written(numbers: np.ndarray, firsts: np.ndarray) -> pa.Array:
    """Bitmaps of rising numbers below ``BLOCK``, one from each of ``firsts`` on.

    A bitmap of few numbers is their list, of two bytes each; from 4,096 numbers on it has
    a bit for each of the block's documents.  Its size says which.
    """
    counts = np.diff(np.append(firsts, len(numbers)))
    sizes = np.minimum(2 * counts, DENSE)
    ends = np.cumsum(sizes)
    flat = numbers.astype("<u2").view(np.uint8)
    if (2 * counts >= DENSE).any():
        out = np.empty(int(ends[-1]), dtype=np.uint8)
        sparse = 2 * counts < DENSE
        out[np.repeat(sparse, sizes)] = gather(flat, 2 * firsts[sparse], sizes[sparse])
        for i in np.flatnonzero(~sparse).tolist():
            bits = np.zeros(BLOCK, dtype=np.uint8)
            bits[numbers[firsts[i]:firsts[i] + counts[i]]] = 1
            out[ends[i] - DENSE:ends[i]] = np.packbits(bits, bitorder="little")
        flat = out
    offsets = np.concatenate([[0], ends]).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(firsts), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(flat))])


def _read(bitmaps: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of all bitmaps, one bitmap after the other, and how many each has."""
    offsets = np.frombuffer(bitmaps.buffers()[1], np.int32)[bitmaps.offset:bitmaps.offset + len(bitmaps) + 1].astype(np.int64)
    flat = np.frombuffer(bitmaps.buffers()[2] or b"", np.uint8)
    sizes = np.diff(offsets)
    counts = sizes // 2
    dense = np.flatnonzero(sizes == DENSE)
    if not len(dense):
        return flat[offsets[0]:offsets[-1]].view("<u2"), counts
    parts, low = [], 0
    for i in dense.tolist():
        parts.append(flat[offsets[low]:offsets[i]].view("<u2"))
        bits = np.flatnonzero(np.unpackbits(flat[offsets[i]:offsets[i + 1]], bitorder="little"))
        parts.append(bits.astype("<u2"))
        counts[i], low = len(bits), i + 1
    parts.append(flat[offsets[low]:offsets[-1]].view("<u2"))
    return np.concatenate(parts), counts


def _changes(*columns: np.ndarray) -> np.ndarray:
    """Places at which any of the sorted columns has another value than before."""
    new = np.ones(len(columns[0]), dtype=bool)
    new[1:] = False
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    return np.flatnonzero(new)


def _bitmaps(row: np.ndarray, a: np.ndarray, b: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Links as bitmaps of documents: plane 0 has the documents of a pair, plane k + 1 the k-th bits of their further links."""
    order = np.lexsort((row, b, a))
    row, a, b = row[order], a[order], b[order]
    first = _changes(a, b, row)
    more = np.diff(np.append(first, len(row))) - 1
    row, a, b = row[first], a[first], b[first]
    for plane in range(1 + int(more.max(initial=0)).bit_length()):
        if plane:
            has = more >> (plane - 1) & 1 == 1
            row_, a_, b_ = row[has], a[has], b[has]
        else:
            row_, a_, b_ = row, a, b
        if not len(row_):
            continue
        firsts = _changes(a_, b_, row_ // BLOCK)
        for low in range(0, len(firsts), SLIM_ROWS):
            part = firsts[low:low + SLIM_ROWS]
            upto = int(firsts[low + SLIM_ROWS]) if low + SLIM_ROWS < len(firsts) else len(row_)
            yield pa.RecordBatch.from_arrays([
                pa.array(a_[part].astype(np.int32)), pa.array(b_[part].astype(np.int32)), pa.array(row_[part] // BLOCK),
                pa.array(np.full(len(part), plane, dtype=np.int32)), _written(row_[part[0]:upto] % BLOCK, part - part[0]),
            ], schema=_BITMAP)


def align_texts(docs: DataFrame, a: str, b: str, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows of documents and rows of bitmaps (``ALIGNED``); the columns of the other kind are null.

    A document has a ``row`` number of its own, its id, the numbers of its ids ``n_a`` and
    ``n_b`` and of its ``groups``, written ``a1,a2|b1;a3|b2,b3``.  A bitmap row says which
    documents of a ``block`` hold the pair ``a``, ``b`` linked: plane 0 has the documents,
    plane k + 1 those whose number of links less one has bit k.  A task writes the bitmaps
    of ``GATHERED`` links at a time, so one pair and block may have several rows.

    ``a`` is a byte-level tokenizer file and encodes a space and the text, ``b`` a piece
    model and encodes the text, before which it puts the space itself.  Null texts, empty
    ones and those whose bytes either tokenizer changes have no ids.  Row numbers depend on
    the task, so write the result before anything is read from it twice.
    """

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both, row, held, size = aligner(a, b), TaskContext.get().partitionId() << 33, [], 0
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            n_a, n_b, n_groups, groups, text_of, link_a, link_b = both.align(texts)
            rows = row + np.arange(len(texts))
            yield _filled({
                "row": pa.array(rows), "id": batch.column("id"), "n_a": pa.array(n_a), "n_b": pa.array(n_b),
                "n_groups": pa.array(n_groups), "groups": pa.array(groups, pa.string()),
            })
            row += len(texts)
            held.append((rows[text_of], link_a.astype(np.int32), link_b.astype(np.int32)))
            size += len(text_of)
            if size >= GATHERED:
                yield from map(_as_aligned, _bitmaps(*map(np.concatenate, zip(*held, strict=True))))
                held, size = [], 0
        if size:
            yield from map(_as_aligned, _bitmaps(*map(np.concatenate, zip(*held, strict=True))))

    return docs.select(F.col(id).cast("long").alias("id"), F.col(text).alias("text")).mapInArrow(align, ALIGNED)


_ALIGNED = pa.schema([
    *[pa.field(n, pa.string() if n == "groups" else pa.int64()) for n in _DOCUMENT], *_BITMAP,
])


def _filled(columns: dict[str, pa.Array]) -> pa.RecordBatch:
    n = len(next(iter(columns.values())))
    return pa.RecordBatch.from_arrays([columns.get(f.name, pa.nulls(n, f.type)) for f in _ALIGNED], schema=_ALIGNED)


def _as_aligned(batch: pa.RecordBatch) -> pa.RecordBatch:
    return _filled({n: batch.column(n) for n in batch.schema.names})


def pair_index(aligned: DataFrame) -> DataFrame:
    """The inverted index: one bitmap per ``a``, ``b``, ``block`` and ``plane``, those of several rows OR-merged.

    A pair that all documents hold has one row per block, so it is many small keys.
    """
    parts = aligned.where("block IS NOT NULL").select("a", "b", "block", "plane", "bitmap")
    keys = ["a", "b", "block", "plane"]

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = (pa.concat_tables([held, table]) if held is not None else table).combine_chunks()
            columns = [table.column(k).to_numpy() for k in keys]
            firsts = _changes(*columns)
            # The last key may go on in the next batch.
            cut = int(firsts[-1])
            held = table.slice(cut)
            if cut:
                yield _merged(table.slice(0, cut), firsts[:-1])
        if held is not None and held.num_rows:
            yield _merged(held, np.zeros(1, dtype=np.int64))

    return parts.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(merge, "a int, b int, block long, plane int, bitmap binary")


def _merged(table: pa.Table, firsts: np.ndarray) -> pa.RecordBatch:
    batch = table.combine_chunks().to_batches()[0]
    if len(firsts) == batch.num_rows:
        return pa.RecordBatch.from_arrays(batch.columns, schema=_BITMAP)
    numbers, counts = _read(batch.column("bitmap"))
    group = np.repeat(np.repeat(np.arange(len(firsts)), np.diff(np.append(firsts, batch.num_rows))), counts)
    union = np.unique(group * BLOCK + numbers)
    bitmaps = _written(union % BLOCK, np.searchsorted(union // BLOCK, np.arange(len(firsts))))
    return pa.RecordBatch.from_arrays(
        [*[batch.column(n).take(pa.array(firsts)) for n in _BITMAP.names[:-1]], bitmaps], schema=_BITMAP)


def _links_per_document(plane: Column) -> Column:
    """Links that a document of a bitmap stands for."""
    one = F.lit(1).cast("long")
    return F.when(plane == 0, one).otherwise(F.call_function("shiftleft", one, plane - 1))


def pair_counts(index: DataFrame) -> DataFrame:
    """Per pair ``a``, ``b``: ``documents`` and ``links`` that hold it, and ``best``: no other a has more links with this b.

    Counted from the bits of the bitmaps: a document of plane 0 is a link, one of plane k + 1
    is 2^k more.
    """
    bits = F.when(F.octet_length("bitmap") == DENSE, F.bitmap_count("bitmap")).otherwise(F.octet_length("bitmap") / 2).cast("long")
    counts = settle(index.withColumn("bits", bits).groupBy("a", "b").agg(
        F.sum(F.when(F.col("plane") == 0, F.col("bits")).otherwise(0)).alias("documents"),
        F.sum(F.col("bits") * _links_per_document(F.col("plane"))).alias("links"),
    ), "pair_counts")
    most = counts.groupBy("b").agg(F.max("links").alias("_most"))
    return counts.join(most, "b").select("a", "b", "documents", "links", (F.col("links") == F.col("_most")).alias("best"))


def document_scores(index: DataFrame, counts: DataFrame) -> DataFrame:
    """Per document (``row``): ``count_sum``, the pair's links summed over its links, and ``n_best``, its links of best pairs.

    The postings of every pair carry its counts to its documents: bitmaps go to the task of
    their block, which adds up a block at a time.
    """
    carried = index.join(counts.select("a", "b", "links", "best"), ["a", "b"]).select(
        "block", _links_per_document(F.col("plane")).alias("each"), "links", "best", "bitmap")

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, sums = None, np.zeros((2, BLOCK), dtype=np.int64)

        def closed() -> pa.RecordBatch:
            some = np.flatnonzero(sums[0])
            out = pa.RecordBatch.from_arrays(
                [pa.array(block * BLOCK + some), pa.array(sums[0][some]), pa.array(sums[1][some])], names=["row", "count_sum", "n_best"])
            sums[:] = 0
            return out

        for batch in batches:
            blocks = batch.column("block").to_numpy()
            each, links = batch.column("each").to_numpy(), batch.column("links").to_numpy()
            best = batch.column("best").to_numpy(zero_copy_only=False)
            firsts = _changes(blocks)
            for low, high in zip(firsts.tolist(), [*firsts[1:].tolist(), len(blocks)], strict=True):
                if block is not None and blocks[low] != block:
                    yield closed()
                block = int(blocks[low])
                numbers, counts = _read(batch.column("bitmap").slice(low, high - low))
                np.add.at(sums[0], numbers, np.repeat(each[low:high] * links[low:high], counts))
                np.add.at(sums[1], numbers, np.repeat(each[low:high] * best[low:high], counts))
        if block is not None:
            yield closed()

    return carried.repartition("block").sortWithinPartitions("block").mapInArrow(add, "row long, count_sum long, n_best long")


def token_alignment(docs: DataFrame, a: str, b: str, id: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame, DataFrame]:
    """(documents, pairs, index) of the alignment of tokenizer ``a`` with ``b``.

    Documents: id, ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``n_best``, ``count_sum``,
    ``groups_sha256`` ('' without ids) per row of ``docs``.  Pairs: ``pair_counts``.  Index:
    ``pair_index``.  A link joins the ids of both that end at the same byte; as ids have
    bytes, that is one per group.  ``align_texts`` gives the groups themselves.

    Repeated rows and null ids are rows of their own.  Other columns, whatever their names,
    do not come along.  An empty table gives empty ones.
    """
    aligned = align_texts(docs, a, b, id, text)
    written = settle(aligned.withColumn("groups_sha256", F.when(
        F.col("n_groups") > 0, F.sha2("groups", 256)).when(F.col("n_groups") == 0, "")).drop("groups"), "aligned")
    index = settle(pair_index(written), "pair_index")
    counts = settle(pair_counts(index), "pairs")
    rows = written.where("block IS NULL").select("row", F.col("id").alias(id), "n_a", "n_b", "n_groups", F.col("n_groups").alias("n_links"), "groups_sha256")
    scored = rows.join(document_scores(index, counts), "row", "left")
    documents = scored.select(
        id, "n_a", "n_b", "n_groups", "n_links", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("n_best", "count_sum")], "groups_sha256")
    return documents, counts, index
