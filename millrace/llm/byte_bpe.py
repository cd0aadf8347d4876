"""Byte-level BPE: pre-tokens from a scan of transition functions, cached merges, decoding by offsets."""

from __future__ import annotations

import base64
from collections.abc import Iterable, Iterator, Sequence
from functools import lru_cache
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.merges import PairMerger
from millrace.llm.token_bytes import TokenBytes, gather

#: Code points that are cut into pre-tokens at a time; a longer text goes in parts.
CHUNK = 1 << 20

# Fixed values of the pattern that the rank files are made for: letters that follow an apostrophe.
SHORT_ENDINGS = ("s", "t", "m", "d")
LONG_ENDINGS = ("re", "ve", "ll")

# Classes of a code point, with what follows it where that matters.
LETTER, NUMBER, OTHER, SHORT, LONG, GLUED, SPACES, LAST_SPACE, CUT = range(9)
# States after a code point.
ENDED, IN_LETTERS, IN_NUMBERS, IN_OTHERS, AFTER_GLUE, IN_SPACES, ONE_LEFT, TWO_LEFT = range(8)


def _transition(kind: int, state: int) -> tuple[int, bool]:
    """The state after a code point of a class, and whether the code point starts a pre-token."""
    glued = state == AFTER_GLUE
    if kind == LETTER:
        # The letters of an ending, which are known to follow.
        if state in (ONE_LEFT, TWO_LEFT):
            return {TWO_LEFT: ONE_LEFT, ONE_LEFT: ENDED}[state], False
        return IN_LETTERS, not glued and state != IN_LETTERS
    if kind == NUMBER:
        return IN_NUMBERS, not glued and state != IN_NUMBERS
    if kind in (OTHER, SHORT, LONG):
        if glued or state == IN_OTHERS:
            return IN_OTHERS, False
        return {OTHER: IN_OTHERS, SHORT: ONE_LEFT, LONG: TWO_LEFT}[kind], True
    if kind == SPACES:
        return IN_SPACES, state != IN_SPACES
    return {GLUED: AFTER_GLUE, LAST_SPACE: ENDED, CUT: ENDED}[kind], True


class TransitionScan:
    """States of the automaton at all places, by an associative scan.

    Each class is a function from states to states.  The functions that products of them
    give are few and closed under composition, so a product is a look-up in a table and
    the products of all prefixes come from a blocked scan: within blocks side by side,
    then over the products of whole blocks, then both put together.
    """

    WIDTH = 64

    def __init__(self) -> None:
        kinds, states = range(CUT + 1), range(TWO_LEFT + 1)
        step = [tuple(_transition(k, s)[0] for s in states) for k in kinds]
        self.starts = np.array([[_transition(k, s)[1] for s in states] for k in kinds]).ravel()
        functions = [tuple(states)]
        known = {functions[0]: 0}
        for f in functions:
            for g in step:
                product = tuple(g[s] for s in f)
                if product not in known:
                    known[product] = len(functions)
                    functions.append(product)
        self._n = len(functions)
        self._table = np.array([[known[tuple(g[s] for s in f)] for g in functions] for f in functions], dtype=np.uint8).ravel()
        self._of_kind = np.array([known[f] for f in step], dtype=np.uint8)
        self._from_ended = np.array([f[ENDED] for f in functions], dtype=np.uint8)

    def _product(self, first: np.ndarray, then: np.ndarray) -> np.ndarray:
        return self._table[first.astype(np.uint16) * np.uint16(self._n) + then]

    def _prefixes(self, functions: np.ndarray) -> np.ndarray:
        """The product of the functions up to and with each place."""
        n = len(functions)
        blocks = -(-n // self.WIDTH)
        columns = np.zeros((blocks, self.WIDTH), dtype=np.uint8)
        columns.ravel()[:n] = functions
        columns = np.ascontiguousarray(columns.T)
        for i in range(1, self.WIDTH):
            columns[i] = self._product(columns[i - 1], columns[i])
        if blocks > 1:
            before = np.concatenate([np.zeros(1, np.uint8), self._prefixes(columns[-1])[:-1]])
            columns = self._product(np.broadcast_to(before, columns.shape), columns)
        return columns.T.ravel()[:n]

    def first_places(self, kinds: np.ndarray) -> np.ndarray:
        """The places at which pre-tokens (and cuts) start."""
        after = self._from_ended[self._prefixes(self._of_kind[kinds])]
        before = np.concatenate([np.array([ENDED], np.uint8), after[:-1]])
        return np.flatnonzero(self.starts[kinds.astype(np.int16) * (TWO_LEFT + 1) + before])


@lru_cache(maxsize=1)
def code_point_classes() -> np.ndarray:
    """LETTER, NUMBER, OTHER or SPACES for every code point, as the library's own Unicode tables have them."""
    import tiktoken

    ranks = {bytes([b]): b for b in range(256)}
    every = "".join(map(chr, chain(range(0xD800), range(0xE000, 0x110000))))
    table = np.full(0x110000, OTHER, dtype=np.uint8)
    for kind, name in ((LETTER, r"\p{L}"), (NUMBER, r"\p{N}"), (SPACES, r"\s")):
        found = tiktoken.Encoding("class", pat_str=name, mergeable_ranks=ranks, special_tokens={}).encode_ordinary(every)
        table[np.frombuffer(bytes(found).decode().encode("utf-32-le"), "<u4")] = kind
    return table


class PreTokenizer:
    """Cuts texts into the slices that the public pattern finds, without a regular expression.

    Every code point gets a class; white space and apostrophes also by the one or two code
    points after them, which is all that the pattern looks ahead.  ``TransitionScan`` then
    gives the places at which slices start.
    """

    def __init__(self) -> None:
        self._classes, self._scan = code_point_classes(), TransitionScan()

    def _kinds(self, points: np.ndarray, cuts: np.ndarray) -> np.ndarray:
        kinds = self._classes[points]
        kinds[cuts] = CUT
        follows = np.append(kinds[1:], np.uint8(CUT))
        last = (kinds == SPACES) & (follows != SPACES) & (follows != CUT)
        kinds[last] = np.where(points[last] == 0x20, GLUED, LAST_SPACE)
        marks = np.flatnonzero(points == ord("'"))
        marks = marks[kinds[marks] == OTHER]
        if len(marks):
            padded = np.append(points, np.zeros(2, points.dtype))
            one, two = padded[marks + 1], padded[marks + 2]
            kinds[marks[np.isin(one, [ord(c) for c in SHORT_ENDINGS])]] = SHORT
            for a, b in LONG_ENDINGS:
                kinds[marks[(one == ord(a)) & (two == ord(b))]] = LONG
        return kinds

    def _cut(self, texts: Sequence[str]) -> tuple[str, np.ndarray, np.ndarray]:
        """The texts, each closed by a cut, and the first places and ends of slices, cuts included."""
        joined = "\0".join(texts) + "\0"
        points = np.frombuffer(joined.encode("utf-32-le"), "<u4")
        cuts = np.cumsum(np.fromiter(map(len, texts), dtype=np.int64, count=len(texts)) + 1) - 1
        first = self._scan.first_places(self._kinds(points, cuts))
        return joined, first, cuts

    def short(self, texts: Sequence[str]) -> tuple[list[str], np.ndarray]:
        """The slices of all texts one after the other, and their number per text."""
        joined, first, cuts = self._cut(texts)
        at = np.searchsorted(first, cuts)
        ends = np.append(first[1:], len(joined))
        places, ends = np.delete(first, at), np.delete(ends, at)
        counts = np.diff(at, prepend=-1) - 1
        return [joined[a:b] for a, b in zip(places.tolist(), ends.tolist(), strict=True)], counts

    def long(self, text: str, chunk: int = CHUNK) -> Iterator[list[str]]:
        """The slices of a long text in parts; a slice at a part's end is cut again with what follows it."""
        at, size = 0, chunk
        while at < len(text):
            part = text[at:at + size]
            _, first, _ = self._cut([part])
            if at + size < len(text):
                # A slice is sure if it ends two code points before the part does.
                first = first[:np.searchsorted(first, len(part) - 2, side="right")]
                if len(first) < 2:
                    size *= 2
                    continue
            yield [part[a:b] for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True)]
            at, size = at + int(first[-1]), chunk


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def pair_merger(ranks: dict[bytes, int]) -> PairMerger:
    """The merges that ranks of byte sequences allow: any two known sequences that make a known one, by its rank."""
    pairs = [
        (ranks[token[:i]], ranks[token[i:]], rank)
        for token, rank in ranks.items() for i in range(1, len(token)) if token[:i] in ranks and token[i:] in ranks
    ]
    left, right, rank = np.array(pairs, dtype=np.int64).T
    return PairMerger(left, right, rank, rank)


class ByteBpe:
    """Encodes and decodes texts; merges of frequent slices are kept, ``limit`` of them at most."""

    def __init__(self, path: str, limit: int = 400_000, chunk: int = CHUNK) -> None:
        self._ranks = read_ranks(path)
        tokens = [b""] * (1 + max(self._ranks.values()))
        for token, rank in self._ranks.items():
            tokens[rank] = token
        self.tokens = TokenBytes(tokens)
        self._merger = pair_merger(self._ranks)
        self._symbols = np.array([self._ranks[bytes([b])] for b in range(256)], dtype=np.int64)
        self._pre, self._limit, self._chunk = PreTokenizer(), limit, chunk
        self._reset()

    def _reset(self) -> None:
        self._code: dict[str, int] = {}
        self._flat, self._used = np.zeros(1 << 16, dtype=np.uint32), 0
        self._at = self._size = np.zeros(0, dtype=np.int64)

    def _learn(self, pieces: Iterable[str]) -> None:
        """Merge new slices side by side; one that is known as a whole is that id."""
        pieces = list(pieces)
        texts = [p.encode() for p in pieces]
        whole = np.fromiter(map(self._ranks.get, texts, repeat(-1)), dtype=np.int64, count=len(texts))
        rest = np.flatnonzero(whole < 0)
        sizes = np.ones(len(texts), dtype=np.int64)
        cut = [texts[i] for i in rest.tolist()]
        lengths = np.fromiter(map(len, cut), dtype=np.int64, count=len(cut))
        sizes[rest], ids = self._merger.merge(self._symbols[np.frombuffer(b"".join(cut), dtype=np.uint8)], lengths)
        at = np.cumsum(sizes) - sizes
        total = int(sizes.sum())
        flat = np.empty(total, dtype=np.uint32)
        flat[at[whole >= 0]] = whole[whole >= 0]
        flat[np.repeat(whole < 0, sizes)] = ids
        while len(self._flat) < self._used + total:
            self._flat = np.concatenate([self._flat, np.zeros_like(self._flat)])
        self._flat[self._used:self._used + total] = flat
        self._code.update(zip(pieces, range(len(self._code), len(self._code) + len(pieces)), strict=True))
        self._at = np.concatenate([self._at, self._used + at])
        self._size = np.concatenate([self._size, sizes])
        self._used += total

    def _ids(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the slices one after the other, and their number per slice."""
        if len(self._code) > self._limit or self._used > 8 * self._limit:
            self._reset()
        codes = np.fromiter(map(self._code.get, pieces, repeat(-1)), dtype=np.int64, count=len(pieces))
        missing = np.flatnonzero(codes < 0)
        if len(missing):
            new = [pieces[i] for i in missing.tolist()]
            self._learn(dict.fromkeys(new))
            codes[missing] = np.fromiter(map(self._code.__getitem__, new), dtype=np.int64, count=len(new))
        sizes = self._size[codes]
        return gather(self._flat, self._at[codes], sizes), sizes

    def encode(self, texts: Sequence[str]) -> Iterator[np.ndarray]:
        """The ids of each text."""
        low = 0
        while low < len(texts):
            if len(texts[low]) > self._chunk:
                parts = [self._ids(p)[0] for p in self._pre.long(texts[low], self._chunk)]
                yield np.concatenate(parts)
                low += 1
                continue
            high, size = low, 0
            while high < len(texts) and (size := size + len(texts[high])) <= self._chunk:
                high += 1
            pieces, counts = self._pre.short(texts[low:high])
            ids, sizes = self._ids(pieces)
            upto = np.concatenate([[0], np.cumsum(sizes)])[np.concatenate([[0], np.cumsum(counts)])]
            for a, b in zip(upto[:-1].tolist(), upto[1:].tolist(), strict=True):
                yield ids[a:b]
            low = high

    def offsets(self, ids: np.ndarray) -> np.ndarray:
        """The place in the text's bytes at which each id starts."""
        sizes = self.tokens.size[ids]
        return np.cumsum(sizes) - sizes


@lru_cache(maxsize=2)
def byte_bpe(path: str) -> ByteBpe:
    """One per Python worker, so that its tasks share the cache."""
    return ByteBpe(path)


def encode_texts(docs: DataFrame, ranks: str, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row of ``docs``: its id, ``n_tokens``, ``ids`` and ``offsets``.

    ``ranks`` is a file of ranks of byte sequences.  A text is cut by the public pattern of
    these files and the bytes of every slice are merged by rank, as the tiktoken library
    does without special tokens, whose strings are ordinary text here.  ``ids`` and
    ``offsets`` (the byte of the text at which each id starts) are little-endian unsigned
    32-bit integers.  Null texts are empty: no ids.  Repeated rows and null ids are kept as
    they are; other columns of ``docs``, whatever their names, do not come along.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = byte_bpe(ranks)
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            ids = list(coder.encode(texts))
            yield pa.RecordBatch.from_arrays([
                batch.column("id"), pa.array([len(i) for i in ids], pa.int64()),
                pa.array([i.astype("<u4").tobytes() for i in ids], pa.binary()),
                pa.array([coder.offsets(i).astype("<u4").tobytes() for i in ids], pa.binary()),
            ], names=[id, "n_tokens", "ids", "offsets"])

    return docs.select(F.col(id).cast("long").alias("id"), F.col(text).alias("text")).mapInArrow(
        encode, f"`{id}` long, n_tokens long, ids binary, offsets binary")


def decode_ids(encoded: DataFrame, ranks: str, ids: str = "ids", offsets: str = "offsets") -> DataFrame:
    """``encoded`` with ``decoded``, the bytes of its ids, each put at its offset.

    As the offsets say where every id's bytes go, ids may come in any order or a part of
    them be given: the bytes go to their places from the first one's on, in the order of
    the offsets.  Null ids decode to null.  An old column ``decoded`` is replaced.
    """
    kept = [f for f in encoded.schema.fields if f.name.lower() != "decoded"]

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = byte_bpe(ranks).tokens
        for batch in batches:
            out: list[bytes | None] = []
            for i, o in zip(batch.column(ids), batch.column(offsets), strict=True):
                if not i.is_valid or not o.is_valid:
                    out.append(None)
                    continue
                own, place = np.frombuffer(i.as_buffer(), "<u4"), np.frombuffer(o.as_buffer(), "<u4")
                if np.any(place[1:] < place[:-1]):
                    own = own[np.argsort(place, kind="stable")]
                out.append(tokens.of(own).tobytes())
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(f.name) for f in kept], pa.array(out, pa.binary())], names=[*[f.name for f in kept], "decoded"])

    return encoded.select(*[f"`{f.name}`" for f in kept]).mapInArrow(
        decode, T.StructType([*kept, T.StructField("decoded", T.BinaryType())]))
