"""Token ids from the tokenizers library, with a bounded cache of words."""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain, islice, repeat

import numpy as np

from millrace.llm.merges import PairMerger

#: A single space between two characters that no reading of "white space" includes.
_CUT = re.compile(r" (?=\S)(?<=\S )")
#: White space beside a space, or such as is looked for one by one.
_BESIDE = ("  ", " \n", "\n ", " \t", "\t ", " \r", "\r ")
_RARE_ASCII = "\x0b\x0c\x1c\x1d\x1e\x1f"
_RARE = re.compile(r"[^\S \n\t\r]")
#: Pieces of plain letters, plain punctuation and single line ends: both patterns split them just there.
_LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
_PLAIN = re.compile(rf"[{_LETTERS}.,;:!?]+(?:\n[{_LETTERS}.,;:!?]+)*")
_STOPS = frozenset(".,;:!?")
_PARTS = re.compile(rf"[{_LETTERS}]+|[.,;:!?]+|\n")


def byte_letters() -> dict[int, str]:
    """How byte-level vocabularies write bytes: printable ones as themselves, the others from 256 on, in order."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = (b for b in range(256) if b not in shown)
    return {b: chr(256 + i) for i, b in enumerate(hidden)}


def _even(text: str) -> bool:
    """Does every space stand between two other characters that are no white space?  (May say no by mistake.)"""
    if text[:1] == " " or text[-1:] == " " or any(pair in text for pair in _BESIDE):
        return False
    return not any(c in text for c in _RARE_ASCII) if text.isascii() else not _RARE.search(text)


# Fixed value: the pattern of the word-level file.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def cut_at_spaces(config: dict) -> bool:
    """Is a tokenizer file of one of the two kinds whose texts may be cut before single spaces?"""
    normal, pre = config.get("normalizer"), config.get("pre_tokenizer") or {}
    if config["model"].get("type") != "BPE":
        return False
    if normal is None:
        return pre.get("type") == "ByteLevel" and not pre.get("add_prefix_space") and pre.get("use_regex", True)
    steps, parts = [n.get("type") for n in normal.get("normalizers", [])], pre.get("pretokenizers", [])
    return steps == ["NFC", "Replace", "Lowercase"] and [p.get("type") for p in parts] == ["Split", "ByteLevel"] and (
        parts[0]["pattern"].get("Regex") == WORD_PATTERN and parts[0].get("invert") and not parts[1].get("use_regex", True))


class WordTokenizer:
    """Ids of whole texts, equal to encoding each text at once.

    The texts of files of other kinds than the two of ``cut_at_spaces`` are encoded whole.
    Both public BPE files never merge across a space that stands between two other
    characters, and their patterns look no further back than it; so a text may be cut
    before such spaces and the ids of its pieces put together.  Most pieces are frequent
    words, of which each is encoded once (``tests/llm`` compares with the library on
    arbitrary Unicode).  A new piece of plain letters and punctuation is put together from
    its parts, which need no pattern; any other goes through the whole tokenizer.  Beyond
    ``limit`` pieces the cache goes back to its first quarter, which has the frequent
    words: memory is bounded.
    """

    def __init__(self, path: str, end: int, limit: int = 1_000_000) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        os.environ.setdefault("RAYON_NUM_THREADS", "1")
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        # The strings of special tokens are ordinary text when they occur in a document.
        self._tokenizer.encode_special_tokens = True
        self._letters = byte_letters()
        #: The merges alone, for parts that are one word to the pattern.
        self._merger: PairMerger | None = None
        with open(path, encoding="utf-8") as file:
            config = json.load(file)
        self._cuts = cut_at_spaces(config)
        if self._cuts:
            self._own_merges(config["model"])
        self.width = 2 if self._tokenizer.get_vocab_size() <= 1 << 16 else 4
        self._drops_space = not self._tokenizer.encode(" ", add_special_tokens=False).ids
        self._end, self._limit = end, limit
        self._reset()

    def _reset(self) -> None:
        self._code: dict[object, int] = {None: 0}
        self._flat = np.zeros(1 << 16, dtype=np.uint32)
        self._flat[0] = self._end
        self._used = 1
        self._at = np.zeros(1 << 14, dtype=np.int64)
        self._size = np.zeros(1 << 14, dtype=np.int64)
        self._size[0] = 1

    def _shrink(self) -> None:
        """Forget all pieces but the first ones."""
        kept = self._limit // 4
        if self._at[kept] > 4 * self._limit:
            self._reset()
            return
        self._code = dict(islice(self._code.items(), kept))
        self._used = int(self._at[kept])
        self._flat = self._flat[:max(self._used, 1 << 16)].copy()

    def _add(self, keys: list[object], sizes: np.ndarray, ids: np.ndarray) -> None:
        n = len(self._code)
        while len(self._at) < n + len(keys):
            self._at, self._size = (np.concatenate([a, np.zeros_like(a)]) for a in (self._at, self._size))
        while len(self._flat) < self._used + len(ids):
            self._flat = np.concatenate([self._flat, np.zeros_like(self._flat)])
        self._size[n:n + len(keys)] = sizes
        self._at[n:n + len(keys)] = self._used + np.cumsum(sizes) - sizes
        self._flat[self._used:self._used + len(ids)] = ids
        self._used += len(ids)
        self._code.update(zip(keys, range(n, n + len(keys)), strict=True))

    def _encode(self, keys: list[object]) -> None:
        space = "" if self._drops_space else " "
        for begin in range(0, len(keys), 4096):
            part = keys[begin:begin + 4096]
            coded = self._tokenizer.encode_batch_fast(
                [k[0] if isinstance(k, tuple) else space + k for k in part], add_special_tokens=False
            )
            self._add_lists(part, [e.ids for e in coded])

    def _encode_words(self, keys: list[object]) -> None:
        """Parts that ``_PARTS`` finds: no normalising but lower case, no pattern, only the merges."""
        if self._merger is None:
            self._encode(keys)
            return
        before, words = b"" if self._drops_space else b" ", []
        for key in keys:
            word = key[0] if isinstance(key, tuple) else key
            if self._drops_space:
                word = word.lower()
            words.append(word.encode() if isinstance(key, tuple) else before + word.encode())
        sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        flat = np.frombuffer(b"".join(words), dtype=np.uint8)
        symbols = self._inner[flat]
        last = np.cumsum(sizes) - 1
        symbols[last] = self._final[flat[last]]
        sizes, ids = self._merger.merge(symbols, sizes)
        self._add(keys, sizes, ids)

    def _own_merges(self, model: dict) -> None:
        """The merges of a byte-level model, if it has nothing but merges to make of a word."""
        plain = not any(model.get(k) for k in ("ignore_merges", "dropout", "continuing_subword_prefix", "byte_fallback"))
        letters, vocab, end = {b: self._letters.get(b, chr(b)) for b in range(256)}, model["vocab"], model.get("end_of_word_suffix") or ""
        if not plain or not all(letters[b] in vocab and letters[b] + end in vocab for b in range(256)):
            return
        self._inner = np.array([vocab[letters[b]] for b in range(256)], dtype=np.int64)
        self._final = np.array([vocab[letters[b] + end] for b in range(256)], dtype=np.int64)
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self._merger = PairMerger(
            np.array([vocab[x] for x, _ in pairs]), np.array([vocab[y] for _, y in pairs]), np.arange(len(pairs)),
            np.array([vocab[x + y] for x, y in pairs]))

    def _add_lists(self, keys: list[object], ids: list[list[int]]) -> None:
        sizes = np.fromiter(map(len, ids), dtype=np.int64, count=len(ids))
        self._add(keys, sizes, np.fromiter(chain.from_iterable(ids), dtype=np.uint32, count=int(sizes.sum())))

    def _gather(self, keys: list[object]) -> tuple[np.ndarray, np.ndarray]:
        """The sizes of known pieces, and their ids one after the other."""
        return self._coded(np.fromiter(map(self._code.__getitem__, keys), dtype=np.int64, count=len(keys)))

    def _coded(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        sizes = self._size[codes]
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        return sizes, self._flat[np.repeat(self._at[codes] - (ends - sizes), sizes) + np.arange(total)]

    def _learn(self, keys: set[object]) -> None:
        """Encode pieces: a string stands for itself after a space, a 1-tuple for one that follows none."""
        whole, single, joined, parts, counts = [], set(), [], [], []
        for key in keys:
            glued = isinstance(key, tuple)
            text = key[0] if glued else key
            own: list[object]
            if text.isascii() and text.isalpha():
                single.add(key)
                continue
            if text[-1:] in _STOPS and text[:-1].isascii() and text[:-1].isalpha():
                own = [text[:-1], text[-1]]
            elif not _PLAIN.fullmatch(text):
                whole.append(key)
                continue
            else:
                own = _PARTS.findall(text)
            if len(own) == 1:
                single.add(key)
                continue
            if self._drops_space:
                own = [p for p in own if p != "\n"]
            else:
                own[0 if glued else 1:] = [(p,) for p in own[0 if glued else 1:]]
            joined.append(key)
            parts += own
            counts.append(len(own))
        self._encode(whole)
        single.update(parts)
        self._encode_words(list(single.difference(self._code)))
        if joined:
            sizes, ids = self._gather(parts)
            self._add(joined, np.add.reduceat(sizes, np.cumsum([0, *counts[:-1]])), ids)

    def encode(self, texts: Iterable[str | None], led: bool = False) -> Iterator[np.ndarray]:
        """The ids of each text (null: empty), the end id last; ``led``: of a space and the text."""
        if not self._cuts:
            for text in texts:
                ids = self._tokenizer.encode((" " if led else "") + (text or ""), add_special_tokens=False).ids
                yield np.array([*ids, self._end], dtype=np.uint32)
            return
        if len(self._code) > self._limit or self._used > 16 * self._limit:
            self._shrink()
        keys: list[object] = []
        bounds = [0]
        for text in texts:
            text = text or ""
            first = not led
            if led and (not text or text[0].isspace()):
                text, first = " " + text, True
            pieces: list[object] = text.split(" ") if _even(text) else _CUT.split(text)
            if first and not self._drops_space:
                pieces[0] = (pieces[0],)
            keys += pieces
            keys.append(None)
            bounds.append(len(keys))
        codes = np.fromiter(map(self._code.get, keys, repeat(-1)), dtype=np.int64, count=len(keys))
        missing = np.flatnonzero(codes < 0)
        if len(missing):
            new = [keys[i] for i in missing.tolist()]
            self._learn(set(new))
            codes[missing] = np.fromiter(map(self._code.__getitem__, new), dtype=np.int64, count=len(new))
        sizes, ids = self._coded(codes)
        cuts = np.concatenate([[0], np.cumsum(sizes)])[bounds]
        for low, high in zip(cuts[:-1], cuts[1:], strict=True):
            yield ids[low:high]


@lru_cache(maxsize=1)
def word_tokenizer(path: str, end: int) -> WordTokenizer:
    """One per Python worker, so that its tasks share the cache."""
    return WordTokenizer(path, end)
