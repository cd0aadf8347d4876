"""Personal data, also disguised, with its place in the source text."""

from __future__ import annotations

import re
import unicodedata
from bisect import bisect_right
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.top_level import TOP_LEVEL

KINDS = ("email", "ip", "card", "phone")

# The patterns of the identifiers.
_HOST = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# Tried from the first digit of a run only, and without giving digits back: the same matches, in linear time.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

# Letters of other scripts that look like Latin ones.
_LOOKALIKES = dict(
    zip("АВЕЅІЈКМНОРСТХУаеѕіјорсухԁһ", "ABESIJKMHOPCTXYaesijopcyxdh", strict=True),
) | dict(zip("ΑΒΕΖΗΙΚΜΝΟΡΤΥΧονι", "ABEZHIKMNOPTYXovi", strict=True))
# Characters without width.
_NOTHING = frozenset("­​‌‍⁠﻿")

_DIGITS = {w: str(i) for i, w in enumerate("zero one two three four five six seven eight nine".split())}
_DIGIT = "zero|one|two|three|four|five|six|seven|eight|nine"
# A plain "at" may lead to a host of any top-level domain.
_ENDS = "|".join(TOP_LEVEL)
# What is no host in prose ("at the dot in the middle"), unless one of these ends follows.
_PROSE, _SURE = "the|a|an|each|every|this|that", "com|org|net|edu|gov|mil|info|biz|io|co|uk|de|fr|es|eu|ch|jp|ca|au|example|test"
_DISGUISE = re.compile(
    # bracketed at and dot, with the space around them; a run of space is tried from its start only
    r"(?P<at>(?:(?<!\s)\s+)?(?:\[\s*(?:at|@)\s*\]|\(\s*(?:at|@)\s*\)|\{\s*(?:at|@)\s*\}|<\s*(?:at|@)\s*>)\s*"
    # the sign as an entity
    r"|&\#0*64;|&commat;"
    # a plain at before a host with spelled or bracketed dots and a top-level domain
    rf"|(?<!\x20)\x20+at\x20+(?!(?:{_PROSE})\x20+dot\x20+(?!(?:{_SURE})\b)[a-z0-9-]+(?![a-z0-9-])(?!\x20+dot\x20|\s*[\[({{<]\s*(?:dot|\.)))"
    r"(?=[a-z0-9-]+(?:(?:\x20+dot\x20+|\s*[\[({<]\s*(?:dot|\.)\s*[\])}>]\s*)[a-z0-9-]+)*?"
    rf"(?:\x20+dot\x20+|\s*[\[({{<]\s*(?:dot|\.)\s*[\])}}>]\s*)(?:{_ENDS})\b))"
    r"|(?P<dot>(?:(?<!\s)\s+)?(?:\[\s*(?:dot|\.)\s*\]|\(\s*(?:dot|\.)\s*\)|\{\s*(?:dot|\.)\s*\}|<\s*(?:dot|\.)\s*>)\s*|&\#0*46;|(?<=[a-z0-9])\x20+dot\x20+(?=[a-z0-9]))"
    # a plus sign spelled before a digit
    rf"|(?P<plus>\bplus\x20+(?=(?:{_DIGIT}|[0-9])))"
    # runs of spelled digits
    rf"|(?P<digits>\b(?:{_DIGIT})(?:[\x20,-]+(?:{_DIGIT}))*\b)",
    re.IGNORECASE | re.ASCII,
)
_SPELLED = re.compile(_DIGIT, re.IGNORECASE)
#: Every match of ``_DISGUISE`` holds one of these, or stands beside one: texts without any have no spelled disguise.
_HINT = re.compile(rf"[\[({{<]\s*(?:at|dot|@|\.)|&(?:\#0*(?:64|46)|commat);|\x20dot\x20|\bplus\x20+[0-9]|\b(?:{_DIGIT})", re.IGNORECASE | re.ASCII)


@lru_cache(maxsize=4096)
def plain(char: str) -> str | None:
    """What a character stands for: its lookalike, its compatibility form or digit in ASCII; None if itself."""
    if char in _NOTHING:
        return ""
    if char in _LOOKALIKES:
        return _LOOKALIKES[char]
    digit = unicodedata.decimal(char, None)
    if digit is not None:
        return str(digit)
    form = unicodedata.normalize("NFKC", char)
    return form if form != char and form.isascii() and form.strip() else None


def _luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def detect(text: str) -> dict[str, list[tuple[int, int]]]:
    """The undisguised identifiers: leftmost, non-overlapping per kind; failing matches are dropped, not retried."""
    found: dict[str, list[tuple[int, int]]] = {k: [] for k in KINDS}
    free = 0
    for m in _HOST.finditer(text):
        # What the pattern for the local part takes: the run before the @, not into the match before.
        start = m.start()
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        if start < m.start():
            found["email"].append((start, m.end()))
            free = m.end()
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m[0].split(".")):
            found["ip"].append(m.span())
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 13 <= len(digits) <= 19 and _luhn(digits):
            found["card"].append(m.span())
    for m in _PHONE.finditer(text):
        if 9 <= sum(map(str.isdigit, m[0])) <= 15:
            found["phone"].append(m.span())
    return found


class Normalised:
    """A text after its transducers, with the way back to source places.

    ``pieces`` are (first place in the normalised text, first and end place in the source,
    whether it was rewritten).  A place inside a rewritten piece means the whole piece.
    """

    def __init__(self) -> None:
        self.parts: list[str] = []
        self.begins: list[int] = []
        self.pieces: list[tuple[int, int, bool]] = []
        self._length = 0

    def add(self, out: str, first: int, end: int, rewritten: bool) -> None:
        if out or rewritten:
            if out:
                self.begins.append(self._length)
                self.pieces.append((first, end, rewritten))
            self.parts.append(out)
            self._length += len(out)

    @property
    def text(self) -> str:
        return "".join(self.parts)

    def source(self, start: int, end: int) -> tuple[int, int, bool]:
        """The source span of a normalised one, and whether it holds anything rewritten."""
        a, b = bisect_right(self.begins, start) - 1, bisect_right(self.begins, end - 1) - 1
        first, _, fixed = self.pieces[a]
        low = first if fixed else first + start - self.begins[a]
        last, over, fixed = self.pieces[b]
        high = over if fixed else last + end - self.begins[b]
        # Whatever lies between may also have been deleted outright, which leaves a gap in the source.
        changed = any(p[2] for p in self.pieces[a:b + 1]) or high - low != end - start
        return low, high, changed


def _characters(text: str) -> Normalised | None:
    """The transducer of single characters; None if it changes nothing."""
    swaps = {c: p for c in set(text) if c > "\x7f" and (p := plain(c)) is not None}
    if not swaps:
        return None
    out, at = Normalised(), 0
    for m in re.finditer("[" + re.escape("".join(swaps)) + "]", text):
        out.add(text[at:m.start()], at, m.start(), False)
        out.add(swaps[m[0]], m.start(), m.end(), True)
        at = m.end()
    out.add(text[at:], at, len(text), False)
    return out


def _spellings(text: str) -> Normalised | None:
    """The transducer of disguises in words; None if it changes nothing."""
    if not _HINT.search(text):
        return None
    out, at = Normalised(), 0
    for m in _DISGUISE.finditer(text):
        out.add(text[at:m.start()], at, m.start(), False)
        kind = m.lastgroup
        word = {"at": "@", "dot": ".", "plus": "+"}.get(kind) or "".join(_DIGITS[d.lower()] for d in _SPELLED.findall(m[0]))
        out.add(word, m.start(), m.end(), True)
        at = m.end()
    out.add(text[at:], at, len(text), False)
    return out if at else None


def disguised(text: str) -> dict[str, list[tuple[int, int]]]:
    """Identifiers that show only after normalising, as spans of the source text.

    The patterns run on the text with its characters rewritten, and once more with its
    spellings rewritten too, so that a spelled digit beside an identifier hides nothing.
    """
    found: dict[str, list[tuple[int, int]]] = {k: [] for k in KINDS}
    first = _characters(text)
    middle = first.text if first else text
    second = _spellings(middle)
    for steps, out in (((first,), middle), ((second, first), second.text if second else "")):
        if steps[0] is None:
            continue
        for kind, spans in detect(out).items():
            for start, end in spans:
                changed = False
                for step in steps:
                    if step:
                        start, end, more = step.source(start, end)
                        changed |= more
                if changed:
                    found[kind].append((start, end))
    return found


def find(text: str | None) -> tuple[dict[str, list[tuple[int, int]]], dict[str, list[tuple[int, int]]]]:
    """(undisguised, added) spans per kind; an added one reaches beyond the undisguised ones of its kind and the added ones before it."""
    text = text or ""
    base, added = detect(text), disguised(text)
    for kind in KINDS:
        own, kept, i, reach = base[kind], [], 0, 0
        for start, end in sorted(added[kind], key=lambda s: (s[0], -s[1])):
            while i < len(own) and own[i][1] <= start:
                i += 1
            # How far the undisguised spans cover it without a gap.
            over, j = start, i
            while j < len(own) and own[j][0] <= over < end:
                over, j = own[j][1], j + 1
            if over < end and reach < end:
                kept.append((start, end))
                reach = end
        added[kind] = kept
    return base, added


_SPAN = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("disguised", pa.bool_())])


def personal_data(df: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, ``found``): an array of (kind, start, end, disguised) per row, by kind (email, ip, card, phone), then start.

    Places are code points of the source text, the end exclusive.  The undisguised
    identifiers come from fixed patterns and checks.  To find disguised ones, transducers
    rewrite lookalike and full-width characters, drop characters without width, and turn
    spelled digits, "plus", and bracketed or spelled "at" and "dot" into signs, noting
    where each output came from; the same patterns run on the results, and their spans are
    mapped back.  A span counts as disguised only if it holds something rewritten and the
    undisguised spans of its kind do not cover it whole; a partly disguised identifier thus
    gives its undisguised part and the whole.  A plain "at" counts before a host with
    spelled or bracketed dots that ends in a top-level domain (``top_level``), but not before
    an article in prose.  Null and empty texts give empty arrays; rows
    are independent, so repeated ones agree.  Each text is read whole by one task.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for t in batch.column("text").to_pylist():
                base, added = find(t)
                out.append([
                    {"kind": k, "start": a, "end": b, "disguised": d}
                    for k in KINDS for a, b, d in sorted([(*s, False) for s in base[k]] + [(*s, True) for s in added[k]])
                ])
            yield pa.RecordBatch.from_arrays([batch.column(id), pa.array(out, pa.list_(_SPAN))], names=[id, "found"])

    kind = dict(df.dtypes)[id]
    return df.select(F.col(id), F.col(text).alias("text")).mapInArrow(
        scan, f"`{id}` {kind}, found array<struct<kind:string,start:long,end:long,disguised:boolean>>"
    )
