"""Byte-level BPE, tokenizer alignment and periodic runs against the libraries and brute force."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from millrace.llm import alignment, byte_bpe, periodic
from millrace.llm.queries import QUERIES
from millrace.llm.words import byte_letters
from millrace.session import scratch_path, settle

FOLDER = "/root/testdata/sf0.001"
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def sha(data):
    return hashlib.sha256(data).hexdigest()


@pytest.fixture(scope="module")
def documents(spark):
    return [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()]


# -- byte-level BPE ----------------------------------------------------------------------------


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=byte_bpe.read_ranks(RANKS), special_tokens={})


@pytest.fixture(scope="module")
def coders():
    return byte_bpe.ByteBpe(RANKS), byte_bpe.ByteBpe(RANKS, limit=40, chunk=5)


ODD = " \t\n\r\x0b\x1c\x85\xa0　'sdtmrevlSL1２Ⅷ.!—漢\0😀á"


@settings(max_examples=300, deadline=None)
@given(texts=st.lists(st.text(alphabet=st.one_of(st.sampled_from(ODD), st.characters(codec="utf-8")), max_size=40), max_size=4))
def test_ids_are_those_of_the_library(library, coders, texts):
    for coder in coders:
        for text, ids in zip(texts, coder.encode(texts), strict=True):
            assert ids.tolist() == library.encode_ordinary(text)
            assert coder.tokens.of(ids).tobytes() == text.encode()
            assert [text.encode()[:i].__len__() for i in coder.offsets(ids)] == coder.offsets(ids).tolist()


def test_code_points_of_every_class(library, coders):
    text = "".join(f"a{chr(p)}'s{chr(p)} {chr(p)}1" for p in [*range(0x3000), *range(0xA000, 0xB000), *range(0x1F000, 0x20000)])
    assert next(iter(coders[0].encode([text]))).tolist() == library.encode_ordinary(text)


def test_products_of_transitions_are_few():
    scan = byte_bpe.TransitionScan()
    assert scan._n < 32
    kinds = np.random.default_rng(1).integers(0, 9, 50_000).astype(np.uint8)
    state, starts = byte_bpe.ENDED, []
    for i, kind in enumerate(kinds):
        after, start = byte_bpe._transition(int(kind), state)
        starts += [i] if start else []
        state = after
    assert scan.first_places(kinds).tolist() == starts


def test_long_slices_merge_in_bounded_time(library, coders):
    for text in ("ab" * 20_000, " " * 50_000 + "x", "'ll" * 5000, "1" * 30_000, "\n" * 1001):
        assert next(iter(coders[0].encode([text]))).tolist() == library.encode_ordinary(text)


def test_encode_and_decode_tables(odd, odd_rows, empty, clashing, library):
    encoded = byte_bpe.encode_texts(odd, RANKS)
    got = byte_bpe.decode_ids(encoded, RANKS).collect()
    expected = Counter((i, tuple(library.encode_ordinary(t or "")), (t or "").encode()) for i, t, *_ in odd_rows)
    assert Counter((r["doc_id"], tuple(np.frombuffer(r["ids"], "<u4").tolist()), bytes(r["decoded"])) for r in got) == expected
    assert all(r["n_tokens"] == len(r["ids"]) // 4 for r in got)
    assert byte_bpe.decode_ids(byte_bpe.encode_texts(empty, RANKS), RANKS).count() == 0
    named = byte_bpe.decode_ids(byte_bpe.encode_texts(clashing, RANKS).withColumn("decoded", F.lit(1)), RANKS)
    assert named.columns == ["doc_id", "n_tokens", "ids", "offsets", "decoded"] and dict(named.dtypes)["decoded"] == "binary"
    assert named.count() == len(odd_rows)


def test_ids_out_of_order_go_to_their_places(spark, coders):
    ids = next(iter(coders[0].encode(["one two three"])))
    offsets = coders[0].offsets(ids)
    rows = [(ids[::-1].astype("<u4").tobytes(), offsets[::-1].astype("<u4").tobytes()), (None, None)]
    out = byte_bpe.decode_ids(spark.createDataFrame(rows, "ids binary, offsets binary"), RANKS).collect()
    assert [None if r["decoded"] is None else bytes(r["decoded"]) for r in out] == [b"one two three", None]


def test_op11(spark, documents, library):
    got = {r["doc_id"]: tuple(r)[1:] for r in QUERIES["op11_byte_bpe"](spark, FOLDER).select(
        "doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect()}
    for i, text in documents:
        ids = library.encode_ordinary(text or "")
        assert got[i] == (len(ids), sha(np.array(ids, dtype="<u4").tobytes()), sha((text or "").encode()))


# -- alignment -----------------------------------------------------------------------------------


class Plain:
    """The contract, a document at a time."""

    def __init__(self):
        self.a, self.b = Tokenizer.from_file(A), SentencePieceProcessor(model_file=B)
        self.a.encode_special_tokens = True
        letters = {chr(k): k for k in range(256)} | {v: k for k, v in byte_letters().items()}
        self.bytes_a = lambda i: bytes(letters[c] for c in self.a.id_to_token(i))

    def bytes_b(self, i):
        piece = self.b.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode()

    def groups(self, text):
        if not text:
            return []
        sides = []
        for ids, name in ((self.a.encode(" " + text, add_special_tokens=False).ids, self.bytes_a), (self.b.encode(text), self.bytes_b)):
            at, ends = 0, []
            parts = [name(i) for i in ids]
            if b"".join(parts) != (" " + text).encode():
                return []
            for i, part in zip(ids, parts, strict=True):
                at += len(part)
                ends.append((at, i))
            sides.append(ends)
        cuts, out, low = sorted({e for e, _ in sides[0]} & {e for e, _ in sides[1]}), [], 0
        for cut in cuts:
            out.append([[i for e, i in side if low < e <= cut] for side in sides])
            low = cut
        return out


def expected_alignment(rows):
    plain = Plain()
    groups = [plain.groups(t) for _, t in rows]
    count = Counter((x[-1], y[-1]) for g in groups for x, y in g)
    most = defaultdict(int)
    for (_, y), n in count.items():
        most[y] = max(most[y], n)
    out = Counter()
    for (i, _), g in zip(rows, groups, strict=True):
        links = [(x[-1], y[-1]) for x, y in g]
        written = ";".join(f"{','.join(map(str, x))}|{','.join(map(str, y))}" for x, y in g)
        out[(i, sum(len(x) for x, _ in g), sum(len(y) for _, y in g), len(g), len(links), sum(count[k] == most[k[1]] for k in links),
             sum(count[k] for k in links), sha(written.encode()) if g else "")] += 1
    return out, count


ALIGNED = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


@pytest.mark.parametrize("gathered", [alignment.GATHERED, 1])
def test_alignment(spark, odd, odd_rows, clashing, monkeypatch, gathered):
    monkeypatch.setattr(alignment, "GATHERED", gathered)
    rng = random.Random(4)
    more = [(1000 + i, "".join(rng.choice(" \n\tab'é漢😀1.<s>▁") for _ in range(25))) for i in range(40)]
    more += [(2000, "▁ a"), (2001, "a\0b"), (2002, "<s> <unk> <0x41> <|endoftext|>"), (2003, "\n\n"), (2004, "  x ")]
    rows = [(r[0], r[1][:3000] if r[1] else r[1]) for r in odd_rows] + more
    documents, pairs, index = alignment.token_alignment(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), A, B)
    expected, count = expected_alignment(rows)
    assert Counter(map(tuple, documents.select("doc_id", *ALIGNED).collect())) == expected
    assert {(r["a"], r["b"]): r["links"] for r in pairs.collect()} == dict(count)
    assert index.groupBy("a", "b", "block", "plane").count().where("count > 1").count() == 0
    if gathered > 1:
        assert alignment.token_alignment(clashing, A, B)[0].columns == ["doc_id", *ALIGNED]


def test_alignment_of_nothing(empty):
    assert all(df.count() == 0 for df in alignment.token_alignment(empty, A, B))


def test_bitmaps_are_merged_and_counted(spark):
    """Blocks of few and of very many documents, in several rows, with repeated links."""
    rng = np.random.default_rng(3)
    rows = [np.sort(rng.choice(3 * alignment.BLOCK, n, replace=False)) for n in (100_000, 5000, 4096, 4095, 3, 100_000)]
    times = [rng.integers(1, 9, len(r)) for r in rows]
    batches = []
    for pair, (row, n) in enumerate(zip(rows, times, strict=True)):
        half = rng.random(len(row)) < 0.5
        for part in (half, ~half):
            again = np.repeat(row[part], n[part])
            batches += list(alignment._bitmaps(again, np.full(len(again), pair % 5), np.full(len(again), 7)))
    table = [r for b in batches for r in b.to_pylist()]
    schema = "a int, b int, block long, plane int, bitmap binary"
    index = settle(alignment.pair_index(spark.createDataFrame([tuple(r.values()) for r in table], schema)), "index")
    assert index.count() < len(table)
    got = {r["a"]: (r["documents"], r["links"], r["best"]) for r in alignment.pair_counts(index.where("a > 0")).collect()}
    most = max(int(n.sum()) for n in times[1:5])
    assert got == {a: (len(rows[a]), int(times[a].sum()), int(times[a].sum()) == most) for a in range(1, 5)}
    # Pair 0 came twice: documents of both are one.
    both = alignment.pair_counts(index.where("a = 0")).first()
    assert both["documents"] == len(np.union1d(rows[0], rows[5]))
    counts = alignment.pair_counts(index.where("a > 0"))
    scores = {r["row"]: (r["count_sum"], r["n_best"]) for r in alignment.document_scores(index.where("a > 0"), counts).collect()}
    expected = defaultdict(lambda: [0, 0])
    for a in range(1, 5):
        for row, n in zip(rows[a].tolist(), times[a].tolist(), strict=True):
            expected[row][0] += n * got[a][1]
            expected[row][1] += n * got[a][2]
    assert scores == {k: tuple(v) for k, v in expected.items()}


def test_op12(spark, documents):
    got = QUERIES["op12_alignment"](spark, FOLDER).select("doc_id", *ALIGNED).collect()
    assert Counter(map(tuple, got)) == expected_alignment(documents)[0]


# -- periodic runs -------------------------------------------------------------------------------


def brute_runs(words):
    """Every stretch of every period by definition; the smallest period of a stretch counts."""
    n, best = len(words), {}
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j > i and j + q - i >= max(6, 4 * q):
                best.setdefault((i, j + q - i), q)
            i = max(j, i + 1)
    return sorted((s, length, q) for (s, length), q in best.items())


def brute_collapsed(words, runs):
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


WORDS = st.one_of(
    st.lists(st.integers(0, 2), max_size=60),
    st.tuples(st.lists(st.integers(0, 3), max_size=8), st.lists(st.integers(0, 3), min_size=1, max_size=6), st.integers(1, 12),
              st.lists(st.integers(0, 3), max_size=8)).map(lambda x: x[0] + x[1] * x[2] + x[3]),
)


@settings(max_examples=400, deadline=None)
@given(texts=st.lists(WORDS, max_size=5))
def test_runs(texts):
    flat = np.array([w for t in texts for w in t], dtype=np.int64)
    runs, _ = periodic.find_runs(flat, np.array([len(t) for t in texts], dtype=np.int64))
    got = [[] for _ in texts]
    for i, *run in runs.tolist():
        got[i].append(tuple(run))
    assert got == [brute_runs(t) for t in texts]


def test_long_runs_take_little_work():
    for words, expected in (
        (np.zeros(100_000, np.int64), [(0, 100_000, 1)]), (np.arange(100_000) % 7, [(0, 100_000, 7)]),
        (np.r_[np.arange(50), np.tile(np.arange(9) + 100, 9000), np.arange(50)], [(50, 81_000, 9)]),
    ):
        runs, _ = periodic.find_runs(words.astype(np.int64), np.array([len(words)]))
        assert [tuple(r[1:]) for r in runs.tolist()] == expected


def test_periodic_table(odd, odd_rows, empty, clashing):
    texts = [r[1] for r in odd_rows]
    out = periodic.periodic_runs(odd).collect()
    expected = Counter()
    for i, t, *_ in odd_rows:
        words = periodic.WORD.findall(t or "")
        runs = brute_runs(words) if len(words) < 1000 else []
        expected[(i, len(words), tuple(runs), brute_collapsed(words, runs))] += 1
    assert Counter((r["doc_id"], r["n_words"], tuple(map(tuple, r["runs"])), r["collapsed"]) for r in out) == expected
    assert len(out) == len(texts) and periodic.periodic_runs(empty).count() == 0
    assert periodic.periodic_runs(clashing).columns == ["doc_id", "n_words", "runs", "collapsed"]


def test_op13(spark, documents):
    columns = ("n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")
    got = {r["doc_id"]: tuple(r)[1:] for r in QUERIES["op13_runs"](spark, FOLDER).select("doc_id", *columns).collect()}
    some = 0
    for i, text in documents:
        words = periodic.WORD.findall(text or "")
        n, h = len(words), zlib.crc32(str(i).encode())
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if k < a else words[a + (k - a) % p] for k, w in enumerate(words)]
        runs = brute_runs(words)
        some += bool(runs)
        best = None
        for run in runs:
            if best is None or run[1] * best[2] > best[1] * run[2]:
                best = run
        lines = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
        expected = (len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None, sha(lines.encode()),
                    sha(brute_collapsed(words, runs).encode()))
        assert got[i] == expected, i
    assert some > 10


def test_op13_of_texts_without_words(spark):
    path = scratch_path(spark, "wordless")
    texts = [None, "", "  \n\t", "a"] * 30
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{path}/documents.parquet")
    rows = QUERIES["op13_runs"](spark, path).collect()
    assert sorted(r["doc_id"] for r in rows) == list(range(120)) and any(zlib.crc32(str(i).encode()) % 10 == 0 for i in range(0, 120, 4))
    for r in rows:
        assert tuple(r)[1:] == (0, None, None, None, None, sha(b""), sha((texts[r["doc_id"]] or "").strip().encode()))
