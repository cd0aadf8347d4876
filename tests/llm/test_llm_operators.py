"""Each operator against a brute-force version on rows with every kind of oddity."""

import hashlib
import json
import random
import re
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from millrace.llm import common, exact, line_windows, mixing, neighbours, packing, pii, quality, sharding, simhash, token_files, words
from millrace.llm.queries import QUERIES
from millrace.llm.words import WordTokenizer


def keyed(rows):
    return sorted(map(tuple, rows), key=repr)


# -- sharding ---------------------------------------------------------------------------------


@pytest.mark.parametrize("slack", [0.0, 0.25])
def test_shards(odd, slack):
    out = sharding.ring_shards(odd, "doc_id", 7, tie=["text", "source"], slack=slack).collect()
    slots = defaultdict(list)
    for r in out:
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    n = odd.count()
    sizes = [len(slots[s]) for s in range(7)]
    assert sum(sizes) == n
    assert max(sizes) - min(sizes) <= 1 if not slack else max(sizes) <= np.ceil(n * 1.25 / 7)


def test_shards_follow_the_ring():
    """One key at a time: the shard of its cell, or the next one clockwise with room."""
    rng, owner = random.Random(1), sharding.owners(5, 8, cells=64)
    counts = {c: rng.randint(0, 9) for c in range(64) if rng.random() < 0.6}
    counts = {c: n for c, n in counts.items() if n}
    free = sharding.capacities(sum(counts.values()), 5, 0.0)
    plan = sharding.fill(counts, owner, free)
    got = {(c, r): s for c, a, b, s, _ in plan for r in range(a, b)}
    left, expected, waiting = list(free), {}, []
    for c in sorted(counts):
        for r in range(counts[c]):
            s = int(owner[c])
            if left[s]:
                left[s] -= 1
                expected[c, r] = s
            else:
                waiting.append((c, r))
    # Those that wait walk at the same pace; where several wait for one place, the one that started first goes.
    for step in range(128):
        c = step % 64
        for key in [w for w in waiting if step >= w[0]]:
            s = int(owner[c])
            if left[s]:
                left[s] -= 1
                expected[key] = s
                waiting.remove(key)
    assert got == expected and not waiting


def test_a_shard_more_moves_few(spark):
    keys = spark.range(4000).select(F.col("id").alias("doc_id"))
    a, b = ({r["doc_id"]: r["shard"] for r in sharding.ring_shards(keys, "doc_id", n, vnodes=128, slack=0.25).collect()} for n in (20, 21))
    assert sum(a[k] != b[k] for k in a) < 0.25 * len(a)


def test_few_keys_move_with_the_registered_setting(spark):
    """Counts at most one apart, 40 and 41 shards: 1 in 41 keys must move, few more do."""
    keys = spark.range(60_000).select(F.xxhash64("id").alias("doc_id"))
    a, b = ({r["doc_id"]: r["shard"] for r in sharding.ring_shards(keys, "doc_id", n).collect()} for n in (40, 41))
    moved = sum(a[k] != b[k] for k in a) / len(a)
    print("moved", moved)
    assert 1 / 41 <= moved + 0.001 and moved < 0.08


def test_shards_of_nothing_and_clashes(empty, clashing):
    assert sharding.ring_shards(empty, "doc_id", 4).count() == 0
    out = sharding.ring_shards(clashing, "doc_id", 4, tie=["text"])
    assert out.count() == clashing.count() and set(out.columns) == set(clashing.columns)
    assert dict(out.dtypes)["shard"] == "int" and {r[0] for r in out.select("kept").distinct().collect()} == {"kept"}


# -- line windows -----------------------------------------------------------------------------


def brute_lines(rows):
    docs = sorted({(r[0] is None, r[0] or 0, xxhash_of(r[1]), r[1]) for r in rows if r[1] is not None})
    seen, out = set(), {}
    for no_id, doc, _, text in docs:
        lines = text.split("\n")
        at = [i for i, x in enumerate(lines) if x]
        gone = set()
        for k in range(len(at) - 2):
            window = tuple(lines[i] for i in at[k:k + 3])
            if window in seen:
                gone.update(at[k:k + 3])
            seen.add(window)
        out[None if no_id else doc, text] = (sorted(gone), "\n".join(x for i, x in enumerate(lines) if i not in gone))
    return out


def xxhash_of(text):
    h = xxhash.xxh64_intdigest((text or "").encode(), seed=42)
    return h - (1 << 64) if h >> 63 else h


def test_lines(odd, odd_rows):
    expected = brute_lines(odd_rows)
    out = line_windows.drop_repeated_lines(odd).collect()
    assert len(out) == len(odd_rows)
    for r in out:
        if r["text"] is None:
            assert r["removed"] == [] and r["clean_text"] is None and r["n_lines"] is None
        else:
            assert (r["removed"], r["clean_text"]) == expected[r["doc_id"], r["text"]]
    assert sum(len(r["removed"]) > 0 for r in out) == 5


def test_lines_of_nothing_and_clashes(empty, clashing):
    assert line_windows.drop_repeated_lines(empty).count() == 0
    out = line_windows.drop_repeated_lines(clashing)
    assert out.count() == clashing.count() and dict(out.dtypes)["removed"] == "array<int>"


# -- token files ------------------------------------------------------------------------------

FILES = {"word_bpe_49k.json": 1, "byte_bpe_50k.json": 0}


def coder(name):
    t = Tokenizer.from_file(public_tokenizers.path(name))
    t.encode_special_tokens = True
    return lambda text: [*t.encode(text or "", add_special_tokens=False).ids, FILES[name]]


@pytest.fixture(scope="module", params=sorted(FILES))
def both_ways(request):
    return WordTokenizer(public_tokenizers.path(request.param), FILES[request.param]), coder(request.param)


@settings(max_examples=150, deadline=None)
@given(text=st.text(alphabet=st.one_of(st.sampled_from(" \t\n\r\x0b\x1c\x85\xa0 　́​ab'sS.1Σσ<|>endoftext"), st.characters(codec="utf-8")), max_size=60))
def test_words_encode_like_whole_texts(both_ways, text):
    words, whole = both_ways
    assert [list(x) for x in words.encode([text, None, "a  b " + text])] == [whole(text), whole(None), whole("a  b " + text)]


def test_texts_of_other_files_are_encoded_whole(tmp_path):
    """A file with another pattern gives the library's ids, too."""
    config = json.load(open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8"))
    config["pre_tokenizer"] = {"type": "ByteLevel", "add_prefix_space": True, "trim_offsets": True, "use_regex": False}
    path = str(tmp_path / "other.json")
    with open(path, "w", encoding="utf-8") as file:
        json.dump(config, file)
    library = Tokenizer.from_file(path)
    for text in ("one two  three", " x", "", "a b"):
        assert next(iter(WordTokenizer(path, 0).encode([text]))).tolist() == [*library.encode(text, add_special_tokens=False).ids, 0]
    assert not words.cut_at_spaces(config)


def test_words_merge_like_the_model():
    """Words of every length, side by side and alone."""
    rng = random.Random(7)
    for name, end in FILES.items():
        own, whole = WordTokenizer(public_tokenizers.path(name), end), coder(name)
        assert own._merger is not None
        text = " ".join("".join(rng.choice("aeinrstlßéA.,\n") for _ in range(n)) for n in [*range(1, 60), 300, 5000] * 5)
        assert next(iter(own.encode([text]))).tolist() == whole(text)


def test_word_cache_starts_anew(odd_rows):
    name = "byte_bpe_50k.json"
    small, whole = WordTokenizer(public_tokenizers.path(name), 0, limit=50), coder(name)
    for r in odd_rows[:70]:
        assert [int(i) for i in next(iter(small.encode([r[1]])))] == whole(r[1])


@settings(max_examples=100, deadline=None)
@given(steps=st.lists(st.integers(0, 5000), max_size=300))
def test_elias_fano(steps):
    values = np.cumsum([0, *steps])
    ef = token_files.EliasFano.of(values)
    assert list(ef.all()) == list(values) and [ef[i] for i in range(len(values))] == list(values)
    assert 8 * (len(ef.low) + len(ef.high)) <= len(values) * (3 + max(1, int(values[-1]) // len(values)).bit_length()) + 16


def test_token_files(spark, odd, odd_rows, tmp_path):
    path = str(tmp_path / "ids")
    token_files.write_ids(odd, path, public_tokenizers.path("word_bpe_49k.json"), 1)
    got = token_files.read_ids(spark, path).collect()
    whole = coder("word_bpe_49k.json")
    expected = Counter((r[0], tuple(whole(r[1]))) for r in odd_rows)
    assert Counter((r["doc_id"], tuple(np.frombuffer(r["ids"], "<u4").tolist())) for r in got) == expected
    at = 0
    for r in sorted(got, key=lambda r: r["start"]):
        assert r["start"] == at
        at += r["n_tokens"]
    ordered = [r["doc_id"] for r in sorted(got, key=lambda r: r["start"])]
    assert ordered == sorted(ordered, key=lambda i: (i is not None, i or 0))
    assert list(token_files.read_document(spark, path, 7)) == whole(odd_rows[7][1])
    plan = spark.read.schema(token_files.BLOCK_SCHEMA).parquet(path).where("first_id <= 7 AND last_id >= 7")._jdf.queryExecution().executedPlan().toString()
    assert "LessThanOrEqual(first_id,7)" in plan
    assert token_files.read_document(spark, path, 10**9) is None


def test_token_files_of_nothing(spark, empty, tmp_path):
    token_files.write_ids(empty, str(tmp_path / "ids"), public_tokenizers.path("word_bpe_49k.json"), 1)
    assert token_files.read_ids(spark, str(tmp_path / "ids")).count() == 0


# -- neighbours -------------------------------------------------------------------------------


def brute_nearest(rows, k):
    rows = sorted({(i, tuple(v)) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)})
    ids, x = np.array([i for i, _ in rows]), np.array([v for _, v in rows], dtype=np.float64)
    out = {}
    for i, v in zip(ids, x, strict=True):
        if i % 20 == 0:
            score = (x * v).sum(axis=1)
            order = [j for j in np.lexsort((ids, -score)) if ids[j] != i][:k]
            out[int(i)] = [(int(ids[j]), float(score[j])) for j in order]
    return out


@pytest.mark.parametrize("hot", [0, 2500])
def test_neighbours(spark, hot):
    rng = np.random.default_rng(2)
    rows = [(i, [float(x) for x in rng.normal(size=24)]) for i in range(3000)]
    rows += [(3000 + i, rows[5][1]) for i in range(hot)]
    rows += [(9000, None), (9020, [0.0] * 24), (9040, [float("nan")] * 24), (9060, [1.0, None] * 12), (None, rows[0][1]), (9080, [1.0]), rows[7], rows[7]]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(4)
    exact_rows = [(r["vec_id"], r["embedding"]) for r in df.collect()]
    expected = brute_nearest([r for r in exact_rows if not r[1] or len(r[1]) == 24], 20)
    got = defaultdict(list)
    for r in sorted(neighbours.nearest(df, F.col("vec_id") % 20 == 0).collect(), key=lambda r: (r["query_id"], r["rank"])):
        got[r["query_id"]].append((r["vec_id"], r["score"]))
        assert r["rank"] == len(got[r["query_id"]])
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in expected[q]}) for q in expected)
    assert set(got) == set(expected) and hits >= 0.9 * sum(map(len, expected.values()))
    for q, found in got.items():
        scores = dict(expected[q])
        assert found == sorted(found, key=lambda f: (-f[1], f[0])) and q not in dict(found)
        assert all(scores.get(i, s) == pytest.approx(s, abs=1e-12) for i, s in found)


def test_neighbours_of_few_and_none(spark):
    shape = "vec_id long, embedding array<float>"
    assert neighbours.nearest(spark.createDataFrame([], shape), F.lit(True)).count() == 0
    few = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.5, 0.5]), (2, [0.5, 0.5])], shape)
    assert keyed(neighbours.nearest(few, F.col("vec_id") == 0).collect()) == [(0, 1, 1, 0.5), (0, 2, 2, 0.5)]


def collected(found):
    got = defaultdict(list)
    for r in sorted(found.collect(), key=lambda r: (r["query_id"], r["rank"])):
        got[r["query_id"]].append((r["vec_id"], pytest.approx(r["score"], abs=1e-9)))
    return got


def recall_of(got, expected):
    assert {q: len(g) for q, g in got.items()} == {q: len(e) for q, e in expected.items()}
    return sum(len({i for i, _ in got[q]} & {i for i, _ in expected[q]}) for q in expected) / sum(map(len, expected.values()))


def test_op4_gives_every_query_its_rows(spark):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").collect()]
    expected = brute_nearest(rows, 20)
    assert len(expected) == 100 and all(len(e) == 20 for e in expected.values())
    recall = recall_of(collected(QUERIES["op4_adaptive_scan"](spark, "/root/testdata/sf0.1")), expected)
    print("recall", recall)
    assert recall >= 0.95


def clustered(n):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(60, 16))[rng.integers(0, 60, n)] + 0.6 * rng.normal(size=(n, 16))
    return [(i, v) for i, v in enumerate(x.tolist())]


@pytest.mark.parametrize("long", [None, 1e6, 1e20, 1e160])
def test_neighbours_above_the_sample(spark, long):
    """Every query has 20 rows where the index is fitted on a part of the table, whatever the length of one vector."""
    rows = clustered(24_000)
    assert len(rows) > 2 * neighbours.SAMPLE
    if long:
        rows.append((24_001, [long, -long, *[0.0] * 14]))
    got = collected(neighbours.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") % 20 == 0))
    recall = recall_of(got, brute_nearest(rows, 20))
    print("recall", recall)
    assert recall >= 0.95


def test_lists_grow_with_the_square_root(spark):
    sizes = {}
    for n in (400, 6400):
        df = spark.createDataFrame(clustered(n), "id long, v array<double>").withColumn("norm", F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, e: s + e * e)))
        sizes[n] = len(neighbours.fit_index(df, n, 16, 20).centres)
    assert sizes == {400: 5, 6400: 20}


def test_neighbours_are_not_found_by_a_product_with_all(spark):
    """Most pairs of the lists that are probed are abandoned, and most lists are not scanned whole."""
    rows = np.array([v for _, v in clustered(6000)])
    rng = np.random.default_rng(1)
    index = neighbours.Index(4 * np.sqrt((rows**2).sum(axis=1)).max(), np.linalg.qr(rng.normal(size=(17, 17)))[0], None, 1)
    r, q = index.rotate(rows, False), index.rotate(rows[:100], True)
    columns = [r[:, :8], r[:, 8:]]
    exact = rows[:100] @ rows.T / (np.sqrt((rows[:100] ** 2).sum(axis=1))[:, None] * index.top)
    radius = 2 - 2 * np.sort(exact, axis=1)[:, -20]
    qi, ci = neighbours.adaptive_scan(q, r, columns, [(c**2).sum(axis=1) for c in columns], radius)
    assert len(qi) < 0.02 * exact.size
    assert len(set(zip(qi.tolist(), ci.tolist())) & set(zip(*map(list, np.nonzero(2 - 2 * exact <= radius[:, None]))))) >= 1900


def test_neighbours_with_a_sample_of_copies(spark, monkeypatch):
    """A query whose lists hold fewer than k candidates reads further ones whole."""
    monkeypatch.setattr(neighbours, "SAMPLE", 10)
    rng = np.random.default_rng(4)
    rows = [(i, v) for i, v in enumerate(rng.normal(size=(400, 8)).tolist())] + [(401, [1.0] * 8)] * 50
    found = collected(neighbours.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") % 20 == 0))
    assert recall_of(found, brute_nearest(rows, 20)) >= 0.9


# -- SimHash ----------------------------------------------------------------------------------


def brute_simhash(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    shingles = [" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    counts = Counter(b for s in shingles for b in range(64) if xxhash.xxh64_intdigest(s, 42) >> b & 1)
    return sum(1 << b for b in range(64) if shingles and 2 * counts[b] > len(shingles))


def brute_components(prints, distance=4):
    root = {p: p for p in prints}

    def find(p):
        while root[p] != p:
            p = root[p]
        return p

    items = sorted(prints)
    for i, a in enumerate(items):
        for b in items[:i]:
            if (a ^ b).bit_count() <= distance:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {p: find(p) for p in prints}


def test_simhash(odd, odd_rows):
    prints = [(r[0], brute_simhash(r[1])) for r in odd_rows]
    classes = brute_components({p for _, p in prints})
    least = defaultdict(list)
    for i, p in prints:
        least[classes[p]].append(i)
    first = {c: min([i for i in ids if i is not None], default=None) for c, ids in least.items()}
    expected = keyed((i, f"{p:016x}", first[classes[p]]) for i, p in prints)
    assert keyed(simhash.simhash_groups(odd).select("doc_id", "fingerprint", "component_id").collect()) == expected
    kept = simhash.simhash_dedup(odd).collect()
    assert len(kept) == len(least) and {classes[brute_simhash(r["text"])] for r in kept} == set(least)


@pytest.mark.parametrize("distance", [1, 3, 4])
def test_fingerprint_classes(spark, distance):
    """Random fingerprints, chains of growing distance, a dense family and its strangers in the same signatures."""
    rng = random.Random(distance)
    prints = {rng.getrandbits(64) for _ in range(300)}
    for p in list(prints)[:60]:
        q = p
        for _ in range(4):
            for b in rng.sample(range(64), rng.randint(1, 6)):
                q ^= 1 << b
            prints.add(q)
    centre = rng.getrandbits(64)
    prints |= {centre ^ (1 << a) ^ (1 << b) for a in range(24) for b in range(a)}
    low = centre & ((1 << 22) - 1)
    prints |= {low | rng.getrandbits(42) << 22 for _ in range(40)}
    signed = {p: p - (1 << 64) if p >> 63 else p for p in prints}
    df = spark.createDataFrame([(s,) for s in signed.values()], "fp long").repartition(4)
    got = defaultdict(set)
    for r in simhash.fingerprint_classes(df, distance).collect():
        got[r["label"]].add(r["fp"] % (1 << 64))
    expected = defaultdict(set)
    for p, c in brute_components(prints, distance).items():
        expected[c].add(p)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, expected.values()))


def test_a_dense_family_gives_no_pairs(spark):
    """Within a label nothing is joined: the links between labels stay few."""
    prints = spark.range(0, 4000).select(F.col("id").alias("fp"))
    assert simhash.fingerprint_classes(prints, 4).select("label").distinct().count() == 1


def test_simhash_of_nothing_and_clashes(empty, clashing, odd):
    assert simhash.simhash_groups(empty).count() == 0 and simhash.simhash_dedup(empty).count() == 0
    out = simhash.simhash_dedup(clashing)
    assert out.columns == clashing.columns and out.count() == simhash.simhash_dedup(odd).count()


# -- mixing -----------------------------------------------------------------------------------


def sized(df):
    return df.withColumns({"words": F.size(F.filter(F.split(F.coalesce("text", F.lit("")), " "), lambda w: w != "")).cast("long"), "tie": F.xxhash64("text")})


def test_mix(odd):
    df = sized(odd)
    first, again = (keyed(mixing.mix(d, "words", "source", (5, 2, 1), ["doc_id", "tie"]).drop("text").collect()) for d in (df, df.repartition(3)))
    out = mixing.mix(df, "words", "source", (5, 2, 1), ["doc_id", "tie"]).collect()
    assert first == again and len(out) == odd.count()
    taken, target, size = Counter(), {}, {}
    for r in out:
        taken[r["source"]] += r["words"] * r["times"]
        target[r["source"]], size[r["source"]] = r["target"], r["source_size"]
        assert 0 <= r["times"] <= 3
    assert sum(target.values()) == pytest.approx(sum(size.values()))
    names = sorted(size, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    free = [s for s in names if target[s] < 3 * size[s] - 1e-6]
    assert len({round(target[s] / weight[s], 6) for s in free}) == 1
    assert all(target[s] / weight[s] <= target[free[0]] / weight[free[0]] + 1e-6 for s in names if size[s])
    assert sum(abs(taken[s] - target[s]) <= 1 for s in names) >= len(names) - 3


@settings(max_examples=80, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 30), st.integers(1, 6)), min_size=1, max_size=8, unique_by=lambda p: p[0]), st.integers(0, 200))
def test_knapsack(items, budget):
    sums = {0}
    for length, count in items:
        sums = {s + length * k for s in sums for k in range(count + 1)}
    picked = mixing.knapsack([n for n, _ in items], [c for _, c in items], budget)
    assert all(0 <= p <= c for p, (_, c) in zip(picked, items, strict=True))
    assert sum(p * n for p, (n, _) in zip(picked, items, strict=True)) == max(s for s in sums if s <= budget)


def test_large_budgets_are_fitted():
    rng = np.random.default_rng(1)
    lengths = np.unique(rng.integers(1, 20_000, 3000))
    counts = rng.integers(1, 1000, len(lengths))
    for share in (0.1, 0.5, 0.93):
        budget = int((lengths * counts).sum() * share)
        picks = mixing.fit_budget(lengths, counts, budget, 7)
        assert (picks >= 0).all() and (picks <= counts).all() and int((picks * lengths).sum()) == budget


@pytest.mark.parametrize("budget", [1000, 16_000, 16_384, 16_385, 9_000_001, 3_700_197_345, 9_999_000_007, 10**10])
def test_budgets_are_met_among_many_lengths(budget):
    lengths = np.arange(1, 20_001)
    for counts in (np.full(20_000, 50), np.ones(20_000, dtype=int)):
        picks = mixing.fit_budget(lengths, counts, budget, 7)
        assert (picks >= 0).all() and (picks <= counts).all()
        assert int((picks * lengths).sum()) == min(budget, int((lengths * counts).sum()))


@settings(max_examples=80, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 60_000), st.integers(1, 3)), min_size=1, max_size=5, unique_by=lambda p: p[0]), st.integers(0, 400_000))
def test_budgets_are_missed_only_by_what_nothing_reaches(items, budget):
    sums = {0}
    for length, count in items:
        sums = {s + length * k for s in sums for k in range(count + 1)}
    budget = min(budget, max(sums))
    picks = mixing.fit_budget(np.array([n for n, _ in items]), np.array([c for _, c in items]), budget, 7)
    assert all(0 <= p <= c for p, (_, c) in zip(picks, items, strict=True))
    assert abs(budget - sum(int(p) * n for p, (n, _) in zip(picks, items, strict=True))) == min(abs(s - budget) for s in sums)


def test_heavy_groups_get_more_salts(spark, monkeypatch):
    """A group of most rows is cut by its count; its numbers stay gapless."""
    monkeypatch.setattr(common, "SALT_ROWS", 10)
    df = spark.range(5000).select(F.when(F.col("id") < 4000, 7).otherwise(F.col("id") % 50).alias("k"), "id")
    counts = {r["k"]: r["count"] for r in df.groupBy("k").count().collect()}
    salts = common.salts_by_count(counts, F.col("k"))
    got = defaultdict(list)
    for r in common.numbered(df, ["k"], ["id"], "n", salts=salts).collect():
        got[r["k"]].append(r["n"])
    assert all(sorted(n) == list(range(counts[k])) for k, n in got.items()) and len(got) == len(counts)
    assert {r["k"]: r["s"] for r in df.select("k", salts.alias("s")).distinct().collect()} == {k: 402 if k == 7 else 16 for k in counts}


def test_few_long_documents():
    assert mixing.fit_budget(np.array([30_000, 49_999]), np.array([1, 1]), 50_000, 7).tolist() == [0, 1]
    assert mixing.fit_budget(np.array([1000]), np.array([1]), 900, 7).tolist() == [1]
    assert mixing.fit_budget(np.array([1000]), np.array([1]), 400, 7).tolist() == [0]
    rng = np.random.default_rng(6)
    lengths = np.unique(rng.integers(100_000, 1_000_000, 40))
    budget = int(lengths.sum()) // 3
    assert int((mixing.fit_budget(lengths, np.ones(len(lengths), dtype=int), budget, 7) * lengths).sum()) == budget


def test_mix_of_nothing_and_clashes(empty, clashing):
    assert mixing.mix(sized(empty), "words", "source", (1,), ["doc_id"]).count() == 0
    out = mixing.mix(sized(clashing), "words", "source", (5, 2, 1), ["doc_id", "tie"])
    assert out.count() == clashing.count() and dict(out.dtypes)["times"] == "int"


# -- exact copies -----------------------------------------------------------------------------


def test_exact(odd, odd_rows):
    groups = defaultdict(list)
    for r in odd_rows:
        groups[r[1] or ""].append(r[0])
    out = exact.exact_groups(odd).collect()
    assert len(out) == len(odd_rows)
    kept = Counter()
    for r in out:
        ids = groups[r["text"] or ""]
        assert r["group_size"] == len(ids) and r["keep_id"] == max((i for i in ids if i is not None), default=None)
        if r["kept"]:
            kept[r["text"] or ""] += 1
            assert r["doc_id"] == r["keep_id"]
    assert kept == Counter(dict.fromkeys(groups, 1))


def test_only_shared_prefixes_are_hashed(spark, monkeypatch):
    """Of many texts with lengths and beginnings of their own, none is read in full."""
    written = {}
    settled = exact.settle
    monkeypatch.setattr(exact, "settle", lambda df, name: written.setdefault(name, settled(df, name)))
    texts = [(i, f"{i:07d}" + "x" * (i % 50)) for i in range(20_000)] + [(30_000 + i, "twice" * 30) for i in range(2)]
    out = exact.exact_groups(spark.createDataFrame(texts, "doc_id long, text string"))
    assert written["tagged"].where("_many").count() == 2 and out.where("group_size = 2").count() == 2 and out.count() == 20_002


def test_exact_of_nothing_and_clashes(empty, clashing, odd):
    assert exact.exact_groups(empty).count() == 0
    out = exact.exact_dedup(clashing)
    assert out.columns == clashing.columns and out.count() == exact.exact_dedup(odd).count()


# -- packing ----------------------------------------------------------------------------------


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 24), max_size=60))
def test_best_fit(lengths):
    """Against the plain method, one piece at a time."""
    rooms, places = [], defaultdict(list)
    for n in sorted(lengths, reverse=True):
        fits = [r for r in rooms if r >= n]
        room = min(fits) if fits else 24
        if fits:
            rooms.remove(room)
        rooms.append(room - n)
        places[n].append(24 - room)
    got, windows = defaultdict(list), defaultdict(list)
    counts, plan = Counter(lengths), packing.best_fit(Counter(lengths), 24)
    for i, (n, first, each, window, offset) in enumerate(plan):
        last = next((p[1] for p in plan[i + 1:] if p[0] == n), counts[n])
        for rank in range(first, last):
            k = rank - first
            got[n].append(offset + k % each * n)
            windows[window + k // each].append((offset + k % each * n, n))
    assert {n: sorted(p) for n, p in got.items()} == {n: sorted(p) for n, p in places.items()}
    assert len(windows) == len(rooms) and set(windows) == set(range(len(rooms)))
    for parts in windows.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= 24


def test_pack(odd, odd_rows):
    whole = coder("byte_bpe_50k.json")
    pieces = packing.token_pieces(odd, public_tokenizers.path("byte_bpe_50k.json"), 0, 64)
    out = packing.pack(pieces, "length", 64, ["doc_id", "start", "ids"]).collect()
    expected = Counter()
    for r in odd_rows:
        ids = whole(r[1])
        for at in range(0, len(ids), 64):
            expected[r[0], at, tuple(ids[at:at + 64]), len(ids)] += 1
    assert Counter((r["doc_id"], r["start"], tuple(np.frombuffer(r["ids"], "<u4").tolist()), r["doc_tokens"]) for r in out) == expected
    windows = defaultdict(list)
    for r in out:
        windows[r["sequence_id"]].append((r["offset"], r["length"]))
    assert set(windows) == set(range(len(windows)))
    for parts in windows.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= 64
    assert len(windows) <= np.ceil(sum(r["length"] for r in out) / 64) * 1.05 + 1


def test_op8(spark):
    """The registered query against the library: every id in one piece, sequences full from 0, little padding."""
    whole = coder("byte_bpe_50k.json")
    documents = {r["doc_id"]: whole(r["text"]) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    out = QUERIES["op8_pack"](spark, "/root/testdata/sf0.001").collect()
    reached, sequences = Counter(), defaultdict(list)
    for r in sorted(out, key=lambda r: (r["doc_id"], r["start"])):
        ids = documents[r["doc_id"]]
        assert r["start"] == reached[r["doc_id"]] and r["doc_tokens"] == len(ids)
        piece = np.array(ids[r["start"]:r["start"] + r["length"]], dtype="<u4").tobytes()
        assert r["ids_crc32"] == zlib.crc32(piece)
        reached[r["doc_id"]] += r["length"]
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    assert reached == Counter({i: len(ids) for i, ids in documents.items()}) and sorted(sequences) == list(range(len(sequences)))
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 1024
    lengths = [r["length"] for r in out]
    # Best fit decreasing, one piece at a time.
    rooms = []
    for n in sorted(lengths, reverse=True):
        fits = [r for r in rooms if r >= n]
        room = min(fits) if fits else 1024
        if fits:
            rooms.remove(room)
        rooms.append(room - n)
    assert len(sequences) == len(rooms)


def test_pack_of_nothing_and_clashes(empty, spark):
    path = public_tokenizers.path("byte_bpe_50k.json")
    assert packing.pack(packing.token_pieces(empty, path, 0, 64), "length", 64, ["doc_id"]).count() == 0
    df = spark.createDataFrame([(1, "a", "b"), (2, "c", "d")], "length int, offset string, _rank string")
    assert keyed(packing.pack(df, "length", 4, ["length"]).select("length", "sequence_id", "offset").collect()) == [(1, 0, 2), (2, 0, 0)]
    with pytest.raises(Exception, match="lengths must be 1 to 4"):
        packing.pack(df.select(F.lit(5).alias("length")), "length", 4, ["length"]).collect()


# -- personal data ----------------------------------------------------------------------------

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
PATTERNS = {"ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(digits):
    d = [int(c) for c in digits[::-1]]
    return (sum(d[::2]) + sum(sum(divmod(2 * x, 10)) for x in d[1::2])) % 10 == 0


def brute_base(text):
    out = {"email": [m.span() for m in EMAIL.finditer(text)]}
    for kind, pattern in PATTERNS.items():
        out[kind] = []
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            if {"ip": lambda m=m: all(int(p) <= 255 for p in m[0].split(".")), "card": lambda d=digits: 13 <= len(d) <= 19 and luhn(d),
                "phone": lambda d=digits: 9 <= len(d) <= 15}[kind]():
                out[kind].append(m.span())
    return out


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["a", "b.c", "@", ".", "-", " ", "1", "255", "256", "001", "+", "(", ")", "4111 1111 1111 1111", "+1 (988) 555-2485",
                                 "x@y.zz", "é", "٣", "_", "%", "10.0.0.1"]), max_size=14).map("".join))
def test_undisguised(text):
    assert pii.detect(text) == brute_base(text)
    base, added = pii.find(text)
    assert base == brute_base(text)


@pytest.mark.parametrize("text, kind, span", [
    ("write to jo.doe [at] mail [dot] example [dot] com now", "email", "jo.doe [at] mail [dot] example [dot] com"),
    ("é jo.doe(at)example(dot)com", "email", "jo.doe(at)example(dot)com"),
    ("mail jo AT example DOT com, please", "email", "jo AT example DOT com"),
    ("jоhn.doe@exаmple.com", "email", "jоhn.doe@exаmple.com"),
    ("call ＋１ ９８８ ５５５ ２４８５ x", "phone", "＋１ ９８８ ５５５ ２４８５"),
    ("call plus one nine eight eight five five five two four eight five!", "phone", "plus one nine eight eight five five five two four eight five"),
    ("card four one one one one one one one one one one one one one one one ok", "card", "four" + " one" * 15),
    ("host one nine two dot one six eight dot one dot seven up", "ip", "one nine two dot one six eight dot one dot seven"),
    ("a 4111​1111​1111​1111 b", "card", "4111​1111​1111​1111"),
])
def test_disguised(text, kind, span):
    _, added = pii.find(text)
    assert [(k, text[a:b]) for k, spans in added.items() for a, b in spans] == [(kind, span)]


@pytest.mark.parametrize("text, kind, part", [
    ("jоhn.doe@example.com", "email", "hn.doe@example.com"),
    ("john [dot] doe@example.com", "email", "doe@example.com"),
    ("john@mail.exаmple.com", "email", "john@mail.ex"),
    ("+1 988 555 24８５", "phone", "+1 988 555 24"),
])
def test_partly_disguised(text, kind, part):
    """The undisguised part stays and the whole is added."""
    base, added = pii.find(f"to {text} or")
    assert [(k, f"to {text} or"[a:b]) for k, spans in base.items() for a, b in spans] == [(kind, part)]
    assert [(k, f"to {text} or"[a:b]) for k, spans in added.items() for a, b in spans] == [(kind, text)]


@pytest.mark.parametrize("text, span", [
    ("call plus 49 30 1234567 now", "plus 49 30 1234567"),
    ("dial +49 three 0 one 23 four 567 now", "+49 three 0 one 23 four 567"),
])
def test_spelled_among_numerals(text, span):
    for beside in ("", " also one two three", " [at]"):
        base, added = pii.find(text + beside)
        assert [(text + beside)[a:b] for a, b in added["phone"]] == [span] and not base["phone"]


def test_long_digit_runs_are_read_once():
    before = time.perf_counter()
    for text in ("7" * 1_000_000, "1." * 300_000, "12345" * 100_000 + ".1.2.3"):
        pii.find(text)
    assert time.perf_counter() - before < 30


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="0123.a ", max_size=40))
def test_addresses_are_those_of_the_plain_pattern(text):
    plain = [m.span() for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text)]
    assert [m.span() for m in pii._IP.finditer(text)] == plain


def disguised(rng, identifier):
    """An identifier with some of its signs disguised."""
    at = rng.choice(["[at]", " (at) ", "[@]", "&#64;", " {at} ", "<@>", "@"])
    dot = rng.choice(["[dot]", " (dot) ", "[.]", "&#46;", "{.}", ".", " [ . ] "])
    letters = {"a": "а", "e": "е", "o": "о", "p": "р", "c": "с", "1": "１", "5": "５"}
    out = "".join(at if c == "@" else dot if c == "." else letters[c] if c in letters and rng.random() < 0.2 else c for c in identifier)
    return out if out != identifier else out.replace("@", "[at]").replace(".", "[dot]")


def test_generated_disguises_are_found():
    rng = random.Random(5)
    found = {"email": 0, "ip": 0}
    for _ in range(400):
        name, host = ("".join(rng.choice("abcdeopxyz") for _ in range(rng.randint(3, 9))) for _ in range(2))
        mail = f"{name}@{host}.{rng.choice(['com', 'org', 'nl'])}"
        address = ".".join(str(rng.randint(1, 255)) for _ in range(4))
        for kind, identifier in (("email", mail), ("ip", address)):
            text = disguised(rng, identifier)
            base, added = pii.find(f"write to {text} now")
            found[kind] += any(a <= 9 and b >= 9 + len(text) for a, b in base[kind] + added[kind])
    print("found", found)
    assert min(found.values()) >= 380


def test_long_space_is_read_once():
    text = " " * 300_000 + "one jo [at]" + " " * 300_000 + "x [dot] org"
    assert [text[a:b] for a, b in pii.find(text)[1]["email"]] == [text[text.index("jo"):]]


def test_a_spelled_digit_hides_nothing():
    text = "pay ４１１１ 1111 1111 1111 one day"
    assert [text[a:b] for a, b in pii.find(text)[1]["card"]] == ["４１１１ 1111 1111 1111"]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from([
    "plus", "one", "Nine", "oneself", "+49", "3", "0 1", "at", "dot", "[at]", "( dot )", "<at>", "jo", "mail", "com", "example.com", ".", ",", "-", "\n", "1234567", "５",
]), max_size=14), st.sampled_from(["", " ", "  "]))
def test_the_hint_loses_nothing(parts, between):
    """With the gate and without it."""
    text, hint = between.join(parts), pii._HINT
    gated = pii.find(text)
    pii._HINT = re.compile("")
    try:
        assert pii.find(text) == gated
    finally:
        pii._HINT = hint


@pytest.mark.parametrize("host", [f"bakker dot {e}" for e in "nl it pl ru cn br se ai dev photography xn--p1ai museum".split()] + [
    "mail dot bakker [dot] co dot za", "the dot com", "the dot shop dot nl", "a-b9  DOT  NL"])
def test_any_top_level_domain(host):
    text = f"write to john at {host}, or call"
    _, added = pii.find(text)
    assert [text[a:b] for a, b in added["email"]] == [f"john at {host}"]


@pytest.mark.parametrize("text", [
    "look at the dot in the middle", "evaluated at each dot product", "stared at a dot on the paper", "at every dot it stops", "aim at this dot so",
])
def test_dots_in_prose(text):
    assert not any(pii.find(text)[1].values())


@pytest.mark.parametrize("text", [
    "we met at noon and at the dot of one two three", "look at example.com", "Это просто русский текст о погоде", "one two three four five six",
    "ratio 1.2.3 at 50%", "x at y dot", "naïve café — déjà vu…",
])
def test_clean_texts_stay_clean(text):
    base, added = pii.find(text)
    assert not any(base.values()) and not any(added.values())


def test_personal_data(odd, odd_rows, empty):
    out = pii.personal_data(odd.withColumn("text", F.concat("text", F.lit(" é +1 (988) 555-2485 and jo [at] x.org")))).collect()
    assert len(out) == len(odd_rows)
    for r in out:
        assert [(s["kind"], s["disguised"]) for s in r["found"]] in ([("email", True), ("phone", False)], [])
    assert pii.personal_data(empty).count() == 0


# -- quality ----------------------------------------------------------------------------------


def graded(spark, n=600):
    rng = random.Random(5)
    rows, labels = [], []
    for i in range(n):
        good = rng.random() < 0.7
        words = ["".join(rng.choice("abcdefg") for _ in range(rng.randint(2, 8))) for _ in range(rng.randint(5, 60))]
        rows.append((i, " ".join(words) + "." if good else "!! ".join(w.upper() for w in words)))
        labels.append((i, int(good)))
    return spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int")


def test_quality(spark):
    docs, labels = graded(spark)
    truth = {r[0]: r[1] for r in labels.collect()}
    out = quality.quality_scores(docs, labels).collect()
    held = [r for r in out if r["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in out)
    assert sum(r["predicted"] == truth[r["doc_id"]] for r in held) >= 0.95 * len(held) > 0
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in out)


def test_held_out_labels_are_not_used(spark):
    docs, labels = graded(spark, 300)
    lies = labels.withColumn("quality", F.when(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = ({r["doc_id"]: r["score"] for r in quality.quality_scores(docs, x).collect()} for x in (labels, lies))
    assert a == pytest.approx(b, abs=1e-9)


def test_partitioned_sums_equal_one_solution(spark):
    """The distributed normal equations against numpy on all rows at once."""
    docs, labels = graded(spark, 300)
    rows = quality.with_statistics(docs, "text", "doc_id").join(labels, "doc_id").select(
        "x", F.col("quality").alias("y"), (F.col("doc_id") % 2 == 1).alias("calibrate"))
    model = quality.fit(rows.repartition(7), features=16)
    data = [r for r in rows.collect() if not r["calibrate"]]
    z, y = model.features(np.array([r["x"] for r in data])), np.array([r["y"] for r in data])
    penalty = np.diag([*[quality.RIDGE * len(data) / 16] * 16, 1e-9])
    assert np.allclose(model.weights, np.linalg.solve(z.T @ z + penalty, z.T @ y), atol=1e-6)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.floats(0, 1), st.integers(1, 9)), min_size=1, max_size=30))
def test_isotonic(points):
    y, w = (np.array(c, dtype=float) for c in zip(*points, strict=True))
    fit = quality.isotonic(y, w)
    assert (np.diff(fit) >= -1e-12).all() and np.isclose((fit * w).sum(), (y * w).sum())
    # The least squares rising fit is max over starts of min over ends of the means.
    brute = [max(min(np.average(y[a:b + 1], weights=w[a:b + 1]) for b in range(i, len(y))) for a in range(i + 1)) for i in range(len(y))]
    assert np.allclose(fit, brute)


def test_the_curve_follows_one_rule(spark):
    """Few rows: the curve comes from rows the ridge has not seen; without both labels on a side the score is constant."""
    docs, labels = graded(spark, 60)
    rows = quality.with_statistics(docs, "text", "doc_id").join(labels, "doc_id").select(
        "x", F.col("quality").alias("y"), (F.col("doc_id") % 3 == 2).alias("calibrate")).cache()
    model = quality.fit(rows)
    own = sorted((float(np.clip(model.raw(np.array([r["x"]]))[0], -0.5, 1.5)), r["y"]) for r in rows.where("calibrate").collect())
    assert model.knots[0] == pytest.approx(own[0][0]) and model.knots[-1] == pytest.approx(own[-1][0])
    share = rows.where("calibrate OR y = 1").agg(F.avg("y")).first()[0]
    one_sided = quality.fit(rows.where("calibrate OR y = 1"))
    assert one_sided.score(np.random.default_rng(1).normal(size=(9, quality.STATISTICS))) == pytest.approx(np.full(9, 0.999 * share))


def test_quality_of_odd_rows(odd, empty, clashing, spark):
    _, labels = graded(spark, 60)
    none = labels.where("quality > 5")
    for known in (labels, none, labels.unionByName(labels), labels.withColumn("quality", F.lit(None).cast("int"))):
        out = quality.quality_scores(odd, known)
        assert out.count() == odd.count() and out.where("score IS NULL OR predicted IS NULL OR held_out IS NULL").count() == 0
    assert quality.quality_scores(empty, labels).count() == 0
    assert quality.quality_scores(clashing, labels).count() == clashing.count()


def test_hashes_are_as_stated():
    assert xxhash.xxh64_intdigest("abc", 42) != xxhash.xxh64_intdigest("abc", 0)
    assert hashlib.sha256(b"").hexdigest().startswith("e3b0c442")
