import random

import pytest
from pyspark.sql import functions as F

from millrace.llm.common import prepare

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def prose(rng, n):
    return " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 7))) for _ in range(n))


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls in every column, empty and long texts, ties, repeated rows, a hot source and a hot text."""
    rng = random.Random(3)
    texts = [prose(rng, rng.randint(1, 80)) for _ in range(60)]
    passage = "\n".join(prose(rng, 12) for _ in range(5))
    texts += [f"{prose(rng, 9)}\n{passage}\n{prose(rng, 9)}" for _ in range(6)]
    texts += [None, "", "   ", "\n\n\n", "x", prose(rng, 30_000), "é" * 3000 + "\U0001f600 ok", "<|endoftext|> <|startoftext|> a"]
    texts += [texts[0]] * 45
    rows = [(i, t, "en", "src0" if i % 3 else f"s{i % 7}", len(t or "")) for i, t in enumerate(texts)]
    rows += [rows[3], rows[3], (None, texts[5], None, None, None), (None, None, None, None, None), (None, None, None, None, None)]
    rows += [(200, "twice", "en", "a", 5), (200, "another", "en", None, 7)]
    return rows


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    return prepare(spark).createDataFrame(odd_rows, SCHEMA).repartition(5)


@pytest.fixture(scope="session")
def empty(spark):
    return prepare(spark).createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def clashing(odd):
    """The same rows with columns named like those that operators add or use."""
    return odd.withColumns({c: F.lit(c) for c in (
        "shard", "slot", "kept", "keep_id", "group_size", "removed", "n_lines", "clean_text", "times", "target", "source_size",
        "sequence_id", "offset", "start", "length", "_rank", "_salt", "_cell", "_fp", "fp", "label", "key", "score", "size", "id", "i", "h",
    )})
