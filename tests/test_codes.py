"""Dictionaries of thousands of codes give what the fold over all of them gives."""

import random

import pytest
from pyspark.sql import functions as F

from millrace.operators import codes as by_index


def fold(text, codes, trim):
    found = []
    for code in codes:
        if text is not None and code and code in text:
            text = trim(text.replace(code, ""))
            found.append(code)
    return text, found


@pytest.fixture(scope="module")
def dictionary():
    rng = random.Random(3)
    codes = {"".join(rng.choice("abcd:") for _ in range(rng.randint(1, 9))) for _ in range(9500)}
    codes = [c for c in sorted(codes, key=lambda c: rng.random()) if len(c) > 3 or rng.random() < 0.2]
    assert len(codes) > 4500
    # Codes that come together only when others are cut out, one of them twice over.
    return ["<x>", "<y<z", "yes>", ":::q", "no", *codes, "n__o"]


def texts():
    rng = random.Random(4)
    out = ["".join(rng.choice("abcd: ") for _ in range(rng.randint(0, 60))) for _ in range(150)]
    return [*out, None, "", "   ", "<y<x><z rest", "<<x>y<z rest", "y<x>es> a", "n<x>o", "é<x>ü 汉", "n_<x>_o", "_%"]


def brute_frame(spark):
    return spark.createDataFrame(list(enumerate(texts())), "id int, msg string")


def table(spark, codes):
    return spark.createDataFrame(list(enumerate(codes)), "position int, code string")


def test_folds_over_thousands_of_codes(spark, dictionary):
    rows, codes = brute_frame(spark), table(spark, dictionary)
    tags = {r["id"]: (r["f"]["text"], r["f"]["tag"]) for r in by_index.strip_last_tag_by_index(rows, "msg", codes).collect()}
    values = {r["id"]: (r["f"]["text"], r["f"]["values"]) for r in by_index.strip_all_values_by_index(rows, "msg", codes).collect()}
    for i, text in enumerate(texts()):
        left, found = fold(text, dictionary, lambda t: t.lstrip(" "))
        assert tags[i] == (left, found[-1] if found else "")
        assert values[i] == fold(text, dictionary, lambda t: t.rstrip(" "))
    kept = {r["id"] for r in by_index.filter_contains_any(rows, "msg", codes).collect()}
    assert kept == {i for i, t in enumerate(texts()) if t is not None and any(c in t for c in dictionary)}


def test_no_codes_and_no_rows(spark):
    rows, none = brute_frame(spark), table(spark, ["x"]).where("false")
    assert [r["f"]["text"] for r in by_index.strip_last_tag_by_index(rows, "msg", none).orderBy("id").collect()] == texts()
    assert by_index.filter_contains_any(rows, "msg", none).count() == 0
    assert by_index.strip_all_values_by_index(rows.where("false"), "msg", table(spark, ["x", None, ""])).count() == 0


def test_the_plan_does_not_grow_with_the_codes(spark, dictionary):
    rows = brute_frame(spark)

    def length(n):
        hits = by_index.code_hits(rows.select(F.col("id").alias("_row"), F.col("msg").alias("_text")), by_index.code_index(table(spark, dictionary[:n])))
        return len(hits._jdf.queryExecution().optimizedPlan().toString())

    assert abs(length(5) - length(3000)) < 200
