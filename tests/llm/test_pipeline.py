"""The registered queries on the smallest tables, and the pipeline stage by stage."""

from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from check import connect, rows as sorted_rows
from millrace.llm import mixing, quality, simhash
from millrace.llm.queries import QUERIES, SQL
from millrace.sources.tables import parquet_table
from test_llm_operators import brute_components, brute_simhash

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(SQL))
def test_against_sql(spark, name):
    df, result = QUERIES[name](spark, FOLDER), connect(FOLDER).execute(SQL[name])
    names = [d[0] for d in result.description]
    assert sorted(df.columns) == sorted(names)
    assert sorted_rows(df.columns, df.collect()) == sorted_rows(names, result.fetchall())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - {"op4_adaptive_scan", "op8_pack", "pipeline"}))
def test_one_row_per_document(spark, name):
    df = QUERIES[name](spark, FOLDER)
    ids = Counter(r[0] for r in df.select("doc_id").collect())
    assert ids == Counter(r[0] for r in parquet_table(spark, FOLDER, "documents").select("doc_id").collect())


def test_the_pipeline_is_registered(spark):
    from __spark_entry__ import queries

    assert {f"op{n}" for n in range(1, 14)} | {"pipeline"} == {k.split("_")[0] for k in QUERIES}
    assert set(QUERIES) <= set(queries())


def texts(df):
    return Counter(r["text"] for r in df.collect())


def test_stages(spark, odd, odd_rows, clashing):
    docs = odd
    stages = dict(corpus_pipeline.STAGES)
    scores = {r["doc_id"]: r for r in quality.quality_scores(docs, parquet_table(spark, FOLDER, "labels")).collect()}
    good = stages["good_quality"](spark, docs, FOLDER)
    assert good.columns == docs.columns
    assert texts(good) == Counter(t for i, t, *_ in odd_rows if scores[i]["predicted"] or i in (None, 200))

    once = stages["exact_copies"](spark, docs, FOLDER)
    assert texts(once.withColumn("text", F.coalesce("text", F.lit("")))) == Counter(dict.fromkeys({t or "" for _, t, *_ in odd_rows}, 1))

    near = stages["near_copies"](spark, docs, FOLDER)
    classes = brute_components({brute_simhash(r[1]) for r in odd_rows})
    assert Counter(classes[brute_simhash(r["text"])] for r in near.collect()) == Counter(dict.fromkeys(classes.values(), 1))

    mixed = stages["mixed_sources"](spark, docs, FOLDER)
    sized = docs.withColumns({"w": F.coalesce(F.regexp_count("text", F.lit("[^\\x20\\x09-\\x0D]+")), F.lit(0)), "t": F.xxhash64("text")})
    expected = Counter()
    for r in mixing.mix(sized, "w", "source", corpus_pipeline.WEIGHTS, ["doc_id", "t"]).collect():
        expected[r["text"]] += r["times"]
    assert texts(mixed) == +expected

    packed = stages["packed_sequences"](spark, docs, FOLDER).collect()
    ends = defaultdict(int)
    for r in packed:
        ends[r["sequence_id"]] += r["length"]
    assert max(ends.values()) <= corpus_pipeline.CAPACITY and set(ends) == set(range(len(ends)))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, clashing, FOLDER).columns == clashing.columns, name


def test_the_whole_pipeline(spark, empty, tmp_path):
    """Against the stages run one by one on the driver's rows."""
    out = corpus_pipeline.run(spark, FOLDER)
    docs = parquet_table(spark, FOLDER, "documents")
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, FOLDER)
        docs.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
    columns = ["doc_id", "start", "length", "ids_crc32"]
    assert Counter(map(tuple, out.select(*columns).collect())) == Counter(map(tuple, docs.select(*columns).collect()))
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, FOLDER).count() == 0


def test_simhash_keeps_whole_rows(spark, odd):
    assert set(simhash.simhash_dedup(odd).collect()) <= set(odd.collect())
