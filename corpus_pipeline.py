"""From raw documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and works on all rows that the stage before it
kept; its result is written as Parquet and read back as the next one's ``docs``.  All
stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import exact, mixing, packing, quality, simhash
from millrace.llm.common import Sealed, prepare
from millrace.session import settle
from millrace.sources.tables import parquet_table

CAPACITY = 1024
WEIGHTS = (5, 2, 1)


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, trained on the labels, does not reject.

    Scores belong to texts, so they come back to the rows by id and text.
    """
    prepare(spark)
    sealed = Sealed(docs, "doc_id", "text")
    keyed = sealed.inner.withColumn("_text_hash", F.sha2(F.coalesce("text", F.lit("")), 256))
    scores = quality.quality_scores(
        keyed, parquet_table(spark, sf_dir, "labels").select("doc_id", "quality"), also=("_text_hash",)
    )
    rejected = settle(scores.where("predicted = 0").select(
        F.col("doc_id").alias("_id"), F.col("_text_hash").alias("_hash")).distinct(), "rejected")
    return sealed.open(keyed.join(
        rejected, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_text_hash") == F.col("_hash")), "left_anti"
    ))


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    prepare(spark)
    return exact.exact_dedup(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: shingles of 4 words, 4 differing bits."""
    prepare(spark)
    return simhash.simhash_dedup(docs, shingle=4, distance=4)


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    prepare(spark)
    sealed = Sealed(docs, "doc_id", "source", "text")
    sized = sealed.inner.withColumns({
        "_words": F.coalesce(F.regexp_count("text", F.lit("[^\\x20\\x09-\\x0D]+")), F.lit(0)).cast("long"),
        "_tie": F.xxhash64("text"),
    })
    mixed = mixing.mix(sized, "_words", "source", WEIGHTS, tie=["doc_id", "_tie"]).where("times > 0")
    return sealed.open(mixed.withColumn("_copy", F.explode(F.sequence(F.lit(1), "times"))))


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their places in sequences of ``CAPACITY`` ids."""
    prepare(spark)
    pieces = packing.token_pieces(docs, public_tokenizers.path("byte_bpe_50k.json"), end=0, capacity=CAPACITY)
    slim = settle(pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids"), "pieces")
    return packing.pack(slim, "length", CAPACITY, tie=["doc_id", "start", "ids_crc32"])


STAGES = [
    ("good_quality", good_quality),
    ("exact_copies", exact_copies),
    ("near_copies", near_copies),
    ("mixed_sources", mixed_sources),
    ("packed_sequences", packed_sequences),
]

#: Training, tokenizing and packing cannot be put in SQL; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order over ``documents``; each result is written and read back."""
    docs = parquet_table(prepare(spark), sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
