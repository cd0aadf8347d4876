"""The operators of this package over the test tables, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from millrace.llm import (
    alignment, byte_bpe, exact, line_windows, mixing, neighbours, packing, periodic, pii, quality, sharding, simhash, token_files,
)
from millrace.llm.common import prepare
from millrace.session import scratch_path, settle
from millrace.sources.tables import parquet_table

WORD = "[^\\x20\\x09-\\x0D]+"


def _documents(spark: SparkSession, folder: str) -> DataFrame:
    return parquet_table(prepare(spark), folder, "documents")


def words(text: str) -> Column:
    """Words between ASCII white space; null texts have none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def op1_ring_shards(spark: SparkSession, folder: str) -> DataFrame:
    """All documents in 40 shards whose counts differ by one at most (law ``rows``)."""
    slim = settle(_documents(spark, folder).select(
        "doc_id", (F.coalesce(F.octet_length("text"), F.lit(0)) + 16).cast("long").alias("size"),
        F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32"), F.xxhash64("text").alias("tie"),
    ), "sizes")
    return sharding.ring_shards(slim, "doc_id", 40, tie=["tie", "size"]).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"),
    )


def op2_line_windows(spark: SparkSession, folder: str) -> DataFrame:
    """Every document with the positions of its removed lines and the text without them."""
    docs = _documents(spark, folder).select("doc_id", "text")
    return line_windows.drop_repeated_lines(docs).select(
        "doc_id", F.col("n_lines").cast("long"), F.size("removed").cast("long").alias("n_removed"),
        F.array_join(F.transform("removed", lambda i: i.cast("string")), ",").alias("removed_lines"), "clean_text",
    )


OP2_SQL = """
WITH lines AS (
  SELECT doc_id, i - 1 AS i, l[i] AS line, n FROM (
    SELECT doc_id, l, len(l) AS n, unnest(generate_series(1, len(l))) AS i
    FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents WHERE text IS NOT NULL))),
windows AS (
  SELECT doc_id, i, lead(i, 1) OVER w AS i2, lead(i, 2) OVER w AS i3,
         line || chr(10) || lead(line, 1) OVER w || chr(10) || lead(line, 2) OVER w AS content
  FROM lines WHERE line <> '' WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
later AS (
  SELECT doc_id, i, i2, i3 FROM (
    SELECT *, row_number() OVER (PARTITION BY content ORDER BY doc_id, i) AS rn FROM windows WHERE content IS NOT NULL)
  WHERE rn > 1),
covered AS (SELECT DISTINCT doc_id, unnest([i, i2, i3]) AS i FROM later)
SELECT d.doc_id, max(n) AS n_lines, count(c.i) AS n_removed,
       coalesce(string_agg(CAST(c.i AS VARCHAR), ',' ORDER BY c.i), '') AS removed_lines,
       CASE WHEN max(d.text) IS NULL THEN NULL
            ELSE coalesce(string_agg(CASE WHEN c.i IS NULL THEN line END, chr(10) ORDER BY lines.i), '') END AS clean_text
FROM documents d LEFT JOIN lines ON lines.doc_id = d.doc_id
LEFT JOIN covered c ON c.doc_id = lines.doc_id AND c.i = lines.i
GROUP BY d.doc_id
"""


def op3_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """All documents as ids in files with Elias-Fano boundaries, read back from them."""
    docs, path = _documents(spark, folder), scratch_path(spark, "token_ids")
    token_files.write_ids(docs, path, public_tokenizers.path("word_bpe_49k.json"), end=1)
    return token_files.read_ids(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op4_adaptive_scan(spark: SparkSession, folder: str) -> DataFrame:
    """The 20 nearest of every 20th vector."""
    vectors = parquet_table(prepare(spark), folder, "embeddings")
    return neighbours.nearest(vectors, F.col("vec_id") % 20 == 0, 20)


def op5_simhash(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprint and component of every document."""
    return simhash.simhash_groups(_documents(spark, folder)).select("doc_id", "fingerprint", "component_id")


def op6_mix(spark: SparkSession, folder: str) -> DataFrame:
    """How many words of each document the mix takes."""
    sized = settle(_documents(spark, folder).select(
        "doc_id", "source", words("text").alias("size"), F.xxhash64("text").alias("tie")), "sizes")
    return mixing.mix(sized, "size", "source", (5, 2, 1), tie=["doc_id", "tie"]).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("times")).alias("taken"))


def op7_exact(spark: SparkSession, folder: str) -> DataFrame:
    """Which copy of each document stays."""
    return exact.exact_groups(_documents(spark, folder).select("doc_id", "text")).select(
        "doc_id", "keep_id", "group_size", "kept", F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256"))


OP7_SQL = """
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = max(doc_id) OVER g AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW g AS (PARTITION BY coalesce(text, ''))
"""


def op8_pack(spark: SparkSession, folder: str) -> DataFrame:
    """All documents packed into sequences of 1024 ids."""
    pieces = packing.token_pieces(_documents(spark, folder), public_tokenizers.path("byte_bpe_50k.json"), end=0, capacity=1024)
    slim = settle(pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids"), "pieces")
    return packing.pack(slim, "length", 1024, tie=["doc_id", "start", "ids_crc32"])


def op9_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    """Personal data of every document: counts and hash of the undisguised, all spans."""
    found = pii.personal_data(_documents(spark, folder))
    base = F.filter("found", lambda s: ~s["disguised"])

    def joined(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def of_kind(kind: str) -> Callable[[Column], Column]:
        return lambda s: s["kind"] == kind

    return found.select(
        "doc_id",
        *[F.size(F.filter(base, of_kind(k))).cast("long").alias(f"n_{k}") for k in pii.KINDS],
        F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("found")).alias("spans"),
        F.size(F.filter("found", lambda s: s["disguised"])).cast("long").alias("n_disguised"),
    )


def op10_quality(spark: SparkSession, folder: str) -> DataFrame:
    """A quality score for every document."""
    docs = _documents(spark, folder)
    return quality.quality_scores(docs, parquet_table(spark, folder, "labels").select("doc_id", "quality"))


def op11_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    """Ids of every text by the multilingual ranks, and the bytes that the ids decode to."""
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    decoded = byte_bpe.decode_ids(byte_bpe.encode_texts(_documents(spark, folder), ranks), ranks)
    return decoded.select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op12_alignment(spark: SparkSession, folder: str) -> DataFrame:
    """How the ids of a byte-level and of a piece tokenizer link up in every document."""
    documents, _, _ = alignment.token_alignment(
        _documents(spark, folder), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))
    return documents


def planted(docs: DataFrame) -> DataFrame:
    """``docs`` with a run of words planted in every tenth text, by the hash of its id (contract of ``op13_runs``)."""
    found = F.regexp_extract_all("text", F.lit(f"({WORD})"), F.lit(1))
    h = F.crc32(F.col("doc_id").cast("string"))
    # In a step of its own, so that the words are found once; it is worked out for texts without words, too.
    numbers = docs.select("doc_id", "text", h.alias("h"), words("text").alias("n")).select(
        "doc_id", "text", "h", "n", F.floor(F.col("h") / 10).alias("g")).withColumn("a", F.expr("g % greatest(n, 1)"))
    period = F.expr("cast(1 + floor((n - a) / (3 + g % 8)) as int)")
    first, again = F.slice(found, 1, F.col("a").cast("int")), F.slice(found, (F.col("a") + 1).cast("int"), period)
    times = F.ceil((F.col("n") - F.col("a")) / period).cast("int")
    left = (F.col("n") - F.col("a")).cast("int")
    changed = F.array_join(F.concat(first, F.slice(F.flatten(F.array_repeat(again, times)), 1, left)), " ")
    return numbers.select("doc_id", F.when((F.col("h") % 10 == 0) & (F.col("n") > 0), changed).otherwise(F.col("text")).alias("text"))


def op13_runs(spark: SparkSession, folder: str) -> DataFrame:
    """Periodic runs of words in every document, and the text without their repeats."""
    found = periodic.periodic_runs(planted(_documents(spark, folder)))
    fields = ("start", "length", "period")

    def better(best: Column, run: Column) -> Column:
        # Runs come in order of start and period, so a tie keeps the earlier one.
        return F.when(best.isNull() | (run["length"] * best["period"] > best["length"] * run["period"]), run).otherwise(best)

    none = F.lit(None).cast("struct<start:long,length:long,period:long>")
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", *[r[f].cast("string") for f in fields]), F.lit("\n")))
    best = found.withColumn("best", F.aggregate("runs", none, better))
    return best.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), *[F.col("best")[f].alias(f) for f in fields],
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_ring_shards, op2_line_windows, op3_token_files, op4_adaptive_scan, op5_simhash, op6_mix, op7_exact, op8_pack,
        op9_personal_data, op10_quality, op11_byte_bpe, op12_alignment, op13_runs,
    )
} | {"pipeline": corpus_pipeline.run}

SQL: dict[str, str] = {"op2_line_windows": OP2_SQL, "op7_exact": OP7_SQL}
