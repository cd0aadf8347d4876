"""SimHash near-duplicates found through deletion-variant signatures."""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.common import Sealed
from millrace.llm.exact import one_per_key
from millrace.session import settle

BITS = 64
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(ord("A"), ord("Z") + 1)})
#: Shingles that are held as bits at a time, which bounds memory for long texts.
_CHUNK = 1 << 16


def simhash(text: str | None, shingle: int = 4) -> int:
    """The 64-bit fingerprint of a text; 0 if it has no words."""
    words = _WORD.findall((text or "").translate(_LOWER))
    if not words:
        return 0
    n, digest = max(1, len(words) - shingle + 1), xxhash.xxh64_intdigest
    ones = np.zeros(BITS, dtype=np.int64)
    for begin in range(0, n, _CHUNK):
        last = min(n, begin + _CHUNK)
        hashes = np.fromiter(
            (digest(" ".join(words[i:i + shingle]), 42) for i in range(begin, last)), dtype="<u8", count=last - begin
        )
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return sum(1 << int(bit) for bit in np.flatnonzero(2 * ones > n))


def with_fingerprint(df: DataFrame, text: str, alias: str = "_fp", shingle: int = 4) -> DataFrame:
    """``df`` without its text, with the fingerprint as a signed 64-bit number."""
    kept = [f for f in df.schema.fields if f.name != text]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = np.array([simhash(t, shingle) for t in batch.column(text).to_pylist()], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(f.name) for f in kept], pa.array(prints.view(np.int64))], names=[*[f.name for f in kept], alias]
            )

    return df.mapInArrow(scan, T.StructType([*kept, T.StructField(alias, T.LongType())]))


def segments(distance: int) -> list[tuple[int, int]]:
    """(first bit, end) of the segments: so few that of ``distance`` differing bits at most one is in some segment."""
    n = distance // 2 + 1
    return [(BITS * i // n, BITS * (i + 1) // n) for i in range(n)]


def _variants(fp: Column, distance: int) -> Column:
    """The signatures of a fingerprint: each segment with each of its bits deleted.

    A signature is the segment's other bits, kept in place, hashed with the deleted bit's
    number, which also names the segment.
    """
    keys = []
    for first, end in segments(distance):
        mask = (1 << end) - (1 << first)
        for bit in range(first, end):
            rest = mask & ~(1 << bit)
            signed = rest - (1 << BITS) if rest >> (BITS - 1) else rest
            keys.append(F.xxhash64(fp.bitwiseAND(F.lit(signed).cast("long")), F.lit(bit)))
    return F.array(*keys)


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(``node``, ``root``) of all nodes of ``edges`` (``a``, ``b``): the smallest node reachable.

    Alternates large-star and small-star steps: each node links its larger neighbours,
    then its smaller ones, to the smallest.  Every step is a map-side combined minimum
    and a join that splits hot nodes; rounds grow with the logarithm of the longest path.
    Each round is written to the shared folder.
    """
    links = settle(
        edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "links"
    )

    def digest(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first())

    before = digest(links)
    for _ in range(most_rounds):
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = settle(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "least")
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = settle(large, "large_star")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.explode(F.array(
            F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct(F.col("u"), F.col("m").alias("v")),
        )).alias("e")).select("e.*").where("u <> v").distinct()
        links = settle(small, "small_star")
        after = digest(links)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError(f"components did not settle in {most_rounds} rounds")
    return links.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        links.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )


def _near(a: str, b: str, distance: int) -> Column:
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b))) <= distance


def _labelled(prints: DataFrame, edges: DataFrame) -> DataFrame:
    """(fp, label) of all fingerprints; those without an edge are their own label."""
    found = components(edges).select(F.col("node").alias("fp"), F.col("root").alias("_root"))
    return prints.join(found, "fp", "left").select("fp", F.coalesce("_root", "fp").alias("label"))


def fingerprint_classes(prints: DataFrame, distance: int) -> DataFrame:
    """(``fp``, ``label``): fingerprints linked by chains of at most ``distance`` differing bits.

    ``prints`` has distinct fingerprints ``fp``.  Two that differ in ``distance`` bits or
    fewer have a segment in which they differ in one bit or none, hence a signature in
    common (``_variants``), so an equality join on signatures meets every such pair.

    A signature that a large group of near copies shares would give all its pairs.
    Therefore each group first links its members to its smallest one, where that holds in
    bits; the components of those links are labelled; and only members of groups in which
    several labels are left are compared: those outside a group's largest label with all
    others of another label.  Within a label nothing is left to find, so the result is
    that of all pairs, and the join gives only links between different labels.
    """
    parts = int(prints.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # By a hash, as Spark would drop a repartition by the column that the rows were made distinct by.
    keyed = prints.repartition(parts, F.xxhash64("fp")).select("fp", F.explode(_variants(F.col("fp"), distance)).alias("key"))
    groups = keyed.groupBy("key").agg(
        F.min("fp").alias("first"), F.max("fp").alias("last"), F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("fp")).alias("all"),
    )
    # Signatures with the same members (the same ends, number and sum of hashes) say the same: one of them is enough.
    groups = groups.where("n > 1").groupBy("first", "last", "n", "all").agg(F.min("key").alias("key"))
    # Written before the join, which can split a hot key only if nothing is aggregated beside it.  A group of
    # two, as chance makes them, is its smallest and its largest member: verified here, it is never joined.
    shared = settle(groups.where((F.col("n") > 2) | (F.col("n") == 2) & _near("first", "last", distance)), "shared")
    # ``shared`` grows with the documents, so it is merged at every size and never broadcast.
    members = settle(keyed.join(shared.where("n > 2").select("key", "first").hint("merge"), "key"), "signatures")
    stars = settle(
        members.where(F.col("fp") != F.col("first")).where(_near("fp", "first", distance))
        .select(F.col("fp").alias("a"), F.col("first").alias("b"))
        .unionByName(shared.where("n = 2").select(F.col("last").alias("a"), F.col("first").alias("b"))).distinct(), "stars",
    )
    labels = settle(_labelled(prints, stars), "labels")
    named = settle(members.drop("first").join(labels, "fp"), "named")
    mixed = named.groupBy("key", "label").agg(F.count(F.lit(1)).alias("n")).groupBy("key").agg(
        F.count(F.lit(1)).alias("labels"), F.max(F.struct("n", "label"))["label"].alias("main")
    ).where("labels > 1").select("key", "main")
    open_members = settle(named.join(settle(mixed, "mixed"), "key"), "open_members")
    some = open_members.where(F.col("label") != F.col("main")).select("key", "main", F.col("fp").alias("a"), F.col("label").alias("la"))
    others = open_members.select("key", F.col("fp").alias("b"), F.col("label").alias("lb"))
    links = some.join(
        others,
        (some["key"] == others["key"]) & (F.col("la") != F.col("lb"))
        & ((F.col("la") < F.col("lb")) | (F.col("lb") == F.col("main"))) & _near("a", "b", distance),
    ).select(F.col("la").alias("a"), F.col("lb").alias("b")).distinct()
    joined = components(links).select(F.col("node").alias("label"), F.col("root").alias("_root"))
    return labels.join(joined, "label", "left").select("fp", F.coalesce("_root", "label").alias("label"))


def simhash_groups(
    df: DataFrame, id: str = "doc_id", text: str = "text", shingle: int = 4, distance: int = 4, also: Sequence[str] = (),
) -> DataFrame:
    """(id, ``also``, ``fingerprint``, ``component_id``, ``_class``): one row per row of ``df``.

    The text is lower-cased (A to Z), cut into words at ASCII white space, and its word
    shingles, repeats included, are hashed by XXH64 with seed 42; a bit of the
    fingerprint is 1 if more than half of the hashes have it.  Texts with fewer words
    than a shingle have one, null texts and texts without words the fingerprint zero.
    Fingerprints within ``distance`` bits are linked; ``component_id`` is the smallest id
    reachable (null if all are null), ``_class`` the smallest fingerprint.  Rows with equal fingerprints meet as one before
    anything is compared.  An empty table gives an empty one.
    """
    rows = settle(with_fingerprint(df.select(id, *also, text), text, "_fp", shingle), "fingerprints")
    classes = settle(fingerprint_classes(rows.select(F.col("_fp").alias("fp")).distinct(), distance), "classes")
    named = rows.join(classes, F.col("_fp") == F.col("fp"))
    least = settle(named.groupBy("label").agg(F.min(id).alias("component_id")), "least")
    return named.join(least, "label").select(
        id, *also, F.lower(F.lpad(F.hex("_fp"), 16, "0")).alias("fingerprint"), "component_id", F.col("label").alias("_class")
    )


def simhash_dedup(df: DataFrame, id: str = "doc_id", text: str = "text", shingle: int = 4, distance: int = 4) -> DataFrame:
    """One row of each component, with the columns of ``df``: that with the smallest id, then text hash."""
    sealed = Sealed(df, id, text)
    hashed = sealed.inner.withColumn("_text_hash", F.sha2(F.coalesce(F.col(text), F.lit("\0null")), 256))
    groups = settle(simhash_groups(hashed, id, text, shingle, distance, also=["_text_hash"]), "groups")
    key = F.struct(F.col(id).isNull().alias("n"), F.col(id).alias("i"), F.col("_text_hash").alias("h"))
    keys = groups.groupBy("_class").agg(F.min(key).alias("k")).select("k.i", "k.h")
    kept = hashed.join(keys, F.col(id).eqNullSafe(F.col("i")) & (F.col("_text_hash") == F.col("h")), "left_semi")
    return sealed.open(one_per_key(kept, [id, "_text_hash"]))
