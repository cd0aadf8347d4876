"""One key holds a third of the rows or more: results stay whole, work stays spread."""

import pytest
from pyspark.sql import functions as F

from millrace.operators import joins, windows
from millrace.session import settle

N = 30_000


@pytest.fixture(scope="module")
def hot(spark):
    """Half of the rows under one key, the rest under a thousand."""
    key = F.when(F.col("id") < N // 2, 0).otherwise(F.col("id") % 1000 + 1)
    return settle(spark.range(0, N, 1, 8).select(key.alias("k"), (F.col("id") * 7919 % N).alias("v"), "id"), "hot")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def brute_ranks(rows):
    groups = {}
    for r in sorted(rows, key=lambda r: r["v"], reverse=True):
        groups.setdefault(r["k"], []).append(r["id"])
    return {(k, i): n for k, ids in groups.items() for n, i in enumerate(ids, 1)}


@pytest.mark.parametrize("parts", [1, 3, 16])
def test_numbers_within_groups(hot, parts):
    got = windows.dense_row_number(hot.repartition(parts), ["k"], [F.col("v").desc()], heavy=1000)
    assert {(r["k"], r["id"]): r["rn"] for r in got.collect()} == brute_ranks(hot.collect())


@pytest.mark.parametrize("heavy", [10**9, 10_000, 10, 0])
def test_heavy_and_light_groups_get_the_same_numbers(hot, heavy):
    got = windows.dense_row_number(hot, ["k"], [F.col("v").desc()], heavy=heavy)
    assert {(r["k"], r["id"]): r["rn"] for r in got.collect()} == brute_ranks(hot.collect())
    assert len(windows.heavy_groups(hot, ["k"], heavy)) == {10**9: 0, 10_000: 1, 10: 1001, 0: 1001}[heavy]


def test_light_groups_take_one_shuffle(hot):
    assert plan(windows.dense_row_number(hot, ["k"], [F.col("v").desc()])).count("Exchange") == 1


def test_numbers_over_the_whole_table(hot):
    got = windows.surrogate_keys(hot, [F.col("v")], "key", offset=1000)
    assert {r["v"]: r["key"] for r in got.collect()} == {v: 1001 + v for v in range(N)}


def test_numbers_continue_after_existing(hot):
    old = hot.select(F.col("id").alias("key"))
    got = windows.surrogate_keys(hot.where("v < 10"), [F.col("v")], "key2", existing=old.withColumnRenamed("key", "key2"))
    assert sorted(r["key2"] for r in got.collect()) == list(range(N, N + 10))


def test_null_groups_are_numbered(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), ("a", 1)], "k string, v int")
    for heavy in (0, 10):
        got = windows.dense_row_number(df, ["k"], [F.col("v")], heavy=heavy)
        assert sorted(map(tuple, got.collect()), key=repr) == sorted([(None, 1, 1), (None, 2, 2), ("a", 1, 1)], key=repr)
    assert windows.dense_row_number(df.where("false"), ["k"], [F.col("v")]).collect() == []


def test_empty_table_is_numbered(spark):
    df = spark.createDataFrame([], "k string, v int")
    assert windows.dense_row_number(df, [], [F.col("v")]).collect() == []


def test_hot_group_spans_slices(spark, hot):
    """The largest slice holds a fraction of the hot group."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sliced = hot.repartitionByRange("k", F.col("v").desc()).withColumn("s", F.spark_partition_id())
        largest = sliced.groupBy("s").count().agg(F.max("count")).first()[0]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert largest < N // 4


def test_groups_are_limited_before_the_shuffle(hot):
    for df in (
        windows.latest_row_per_key(hot, ["k"], [F.col("v").desc()]),
        windows.top_ranked(hot, ["k"], [F.col("v").desc()], 2),
    ):
        text = plan(df)
        assert text.count("WindowGroupLimit") == 2
        # The plan prints from the result down: the last limit is below the exchange.
        assert text.rindex("WindowGroupLimit") > text.rindex("Exchange hashpartitioning")


def test_latest_of_hot_key(hot):
    got = windows.latest_row_per_key(hot, ["k"], [F.col("v").desc()]).collect()
    best = {}
    for r in hot.collect():
        best[r["k"]] = max(best.get(r["k"], -1), r["v"])
    assert {r["k"]: r["v"] for r in got} == best and len(got) == len(best)


def test_right_side_of_semi_join_is_reduced_first(hot, spark):
    left = spark.range(5).select(F.col("id").alias("k"))
    df = joins.semi_join(left, hot, {"k": "k"})
    assert df.count() == 5
    # Partial aggregation of the keys below their exchange.
    assert "HashAggregate" in plan(df)


def test_rows_without_key_are_spread(spark):
    """Rows that match nothing do not meet in one task."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df = spark.range(N).select("id", F.when(F.col("id") % 10 == 0, F.col("id")).alias("k"))
        side = spark.range(N).select(F.col("id").alias("k2"), (F.col("id") + 1).alias("v"))
        got = joins.join_lookup(df, side, {"k": "k2"}, {"v": "v"})
        sizes = [r[1] for r in got.groupBy(F.spark_partition_id()).count().collect()]
        assert sum(sizes) == N and max(sizes) < N // 4
        assert got.where("v is not null").count() == N // 10
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10485760")
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_order_of_input_does_not_matter(spark, hot):
    a = windows.latest_row_per_key(hot.repartition(3), ["k"], [F.col("v").desc()])
    b = windows.latest_row_per_key(hot.repartition(11, "id"), ["k"], [F.col("v").desc()])
    assert a.exceptAll(b).count() == 0


@pytest.fixture
def small_limits(spark):
    """Skew limits that fit test data; no broadcasts."""
    limits = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
    }
    before = {k: spark.conf.get(k) for k in limits}
    for k, v in limits.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def test_hot_join_keys_are_split(spark, hot, small_limits):
    """Lookups, semi- and anti-joins and updates split the tasks of a hot key."""
    parent = spark.range(0, 800).select(F.col("id").alias("p"), (F.col("id") * 2).alias("w"))
    results = {
        "parent": (joins.join_parent_key(hot, parent, {"k": "p"}, ["w"]), None),
        "lookup": (joins.join_lookup(hot, parent, {"k": "p"}, {"w": "w"}), N),
        "update": (joins.update_from_join(hot, parent, {"k": "p"}, {"v": "w"}), N),
        "semi": (joins.semi_join(hot, parent, {"k": "p"}), None),
    }
    matched = hot.where("k < 800").count()
    for name, (df, size) in results.items():
        assert len(df.collect()) == (size or matched), name
        assert "isSkew=true" in plan(df) or "skew=true" in plan(df), name
    far = parent.where("p > 0")
    kept = joins.anti_join(hot, far, {"k": "p"})
    assert len(kept.collect()) == N - hot.where("k between 1 and 799").count()
    assert "skew=true" in plan(kept)
