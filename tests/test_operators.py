"""Small frames with hand-computed answers, and properties of table states."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from millrace.operators import aggregates, filters, joins, lists, projections, state, windows
from millrace.sinks import tables as sinks
from millrace.session import scratch_path, scratch_root
from millrace.sources.catalog import catalog_scan, measure_tables, measured_scan, registered_tables
from millrace.sources.tables import control_table_scan, jdbc_options, table_projected_scan


def test_not_in_null_rules(spark, rows):
    left = spark.createDataFrame([("a",), ("b",), (None,)], "k string")
    right = spark.createDataFrame([("a",)], "r string")
    with_null = spark.createDataFrame([("a",), (None,)], "r string")
    assert rows(joins.not_in(left, "k", right, "r")) == [("b",)]
    assert rows(joins.not_in(left, "k", with_null, "r")) == []
    assert rows(joins.not_in(left, "k", right.where("false"), "r")) == [("a",), ("b",), (None,)]
    # The anti-join is the other rule: NULL keys stay.
    assert rows(joins.anti_join(left, with_null, {"k": "r"})) == [("b",), (None,)]


def test_semi_latest_version_accepts_other_keys_maximum(spark, rows):
    versions = spark.createDataFrame([("a", 1), ("a", 2), ("b", 1)], "k string, v int")
    assert rows(joins.semi_latest_version(versions, "k", "v")) == [("a", 1), ("a", 2), ("b", 1)]
    assert rows(windows.latest_row_per_key(versions, ["k"], [F.col("v").desc()])) == [("a", 2), ("b", 1)]


def test_unique_rows_keeps_rows_whole(spark, rows):
    people = spark.createDataFrame([("x", "a", "2"), ("x", "b", "1")], "k string, n string, e string")
    assert rows(joins.unique_rows(people, ["k"])) == [("x", "b", "1")]


def test_lookup_keeps_rows_without_key(spark, rows):
    df = spark.createDataFrame([(1, "a"), (2, None), (3, "z")], "id int, k string")
    side = spark.createDataFrame([("a", 10)], "k2 string, v int")
    assert rows(joins.join_lookup(df, side, {"k": "k2"}, {"v": "got"})) == [(1, "a", 10), (2, None, None), (3, "z", None)]


def test_identity_from_either_side(spark, rows):
    directory = spark.createDataFrame([("U1", "ann", "a@x"), ("U2", "bob", "b@x")], "id string, name string, email string")
    sent = spark.createDataFrame(
        [(1, "U1", None), (2, None, "bob"), (3, "U9", None), (4, None, "zed"), (5, None, None)],
        "m int, user string, username string")
    got = joins.coalesce_identity(sent, directory).select("m", "from_id", "from_name", "from_email")
    assert rows(got) == [
        (1, "U1", "ann", "a@x"), (2, "U2", "bob", "b@x"), (3, "U9", None, None), (4, None, "zed", None),
        (5, None, None, None)]


def test_update_from_join_overwrites_with_null(spark, rows):
    child = spark.createDataFrame([(1, 5), (2, 6)], "id int, fk int")
    parent = spark.createDataFrame([(1, None)], "pid int, new int")
    assert rows(joins.update_from_join(child, parent, {"id": "pid"}, {"fk": "new"})) == [(1, None), (2, 6)]


def test_update_three_way(spark, rows):
    target = spark.createDataFrame([(1, "old", 7), (2, "old", 7)], "id int, txt string, tag int")
    stage = spark.createDataFrame([(1, "new", "t1"), (2, "new", "unknown")], "id int, stxt string, code string")
    codes = spark.createDataFrame([("t1", 42)], "code string, code_id int")
    got = joins.update_three_way(target, stage, codes, "id", "code", {"txt": "stxt"}, "code_id", "tag")
    assert rows(got) == [(1, "new", 42), (2, "old", 7)]


def test_directory_join_equals_right_joins_with_dropna(spark, rows):
    sent = spark.createDataFrame([(1, "a@x", "b@x"), (2, "a@x", "?"), (3, None, "b@x")], "m int, t string, f string")
    people = spark.createDataFrame([("a@x", "ann"), ("b@x", "bob"), ("c@x", "cy")], "email string, name string")
    got = joins.join_directory_twice(sent, people, "t", "f").select("m", "to_username", "from_username")
    assert rows(got) == [(1, "ann", "bob")]


def test_cascade_leaves_no_orphans_and_nothing_too_much(spark, rows):
    header = spark.createDataFrame([(1, "x"), (2, "y"), (3, None)], "h int, batch string")
    task = spark.createDataFrame([(10, 1), (20, 2), (30, None)], "t int, h int")
    link = spark.createDataFrame([(100, 10), (200, 20), (300, 99)], "l int, t int")
    new = state.cascade_delete(
        {"header": header, "task": task, "link": link}, "header", F.col("batch") == "x",
        [state.Child("task", "header", {"h": "h"}), state.Child("link", "task", {"t": "t"})])
    assert rows(new["header"]) == [(2, "y"), (3, None)]
    assert rows(new["task"]) == [(20, 2), (30, None)]
    assert rows(new["link"]) == [(200, 20), (300, 99)]
    assert rows(state.drop_orphans(new["link"], new["task"], {"t": "t"})) == [(200, 20)]


def test_batch_replacement_twice_is_once(spark, rows):
    old = spark.createDataFrame([("a", 1), ("b", 2)], "batch string, v int")
    new = spark.createDataFrame([("b", 3), ("b", 4)], "batch string, v int")
    once = state.replace_batch(old, new, "batch")
    assert rows(once) == [("a", 1), ("b", 3), ("b", 4)]
    assert rows(state.replace_batch(once, new, "batch")) == rows(once)
    path = scratch_path(spark, "t")
    shape = ["v", "batch"]
    sinks.replace_partitions(old.select(shape), path, ["batch"])
    for _ in range(2):
        table = sinks.replace_partitions(new.select(shape), path, ["batch"])
    assert rows(table, "batch", "v") == rows(once)


def test_bucketed_batches(spark, rows):
    path = scratch_path(spark, "t")
    old = spark.range(40).select(F.concat(F.lit("b"), F.col("id") % 20).alias("batch"), F.col("id").alias("v"))
    sinks.replace_in_buckets(old, path, "batch", 8)

    def files():
        return {r[0] for r in spark.read.parquet(path).select("_metadata.file_path").distinct().collect()}

    before = files()
    new = spark.createDataFrame([("b3", 100), ("new", 200)], "batch string, v bigint")
    for _ in range(2):
        table = sinks.replace_in_buckets(new, path, "batch", 8)
    expected = state.replace_batch(old, new, "batch")
    assert table.columns == ["batch", "v"] and rows(table) == rows(expected)
    # Buckets without incoming batches keep their files.
    assert len(before & files()) >= 4


def test_untouched_partitions_keep_their_files(spark, rows):
    path = scratch_path(spark, "t")
    schema = "id bigint, flag string, day int"
    old = spark.range(60).select("id", F.lit("N").alias("flag"), (F.col("id") % 6).cast("int").alias("day"))
    sinks.replace_partitions(old, path, ["day"])

    def files():
        found = spark.read.schema(schema).parquet(path).select("day", "_metadata.file_path", "_metadata.file_modification_time").distinct()
        return {(r[0], r[1], r[2]) for r in found.collect()}

    def written(before):
        return {d for d, *_ in files() ^ before}

    before, claimed = files(), spark.createDataFrame([(1,), (7,), (999,)], "key bigint")
    keys = {"id": "key"}
    for _ in range(2):
        table = sinks.rewrite_touched(spark, path, old.schema, "day", claimed, keys, lambda df: state.mark_claimed(
            df, claimed.withColumnRenamed("key", "id"), "id", "flag"))
        assert rows(table.where("flag = 'Y'"), "id") == [(1,), (7,)] and table.count() == 60
    assert written(before) == {1}
    # Updates from another table, and deletes, one of which empties a partition.
    before = files()
    stage = spark.createDataFrame([(2, "X")], "id bigint, new string")
    table = sinks.rewrite_touched(spark, path, old.schema, "day", stage, {"id": "id"}, lambda df: joins.update_from_join(df, stage, {"id": "id"}, {"flag": "new"}))
    assert rows(table.where("flag = 'X'"), "id") == [(2,)] and written(before) == {2}
    before = files()
    doomed = spark.createDataFrame([(i,) for i in [3, 9, *range(4, 60, 6)]], "id bigint")
    for _ in range(2):
        table = sinks.rewrite_touched(spark, path, old.schema, "day", doomed, {"id": "id"}, lambda df: joins.anti_join(df, doomed, {"id": "id"}))
        assert table.count() == 48 and table.where("day = 4").count() == 0
    assert written(before) == {3, 4}
    parent = spark.createDataFrame([(5,)], "k bigint")

    def cascade(df):
        return state.cascade_delete({"a": parent, "b": df}, "a", F.col("k") == 5, [state.Child("b", "a", {"id": "k"})])["b"]

    before, expected = files(), rows(cascade(table))
    table = sinks.rewrite_touched(spark, path, old.schema, "day", parent, {"id": "k"}, cascade)
    assert written(before) == {5} and rows(table) == expected and len(expected) == 47


def test_delete_batch_keeps_rows_without_batch(spark, rows):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "batch string")
    assert rows(state.delete_batch(df, "batch", "a")) == [("b",), (None,)]


def test_only_claimed_rows_are_marked(spark, rows):
    queue = spark.createDataFrame([(1, "N"), (2, "N"), (3, "Y")], "id int, flag string")
    claimed = queue.where("id = 1")
    assert rows(state.mark_claimed(queue, claimed, "id", "flag")) == [(1, "Y"), (2, "N"), (3, "Y")]


def test_commit_state_over_its_own_source(spark, rows):
    path = scratch_path(spark, "t")
    table = sinks.truncate_load(spark.createDataFrame([(1,), (2,)], "v int"), path)
    assert rows(sinks.commit_state(table.where("v = 2"), path)) == [(2,)]


def test_retention(spark, rows):
    old, new = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 10)
    main = spark.createDataFrame([(1, "Y", old), (2, "N", old), (3, "Y", new)], "id int, flag string, t timestamp_ntz")
    detail = spark.createDataFrame([(1, old), (2, old), (9, old), (9, new)], "id int, t timestamp_ntz")
    kept, details = state.retention_delete(
        main, {"d": detail}, "id", "flag", "t", F.lit("2024-01-10 00:00:00").cast("timestamp_ntz"))
    assert rows(kept, "id") == [(2,), (3,)]
    assert rows(details["d"], "id") == [(2,), (9,)]


def test_placeholder_only_if_nothing_is_pending(spark, rows):
    queue = spark.createDataFrame([("a", "Y")], "r string, flag string")
    none = spark.createDataFrame([("nobody", "N")], "r string, flag string")
    assert rows(filters.filter_unprocessed(queue, "flag", none)) == [("nobody", "N")]
    busy = spark.createDataFrame([("a", "N")], "r string, flag string")
    assert rows(filters.filter_unprocessed(busy, "flag", none)) == [("a", "N")]


@pytest.mark.parametrize("name, good", [
    ("MS_PR000001_01_20240101.xml", True), ("SG_PRABCDEF_0A_20240101.XML", True), ("SS_PR000001_01_20240101.xml", True),
    ("XX_PR000001_01_20240101.xml", False), ("MS_PR0001_01_20240101.xml", False), ("MS_PR000001_1_20240101.xml", False),
    ("MS_PR000001_01_20240101.txt", False), ("MS_PR000001.xml", False), (None, False),
])
def test_file_name_rule(spark, name, good):
    df = spark.createDataFrame([(name,)], "f string")
    accepted, rejected = filters.split_by_file_name(df, "f")
    assert (accepted.count(), rejected.count()) == ((1, 0) if good else (0, 1))


def test_any_value_equals(spark, rows):
    df = spark.createDataFrame([("x", "bot"), (None, "y")], "a string, b string")
    assert rows(filters.filter_any_value_equals(df, "bot")) == [("x", "bot")]


def test_mention_lists(spark, rows):
    directory = spark.createDataFrame([("U1", "ann", "a@x"), ("U2", "bob", None)], "id string, name string, email string")
    sent = spark.createDataFrame([(1, "<@U1> <@U9> <@U1> hi"), (2, "none"), (3, "<@U2> x")], "m int, t string")
    got = lists.mention_lists(sent, directory, ["m"], "t").select("m", "TO_USR_SRC_ID", "TO_USRNM", "TO_USR_EMAIL")
    assert rows(got) == [(1, "U1|U9|U1", "ann||ann", "a@x||a@x"), (2, None, None, None), (3, "U2", "", "")]


def test_copies_of_a_message_do_not_repeat_its_mentions(spark, rows):
    directory = spark.createDataFrame([("U1", "ann", "a@x")], "id string, name string, email string")
    sent = spark.createDataFrame([(1, "<@U1> hi")] * 3, "m int, t string")
    assert rows(lists.mention_lists(sent, directory, ["m"], "t"), "m", "TO_USRNM") == [(1, "ann")] * 3


def test_lists_keep_empty_slots(spark, rows):
    df = spark.createDataFrame([(1, "a||b")], "id int, l string")
    assert rows(lists.explode_delimited(df, "l")) == [(1, 1, "a"), (1, 2, ""), (1, 3, "b")]


def test_recipients_pair_by_position(spark, rows):
    df = spark.createDataFrame([(1, "U00000001|bad|U00000003", "a@x|b@x|c@x")], "id int, i string, p string")
    assert rows(lists.zip_recipients(df, "i", "p")) == [(1, 1, "U00000001", "a@x"), (1, 3, "U00000003", "c@x")]


def test_counts(spark, rows):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("b", 2)], "t string, v int")
    assert rows(aggregates.max_high_water(df.where("false"), "v")) == [(0,)]
    empty = aggregates.reconcile_counts({"t": (df, df.where("v = 1")), "none": (df.where("false"), df)})
    assert [tuple(map(str, r)) for r in rows(empty)] == [("none", "0", "3", "-3", "None"), ("t", "3", "2", "1", "66.67")]
    listed = aggregates.concat_accumulate(df.withColumn("c", F.col("v").cast("string")), ["t"], "v", "c", "l")
    assert rows(listed) == [("a", "1|"), ("b", "2|")]


def test_columns(spark, rows):
    df = spark.createDataFrame([(1, None, "x")], "id int, empty string, v string")
    assert projections.drop_all_null_columns(df).columns == ["id", "v"]
    assert projections.drop_all_null_columns(df.where("false")).columns == df.columns
    assert projections.drop_identity_columns(df, []).columns == df.columns
    assert projections.upper_columns(df).columns == ["ID", "EMPTY", "V"]


def test_private_columns(spark, rows):
    meta = spark.createDataFrame(
        [("Employee", 1, "Name"), ("Employee", 2, "SSN"), ("Employee", 3, "Notes"), ("Invoice", 1, "Notes"),
         ("Invoice", 2, "Note"), ("ItemAssembliesCanBuild", 1, "Id")],
        "table_name string, position int, column_name string")
    kept = projections.exclude_private_columns(meta)
    assert rows(projections.build_column_list(kept), "Source_Table_Nm", "Source_Column_Names", "Extract_Process_Active_Ind") == [
        ("Employee", '"Name"', "Y"), ("Invoice", '"Notes","Note"', "Y"), ("ItemAssembliesCanBuild", '"Id"', "N")]


def test_control_rows_drive_a_projection(spark, rows):
    control = spark.createDataFrame(
        [("A", "t1", '"a","b"', "Y"), ("A", "t2", '"a"', "N"), ("B", "t3", '"a"', "Y")],
        "Source_Db_Nm string, Source_Table_Nm string, Source_Column_Names string, Extract_Process_Active_Ind string")
    picked = rows(control_table_scan(control, "A"))
    assert picked == [("t1", '"a","b"')]
    df = spark.createDataFrame([(1, 2, 3)], "a int, b int, c int")
    assert table_projected_scan(df, picked[0][1]).columns == ["a", "b"]


def test_jdbc_options():
    plain = jdbc_options("jdbc:x", "t")
    assert plain == {"url": "jdbc:x", "fetchsize": "10000", "dbtable": "t"}
    split = jdbc_options("jdbc:x", "t", columns=["a", "b"], partition_column="a", lower=0, upper=9, partitions=4)
    assert split["dbtable"] == "(SELECT a, b FROM t) src" and split["numPartitions"] == "4"
    with pytest.raises(ValueError):
        jdbc_options("jdbc:x", "t", partition_column="a")


def test_columns_come_from_the_catalog(spark, rows):
    database = "declared_test"
    spark.sql(f"CREATE DATABASE {database} LOCATION '{scratch_path(spark, 'database')}'")
    try:
        spark.sql(f"CREATE TABLE {database}.people (`a b` VARCHAR(7), c CHAR(2), d DECIMAL(9,2), note STRING, n BIGINT, at TIMESTAMP) "
                  f"USING parquet PARTITIONED BY (n) LOCATION '{scratch_path(spark, 'people')}'")
        spark.sql(f"INSERT INTO {database}.people VALUES ('x', 'y', 1.5, 'four', TIMESTAMP '2024-01-01 00:00:00', 1), ('x', 'y', 2, 'longest', NULL, 2)")
        assert registered_tables(spark, database) == ["people"]
        found = catalog_scan(spark, database)
        text = found._jdf.queryExecution().executedPlan().toString()
        assert "FileScan" not in text and "Scan parquet" not in text
        declared = [(1, "a b", "VARCHAR", 7, 0, 0), (2, "c", "CHAR", 2, 0, 0), (3, "d", "DECIMAL", 9, 9, 2), (4, "note", "NVARCHAR", None, 0, 0),
                    (5, "at", "TIMESTAMP", 26, 26, 6), (6, "n", "BIGINT", 19, 19, 0)]
        assert rows(found.drop("table_name")) == declared
        measure_tables(spark, ["people"], database)
        assert rows(catalog_scan(spark, database, ["people"]).where("size IS NOT NULL"), "column_name", "size")[2:3] == [("c", 2)]
        assert catalog_scan(spark, database).where("column_name = 'note'").first()["size"] == 7
    finally:
        spark.sql(f"DROP DATABASE {database} CASCADE")


def test_frames_without_a_catalog_are_measured(spark, rows):
    spark.createDataFrame([("abc", 1)], "name string, n bigint").createOrReplaceTempView("measured_view")
    assert "measured_view" in registered_tables(spark)
    assert rows(catalog_scan(spark, tables=["measured_view"]), "column_name", "type", "size") == [("n", "BIGINT", 19), ("name", "NVARCHAR", None)]
    views = {"measured_view": spark.table("measured_view")}
    assert rows(measured_scan(views), "column_name", "type", "size") == [("n", "BIGINT", 19), ("name", "NVARCHAR", 3)]


def test_scratch_follows_the_session(spark):
    class Conf:
        @staticmethod
        def get(key, default=None):
            return "hdfs://shared/scratch/"

    class Session:
        conf = Conf()

    assert scratch_root(Session()) == "hdfs://shared/scratch"


def test_scratch_refuses_a_local_folder_on_a_cluster():
    class Conf:
        @staticmethod
        def get(key, default=None):
            return default

    class Context:
        master = "spark://host:7077"

        @staticmethod
        def getCheckpointDir():
            return None

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(RuntimeError):
        scratch_root(Session())
