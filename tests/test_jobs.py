"""Ledger, metadata, extract, reload and streams."""

import datetime as dt
import os
import random
import time

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators import metadata
from millrace.plans import extract, ledger, reload
from millrace.session import scratch_path
from millrace.sources.catalog import measured_scan
from millrace.sources.files import csv_folder_scan, csv_folder_tables, csv_rejects, csv_scan, json_messages_scan, json_rejects
from millrace.streaming import jobs


def ts(text):
    return F.lit(text).cast("timestamp_ntz")


# --- ledger ---


def test_gate_open_close(spark, rows):
    events = spark.createDataFrame([
        ("a", 1, dt.datetime(2024, 1, 1), "STRT"), ("a", 2, dt.datetime(2024, 1, 2), "CPLT"),
        ("b", 3, dt.datetime(2024, 1, 1), "CPLT"), ("b", 4, dt.datetime(2024, 1, 3), "STRT"),
        ("c", 5, dt.datetime(2024, 1, 1), "CPLT")], "step string, event_id int, event_ts timestamp_ntz, status string")
    gated = ledger.gate(events)
    assert rows(gated, "step", "may_start") == [("a", True), ("b", False), ("c", True)]
    ready = gated.withColumns({"window_start": F.col("event_ts"), "window_end": ts("2024-02-01")})
    started = ledger.open_events(ready, ts("2024-02-01"))
    assert rows(started, "step", "status", "Num_Rows_Read", "Process_End_Ts") == [
        (s, "STRT", 0, dt.datetime(9999, 12, 31)) for s in ("a", "c")]
    results = spark.createDataFrame([("a", True, 5, 5, 5, 4, None), ("c", False, 9, 9, 9, 9, "broke")],
                                    "step string, ok boolean, Num_Rows_Read bigint, Num_Rows_Processed bigint, "
                                    "Total_Rows_From_Source bigint, Total_Rows_To_Target bigint, error string")
    closed = ledger.close_events(started, results, ts("2024-02-02"))
    assert rows(closed, "step", "status", "Num_Rows_Read", "Total_Rows_To_Target", "Process_Error_Desc") == [
        ("a", "CPLT", 5, 4, ""), ("c", "FAIL", 0, 0, "broke")]


def test_windows(spark):
    steps = spark.createDataFrame(
        [(k, k, dt.datetime(2024, 1, 5), "v5") for k in ("ALL", "MAX_DT", "DAY_END", "CUR_TS", "PREV_DAY_END", "MAX_VAL", "ODD")],
        "step string, increment_type string, previous_end timestamp_ntz, previous_value string")
    got = {r["step"]: r for r in ledger.incremental_windows(
        steps, ts("2024-01-10 12:00:00.123456"), max_end=ts("2024-01-09"), max_value=F.lit("v9")).collect()}
    start = dt.datetime(2024, 1, 5)
    assert (got["ALL"]["window_start"], got["ALL"]["window_end"], got["ALL"]["window_ok"]) == (None, None, True)
    assert (got["MAX_DT"]["window_start"], got["MAX_DT"]["window_end"]) == (start, dt.datetime(2024, 1, 9))
    assert got["DAY_END"]["window_end"] == dt.datetime(2024, 1, 10, 23, 59, 59, 999999)
    assert got["CUR_TS"]["window_end"] == dt.datetime(2024, 1, 10, 12, 0, 0, 123000)
    assert got["PREV_DAY_END"]["window_end"] == dt.datetime(2024, 1, 9, 23, 59, 59, 999999)
    assert (got["MAX_VAL"]["start_value"], got["MAX_VAL"]["end_value"]) == ("v5", "v9")
    assert got["ODD"]["window_ok"] is False


def test_rows_in_window_exclude_the_start_and_include_the_end(spark, rows):
    df = spark.createDataFrame([("s", dt.datetime(2024, 1, d)) for d in (1, 2, 3)], "step string, t timestamp_ntz")
    windows = spark.createDataFrame(
        [("s", "MAX_DT", dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2), True)],
        "step string, increment_type string, window_start timestamp_ntz, window_end timestamp_ntz, window_ok boolean")
    assert rows(ledger.in_window(df, windows, "step", "t"), "t") == [(dt.datetime(2024, 1, 2),)]


# --- metadata ---

META = "table_name string, position int, column_name string, type string, size int, precision int, scale int"


@pytest.mark.parametrize("source, target, issue, detail", [
    (("VARCHAR", 41, 0, 0), ("VARCHAR", 40, 0, 0), "DATA SIZE MISMATCH", "VARCHAR(41)"),
    (("VARCHAR", 40, 0, 0), ("VARCHAR", 41, 0, 0), None, None),
    (("NUMERIC", 16, 16, 2), ("NUMERIC", 15, 15, 2), None, None),
    (("NUMERIC", 16, 16, 2), ("NUMERIC", 14, 14, 2), "DATA SIZE MISMATCH", "NUMERIC(16,2)"),
    (("INTEGER", 10, 0, 0), ("INTEGER", 4, 0, 0), None, None),
    (("BIT", 1, 0, 0), ("INTEGER", 10, 0, 0), None, None),
    (("BIT", 1, 0, 0), ("SMALLINT", 5, 0, 0), None, None),
    (("DATE", 10, 0, 0), ("VARCHAR", 4, 0, 0), None, None),
    (("INTEGER", 10, 0, 0), ("BIGINT", 19, 0, 0), None, None),
    (("BIGINT", 19, 0, 0), ("INTEGER", 10, 0, 0), "DATA TYPE MISMATCH", "BIGINT -> INTEGER"),
    (("VARCHAR", 9, 0, 0), None, "NOT FOUND", "VARCHAR(9)"),
    (("NUMERIC", 16, 16, 2), None, "NOT FOUND", "NUMERIC(16,2)"),
    (("DATE", 10, 0, 0), None, "NOT FOUND", "DATE"),
])
def test_drift(spark, rows, source, target, issue, detail):
    mine = spark.createDataFrame([("t", 1, "c", *source), ("t", 2, "same", "DATE", 10, 0, 0)], META)
    theirs = [("t", 2, "same", "DATE", 10, 0, 0)] + ([("t", 1, "c", *target)] if target else [])
    got = rows(metadata.schema_drift_report(mine, spark.createDataFrame(theirs, META)))
    assert got == ([("t", "c", issue, detail)] if issue else [])


def test_missing_table_is_reported_once(spark, rows):
    mine = spark.createDataFrame([("t", 1, "a", "DATE", 1, 0, 0), ("t", 2, "b", "DATE", 1, 0, 0)], META)
    assert rows(metadata.schema_drift_report(mine, mine.where("false"))) == [("t", None, "TABLE NOT FOUND", "t")]


def test_unlimited_text_fits_in_no_other(spark, rows):
    mine = spark.createDataFrame([("t", 1, "a", "VARCHAR", None, 0, 0), ("t", 2, "b", "VARCHAR", 5, 0, 0)], META)
    theirs = spark.createDataFrame([("t", 1, "a", "VARCHAR", 9, 0, 0), ("t", 2, "b", "VARCHAR", None, 0, 0)], META)
    assert rows(metadata.schema_drift_report(mine, theirs)) == [("t", "a", "DATA SIZE MISMATCH", "VARCHAR(MAX)")]
    assert metadata.schema_drift_report(mine, mine).count() == 0
    assert rows(metadata.ddl_report(mine)) == [("t", "[a] VARCHAR(MAX)\n,[b] VARCHAR(5)")]


def test_ddl(spark, rows):
    df = spark.createDataFrame([(None, 1, None, None, "x" * 36)], "a timestamp_ntz, b int, c date, d decimal(16,2), e string")
    meta = metadata.standardise_types(measured_scan({"t": df}))
    assert rows(metadata.ddl_report(meta)) == [
        ("t", "[a] DATETIME\n,[b] INTEGER\n,[c] DATE\n,[d] NUMERIC(16,2)\n,[e] VARCHAR(36)")]
    assert metadata.ddl_report(meta, ["other"]).count() == 0


# --- extract and reload ---


def test_extract_counts_and_formats(spark, rows):
    source = spark.createDataFrame([(1, dt.datetime(2024, 1, 1, 2, 3, 4, 567000), "x")], "id int, t timestamp_ntz, secret string")
    root = scratch_path(spark, "extract")
    report = extract.control_driven_extract(
        spark, [("a", '"id","t"'), ("b", '"id"')], lambda t: source if t == "a" else source.where("false"), root)
    assert rows(report) == [("a", 1, 1), ("b", 0, 0)]
    assert rows(spark.read.parquet(f"{root}/a")) == [(1, "2024-01-01 02:03:04")]


def test_extract_closes_a_failing_table_and_goes_on(spark, rows):
    control = spark.createDataFrame(
        [("a", '"id"'), ("gone", '"id"'), ("late", '"id"')], "Source_Table_Nm string, Source_Column_Names string")
    events = spark.createDataFrame(
        [("a", 1, dt.datetime(2024, 1, 1), "CPLT"), ("late", 2, dt.datetime(2024, 1, 1), "STRT")],
        "step string, event_id int, event_ts timestamp_ntz, status string")

    def source(name):
        if name == "gone":
            raise ValueError("no such table")
        return spark.range(3)

    started, closed = extract.extract_with_ledger(
        spark, control, events, source, scratch_path(spark, "extract"), ts("2024-02-01"))
    assert rows(started, "step", "status", "window_start") == [("a", "STRT", dt.datetime(2024, 1, 1)), ("gone", "STRT", None)]
    assert rows(closed, "step", "status", "Total_Rows_To_Target", "Process_Error_Desc") == [
        ("a", "CPLT", 3, ""), ("gone", "FAIL", 0, "no such table")]


def test_extract_of_nothing(spark, rows):
    control = spark.createDataFrame([], "Source_Table_Nm string, Source_Column_Names string")
    events = spark.createDataFrame([], "step string, event_id int, event_ts timestamp_ntz, status string")
    started, closed = extract.extract_with_ledger(
        spark, control, events, lambda name: spark.range(1), scratch_path(spark, "extract"), ts("2024-02-01"))
    assert rows(started) == rows(closed) == []


def test_encryption_round_trip(spark):
    df = spark.createDataFrame([(1, 12.5), (2, None)], "id int, rate double")
    key = F.lit(b"0123456789abcdef")
    got = extract.encrypt_column_on_load(df, "rate", "rate_ENCRPTD", key)
    back = got.select("rate", extract.decrypt_column(F.col("rate_ENCRPTD"), key).alias("d")).orderBy("id").collect()
    assert [tuple(r) for r in back] == [(None, "12.5"), (None, None)]


def test_plan_text_does_not_hold_the_key(spark, capsys):
    for secret in (b"0123456789abcdef", b"0123456789abcdef01234567", b"0123456789abcdef0123456789abcdef"):
        df = spark.createDataFrame([(1, 12.5)], "id int, rate double")
        extract.encrypt_column_on_load(df, "rate", "rate_ENCRPTD", F.lit(secret)).explain(True)
        text = capsys.readouterr().out
        assert "aes_encrypt" in text.lower() or "redacted" in text.lower()
        assert secret.hex() not in text.lower()


CSV = "ID,NOTE,START_DT,SEEN_TS,PIN_ENCRPTD,FAX\n1,,2024-01-01,,ab,\n2,  ,,,c,\n3,\"a, b\",2024-01-03,2024-01-04,,\n"


@pytest.fixture
def csv_folder(spark):
    path = scratch_path(spark, "csv").removeprefix("file:")
    os.makedirs(path)
    with open(f"{path}/people.csv", "w") as f:
        f.write(CSV)
    with open(f"{path}/empty.csv", "w") as f:
        f.write(CSV.split("\n")[0] + "\n")
    with open(f"{path}/.DS_Store", "w") as f:
        f.write("junk")
    with open(f"{path}/readme.txt", "w") as f:
        f.write("a,b\n1,2\n")
    return path


def test_reload_into_declared_tables(spark, csv_folder, rows):
    database = "reload_test"
    with open(f"{csv_folder}/pets.csv", "w") as f:
        f.write("Name,ID,weight\nrex,1,2.5\n tom ,2,heavy\nlongername,3,\nbo,x\n,4,1\n")
    spark.sql(f"CREATE DATABASE {database} LOCATION '{scratch_path(spark, 'database')}'")
    try:
        for name, columns in (("people", "ID INT, NOTE STRING, START_DT DATE, FAX STRING, AGE INT"), ("PETS", "WEIGHT DECIMAL(5,2), NAME VARCHAR(6), ID BIGINT")):
            spark.sql(f"CREATE TABLE {database}.{name} ({columns}) USING parquet LOCATION '{scratch_path(spark, name)}'")
        rules = spark.createDataFrame([("PETS", "NAME", 0, 0), ("PETS", "ID", 0, 0)], "TABLE_NAME string, COLUMN_NAME string, NULLABLE int, IDENTITY_COL int")
        for _ in range(2):
            done = reload.csv_reload_folder(spark, csv_folder, database, rules)
            assert sorted(done.tables) == ["PEOPLE", "PETS"]
            # Blank today and absent from the file, FAX and AGE stay.
            assert rows(done.tables["PEOPLE"].withColumn("START_DT", F.col("START_DT").cast("string"))) == [
                (1, None, "2024-01-01", None, None), (2, None, None, None, None), (3, "a, b", "2024-01-03", None, None)]
            assert rows(done.tables["PETS"].withColumn("WEIGHT", F.col("WEIGHT").cast("string"))) == [("1.00", "", 4), ("2.50", "rex", 1)]
            assert rows(done.rejects, "table_name", "reason") == [("PETS", "NAME"), ("PETS", "WEIGHT"), ("PETS", "number of cells")]
            assert rows(done.counts.withColumn("percent_loaded", F.col("percent_loaded").cast("double"))) == [
                ("PEOPLE", 3, 0, 3, 0, 100.0), ("PETS", 5, 3, 2, 3, 40.0)]
    finally:
        spark.sql(f"DROP DATABASE {database} CASCADE")


def test_unreadable_lines_are_returned(spark, rows):
    path = scratch_path(spark, "csv").removeprefix("file:")
    os.makedirs(path)
    with open(f"{path}/a.csv", "w") as f:
        f.write('id,when,note,extra\n1,2024-01-01,"a, b",x\nx,2024-01-02,c,\n2,soon,d,\ny,z,"e ""f""",\n3,2024-01-03\n4,,,,5\n5,,,\n')
    schema = "id int, note string, when date, missing int"
    assert rows(csv_scan(spark, path, schema).select("id", "note", F.col("when").cast("string"), "missing")) == [
        (1, "a, b", "2024-01-01", None), (5, None, None, None)]
    rejects = csv_rejects(spark, path, schema)
    assert rows(rejects, "file_name", "reason") == [
        ("a.csv", "id"), ("a.csv", "id, when"), ("a.csv", "number of cells"), ("a.csv", "number of cells"), ("a.csv", "when")]
    assert 'y,z,"e ""f""",' in [r["record"] for r in rejects.collect()]
    # The same lines are rejected whatever is asked for.
    assert csv_scan(spark, path, schema).select("note").count() == 2 and csv_scan(spark, path, "note string").count() == 5


SCHEMA = "id string, note string, start_dt string, seen_ts string, pin_encrptd string, fax string"


def test_each_table_of_a_folder_has_its_own_columns(spark, csv_folder, rows):
    os.makedirs(f"{csv_folder}/deep/pets.csv")
    for part, line in (("part-0.csv", "rex,1"), ("part-1.csv", "tom,2")):
        with open(f"{csv_folder}/deep/pets.csv/{part}", "w") as f:
            f.write(f"name,id\n{line}\n")
    got = csv_folder_tables(spark, csv_folder, {"people": "id int, note string", "pets": "id int, name string", "none": "x int"})
    assert sorted(got) == ["people", "pets"]
    assert rows(got["pets"]) == [(1, "rex"), (2, "tom")]
    assert [r["id"] for r in got["people"].orderBy("id").collect()] == [1, 2, 3]


def _page(spark, text):
    path = scratch_path(spark, "json").removeprefix("file:")
    os.makedirs(path)
    with open(f"{path}/page.json", "w") as f:
        f.write(text)
    return path


def test_a_broken_message_costs_only_itself(spark, rows):
    path = _page(spark, "\n".join([
        '{"messages": [{"n": 1, "r": [{"c": 1}]}, {"n": "x"}, {"n": 2, "r": null}, "lost", {"n": {"k": 1}, "r": 5}, null]}',
        '{"messages": [{"n": ', '{"messages": [{"n": 3, "r": [{"c": 1}, {"c": "few"}]}, {"n": "4", "m": {"a": "b"}}, {}]}',
        '{"messages": 7}', '{"messages": null}', '[{"messages": [{"n": 5}]}, [1]]', '"text"', "", '{"other": 1}',
    ]) + "\n")
    message = T.StructType.fromDDL("n int, r array<struct<c int>>, m map<string, string>")
    good = json_messages_scan(spark, path, message)
    assert sorted(good.select("n").collect(), key=repr) == sorted([(1,), (2,), (4,), (5,), (None,)], key=repr)
    assert [r["m"] for r in good.where("n = 4").collect()] == [{"a": "b"}]
    rejects = json_rejects(spark, path, message)
    assert rejects.columns == ["file_name", "position", "reason", "record"]
    assert rows(rejects, "position", "reason", "record") == sorted([
        (1, "n", '{"n":"x"}'), (3, "no object", '"lost"'), (4, "n, r", '{"n":{"k":1},"r":5}'), (5, "no object", "null"),
        (None, "no JSON", '{"messages": [{"n": '), (0, "r", '{"n":3,"r":[{"c":1},{"c":"few"}]}'),
        (None, "no list", '{"messages": 7}'), (None, "no object", '[{"messages": [{"n": 5}]}, [1]]'), (None, "no object", '"text"'),
    ], key=repr)


def test_misfits_at_any_depth(spark):
    kind = T.StructType.fromDDL("a struct<b: array<map<string, int>>>, t timestamp, s string")
    cases = {
        '{"a": {"b": [{"x": 1}, {}]}}': None, '{"a": {"b": [{"x": "y"}]}}': "a", '{"a": {"b": [1]}}': "a", '{"a": {"b": {}}}': "a",
        '{"a": []}': "a", '{"a": {"b": null}}': None, '{"t": "2024-01-01 00:00:00"}': None, '{"t": "soon", "s": 1}': "t", '{"s": {"x": 1}}': None,
    }
    path = _page(spark, "\n".join(f'{{"messages": [{c}]}}' for c in cases))
    got = {r["record"]: r["reason"] for r in json_rejects(spark, path, kind).collect()}
    assert sorted(got.values()) == sorted(v for v in cases.values() if v)


def test_json_page_over_several_lines(spark, rows):
    path = scratch_path(spark, "json").removeprefix("file:")
    os.makedirs(path)
    with open(f"{path}/page.json", "w") as f:
        f.write('{\n "messages": [\n  {"n": 1}\n ]\n}\n')
    message = T.StructType.fromDDL("n int")
    assert rows(json_messages_scan(spark, path, message, multi_line=True)) == [(1,)]
    assert rows(json_rejects(spark, path, message, multi_line=True)) == []


def test_reload(spark, csv_folder, rows):
    clean = reload.csv_cleanse(csv_scan(spark, f"{csv_folder}/people.csv", SCHEMA), ["NOTE", "START_DT"], ["ID"])
    assert clean.columns == ["NOTE", "START_DT", "SEEN_TS", "PIN_ENCRPTD"]
    assert rows(clean) == sorted([
        ("", "2024-01-01", None, "0110000101100010"), ("", None, None, "01100011"),
        ("a, b", "2024-01-03", "2024-01-04", None)], key=repr)


def test_reload_without_rules_or_rows(spark, csv_folder):
    assert "ID" in reload.csv_cleanse(csv_scan(spark, f"{csv_folder}/people.csv", SCHEMA)).columns
    empty = reload.csv_cleanse(csv_scan(spark, f"{csv_folder}/empty.csv", SCHEMA), [], ["ID"])
    assert empty.count() == 0 and empty.columns == ["NOTE", "START_DT", "SEEN_TS", "PIN_ENCRPTD", "FAX"]


def test_folder_scan_ignores_other_files(spark, csv_folder, rows):
    got = csv_folder_scan(spark, csv_folder, SCHEMA)
    assert rows(got.groupBy("table_name").count()) == [("people", 3)]


def test_estimates(spark, rows):
    sheet = spark.createDataFrame([("1", "2024-01-02", "9"), (None, "x", "1"), ("2", "soon", "2")],
                                  "`Employee ID` string, `Project Start Date` string, `Other` string")
    assert rows(reload.estimate_rows(sheet), "EMPL_ID", "PROJ_STRT_DT", "Other") == [
        ("1", dt.datetime(2024, 1, 2), "9"), ("2", None, "2")]


# --- streams ---

EVENTS = "k string, v timestamp, x int"


def day(d):
    return dt.datetime(2024, 1, d)


@pytest.fixture
def inbox(spark):
    path = scratch_path(spark, "inbox")

    def put(*rows):
        spark.createDataFrame(list(rows), EVENTS).coalesce(1).write.mode("append").parquet(path)

    return path, put


def schema(spark):
    return spark.createDataFrame([], EVENTS).schema


def test_ingest_takes_every_file_once(spark, inbox, rows):
    path, put = inbox
    target, state = scratch_path(spark, "t"), scratch_path(spark, "s")
    for batch in ([("a", day(1), 1)], [("b", day(2), 2)]):
        put(*batch)
        jobs.stream_file_ingest(jobs.read_folder(spark, path, schema(spark)), target, state).awaitTermination()
    jobs.stream_file_ingest(jobs.read_folder(spark, path, schema(spark)), target, state).awaitTermination()
    assert rows(spark.read.parquet(target), "k") == [("a",), ("b",)]


def test_repeats_within_the_look_back_are_dropped(spark, inbox, rows):
    path, put = inbox
    target, state = scratch_path(spark, "t"), scratch_path(spark, "s")
    for batch in ([("a", day(1), 1), ("b", day(1), 1)], [("a", day(1), 1), ("a", day(2), 1)]):
        put(*batch)
        jobs.stream_dedup_versions(
            jobs.read_folder(spark, path, schema(spark)), ["k", "v"], "v", target, state).awaitTermination()
    assert rows(spark.read.parquet(target), "k", "v") == [("a", day(1)), ("a", day(2)), ("b", day(1))]


def test_rows_older_than_the_look_back_are_kept(spark, inbox, rows):
    path, put = inbox
    target, state = scratch_path(spark, "t"), scratch_path(spark, "s")
    deliveries = (
        [("a", dt.datetime(2024, 3, 1), 1)], [("b", dt.datetime(2024, 3, 2), 1), (None, None, 1), (None, None, 2)],
        [("c", dt.datetime(2024, 1, 1), 1), ("a", dt.datetime(2024, 1, 1), 1), ("b", dt.datetime(2024, 3, 9), 1), (None, None, 1)],
        [("c", dt.datetime(2024, 1, 2), 1)])
    for batch in deliveries:
        put(*batch)
        jobs.stream_dedup_versions(
            jobs.read_folder(spark, path, schema(spark)), ["k"], "v", target, state).awaitTermination()
    got = [tuple(r) for r in spark.read.parquet(target).select("k", F.date_format("v", "MM-dd")).collect()]
    assert sorted(got, key=str) == sorted(
        [("a", "03-01"), ("b", "03-02"), (None, None), ("c", "01-01"), ("a", "01-01")], key=str)


def test_latest_version_over_batches(spark, inbox, rows):
    path, put = inbox
    target, state = scratch_path(spark, "t"), scratch_path(spark, "s")
    newest = [F.col("v").desc()]
    for batch in ([("a", day(3), 1), ("b", day(1), 1)], [("a", day(2), 2), ("b", day(5), 2), ("b", day(4), 9)]):
        put(*batch)
        jobs.stream_upsert_latest(
            jobs.read_folder(spark, path, schema(spark)), ["k"], newest, target, state).awaitTermination()
    expected = [("a", 1), ("b", 2)]
    latest = jobs.read_latest(spark, target, schema(spark))
    assert rows(latest, "k", "x") == expected
    text = latest._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in text and "Exchange" not in text
    # A batch that is run again starts from the versions before it.
    versions = jobs._versions(spark, target)
    assert set(versions.values()) <= {0, 1} and 1 in versions.values()
    compacted = scratch_path(spark, "c")
    jobs.compact(spark, target, schema(spark), compacted)
    assert rows(jobs.read_latest(spark, compacted, schema(spark)), "k", "x") == expected
    put(("a", day(9), 7), ("c", day(1), 3))
    jobs.stream_upsert_latest(
        jobs.read_folder(spark, path, schema(spark)), ["k"], newest, compacted, scratch_path(spark, "s")).awaitTermination()
    assert rows(jobs.read_latest(spark, compacted, schema(spark)), "k", "x") == [("a", 7), ("b", 2), ("c", 3)]
    with pytest.raises(Exception, match="(?i)already.exists"):
        jobs.compact(spark, compacted, schema(spark), target)


def test_a_replay_of_a_batch_changes_nothing(spark, rows):
    target = scratch_path(spark, "t")
    jobs._begin(spark, target, "ignore")
    frames = {}
    for batch, data in enumerate(([("a", 1, 1)], [("a", 2, 2), ("b", 2, 2)], [("b", 3, 3)])):
        df = spark.createDataFrame(data, "k string, v int, x int").withColumn("bucket", jobs._bucket(["k"], 4))
        frames[batch] = df, sorted({r["bucket"] for r in df.collect()})
        jobs._put_versions(*frames[batch], target, batch)
    before = jobs._versions(spark, target)
    jobs._put_versions(*frames[1], target, 1)
    assert jobs._versions(spark, target) == before and jobs._versions(spark, target, 1) == dict.fromkeys(frames[0][1], 0)


def brute_kept(rows, least):
    """Row by row in order of arrival."""
    kept = []
    for k, t in rows:
        if not any(k == a and (t is None and b is None or None not in (t, b) and abs(t - b) <= least) for a, b in kept):
            kept.append((k, t))
    return kept


def _deliver(spark, path, files):
    for i, rows_ in enumerate(files):
        data = [(k, None if t is None else dt.datetime(2024, 1, 1) + dt.timedelta(days=t), 0) for k, t in rows_]
        spark.createDataFrame(data, EVENTS).coalesce(1).write.parquet(f"{path}/f{i:03d}")
        time.sleep(0.01)


@pytest.mark.parametrize("seed", [1])
def test_any_cut_into_batches_keeps_the_same_rows(spark, seed):
    rng = random.Random(seed)
    files = [[(rng.choice(["a", "b", None]), rng.choice([None, *range(0, 200, 7)])) for _ in range(rng.randint(1, 6))] for _ in range(9)]
    files[0] += [("a", 0), ("a", 20), ("a", 40)]
    path = scratch_path(spark, "inbox")
    _deliver(spark, path, files)
    expected = sorted(brute_kept([r for f in files for r in f], 30), key=repr)
    for per_batch in (1, 4, 9):
        target = scratch_path(spark, "t")
        stream = jobs.with_arrival(jobs.read_folder(spark, f"{path}/*", schema(spark), files_per_batch=per_batch))
        jobs.stream_dedup_versions(stream, ["k"], "v", target, scratch_path(spark, "s"), arrival=[jobs.ARRIVAL], buckets=4).awaitTermination()
        got = spark.read.parquet(target).select("k", F.datediff("v", F.lit("2024-01-01").cast("date"))).collect()
        assert sorted(map(tuple, got), key=repr) == expected, per_batch


def test_dropped_rows_hide_nothing(spark, inbox, rows):
    path, put = inbox
    for batches in ([["a0", "a20", "a40"]], [["a0"], ["a20"], ["a40"]]):
        target, state = scratch_path(spark, "t"), scratch_path(spark, "s")
        path = scratch_path(spark, "inbox")
        for batch in batches:
            spark.createDataFrame([("a", dt.datetime(2024, 1, 1) + dt.timedelta(days=int(r[1:])), 1) for r in batch], EVENTS).write.mode("append").parquet(path)
            jobs.stream_dedup_versions(jobs.read_folder(spark, path, schema(spark)), ["k"], "v", target, state).awaitTermination()
        assert rows(spark.read.parquet(target).select(F.dayofyear("v"))) == [(1,), (41,)]
