"""Work on large inputs is dealt out over tasks, and done once a row."""

from pyspark.sql import functions as F

from __spark_entry__ import queries
from millrace.bindings import scans_and_sinks
from millrace.bindings.inputs import raw_messages
from millrace.bindings.scans_and_sinks import write_plans, write_raw_messages
from millrace.plans.project_plan import BATCH, plan_stage_to_integrated
from millrace.session import scratch_path, settle, spread
from millrace.sources.json_pages import json_items, split_items

FOLDER = "/root/testdata/sf0.001"


def parts(df):
    return df.select(F.spark_partition_id()).distinct().count()


def one_file(spark, name, df):
    """A folder whose table is one file with one row group."""
    root = scratch_path(spark, "one-file")
    df.coalesce(1).write.parquet(f"{root}/{name}.parquet")
    return root


def test_rows_are_spread_once(spark, rows):
    few = spark.range(1000).coalesce(1)
    assert parts(spread(few)) > 8 and rows(spread(few)) == rows(few)
    many = spark.range(0, 1000, 1, 100)
    assert spread(many) is many


def test_messages_of_one_file_are_written_by_many_tasks(spark):
    folder = one_file(spark, "events", spark.range(1, 2001).selectExpr(
        "id AS event_id", "TIMESTAMP_NTZ '2024-01-01 00:00:00' AS ts", "id % 7 AS user_id", "'view' AS event_type", "1.0D AS value", "'{}' AS props"))
    assert parts(raw_messages(spark, folder)) > 8
    written = spark.read.text(write_raw_messages(spark, folder))
    assert written.count() == 2000 and len(written.inputFiles()) > 8


def test_records_are_judged_once(spark, rows):
    path = scratch_path(spark, "pages")
    spark.createDataFrame([('{"m":[{"a":1,"b":["x"]},{"a":"y"}]}',), ("{",)], "value string").write.text(path)
    good, rejects = split_items(json_items(spark, path, "m", spark.createDataFrame([], "a bigint, b array<string>").schema))
    assert rows(good) == [(1, ["x"])] and rows(rejects, "position", "reason") == [(1, "a"), (None, "no JSON")]
    plan = good._jdf.queryExecution().optimizedPlan().toString()
    filters = [line for line in plan.splitlines() if "Filter" in line and "reason" in line]
    assert len(filters) == 1 and "variant" not in filters[0]


def orders_of_one_file(spark, first, n):
    return one_file(spark, "orders", spark.range(first, first + n).selectExpr(
        "id AS o_orderkey", "id % 7 AS o_custkey", "'F' AS o_orderstatus", "1.0D AS o_totalprice",
        "TIMESTAMP_NTZ '2024-01-02 00:00:00' AS o_orderdate", "if(id % 5 = 0, '5-LOW', '1-URGENT') AS o_orderpriority"))


def test_documents_of_one_file_are_written_by_many_tasks(spark):
    written = spark.read.text(write_plans(spark, orders_of_one_file(spark, 1, 1000)))
    assert written.count() == 1000 and len(written.inputFiles()) > 8


def test_documents_are_compressed_in_files_of_bounded_size(spark, monkeypatch):
    folder = orders_of_one_file(spark, 1, 2000)
    whole = write_plans(spark, folder)
    stored = spark.read.format("binaryFile").load(whole).agg(F.sum("length")).first()[0]
    assert 5 * stored < spark.read.text(whole).agg(F.sum(F.octet_length("value"))).first()[0]
    monkeypatch.setattr(scans_and_sinks, "PLAN_FILE_ROWS", 10)
    written = spark.read.text(write_plans(spark, folder)).groupBy("_metadata.file_name").count().collect()
    assert sum(r["count"] for r in written) == 2000 and max(r["count"] for r in written) == 10


def test_rows_of_documents_travel_without_the_batch(spark):
    path = write_plans(spark, orders_of_one_file(spark, 1, 60))
    staging = plan_stage_to_integrated(spark, path, batch=F.col("Name"), multi_line=False).staging
    for name in ("task", "weekday", "exception_times"):
        plan = staging[name]._jdf.queryExecution().optimizedPlan().toString().splitlines()
        joins = [i for i, line in enumerate(plan) if "Join Inner" in line]
        assert len(joins) == 1 and ":- Project" in plan[joins[0] + 1] and BATCH not in plan[joins[0] + 1]
    keyed = {r["Unique_Key"]: r[BATCH] for r in staging["header"].collect()}
    assert len(set(keyed.values())) == 48 and all(keyed[r["Ms_Project_Header_Id"]] == r[BATCH] for r in staging["weekday"].collect())
    files = settle(spark.range(3), "packed", "zstd").inputFiles()
    assert files and all(f.endswith(".zstd.parquet") for f in files)


def test_large_order_numbers_keep_their_damage(spark):
    first = (1 << 24) + 5
    found = queries()["xml_hierarchy_scan"](spark, orders_of_one_file(spark, first, 500)).groupBy("reason").count().collect()
    keys = range(first, first + 500)
    no_xml = [k for k in keys if k % 89 == 7]
    invalid = [k for k in keys if k % 97 == 11 and k % 89 != 7]
    assert {r["reason"]: r["count"] for r in found} == {
        None: 500 - len(no_xml) - len(invalid), "no XML": len(no_xml), "violates the schema": len(invalid)}
