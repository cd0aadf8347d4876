"""What reaches the scans, and which shuffles are left."""

from pyspark.sql import functions as F

from __spark_entry__ import queries
from millrace.operators import joins, windows
from millrace.session import scratch_path
from millrace.sinks.tables import bucketed_load, replace_partitions
from millrace.sources.tables import parquet_table

FOLDER = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_columns_are_pruned(spark):
    text = plan(queries()["table_projected_scan"](spark, FOLDER))
    assert "ReadSchema: struct<l_orderkey:bigint,l_linenumber:int,l_quantity:double>" in text
    text = plan(queries()["latest_row_per_key"](spark, FOLDER))
    assert "props" not in text


def test_filters_reach_the_scan(spark):
    for name, pushed in (
        ("filter_batch", "EqualTo(o_orderpriority,1-URGENT)"), ("control_table_scan", "EqualTo(p_brand,Brand#7)"),
        ("filter_contains", "StringContains(p_name,red)"), ("filter_recent", "GreaterThanOrEqual(ts,"),
        ("semi_two_level", "EqualTo(c_mktsegment,BUILDING)"),
    ):
        assert pushed in plan(queries()[name](spark, FOLDER)), name


def test_metadata_reads_no_data(spark):
    for name in ("catalog_scan", "standardise_type", "ddl_report", "exclude_pii_columns", "build_column_list", "schema_drift_report"):
        assert "FileScan" not in plan(queries()[name](spark, FOLDER)), name


def test_batch_filter_prunes_partitions(spark):
    orders = parquet_table(spark, FOLDER, "orders").select("o_orderkey", "o_orderpriority")
    path = scratch_path(spark, "orders")
    one = replace_partitions(orders, path, ["o_orderpriority"]).where("o_orderpriority = '1-URGENT'")
    assert "PartitionFilters: [isnotnull(o_orderpriority" in plan(one)
    assert len(one.inputFiles()) >= 1 and one.count() == orders.where("o_orderpriority = '1-URGENT'").count()


def test_scalar_queries_need_no_shuffle(spark):
    for name in ("iso_duration_seconds", "string_to_bits", "strip_last_tag", "strip_all_values", "zip_recipients",
                 "explode_delimited", "epoch_seconds", "filter_filename_rule"):
        assert "Exchange" not in plan(queries()[name](spark, FOLDER)), name


def test_top_n_is_not_a_full_sort(spark):
    assert "TakeOrderedAndProject" in plan(queries()["top_n_rows"](spark, FOLDER))


def test_bucketed_tables_join_without_shuffle(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        orders = bucketed_load(parquet_table(spark, FOLDER, "orders"), "bucketed_orders",
                               scratch_path(spark, "bucketed"), ["o_orderkey"], 4)
        lines = bucketed_load(parquet_table(spark, FOLDER, "lineitem"), "bucketed_lines",
                              scratch_path(spark, "bucketed"), ["l_orderkey"], 4)
        joined = joins.join_parent_key(lines, orders, {"l_orderkey": "o_orderkey"}, ["o_custkey"])
        assert "Exchange" not in plan(joined) and joined.count() == lines.count()
        latest = windows.latest_row_per_key(lines, ["l_orderkey"], [F.col("l_shipdate").desc()])
        assert "Exchange" not in plan(latest)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10485760")
        spark.sql("DROP TABLE IF EXISTS bucketed_orders")
        spark.sql("DROP TABLE IF EXISTS bucketed_lines")
