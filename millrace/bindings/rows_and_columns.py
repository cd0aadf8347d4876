"""Projections, filters, sorts and limits."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.bindings.inputs import (
    PLAN_NAME_DUCK,
    PLAN_NAME_SPARK,
    RAW_SCHEMA,
    RAW_SQL,
    STAGED_SQL,
    raw_messages,
    staged_messages,
)
from millrace.bindings.registry import AS_OF, query, table
from millrace.functions.cleansing import base_name, file_segment, file_stem, substring_project_id
from millrace.functions.text import valid_user_id
from millrace.operators import filters, projections
from millrace.operators.aggregates import distinct_keys
from millrace.plans.messages import SCALARS, SECTIONS, optional_fields
from millrace.session import scratch_path
from millrace.sources.files import json_messages_scan


def as_of():
    return F.lit(AS_OF).cast("timestamp_ntz")


# --- projections -----------------------------------------------------------------


@query("project_reorder", "SELECT c_mktsegment, c_custkey, c_name FROM customer")
def _project_reorder(spark: SparkSession, folder: str) -> DataFrame:
    return projections.project(table(spark, folder, "customer"), ["c_mktsegment", "c_custkey", "c_name"])


@query("rename_map", """
SELECT c_custkey AS EMPL_ID, c_name AS RESRC_NM, c_nationkey, c_acctbal AS CST, c_mktsegment AS TYP FROM customer
""")
def _rename_map(spark: SparkSession, folder: str) -> DataFrame:
    names = {"c_custkey": "EMPL_ID", "c_name": "RESRC_NM", "c_acctbal": "CST", "c_mktsegment": "TYP", "absent": "X"}
    return projections.rename_map(table(spark, folder, "customer"), names)


@query("upper_columns", """
SELECT p_partkey AS P_PARTKEY, p_name AS P_NAME, p_brand AS P_BRAND, p_type AS P_TYPE,
  p_size AS P_SIZE, p_retailprice AS P_RETAILPRICE FROM part
""")
def _upper_columns(spark: SparkSession, folder: str) -> DataFrame:
    return projections.upper_columns(table(spark, folder, "part"))


@query("drop_all_null_columns", "SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier")
def _drop_all_null_columns(spark: SparkSession, folder: str) -> DataFrame:
    supplier = table(spark, folder, "supplier").withColumn("s_fax", F.nullif("s_name", "s_name"))
    return projections.drop_all_null_columns(supplier)


@query("drop_identity_columns", "SELECT s_name, s_nationkey, s_acctbal FROM supplier")
def _drop_identity_columns(spark: SparkSession, folder: str) -> DataFrame:
    return projections.drop_identity_columns(table(spark, folder, "supplier"), ["s_suppkey"])


@query("constant_columns", "SELECT *, 1 AS Task_Active_Ind, 'part.parquet' AS Batch_Run_Id FROM part")
def _constant_columns(spark: SparkSession, folder: str) -> DataFrame:
    part = projections.with_batch_id(table(spark, folder, "part"))
    return projections.constant_columns(part, {"Task_Active_Ind": 1})


@query("add_default_columns", """
SELECT p_partkey, p_name, p_name AS NEW_MSG_TEXT, '' AS TAG_CD, '' AS VALUE_CD, '' AS FRM_EMPL_ID,
  '' AS TO_EMPL_ID FROM part
""")
def _add_default_columns(spark: SparkSession, folder: str) -> DataFrame:
    return projections.add_default_columns(
        table(spark, folder, "part").select("p_partkey", "p_name"),
        {"NEW_MSG_TEXT": "p_name"}, ["TAG_CD", "VALUE_CD", "FRM_EMPL_ID", "TO_EMPL_ID"],
    )


#: Keys of an export beside those of the raw messages: their type, value, and the value's text.  All but a few messages lack some.
_OPTIONAL = {
    "message_id": ("bigint", "event_id", "CAST(event_id AS VARCHAR)", 2), "client_message_id": ("string", "concat('c', event_id)", "concat('c', event_id)", 3),
    "parent_user_id": ("string", "concat('P', event_id % 9)", "concat('P', event_id % 9)", 4), "FLS_SCTN": ("string", "'files'", "'files'", 5),
    "upload": ("boolean", "event_id % 2 = 0", "CASE WHEN event_id % 2 = 0 THEN 'true' ELSE 'false' END", 6),
    "display_as_bot": ("boolean", "false", "'false'", 7), "reply_users_count": ("bigint", "event_id % 5", "CAST(event_id % 5 AS VARCHAR)", 8),
    "latest_reply": ("string", "ts", "ts", 9), "subscribed": ("boolean", "true", "'true'", 10), "bot_id": ("string", "concat('B', event_id)", "concat('B', event_id)", 11),
    "attachments": ("array<struct<id: bigint>>", "array(named_struct('id', event_id))", """concat('[{{"id":', event_id, '}}]')""", 2),
    "reply_users": ("array<string>", "array(ts, 'U2')", """concat('["', ts, '","U2"]')""", 3),
    "replies": ("array<struct<ts: string>>", "array(named_struct('ts', ts))", """concat('[{{"ts":"', ts, '"}}]')""", 4),
    "icons": ("struct<emoji: string>", "named_struct('emoji', ':x:')", """'{{"emoji":":x:"}}'""", 5),
    "root": ("struct<text: string, n: bigint>", "named_struct('text', 'a, b', 'n', event_id)", """concat('{{"text":"a, b","n":', event_id, '}}')""", 6),
}
_WIDE_SCHEMA = ", ".join([RAW_SCHEMA, *[f"{c} {kind}" for c, (kind, *_) in _OPTIONAL.items()]])
_TARGETS = {**SCALARS, **SECTIONS}


@query("optional_fields", f"""
SELECT text, "user", username, ts AS "SRC_TS", thread_ts AS "SRC_THRD_TS", type AS "MSG_TYP", subtype AS "MSG_SBTYP",
  CAST(reply_count AS VARCHAR) AS "RPLY_CNT",
  CASE WHEN n_reactions > 0 THEN concat('[{{"name":"', event_type, '","count":', n_reactions, '}}]') END AS "REACTN_SCTN",
  CASE WHEN n_edit = 0 THEN concat('{{"user":"U1","ts":"', ts, '"}}') END AS "EDITED",
  {', '.join(f'CASE WHEN event_id % {n} = 0 THEN {text.replace("{{", "{").replace("}}", "}")} END AS "{_TARGETS[c]}"' for c, (_, _, text, n) in _OPTIONAL.items())}
FROM ({RAW_SQL.replace('AS user,', 'AS "user",')}) r
""")
def _optional_fields(spark: SparkSession, folder: str) -> DataFrame:
    """All 22 known keys, and the text and sender, of messages that lack some of them."""
    number = F.regexp_extract("ts", r"\.0*([0-9]+)$", 1).cast("long")
    raw = raw_messages(spark, folder).withColumn("event_id", number)
    wide = raw.select(*raw.columns[:-1], *[
        F.when(F.col("event_id") % n == 0, F.expr(value)).cast(kind).alias(c) for c, (kind, value, _, n) in _OPTIONAL.items()])
    path = scratch_path(spark, "messages-json")
    wide.select(F.array(F.struct("*")).alias("messages")).write.json(path)
    return optional_fields(json_messages_scan(spark, path, T.StructType.fromDDL(_WIDE_SCHEMA)))


# --- filters -----------------------------------------------------------------------


@query("filter_batch", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderpriority = '1-URGENT'")
def _filter_batch(spark: SparkSession, folder: str) -> DataFrame:
    return filters.filter_batch(table(spark, folder, "orders"), "o_orderpriority", "1-URGENT").select(
        "o_orderkey", "o_totalprice"
    )


def _events_with_gaps(spark: SparkSession, folder: str) -> DataFrame:
    """Events whose type is NULL for views and '' for errors."""
    kind = F.when(F.col("event_type") == "error", "").otherwise(F.nullif("event_type", F.lit("view")))
    return table(spark, folder, "events").select("event_id", kind.alias("kind"), "value")


@query("filter_not_null", """
SELECT event_id, CASE WHEN event_type = 'error' THEN '' ELSE event_type END AS kind, value
FROM events WHERE event_type <> 'view'
""")
def _filter_not_null(spark: SparkSession, folder: str) -> DataFrame:
    return filters.filter_not_null(_events_with_gaps(spark, folder), "kind")


@query("filter_non_empty", """
SELECT event_id, event_type AS kind, value FROM events WHERE event_type NOT IN ('view', 'error')
""")
def _filter_non_empty(spark: SparkSession, folder: str) -> DataFrame:
    return filters.filter_non_empty(_events_with_gaps(spark, folder), "kind")


@query("drop_any_null", """
SELECT event_id, CASE WHEN event_type = 'error' THEN '' ELSE event_type END AS kind, value
FROM events WHERE event_type <> 'view' AND value <> 1.5
""")
def _drop_any_null(spark: SparkSession, folder: str) -> DataFrame:
    rows = _events_with_gaps(spark, folder).withColumn("value", F.nullif("value", F.lit(1.5)))
    return filters.drop_any_null(rows)


@query("filter_unprocessed", """
SELECT CAST(o_orderkey AS VARCHAR) AS RECIPIENTS, o_orderpriority AS SUBJECT, 'open' AS queue FROM orders
  WHERE o_orderstatus = 'O'
UNION ALL SELECT 'nobody', 'nothing to process', 'empty' WHERE NOT EXISTS
  (SELECT 1 FROM orders WHERE o_orderstatus = 'Z')
""")
def _filter_unprocessed(spark: SparkSession, folder: str) -> DataFrame:
    queue = table(spark, folder, "orders").select(
        F.col("o_orderkey").cast("string").alias("RECIPIENTS"), F.col("o_orderpriority").alias("SUBJECT"),
        "o_orderstatus",
    )
    placeholder = spark.sql("SELECT 'nobody' AS RECIPIENTS, 'nothing to process' AS SUBJECT, 'N' AS o_orderstatus")
    some = filters.filter_unprocessed(queue, "o_orderstatus", placeholder, "O")
    none = filters.filter_unprocessed(queue, "o_orderstatus", placeholder, "Z")
    return some.select("RECIPIENTS", "SUBJECT", F.lit("open").alias("queue")).unionByName(
        none.select("RECIPIENTS", "SUBJECT", F.lit("empty").alias("queue"))
    )


@query("filter_top_level", f"""
SELECT event_id, SRC_TS AS src_ts FROM ({STAGED_SQL}) s WHERE SRC_THRD_TS IS NULL OR SRC_THRD_TS = SRC_TS
""")
def _filter_top_level(spark: SparkSession, folder: str) -> DataFrame:
    return filters.filter_top_level(staged_messages(spark, folder)).select(
        "event_id", F.col("SRC_TS").alias("src_ts")
    )


@query("filter_recent", """
SELECT 'version' AS kind, event_id FROM events WHERE ts >= TIMESTAMP '2024-01-31' - INTERVAL 10 DAY
UNION ALL SELECT 'epoch', event_id FROM events WHERE epoch_us(ts) > epoch_us(TIMESTAMP '2024-01-11')
""")
def _filter_recent(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events")
    by_version = filters.filter_recent(events, "ts", as_of(), 10)
    # A text key in epoch seconds, as message exports carry it.
    span = F.col("ts") - F.lit("1970-01-01").cast("timestamp_ntz")
    seconds = (F.extract(F.lit("DAY"), span) * 86400 + F.extract(F.lit("HOUR"), span) * 3600
               + F.extract(F.lit("MINUTE"), span) * 60 + F.extract(F.lit("SECOND"), span))
    keyed = events.withColumn("key", seconds.cast("decimal(20,6)").cast("string"))
    by_key = filters.filter_recent_epoch(keyed, "key", as_of(), 20)
    return by_version.select(F.lit("version").alias("kind"), "event_id").unionByName(
        by_key.select(F.lit("epoch").alias("kind"), "event_id")
    )


@query("filter_contains", "SELECT p_partkey, p_name FROM part WHERE contains(p_name, 'red')")
def _filter_contains(spark: SparkSession, folder: str) -> DataFrame:
    return filters.filter_contains(table(spark, folder, "part"), "p_name", "red").select("p_partkey", "p_name")


@query("filter_any_value_equals", """
SELECT o_orderkey, o_orderstatus, o_orderpriority FROM orders
WHERE o_orderstatus = 'F' OR o_orderpriority = 'F'
""")
def _filter_any_value_equals(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    return filters.filter_any_value_equals(orders, "F")


def _plan_names(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders").selectExpr("o_orderkey", f"{PLAN_NAME_SPARK} AS file_name")


@query("filter_filename_rule", f"""
SELECT o_orderkey, file_name,
  CASE WHEN regexp_matches(file_name, '^(MS|SG|SS)_PR[^_]{{6}}_[^_]{{2}}_[^_]{{9}}[xX][mM][lL](_.*)?$')
       THEN 'accepted' ELSE 'quarantined' END AS fate
FROM (SELECT o_orderkey, {PLAN_NAME_DUCK} AS file_name FROM orders) n
""")
def _filter_filename_rule(spark: SparkSession, folder: str) -> DataFrame:
    good, bad = filters.split_by_file_name(_plan_names(spark, folder), "file_name")
    return good.withColumn("fate", F.lit("accepted")).unionByName(
        bad.withColumn("fate", F.lit("quarantined"))
    )


@query("filter_valid_user_id", """
WITH ids AS (SELECT event_id, concat(CASE event_type WHEN 'view' THEN 'W' WHEN 'click' THEN 'X' ELSE 'U' END,
    lpad(CAST(user_id AS VARCHAR), 8, '0')) AS user_id FROM events
  UNION ALL SELECT event_id, concat('A', lpad(CAST(user_id AS VARCHAR), 7, '0'), 'U') FROM events)
SELECT 'rule' AS variant, event_id, user_id FROM ids WHERE regexp_matches(user_id, '^[UW][A-Z0-9]{8}$')
UNION ALL SELECT 'legacy', event_id, user_id FROM ids WHERE length(user_id) = 9
  AND (instr(user_id, 'U') > 1 OR instr(user_id, 'W') > 1)
""")
def _filter_valid_user_id(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events")
    first = F.when(F.col("event_type") == "view", "W").when(F.col("event_type") == "click", "X").otherwise("U")
    number = F.col("user_id").cast("string")
    ids = events.select("event_id", F.concat(first, F.lpad(number, 8, "0")).alias("user_id")).unionByName(
        events.select("event_id", F.concat(F.lit("A"), F.lpad(number, 7, "0"), F.lit("U")).alias("user_id"))
    )
    by_rule = ids.where(valid_user_id(F.col("user_id"))).withColumn("variant", F.lit("rule"))
    return by_rule.unionByName(
        ids.where(valid_user_id(F.col("user_id"), legacy=True)).withColumn("variant", F.lit("legacy"))
    )


# --- file names ------------------------------------------------------------------


@query("file_name_parts", f"""
SELECT o_orderkey, file_name AS base, split_part(file_name, '.', 1) AS stem,
  split_part(file_name, '_', 1) AS prefix, split_part(file_name, '_', 3) AS version
FROM (SELECT o_orderkey, {PLAN_NAME_DUCK} AS file_name FROM orders) n
""")
def _file_name_parts(spark: SparkSession, folder: str) -> DataFrame:
    path = F.concat(F.lit("/data/plans/"), F.col("file_name"))
    return _plan_names(spark, folder).select(
        "o_orderkey", base_name(path).alias("base"), file_stem(path).alias("stem"),
        file_segment(path, 1).alias("prefix"), file_segment(path, 3).alias("version"),
    )


@query("substring_project_id", f"""
SELECT o_orderkey, substr(file_name, instr(file_name, '_') + 1, 8) AS project_id
FROM (SELECT o_orderkey, {PLAN_NAME_DUCK} AS file_name FROM orders) n
""")
def _substring_project_id(spark: SparkSession, folder: str) -> DataFrame:
    return _plan_names(spark, folder).select(
        "o_orderkey", substring_project_id(F.col("file_name")).alias("project_id")
    )


# --- sort and limit -----------------------------------------------------------------


@query("sort_unique_ids", "SELECT DISTINCT l_orderkey FROM lineitem ORDER BY l_orderkey")
def _sort_unique_ids(spark: SparkSession, folder: str) -> DataFrame:
    return distinct_keys(table(spark, folder, "lineitem"), "l_orderkey").orderBy("l_orderkey")


@query("top_n_rows", """
SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10
""")
def _top_n_rows(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders").select("o_orderkey", "o_totalprice").orderBy(
        F.desc("o_totalprice"), "o_orderkey"
    ).limit(10)
