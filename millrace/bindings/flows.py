"""Multi-step jobs and streams."""

from __future__ import annotations

import secrets
import uuid
from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.bindings.inputs import (
    CODES,
    DOCS_SQL,
    EMPLOYEES_SQL,
    LOADED_SQL,
    PLAN_NAME_DUCK,
    STAGED_SQL,
    employees,
    loaded_messages,
    staged_messages,
)
from millrace.bindings.registry import AS_OF, EXACT, query, table, tables
from millrace.bindings.scans_and_sinks import PLAN_DAMAGE, write_plans, write_xsd
from millrace.fixed_values import COMPARED_MESSAGE_COLUMNS, ESTIMATE_COLUMNS
from millrace.functions.dates import format_seconds
from millrace.operators.state import retention_delete
from millrace.plans import extract, ledger, messages, outbound, reload
from millrace.plans.project_plan import BATCH, plan_stage_to_integrated
from millrace.session import scratch_path, settle
from millrace.sinks.tables import truncate_load
from millrace.sources.files import csv_scan
from millrace.sources.tables import control_table_scan
from millrace.streaming import jobs


def ts(text: str):
    return F.lit(text).cast("timestamp_ntz")


#: How a NULL looks in a payload, so that its place can be checked.
NOTHING = "~"


def _long(frames: Mapping[str, tuple[DataFrame, str, str, list]]) -> DataFrame:
    """Tables of different shape as ``entity, row_key, parent_key, payload``."""
    parts = [
        df.select(
            F.lit(name).alias("entity"), F.col(key).cast("bigint").alias("row_key"),
            F.expr(parent).cast("bigint").alias("parent_key"),
            F.concat_ws("|", *[
                F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit(NOTHING)) for c in payload
            ]).alias("payload"),
        )
        for name, (df, key, parent, payload) in frames.items()
    ]
    return reduce(DataFrame.unionByName, parts)


# --- project plans -----------------------------------------------------------------------

_PLAN_TASK_CHILDREN_SQL = """
SELECT '{p}task_time_phased' AS entity, h * 4294967296 + (i + 1) // 2 AS row_key, h * 4294967296 + i AS parent_key,
  concat_ws('|', '1', i, d, '2', concat('PT', i, 'H0M0S')) AS payload FROM per_task WHERE i % 2 = 1
UNION ALL SELECT '{p}assignment_time_phased', h * 4294967296 + i, h * 4294967296 + i,
  concat_ws('|', '1', i, d, '2', i * 3600 + 1800) FROM per_task
UNION ALL SELECT '{p}link', h * 4294967296 + i - 1, h * 4294967296 + i, concat_ws('|', i - 1, '1', '0', '0', '7')
  FROM per_task WHERE i > 1
UNION ALL SELECT '{p}resource', h * 4294967296 + 1, h, concat_ws('|', cust, concat('Customer ', cust), 29280, 18005)
  FROM docs
UNION ALL SELECT '{p}calendar', h * 4294967296 + 1, h, '1|Standard' FROM docs
UNION ALL SELECT '{p}assignment', h * 4294967296 + i, h, concat_ws('|', i, i, cust, 29280) FROM per_task
"""
_TP = ["Task_Type", "Task_Uid", "Time_Phased_Start_Dt", "Time_Phased_Unit", "Time_Phased_Value"]
_LINK = ["Predecessor_Uid", "Predecessor_Type", "Cross_Project", "Link_Lag", "Lag_Format"]


@query("xml_entity_flatten", f"""
WITH {DOCS_SQL}
{_PLAN_TASK_CHILDREN_SQL.format(p='')}
UNION ALL SELECT 'header', h, 0, concat_ws('|', b, d, CASE WHEN k % 2 = 1 THEN d ELSE '0' END) FROM docs
UNION ALL SELECT 'task', h * 4294967296 + i, h, concat_ws('|', i, concat('task ', i), d,
  i * 28800 + (k % 60) * 60, i * 3600) FROM per_task
UNION ALL SELECT 'weekday', h * 4294967296 + t.day, h * 4294967296 + 1, concat_ws('|', t.day, t.day - 1)
  FROM docs, (VALUES (1), (2)) t(day)
UNION ALL SELECT 'weekday_times', h * 4294967296 + j, h * 4294967296 + 1, concat_ws('|', '2',
  concat(lpad(CAST(6 + 2 * j AS VARCHAR), 2, '0'), ':00:00'), concat(lpad(CAST(7 + 2 * j AS VARCHAR), 2, '0'), ':30:00'))
  FROM per_time
UNION ALL SELECT 'exception', h * 4294967296 + 1, h * 4294967296 + 1,
  concat_ws('|', '1', '1', '0', CASE WHEN k % 2 = 1 THEN d ELSE '~' END) FROM docs
UNION ALL SELECT 'exception_times', h * 4294967296 + 1, h * 4294967296 + 1, '1|08:00:00|12:00:00'
  FROM docs WHERE k % 5 = 0
""")
def _xml_entity_flatten(spark: SparkSession, folder: str) -> DataFrame:
    staging = plan_stage_to_integrated(spark, write_plans(spark, folder), batch=F.col("Name"), multi_line=False).staging
    header = "Ms_Project_Header_Id"
    key = "Unique_Key"
    times = ["From_Working_Time", "To_Working_Time"]
    shape = {
        "header": ("0", [BATCH, "Project_Start_Dt", "New_Task_Start_Dt"]),
        "resource": (header, ["Resource_Uid", "Resource_Nm", "Work", "Regular_Work"]),
        "task": (header, ["Project_Task_Uid", "Task_Nm", "Task_Start_Dt", "Task_Duration", "Task_Work"]),
        "assignment": (header, ["Assignment_Uid", "Project_Task_Uid", "Resource_Uid", "Work"]),
        "calendar": (header, ["Calendar_Uid", "Calendar_Nm"]),
        "assignment_time_phased": ("Ms_Project_Assignment_Id", _TP),
        "task_time_phased": ("Ms_Project_Task_Id", _TP),
        "weekday": ("Ms_Project_Calendar_Id", ["Day_Type_Num", "Working_Day_Ind"]),
        "weekday_times": ("Ms_Project_Calendar_Id", ["Day_Type_Num", *times]),
        "exception": ("Ms_Project_Calendar_Id",
                      ["Exception_Type", "Day_Working", "Entered_By_Occurrences", "Exception_From_Dt"]),
        "exception_times": ("Ms_Project_Calendar_Id", ["Day_Working", *times]),
        "link": ("Ms_Project_Task_Id", _LINK),
    }
    return _long({n: (staging[n], key, parent, payload) for n, (parent, payload) in shape.items()})


@query("plan_stage_to_integrated", f"""
WITH {DOCS_SQL.replace('WHERE regexp_matches', 'WHERE (' + PLAN_DAMAGE.replace('o_orderkey', 'k') + ') IS NULL AND regexp_matches')}
{_PLAN_TASK_CHILDREN_SQL.format(p='plan_')}
UNION ALL SELECT 'plan_header', h, 0, concat_ws('|', substr(b, 4, 8), b, dt, CASE WHEN k % 2 = 1 THEN dt ELSE '~' END) FROM docs
UNION ALL SELECT 'plan_task', h * 4294967296 + i, h, concat_ws('|', i, concat('task ', i), dt,
  i * 28800 + (k % 60) * 60, i * 3600, 1) FROM per_task
UNION ALL SELECT 'plan_calendar_weekday', h * 4294967296 + 1, h * 4294967296 + 1, '1|0|~|~|~|~|0' FROM docs
UNION ALL SELECT 'plan_calendar_weekday', h * 4294967296 + 2, h * 4294967296 + 1, concat_ws('|', '2', '1',
  CASE WHEN n_times > 1 THEN concat(lpad(CAST(4 + 2 * n_times AS VARCHAR), 2, '0'), ':00:00') ELSE '~' END,
  CASE WHEN n_times > 1 THEN concat(lpad(CAST(5 + 2 * n_times AS VARCHAR), 2, '0'), ':30:00') ELSE '~' END,
  CASE WHEN n_times > 0 THEN concat(lpad(CAST(6 + 2 * n_times AS VARCHAR), 2, '0'), ':00:00') ELSE '~' END,
  CASE WHEN n_times > 0 THEN concat(lpad(CAST(7 + 2 * n_times AS VARCHAR), 2, '0'), ':30:00') ELSE '~' END, n_times) FROM docs
UNION ALL SELECT 'plan_calendar_exception', h * 4294967296 + 1, h * 4294967296 + 1, concat_ws('|', '1', '1', '0', '~', '~',
  CASE WHEN k % 5 = 0 THEN '08:00:00' ELSE '~' END, CASE WHEN k % 5 = 0 THEN '12:00:00' ELSE '~' END,
  CASE WHEN k % 2 = 1 THEN d ELSE '~' END, CASE WHEN k % 5 = 0 THEN 1 ELSE 0 END) FROM docs
UNION ALL SELECT 'reject', 0, 0, concat_ws('|', coalesce(why, 'file name'), b) FROM (
  SELECT {PLAN_DAMAGE} AS why, {PLAN_NAME_DUCK} AS b FROM orders) x
  WHERE why IS NOT NULL OR NOT regexp_matches(b, '^(MS|SG|SS)_')
""")
def _plan_stage_to_integrated(spark: SparkSession, folder: str) -> DataFrame:
    flow = plan_stage_to_integrated(spark, write_plans(spark, folder, PLAN_DAMAGE), batch=F.col("Name"), xsd=write_xsd(spark), multi_line=False)
    plan = flow.integrated
    header, key = "Project_Plan_Header_Id", "Staging_Unique_Key"
    pairs = ["From_Working_Time", "To_Working_Time", "From_Working_Time_2", "To_Working_Time_2"]
    shape = {
        "plan_header": ("0", ["Project_Id", "Source_File_Nm", format_seconds(F.col("Project_Start_Dt")),
                              format_seconds(F.col("New_Task_Start_Dt"))]),
        "plan_resource": (header, ["Resource_Uid", "Resource_Nm", "Work", "Regular_Work"]),
        "plan_task": (header, ["Project_Task_Uid", "Task_Nm", format_seconds(F.col("Task_Start_Dt")),
                               "Task_Duration", "Task_Work", "Task_Active_Ind"]),
        "plan_assignment": (header, ["Assignment_Uid", "Project_Task_Uid", "Resource_Uid", "Work"]),
        "plan_calendar": (header, ["Calendar_Uid", "Calendar_Nm"]),
        "plan_assignment_time_phased": ("Project_Plan_Assignment_Id", _TP),
        "plan_task_time_phased": ("Project_Plan_Task_Id", _TP),
        "plan_link": ("Project_Plan_Task_Id", _LINK),
        "plan_calendar_weekday": ("Project_Plan_Calendar_Id",
                                  ["Day_Type_Num", "Working_Day_Ind", *pairs, "n_ranges"]),
        "plan_calendar_exception": ("Project_Plan_Calendar_Id", [
            "Exception_Type", "Day_Working", "Entered_By_Occurrences", *pairs, "Exception_From_Dt", "n_ranges"]),
    }
    rejects = flow.rejects.select(F.lit(0).alias("k"), "reason", F.coalesce(
        BATCH, F.regexp_extract("record", "<Name>([^<]+)</Name>", 1)).alias("batch"))
    return _long({n: (plan[n], key, parent, payload) for n, (parent, payload) in shape.items()}
                 | {"reject": (rejects, "k", "0", ["reason", "batch"])})


# --- recognition messages ----------------------------------------------------------------------

#: The compared fields that staged messages of the tables lack, by their SQL.
_MORE_FIELDS = {
    "RPLY_CNT": "CAST(event_id % 9 AS VARCHAR)", "RPLY_USRS_CNT": "CASE WHEN event_id % 2 = 0 THEN CAST(event_id % 3 AS VARCHAR) END",
    "LTST_RPLY_TS": "CASE WHEN event_id % 4 = 1 THEN SRC_TS END", "RPLY_USRS_SCTN": "concat('[', event_id % 6, ']')",
    "RPLIES_SCTN": "CASE WHEN event_id % 3 = 2 THEN '[]' END", "REACTN_SCTN": "CASE WHEN event_id % 5 > 0 THEN concat('[', event_id, ']') END",
    "TO_USRNM": "concat('name', event_id % 7)", "ICNS": "CASE WHEN event_id % 6 = 0 THEN '{}' END",
}
_WIDE_SQL = f"SELECT s.*, {', '.join(f'{e} AS {c}' for c, e in _MORE_FIELDS.items())} FROM ({STAGED_SQL}) s"
#: One field of a stored message is another than staged: gone, or with an x more; two in fifteen have none such.
_STORED_FIELDS = {
    c: f"CASE WHEN event_id % 15 <> {i} THEN {c} WHEN event_id % 2 = 0 THEN NULL ELSE concat(coalesce({c}, ''), 'x') END"
    for i, c in enumerate(COMPARED_MESSAGE_COLUMNS)
}


@query("detect_changed_versions", f"""
WITH incoming AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY SRC_TS ORDER BY INTRNL_TS DESC) AS rn
  FROM ({_WIDE_SQL}) w) v WHERE rn = 1),
stored AS (SELECT * REPLACE ({', '.join(f'{e} AS {c}' for c, e in _STORED_FIELDS.items())}) FROM incoming WHERE event_id % 11 > 0)
SELECT i.event_id, i.SRC_TS AS src_ts, {', '.join(f"coalesce(i.{c}, '~') AS {c.lower()}" for c in COMPARED_MESSAGE_COLUMNS if c != 'SRC_TS')}
FROM incoming i LEFT JOIN stored s ON s.SRC_TS = i.SRC_TS
WHERE s.SRC_TS IS NULL OR {' OR '.join(f'i.{c} IS DISTINCT FROM s.{c}' for c in COMPARED_MESSAGE_COLUMNS)}
""")
def _detect_changed_versions(spark: SparkSession, folder: str) -> DataFrame:
    """Of the latest versions, those of which any of the thirteen fields is another than stored, and new ones."""
    staged = staged_messages(spark, folder).withColumns({c: F.expr(e.replace("VARCHAR", "STRING")) for c, e in _MORE_FIELDS.items()})
    incoming = settle(messages.latest_versions(staged), "incoming")
    stored = incoming.where("event_id % 11 > 0").select("SRC_TS", "INTRNL_TS", *[F.expr(e).alias(c) for c, e in _STORED_FIELDS.items()])
    return messages.detect_changed_versions(incoming, stored).select(
        "event_id", F.col("SRC_TS").alias("src_ts"),
        *[F.coalesce(c, F.lit(NOTHING)).alias(c.lower()) for c in COMPARED_MESSAGE_COLUMNS],
    )


def _folded_sql(source: str) -> str:
    """Tags and values of ``source`` cut out step by step, ending in ``folded``."""
    cut = "CASE WHEN contains(t, '{c}') THEN {f}(replace(t, '{c}', '')) ELSE t END AS t"
    tag = "CASE WHEN contains(t, '{c}') THEN {i} ELSE tag END AS tag"
    parts = [f"g0 AS (SELECT *, MSG_TXT AS t, 0 AS tag, false AS v1, false AS v2 FROM {source})"]
    for n, (i, c) in enumerate(CODES.tags):
        parts.append(f"g{n + 1} AS (SELECT * REPLACE ({cut.format(c=c, f='ltrim')}, {tag.format(c=c, i=i)}) FROM g{n})")
    first, second = (c for _, c in CODES.values)
    parts.append(f"g4 AS (SELECT * REPLACE ({cut.format(c=first, f='rtrim')}, contains(t, '{first}') AS v1) FROM g3)")
    parts.append(f"folded AS (SELECT * REPLACE ({cut.format(c=second, f='rtrim')}, contains(t, '{second}') AS v2) FROM g4)")
    return ", ".join(parts)


_RECIPIENTS_SQL = """
SELECT msg_id, split_part(TO_USR_SRC_ID, '|', u.p) AS to_id, EMPL_ID
FROM {source}, (VALUES (1), (2)) u(p), employees
WHERE split_part(TO_USR_EMAIL, '|', u.p) = CO_EMAIL
  AND regexp_matches(split_part(TO_USR_SRC_ID, '|', u.p), '^[UW][A-Z0-9]{{8}}$')
"""


@query("load_new_messages", f"""
WITH staged AS ({STAGED_SQL}), employees AS ({EMPLOYEES_SQL}), loaded AS ({LOADED_SQL}),
latest AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY SRC_TS ORDER BY INTRNL_TS DESC) AS rn
  FROM staged WHERE INTRNL_TS >= TIMESTAMP '{AS_OF}' - INTERVAL 30 DAY) v WHERE rn = 1),
fresh AS (SELECT * FROM latest WHERE (SRC_THRD_TS IS NULL OR SRC_THRD_TS = SRC_TS)
  AND SRC_TS NOT IN (SELECT SRC_TS FROM loaded)), {_folded_sql('fresh')},
keyed AS (SELECT *, row_number() OVER (ORDER BY SRC_TS) + (SELECT max(RCGNTN_MSG_ID) FROM loaded) AS msg_id
  FROM folded WHERE tag > 0 AND TO_USR_EMAIL <> ''),
recipients AS ({_RECIPIENTS_SQL.format(source='keyed')}),
reached AS (SELECT * FROM keyed WHERE msg_id IN (SELECT msg_id FROM recipients))
SELECT 'messages' AS entity, msg_id AS row_key, CAST(tag AS BIGINT) AS parent_key,
  concat_ws('|', SRC_TS, strftime(INTRNL_TS, '%Y-%m-%d %H:%M:%S'), t, FRM_USR_SRC_ID, coalesce(e.EMPL_ID, '~')) AS payload
  FROM reached LEFT JOIN employees e ON e.CO_EMAIL = FRM_USR_EMAIL
UNION ALL SELECT 'recipients', msg_id, 0, concat_ws('|', to_id, EMPL_ID) FROM recipients
UNION ALL SELECT 'values', msg_id, 1, '' FROM reached WHERE v1
UNION ALL SELECT 'values', msg_id, 2, '' FROM reached WHERE v2
""")
def load_new_messages(spark: SparkSession, folder: str) -> DataFrame:
    staged = staged_messages(spark, folder)
    loaded = settle(loaded_messages(staged), "loaded")
    new = messages.load_new_messages(staged, loaded, employees(spark, folder), CODES, ts(AS_OF), 30)
    return _message_tables(new)


def _message_tables(state: Mapping[str, DataFrame]) -> DataFrame:
    key = "RCGNTN_MSG_ID"
    return _long({
        "messages": (state["messages"], key, "coalesce(RCGNTN_TAG_ID, -1)", [
            "SRC_TS", format_seconds(F.col("INTRNL_TS")), "RCGNTN_MSG_TXT", "FRM_USR_ID", "FRM_EMPL_ID"]),
        "recipients": (state["recipients"], key, "0", ["TO_USR_ID", "TO_EMPL_ID"]),
        "values": (state["values"], key, "RCGNTN_VALUE_ID", []),
    })


@query("apply_modified_messages", f"""
WITH staged AS ({STAGED_SQL}), employees AS ({EMPLOYEES_SQL}), loaded AS ({LOADED_SQL}),
old_to AS (SELECT RCGNTN_MSG_ID, FRM_USR_ID AS to_id, 'E0' AS EMPL_ID FROM loaded),
old_val AS (SELECT RCGNTN_MSG_ID, 9 AS v FROM loaded),
latest AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY SRC_TS ORDER BY INTRNL_TS DESC) AS rn
  FROM staged WHERE INTRNL_TS >= TIMESTAMP '{AS_OF}' - INTERVAL 30 DAY) v WHERE rn = 1),
newer AS (SELECT latest.*, l.RCGNTN_MSG_ID AS msg_id FROM latest JOIN loaded l ON l.SRC_TS = latest.SRC_TS
  AND latest.INTRNL_TS > l.INTRNL_TS AND latest.FRM_USR_SRC_ID = l.FRM_USR_ID
  WHERE (SRC_THRD_TS IS NULL OR SRC_THRD_TS = latest.SRC_TS) AND EDITED IS NOT NULL), {_folded_sql('newer')},
recipients AS ({_RECIPIENTS_SQL.format(source='folded')})
SELECT 'messages' AS entity, l.RCGNTN_MSG_ID AS row_key,
  CAST(CASE WHEN f.msg_id IS NULL THEN l.RCGNTN_TAG_ID WHEN f.tag = 0 THEN -1 ELSE f.tag END AS BIGINT) AS parent_key,
  concat_ws('|', l.SRC_TS, strftime(coalesce(f.INTRNL_TS, l.INTRNL_TS), '%Y-%m-%d %H:%M:%S'),
            CASE WHEN f.msg_id IS NULL THEN l.RCGNTN_MSG_TXT ELSE f.t END, l.FRM_USR_ID, '~') AS payload
  FROM loaded l LEFT JOIN folded f ON f.msg_id = l.RCGNTN_MSG_ID
UNION ALL SELECT 'recipients', RCGNTN_MSG_ID, 0, concat_ws('|', to_id, EMPL_ID) FROM old_to
  WHERE RCGNTN_MSG_ID NOT IN (SELECT msg_id FROM folded)
UNION ALL SELECT 'recipients', msg_id, 0, concat_ws('|', to_id, EMPL_ID) FROM recipients
UNION ALL SELECT 'values', RCGNTN_MSG_ID, v, '' FROM old_val WHERE RCGNTN_MSG_ID NOT IN (SELECT msg_id FROM folded)
UNION ALL SELECT 'values', msg_id, 1, '' FROM folded WHERE v1
UNION ALL SELECT 'values', msg_id, 2, '' FROM folded WHERE v2
""")
def _apply_modified_messages(spark: SparkSession, folder: str) -> DataFrame:
    staged = staged_messages(spark, folder)
    loaded = settle(loaded_messages(staged), "loaded")
    before = {
        "messages": loaded,
        "recipients": loaded.select("RCGNTN_MSG_ID", F.col("FRM_USR_ID").alias("TO_USR_ID"),
                                    F.lit("E0").alias("TO_EMPL_ID")),
        "values": loaded.select("RCGNTN_MSG_ID", F.lit(9).alias("RCGNTN_VALUE_ID")),
    }
    return _message_tables(messages.apply_modified_messages(
        staged, before, employees(spark, folder), CODES, ts(AS_OF), 30
    ))


# --- outbound -------------------------------------------------------------------------------


def _outbound_inputs(spark: SparkSession, folder: str):
    """Orders as messages, their suppliers' nations as recipients, line flags as values."""
    orders, customer, lineitem, supplier, nation = tables(
        spark, folder, "orders", "customer", "lineitem", "supplier", "nation"
    )
    key = F.col("l_orderkey").alias("RCGNTN_MSG_ID")
    queue = orders.join(customer, orders["o_custkey"] == customer["c_custkey"]).select(
        F.col("o_orderkey").alias("RCGNTN_MSG_ID"),
        F.concat(F.lit("n"), "c_nationkey").alias("RCGNTN_FRM_USR_EMAIL"),
        F.concat(F.lit("order "), "o_orderkey").alias("RCGNTN_MSG_TXT"),
        F.concat(F.lit(":"), F.lower(F.expr("substr(o_orderpriority, 3)")), F.lit(":")).alias("RCGNTN_TAG_DESC"),
        F.when(F.col("o_orderstatus") == "O", "N").otherwise("Y").alias("PRCSSD_IND"),
        F.col("o_orderdate").alias("RCGNTN_TS"),
    )
    recipients = lineitem.join(supplier, lineitem["l_suppkey"] == supplier["s_suppkey"]).select(
        key, F.concat(F.lit("n"), "s_nationkey").alias("RCGNTN_TO_USR_EMAIL")
    )
    values = lineitem.where("l_returnflag <> 'N'").select(
        key, F.concat(F.lit(":"), "l_returnflag", F.lit(":")).alias("RCGNTN_VALUES_DESC")
    )
    people = nation.select(F.concat(F.lit("n"), "n_nationkey").alias("email"), F.col("n_name").alias("name"))
    return queue, recipients, values, people


@query("outbound_queue", """
WITH q AS (SELECT o_orderkey, concat(':', lower(substr(o_orderpriority, 3)), ':') AS tag, n_name AS sender
    FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON n_nationkey = c_nationkey WHERE o_orderstatus = 'O'),
rcp AS (SELECT l_orderkey, string_agg(DISTINCT concat('@', n_name), ' ' ORDER BY concat('@', n_name)) AS names
    FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON n_nationkey = s_nationkey GROUP BY l_orderkey),
val AS (SELECT l_orderkey, string_agg(DISTINCT concat(':', l_returnflag, ':'), ' ' ORDER BY concat(':', l_returnflag, ':')) AS vals
    FROM lineitem WHERE l_returnflag <> 'N' GROUP BY l_orderkey),
ready AS (SELECT q.*, names, vals FROM q JOIN rcp ON rcp.l_orderkey = o_orderkey LEFT JOIN val ON val.l_orderkey = o_orderkey)
SELECT 'composed' AS entity, o_orderkey AS row_key, CAST(0 AS BIGINT) AS parent_key,
  concat_ws('|', sender, concat(names, ' ', tag, ' order ', o_orderkey, ' ', coalesce(vals, ' '))) AS payload FROM ready
UNION ALL SELECT DISTINCT 'reactions', o_orderkey, 0, replace(r, ':', '') FROM (
  SELECT o_orderkey, tag AS r FROM ready
  UNION ALL SELECT o_orderkey, concat(':', l_returnflag, ':') FROM ready JOIN lineitem ON l_orderkey = o_orderkey
  WHERE l_returnflag <> 'N') x
UNION ALL SELECT 'queue', o_orderkey, 0, CASE WHEN o_orderstatus = 'O' AND o_orderkey NOT IN
  (SELECT o_orderkey FROM ready) THEN 'N' ELSE 'Y' END FROM orders
""")
def _outbound_queue(spark: SparkSession, folder: str) -> DataFrame:
    box = outbound.outbound_queue(*_outbound_inputs(spark, folder))
    key = "RCGNTN_MSG_ID"
    return _long({
        "composed": (box.composed, key, "0", ["from_name", "message"]),
        "reactions": (box.reactions, key, "0", ["reaction"]),
        "queue": (box.queue, key, "0", ["PRCSSD_IND"]),
    })


@query("retention_delete", """
WITH main AS (SELECT o_orderkey FROM orders
  WHERE NOT (o_orderdate < TIMESTAMP '1999-01-01' - INTERVAL 1 DAY AND o_orderstatus <> 'O'))
SELECT 'queue' AS table_name, o_orderkey AS row_key, CAST(0 AS BIGINT) AS sub_key FROM main
UNION ALL SELECT 'lines', l_orderkey, l_partkey FROM lineitem
  WHERE l_shipdate >= TIMESTAMP '1999-01-01' - INTERVAL 1 DAY OR l_orderkey IN (SELECT o_orderkey FROM main)
""")
def _retention_delete(spark: SparkSession, folder: str) -> DataFrame:
    orders, lineitem = tables(spark, folder, "orders", "lineitem")
    done = F.when(F.col("o_orderstatus") == "O", "N").otherwise("Y")
    main = orders.select("o_orderkey", done.alias("PRCSSD_IND"), F.col("o_orderdate").alias("RCGNTN_TS"))
    lines = lineitem.select(
        F.col("l_orderkey").alias("o_orderkey"), "l_partkey", F.col("l_shipdate").alias("RCGNTN_TS")
    )
    kept, details = retention_delete(
        main, {"lines": lines}, "o_orderkey", "PRCSSD_IND", "RCGNTN_TS", ts("1999-01-01")
    )
    return kept.select(
        F.lit("queue").alias("table_name"), F.col("o_orderkey").alias("row_key"),
        F.lit(0).cast("bigint").alias("sub_key"),
    ).unionByName(details["lines"].select(
        F.lit("lines").alias("table_name"), F.col("o_orderkey").alias("row_key"), F.col("l_partkey").alias("sub_key")
    ))


# --- extract, ledger, reload -------------------------------------------------------------------

CONTROL = [
    ("customer", '"c_custkey","c_name","c_mktsegment"'),
    ("supplier", '"s_suppkey","s_name"'),
    ("orders", '"o_orderkey","o_custkey","o_orderdate"'),
    ("lineitem", '"l_orderkey","l_partkey","l_shipdate"'),
    ("events", '"event_id","ts","event_type"'),
]


#: The table that the events of one type stand for in the ledger of the extract; ``absent`` does not exist.
LEDGER_STEPS = {"click": "customer", "view": "orders", "signup": "supplier", "error": "absent", "purchase": "lineitem"}
_STEP_SQL = "CASE event_type " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in LEDGER_STEPS.items()) + " END"


@query("control_driven_extract", f"""
WITH ledger AS (SELECT {_STEP_SQL} AS step, ts, row_number() OVER (PARTITION BY {_STEP_SQL} ORDER BY ts DESC, event_id DESC) AS rn,
    CASE WHEN event_type = 'signup' THEN 'STRT' ELSE 'CPLT' END AS status FROM events),
counts AS ({" UNION ALL ".join(f"SELECT '{t}' AS step, count(*) AS n, true AS ok FROM {t}" for t, _ in CONTROL)}
  UNION ALL SELECT 'absent', 0, false),
due AS (SELECT counts.*, ts FROM counts LEFT JOIN (SELECT * FROM ledger WHERE rn = 1) l USING (step)
  WHERE coalesce(status, 'CPLT') = 'CPLT')
SELECT step, 'STRT' AS status, strftime(ts, '%Y-%m-%d %H:%M:%S') AS window_start, '{AS_OF}' AS window_end,
  '9999-12-31 00:00:00' AS process_end, CAST(0 AS BIGINT) AS "Num_Rows_Read", CAST(0 AS BIGINT) AS "Total_Rows_To_Target",
  false AS has_error FROM due
UNION ALL SELECT step, CASE WHEN ok THEN 'CPLT' ELSE 'FAIL' END, strftime(ts, '%Y-%m-%d %H:%M:%S'), '{AS_OF}',
  CASE WHEN ok THEN '{AS_OF}' ELSE '9999-12-31 00:00:00' END, n, n, NOT ok FROM due
""")
def _control_driven_extract(spark: SparkSession, folder: str) -> DataFrame:
    kind = F.col("event_type")
    names = F.create_map(*[F.lit(x) for pair in LEDGER_STEPS.items() for x in pair])
    so_far = table(spark, folder, "events").select(
        "event_id", F.try_element_at(names, kind).alias("step"), F.col("ts").alias("event_ts"),
        F.when(kind == "signup", "STRT").otherwise("CPLT").alias("status"),
    )
    listed = spark.createDataFrame(
        [("main", *row, "Y") for row in [*CONTROL, ("absent", '"id"')]] + [("main", "part", '"p_partkey"', "N")],
        "Source_Db_Nm string, Source_Table_Nm string, Source_Column_Names string, Extract_Process_Active_Ind string",
    )
    control = control_table_scan(truncate_load(listed, scratch_path(spark, "control")), "main")
    started, closed = extract.extract_with_ledger(
        spark, control, so_far, lambda t: table(spark, folder, t), scratch_path(spark, "extract"), ts(AS_OF)
    )
    return started.unionByName(closed).select(
        "step", "status", format_seconds(F.col("window_start")).alias("window_start"),
        format_seconds(F.col("window_end")).alias("window_end"),
        format_seconds(F.col("Process_End_Ts")).alias("process_end"), "Num_Rows_Read", "Total_Rows_To_Target",
        (F.col("Process_Error_Desc") != "").alias("has_error"),
    )


def _ledger_events(spark: SparkSession, folder: str) -> DataFrame:
    kind = F.col("event_type")
    return table(spark, folder, "events").select(
        "event_id", F.concat(F.lit("step-"), "user_id").alias("step"), F.col("ts").alias("event_ts"),
        F.when(kind == "error", "FAIL").when(kind == "signup", "STRT").otherwise("CPLT").alias("status"), "value",
    )


@query("run_ledger", f"""
WITH ledger AS (SELECT event_id, concat('step-', user_id) AS step, ts AS event_ts, value,
    CASE event_type WHEN 'error' THEN 'FAIL' WHEN 'signup' THEN 'STRT' ELSE 'CPLT' END AS status FROM events),
last AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY step ORDER BY event_ts DESC, event_id DESC) AS rn
    FROM ledger) v WHERE rn = 1),
counts AS (SELECT step, count(*) AS n, count(*) FILTER (value > 20) AS n_big FROM ledger GROUP BY step)
SELECT last.step, CASE WHEN status <> 'CPLT' THEN concat('blocked ', status) WHEN n_big > 0 THEN 'CPLT' ELSE 'FAIL' END AS status,
  CASE WHEN status <> 'CPLT' OR n_big = 0 THEN 0 ELSE n END AS n_read,
  CASE WHEN status <> 'CPLT' THEN '' WHEN n_big > 0 THEN '{AS_OF}' ELSE '9999-12-31 00:00:00' END AS process_end,
  CASE WHEN status = 'CPLT' AND n_big = 0 THEN 'nothing big' ELSE '' END AS error
FROM last JOIN counts ON counts.step = last.step
""")
def _run_ledger(spark: SparkSession, folder: str) -> DataFrame:
    events = _ledger_events(spark, folder)
    gated = ledger.gate(events)
    ready = gated.withColumns({"window_start": F.col("event_ts"), "window_end": ts(AS_OF)})
    started = ledger.open_events(ready, ts(AS_OF))
    n = F.count(F.lit(1))
    big = F.count(F.when(F.col("value") > 20, 1)) > 0
    results = events.groupBy("step").agg(
        big.alias("ok"), *[n.alias(c) for c in ledger.COUNTERS],
        F.when(~big, "nothing big").alias("error"),
    )
    closed = ledger.close_events(started, results, ts(AS_OF)).select(
        "step", "status", F.col("Num_Rows_Read").alias("n_read"),
        format_seconds(F.col("Process_End_Ts")).alias("process_end"), F.col("Process_Error_Desc").alias("error"),
    )
    blocked = gated.where("not may_start").select(
        "step", F.concat(F.lit("blocked "), "status").alias("status"), F.lit(0).cast("bigint").alias("n_read"),
        F.lit("").alias("process_end"), F.lit("").alias("error"),
    )
    return closed.unionByName(blocked)


@query("incremental_window", """
WITH steps AS (SELECT event_type AS step, max(ts) FILTER (value > 5 AND ts < TIMESTAMP '2024-01-20') AS previous_end
    FROM events GROUP BY event_type),
w AS (SELECT step, CASE WHEN step <> 'error' THEN previous_end END AS s,
  CASE step WHEN 'click' THEN TIMESTAMP '2024-01-25' WHEN 'view' THEN TIMESTAMP '2024-01-25 23:59:59.999999'
    WHEN 'purchase' THEN TIMESTAMP '2024-01-25 12:34:56.789' WHEN 'signup' THEN TIMESTAMP '2024-01-24 23:59:59.999999' END AS e
  FROM steps)
SELECT event_id, event_type AS step, strftime(s, '%Y-%m-%d %H:%M:%S.%f') AS window_start,
  strftime(e, '%Y-%m-%d %H:%M:%S.%f') AS window_end
FROM events JOIN w ON step = event_type WHERE (s IS NULL OR ts > s) AND (e IS NULL OR ts <= e)
""")
def _incremental_window(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events")
    old = (F.col("value") > 5) & (F.col("ts") < ts("2024-01-20"))
    kinds = {"click": "MAX_DT", "view": "DAY_END", "purchase": "CUR_TS", "signup": "PREV_DAY_END", "error": "ALL"}
    kind = F.create_map(*[F.lit(x) for pair in kinds.items() for x in pair])
    steps = events.groupBy(F.col("event_type").alias("step")).agg(
        F.max(F.when(old, F.col("ts"))).alias("previous_end")
    ).withColumns({
        "increment_type": F.try_element_at(kind, F.col("step")),
        "previous_value": F.lit(None).cast("string"),
    })
    windows = ledger.incremental_windows(steps, ts("2024-01-25 12:34:56.789012"), max_end=ts("2024-01-25"))
    exact = "yyyy-MM-dd HH:mm:ss.SSSSSS"
    return ledger.in_window(events.withColumnRenamed("event_type", "step"), windows, "step", "ts").select(
        "event_id", "step", F.date_format("window_start", exact).alias("window_start"),
        F.date_format("window_end", exact).alias("window_end"),
    )


#: Lines that a target cannot take: a date that is none, a segment that is too long, both.
RELOAD_DAMAGE = "CASE WHEN c_custkey % 31 = 4 AND c_custkey % 37 = 5 THEN 'OPEN_DT, C_MKTSEGMENT' " \
    "WHEN c_custkey % 31 = 4 THEN 'OPEN_DT' WHEN c_custkey % 37 = 5 THEN 'C_MKTSEGMENT' END"


@query("csv_cleanse_reload", f"""
WITH c AS (SELECT *, {RELOAD_DAMAGE} AS why FROM customer)
SELECT 'CUSTOMER' AS table_name, c_name AS "C_NAME", CASE WHEN c_acctbal > 0 THEN '2024-01-31' END AS "OPEN_DT",
  CASE WHEN c_mktsegment = 'BUILDING' THEN '' ELSE c_mktsegment END AS "C_MKTSEGMENT",
  array_to_string(list_transform(string_split(CAST(c_nationkey AS VARCHAR), ''),
    lambda x: lpad(bin(ord(x)), 8, '0')), '') AS "PIN_ENCRPTD", CAST(NULL AS VARCHAR) AS "FAX", CAST(NULL AS VARCHAR) AS reason,
  CAST(NULL AS BIGINT) AS source_rows, CAST(NULL AS BIGINT) AS rejected_rows, CAST(NULL AS BIGINT) AS loaded_rows
FROM c WHERE why IS NULL
UNION ALL SELECT 'SUPPLIER', s_name, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL FROM supplier
UNION ALL SELECT 'CUSTOMER', NULL, NULL, NULL, NULL, NULL, why, NULL, NULL, NULL FROM c WHERE why IS NOT NULL
UNION ALL SELECT 'CUSTOMER', NULL, NULL, NULL, NULL, NULL, NULL, count(*), count(why), count(*) - count(why) FROM c
UNION ALL SELECT 'SUPPLIER', NULL, NULL, NULL, NULL, NULL, NULL, count(*), 0, count(*) FROM supplier
""")
def _csv_cleanse_reload(spark: SparkSession, folder: str) -> DataFrame:
    """A folder of two tables and a stray file into declared targets; rows, rejects and counts."""
    root, database = scratch_path(spark, "reload-csv"), f"reload_{uuid.uuid4().hex}"
    customer, supplier = tables(spark, folder, "customer", "supplier")
    spaces = {"header": True, "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    why = F.expr(RELOAD_DAMAGE)
    segment = F.when(F.col("c_mktsegment") == "BUILDING", "  ").otherwise(F.col("c_mktsegment"))
    customer.select(
        F.when(F.coalesce(why, F.lit("")).contains("OPEN_DT"), "soon").when(F.col("c_acctbal") > 0, "2024-01-31").otherwise(" ").alias("open_dt"),
        "c_custkey", "c_name", F.when(F.coalesce(why, F.lit("")).contains("SEGMENT"), F.repeat(F.lit("x"), F.lit(11))).otherwise(segment).alias("c_mktsegment"),
        F.col("c_nationkey").cast("string").alias("pin_encrptd"), F.lit(" ").alias("fax"),
    ).write.options(**spaces).csv(f"{root}/customer.csv")
    supplier.select("s_suppkey", "s_name").write.options(**spaces).csv(f"{root}/deep/supplier.csv")
    supplier.select("s_suppkey").write.options(**spaces).csv(f"{root}/stray.csv")
    rules = spark.createDataFrame(
        [("CUSTOMER", "C_MKTSEGMENT", 0, 0), ("OTHER", "C_NAME", 0, 1)],
        "TABLE_NAME string, COLUMN_NAME string, NULLABLE int, IDENTITY_COL int",
    )
    spark.sql(f"CREATE DATABASE {database} LOCATION '{scratch_path(spark, 'database')}'")
    for name, columns in (
        ("customer", "C_NAME VARCHAR(25), OPEN_DT DATE, C_MKTSEGMENT VARCHAR(10), PIN_ENCRPTD STRING, FAX STRING"),
        ("supplier", "S_NAME STRING"), ("untouched", "X INT"),
    ):
        spark.sql(f"CREATE TABLE {database}.{name} ({columns}) USING parquet LOCATION '{scratch_path(spark, name)}'")
    done = reload.csv_reload_folder(spark, root, database, rules)
    loaded = done.tables["CUSTOMER"].withColumn("OPEN_DT", F.col("OPEN_DT").cast("string")).select(F.lit("CUSTOMER").alias("table_name"), "*")
    suppliers = done.tables["SUPPLIER"].select(F.lit("SUPPLIER").alias("table_name"), F.col("S_NAME").alias("C_NAME"))
    parts = [suppliers, done.rejects.select("table_name", "reason"), done.counts.select("table_name", "source_rows", "rejected_rows", "loaded_rows")]
    return reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), parts, loaded)


#: A sheet's cells by their headers, as SQL over customers; the headers are those of the fixed list.
_SHEET = {
    "Employee ID": "CASE WHEN c_acctbal > 0 THEN CAST(c_custkey AS VARCHAR) END", "Project ID": "c_mktsegment",
    "Project Start Date": "CASE WHEN c_custkey % 7 = 0 THEN 'soon' ELSE '2024-01-31' END", "Resource Name": "c_name",
    "Role": "concat('role ', c_nationkey)", "Type": "CASE WHEN c_custkey % 2 = 0 THEN 'T' END", "Client": "concat('client, ', c_custkey % 9)",
    "Client ID": "CAST(c_custkey % 9 AS VARCHAR)", "Project Name": "concat(c_mktsegment, ' \"', c_custkey % 5, '\"')",
    "TPS_Type": "CASE WHEN c_custkey % 3 = 0 THEN 'x' END", "Cost": "CAST(c_custkey % 100 AS VARCHAR)", "Rate": "CAST(c_nationkey AS VARCHAR)",
    "Hours": "CAST(c_custkey % 40 AS VARCHAR)", "Resource Cost": "CAST(c_custkey % 1000 AS VARCHAR)",
    "Resource Revenue": "CASE WHEN c_custkey % 4 > 0 THEN CAST(c_custkey AS VARCHAR) END",
}
_SHEET_SQL = {ESTIMATE_COLUMNS[h]: e for h, e in _SHEET.items()} | {
    "PROJ_STRT_DT": "CASE WHEN c_custkey % 7 <> 0 THEN '2024-01-31 00:00:00' END"}


@query("sheet_estimate_load", f"""
SELECT {', '.join(f'{e} AS "{c}"' for c, e in _SHEET_SQL.items())} FROM customer WHERE c_acctbal > 0
""")
def _sheet_estimate_load(spark: SparkSession, folder: str) -> DataFrame:
    """All fifteen columns of a sheet; dates that are none are NULL, rows without an employee are not loaded."""
    sheet = table(spark, folder, "customer").select(*[F.expr(e.replace("VARCHAR", "STRING")).alias(h) for h, e in _SHEET.items()])
    path = scratch_path(spark, "estimates")
    sheet.write.option("header", True).option("escape", '"').csv(path)
    loaded = reload.estimate_rows(csv_scan(spark, path, sheet.schema))
    return loaded.withColumn("PROJ_STRT_DT", format_seconds(F.col("PROJ_STRT_DT")))


@query("encrypt_column_on_load", """
SELECT c_custkey, true AS raw_cleared, CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS VARCHAR) AS decrypted FROM customer
""")
def _encrypt_column_on_load(spark: SparkSession, folder: str) -> DataFrame:
    key = F.lit(secrets.token_bytes(32))
    rows = table(spark, folder, "customer").select("c_custkey", F.col("c_acctbal").cast("decimal(18,2)").alias("rate"))
    loaded = truncate_load(
        extract.encrypt_column_on_load(rows, "rate", "rate_ENCRPTD", key), scratch_path(spark, "encrypted")
    )
    return loaded.select(
        "c_custkey", F.col("rate").isNull().alias("raw_cleared"),
        extract.decrypt_column(F.col("rate_ENCRPTD"), key).alias("decrypted"),
    )


# --- streams -----------------------------------------------------------------------------------

EXACT_TS = "date_format(ts, 'yyyy-MM-dd HH:mm:ss.SSSSSS') AS ts"
_EVENTS_SQL = "SELECT event_id, user_id, event_type, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts FROM events"


def _event_files(spark: SparkSession, folder: str, repeated: bool) -> tuple[str, object]:
    """Events as several files; with ``repeated`` all purchases come twice."""
    events = table(spark, folder, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    if repeated:
        events = events.unionByName(events.where("event_type = 'purchase'"))
    path = scratch_path(spark, "event-files")
    events.repartition(5).write.parquet(path)
    return path, events.schema


def _drain(running) -> None:
    running.awaitTermination()
    if running.exception() is not None:
        raise running.exception()


@query("stream_file_ingest", _EVENTS_SQL)
def _stream_file_ingest(spark: SparkSession, folder: str) -> DataFrame:
    path, schema = _event_files(spark, folder, repeated=False)
    target = scratch_path(spark, "ingested")
    stream = jobs.read_folder(spark, path, schema, files_per_batch=2, archive=scratch_path(spark, "archive"))
    _drain(jobs.stream_file_ingest(stream, target, scratch_path(spark, "ingest-state")))
    return spark.read.schema(schema).parquet(target).selectExpr("event_id", "user_id", "event_type", EXACT_TS)


@query("stream_dedup_versions", """
WITH RECURSIVE kept AS (
  SELECT user_id, event_type, min(ts) AS ts FROM events GROUP BY user_id, event_type
  UNION ALL
  SELECT k.user_id, k.event_type, min(e.ts) FROM kept k JOIN events e
    ON e.user_id = k.user_id AND e.event_type = k.event_type AND e.ts > k.ts + INTERVAL 2 DAY GROUP BY k.user_id, k.event_type
)
SELECT user_id, event_type, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts FROM kept
""")
def _stream_dedup_versions(spark: SparkSession, folder: str) -> DataFrame:
    """A user's events of a kind, two days apart; every delivery brings the one before it again."""
    events = table(spark, folder, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    path, target, state = (scratch_path(spark, n) for n in ("event-files", "deduplicated", "dedup-state"))
    week = F.expr("dayofmonth(ts) div 8")
    for i in range(4):
        events.where(week.between(i - 1, i)).coalesce(1).write.mode("append").parquet(path)
    # Three files a batch, so the cut is not that of the deliveries.
    stream = jobs.read_folder(spark, path, events.schema, files_per_batch=3)
    _drain(jobs.stream_dedup_versions(stream, ["user_id", "event_type"], "ts", target, state, "2 days"))
    return spark.read.schema(events.schema).parquet(target).select(
        "user_id", "event_type", F.date_format("ts", EXACT).alias("ts"))


@query("stream_upsert_latest", f"""
SELECT event_id, user_id, event_type, ts FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM ({_EVENTS_SQL}) e) v
WHERE rn = 1
""")
def _stream_upsert_latest(spark: SparkSession, folder: str) -> DataFrame:
    path, schema = _event_files(spark, folder, repeated=True)
    target = scratch_path(spark, "versions")
    newest = [F.col("ts").desc(), F.col("event_id").desc()]
    stream = jobs.read_folder(spark, path, schema, files_per_batch=2)
    _drain(jobs.stream_upsert_latest(stream, ["user_id"], newest, target, scratch_path(spark, "upsert-state")))
    return jobs.read_latest(spark, target, schema).selectExpr(
        "event_id", "user_id", "event_type", EXACT_TS
    )
