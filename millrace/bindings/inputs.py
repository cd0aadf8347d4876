"""Inputs in the shape of real exports, derived from the test tables.

Each builder has its SQL twin, a common table expression for the oracles.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.bindings.registry import table
from millrace.operators.windows import latest_row_per_key
from millrace.plans.messages import Dictionaries
from millrace.session import spread

# --- staged message versions (events), loaded messages, employees, directory ---

CODES = Dictionaries(
    tags=[(1, ":view:"), (2, ":click:"), (3, ":signup:")],
    values=[(1, ":team:"), (2, ":bold:")],
)

STAGED_SQL = """
SELECT event_id,
  concat(user_id, '.', lpad(CAST(event_id % 53 AS VARCHAR), 6, '0')) AS SRC_TS,
  ts AS INTRNL_TS,
  CASE WHEN event_id % 5 = 0
         THEN concat(user_id, '.', lpad(CAST(event_id % 53 AS VARCHAR), 6, '0'))
       WHEN event_id % 11 = 0 THEN '0' END AS SRC_THRD_TS,
  concat(CASE event_type WHEN 'view' THEN ':view: ' WHEN 'click' THEN ':click: '
                         WHEN 'signup' THEN ':signup::view: ' ELSE '' END,
         'well done ', event_id % 100,
         CASE WHEN event_id % 2 = 0 THEN ' :team:' ELSE '' END,
         CASE WHEN event_id % 3 = 0 THEN ' :bold:' ELSE '' END) AS MSG_TXT,
  concat('U', lpad(CAST(user_id AS VARCHAR), 8, '0')) AS FRM_USR_SRC_ID,
  concat('c', user_id, '@x.org') AS FRM_USR_EMAIL,
  CASE WHEN value >= 5 THEN
    concat('U', lpad(CAST(CAST(floor(value) AS BIGINT) AS VARCHAR), 8, '0'),
           '|W', lpad(CAST(event_id % 10 AS VARCHAR), 8, '0')) END AS TO_USR_SRC_ID,
  CASE WHEN value >= 5 THEN
    concat('c', CAST(floor(value) AS BIGINT), '@x.org|') END AS TO_USR_EMAIL,
  CASE WHEN event_id % 3 <> 0 THEN props END AS EDITED
FROM events
"""

EMPLOYEES_SQL = """
SELECT concat('E', c_custkey) AS EMPL_ID, concat('c', c_custkey, '@x.org') AS CO_EMAIL
FROM customer WHERE c_mktsegment <> 'HOUSEHOLD'
"""

DIRECTORY_SQL = """
SELECT concat('U', lpad(CAST(c_custkey AS VARCHAR), 8, '0')) AS id, c_name AS name,
  CASE WHEN c_acctbal > 0 THEN concat('c', c_custkey, '@x.org') END AS email
FROM customer
"""

LOADED_SQL = """
SELECT event_id AS RCGNTN_MSG_ID, INTRNL_TS, SRC_TS, MSG_TXT AS RCGNTN_MSG_TXT,
  0 AS RCGNTN_TAG_ID, FRM_USR_SRC_ID AS FRM_USR_ID, CAST(NULL AS VARCHAR) AS FRM_EMPL_ID
FROM (SELECT *, row_number() OVER (PARTITION BY SRC_TS ORDER BY INTRNL_TS DESC, event_id DESC) AS rn
      FROM staged WHERE INTRNL_TS < TIMESTAMP '2024-01-21 00:00:00') v
WHERE rn = 1
"""


def _from(rows: DataFrame, name: str, sql: str) -> DataFrame:
    """Run a builder over one table; the same text serves both engines."""
    spark_sql = sql.replace("VARCHAR", "STRING").replace("TIMESTAMP '", "TIMESTAMP_NTZ '")
    return rows.sparkSession.sql(spark_sql.replace(f"FROM {name}", "FROM {src}"), src=rows)


def staged_messages(spark: SparkSession, folder: str) -> DataFrame:
    return _from(table(spark, folder, "events"), "events", STAGED_SQL)


def employees(spark: SparkSession, folder: str) -> DataFrame:
    return _from(table(spark, folder, "customer"), "customer", EMPLOYEES_SQL)


def directory(spark: SparkSession, folder: str) -> DataFrame:
    return _from(table(spark, folder, "customer"), "customer", DIRECTORY_SQL)


def loaded_messages(staged: DataFrame) -> DataFrame:
    old = staged.where(F.col("INTRNL_TS") < F.lit("2024-01-21 00:00:00").cast("timestamp_ntz"))
    latest = latest_row_per_key(old, ["SRC_TS"], [F.col("INTRNL_TS").desc(), F.col("event_id").desc()])
    return latest.select(
        F.col("event_id").alias("RCGNTN_MSG_ID"), "INTRNL_TS", "SRC_TS",
        F.col("MSG_TXT").alias("RCGNTN_MSG_TXT"), F.lit(0).alias("RCGNTN_TAG_ID"),
        F.col("FRM_USR_SRC_ID").alias("FRM_USR_ID"), F.lit(None).cast("string").alias("FRM_EMPL_ID"),
    )


# --- raw messages with optional and nested parts (events), for JSON exports -------

RAW_SCHEMA = (
    "ts string, thread_ts string, type string, subtype string, text string, user string, "
    "username string, reply_count bigint, reactions array<struct<name: string, count: bigint>>, "
    "edited struct<user: string, ts: string>"
)

RAW_SQL = """
SELECT concat(user_id, '.', lpad(CAST(event_id AS VARCHAR), 9, '0')) AS ts,
  CASE WHEN event_id % 5 = 0 THEN '0' END AS thread_ts, 'message' AS type,
  CASE WHEN event_type <> 'view' THEN event_type END AS subtype,
  CASE WHEN event_type = 'error' THEN event_type ELSE
    concat('hi <@U', lpad(CAST(user_id AS VARCHAR), 8, '0'), '> <@W',
           lpad(CAST(event_id % 10 AS VARCHAR), 8, '0'), '> ', event_type) END AS text,
  CASE WHEN event_id % 3 <> 0 THEN concat('U', lpad(CAST(user_id AS VARCHAR), 8, '0')) END AS user,
  CASE WHEN event_id % 3 = 0 THEN concat('Customer#', lpad(CAST(user_id AS VARCHAR), 9, '0')) END AS username,
  event_id % 9 AS reply_count, event_type, event_id, event_id % 4 AS n_reactions,
  event_id % 6 AS n_edit
FROM events
"""


def raw_messages(spark: SparkSession, folder: str) -> DataFrame:
    events = spread(table(spark, folder, "events").select("event_id", "user_id", "event_type"))
    rows = _from(events, "events", RAW_SQL.replace("AS user,", "AS `user`,"))
    reactions = F.array(F.struct(F.col("event_type").alias("name"), F.col("n_reactions").alias("count")))
    edited = F.struct(F.lit("U1").alias("user"), F.col("ts").alias("ts"))
    return rows.select(
        "ts", "thread_ts", "type", "subtype", "text", "user", "username", "reply_count",
        F.when(F.col("n_reactions") > 0, reactions).alias("reactions"),
        F.when(F.col("n_edit") == 0, edited).alias("edited"),
    )


# --- plan documents (orders) --------------------------------------------------

#: File names by the rule; the lowest priority gets a wrong prefix.
PLAN_NAME_SQL = """
concat(CASE WHEN o_orderpriority = '5-LOW' THEN 'XX' ELSE 'MS' END, '_PR',
       lpad(lower({hex}(o_orderkey % 16777216)), 6, '0'), '_',
       lpad(lower({hex}(({div}) % 256)), 2, '0'), '_', {day}, '.xml')
"""
PLAN_NAME_SPARK = PLAN_NAME_SQL.format(
    hex="hex", div="o_orderkey div 16777216", day="date_format(o_orderdate, 'yyyyMMdd')"
)
PLAN_NAME_DUCK = PLAN_NAME_SQL.format(
    hex="to_hex", div="o_orderkey // 16777216", day="strftime(o_orderdate, '%Y%m%d')"
)


def plan_documents(spark: SparkSession, folder: str) -> DataFrame:
    """One project per order with one to three tasks and up to three working times a day; ``_key`` is the order's number."""
    orders = spread(table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderpriority", "o_orderdate")).selectExpr(
        "o_orderkey AS k", "o_custkey AS cust", f"{PLAN_NAME_SPARK} AS name",
        "date_format(o_orderdate, \"yyyy-MM-dd'T'HH:mm:ss\") AS day",
        "sequence(1, CAST(1 + o_orderkey % 3 AS INT)) AS n",
        "CAST(o_orderkey % 4 AS INT) AS n_times",
    )
    task = """transform(n, i -> named_struct(
        'UID', CAST(i AS STRING), 'Name', concat('task ', i), 'Start', day, 'Finish', day,
        'Duration', concat('PT', i * 8, 'H', k % 60, 'M0S'), 'Work', concat('PT', i, 'H0M0S'),
        'TimephasedData', if(i % 2 = 1, array(named_struct('Type', '1', 'UID', CAST(i AS STRING),
            'Start', day, 'Finish', day, 'Unit', '2', 'Value', concat('PT', i, 'H0M0S'))), NULL),
        'PredecessorLink', if(i > 1, array(named_struct('PredecessorUID', CAST(i - 1 AS STRING),
            'Type', '1', 'CrossProject', '0', 'LinkLag', '0', 'LagFormat', '7')), NULL)))"""
    assignment = """transform(n, i -> named_struct(
        'UID', CAST(i AS STRING), 'TaskUID', CAST(i AS STRING), 'ResourceUID', CAST(cust AS STRING),
        'Work', 'PT8H8M0S', 'TimephasedData', array(named_struct('Type', '1', 'UID', CAST(i AS STRING),
            'Start', day, 'Finish', day, 'Unit', '2', 'Value', concat('PT', i, 'H30M0S')))))"""
    times = """transform(if(n_times = 0, array(), sequence(1, n_times)), j -> named_struct(
        'FromTime', concat(lpad(CAST(6 + 2 * j AS STRING), 2, '0'), ':00:00'),
        'ToTime', concat(lpad(CAST(7 + 2 * j AS STRING), 2, '0'), ':30:00')))"""
    calendar = f"""array(named_struct('UID', '1', 'Name', 'Standard',
        'WeekDays', named_struct('WeekDay', array(
            named_struct('DayType', '1', 'DayWorking', '0', 'WorkingTimes', NULL),
            named_struct('DayType', '2', 'DayWorking', '1',
                         'WorkingTimes', named_struct('WorkingTime', {times})))),
        'Exceptions', named_struct('Exception', array(named_struct(
            'Type', '1', 'DayWorking', '1', 'EnteredByOccurrences', '0',
            'TimePeriod', if(k % 2 = 1, named_struct('FromDate', day, 'ToDate', day), NULL),
            'WorkingTimes', if(k % 5 = 0, named_struct('WorkingTime', array(
                named_struct('FromTime', '08:00:00', 'ToTime', '12:00:00'))), NULL))))))"""
    return orders.selectExpr(
        "name AS Name", "'14' AS SaveVersion", "day AS StartDate", "day AS FinishDate",
        "if(k % 2 = 0, '0', day) AS NewTaskStartDate",
        f"named_struct('Task', {task}) AS Tasks",
        "named_struct('Resource', array(named_struct('UID', CAST(cust AS STRING), 'Name', "
        "concat('Customer ', cust), 'Work', 'PT8H8M0S', 'RegularWork', 'PT5H0M5S'))) AS Resources",
        f"named_struct('Assignment', {assignment}) AS Assignments",
        f"named_struct('Calendar', {calendar}) AS Calendars", "k AS _key",
    )


#: Documents that pass the name rule, with their header number.
DOCS_SQL = f"""
docs AS (
  SELECT *, row_number() OVER (ORDER BY b) AS h FROM (
    SELECT o_orderkey AS k, o_custkey AS cust, {PLAN_NAME_DUCK} AS b,
      strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') AS d,
      strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS dt,
      1 + o_orderkey % 3 AS n, o_orderkey % 4 AS n_times
    FROM orders) x
  WHERE regexp_matches(b, '^(MS|SG|SS)_')
),
per_task AS (SELECT docs.*, u.i FROM docs, LATERAL (SELECT unnest(range(1, n + 1)) AS i) u),
per_time AS (SELECT docs.*, u.j FROM docs, LATERAL (SELECT unnest(range(1, n_times + 1)) AS j) u)
"""
