"""Joins, aggregations and windows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.bindings.inputs import LOADED_SQL, STAGED_SQL, loaded_messages, staged_messages
from millrace.bindings.registry import query, table, tables
from millrace.operators import aggregates, joins, windows
from millrace.operators.filters import filter_top_level
from millrace.operators.state import drop_orphans
from millrace.plans.messages import latest_versions

# --- joins -----------------------------------------------------------------------


@query("join_parent_key", """
SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, o_custkey
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
""")
def _join_parent_key(spark: SparkSession, folder: str) -> DataFrame:
    lineitem, orders = tables(spark, folder, "lineitem", "orders")
    child = lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    return joins.join_parent_key(child, orders, {"l_orderkey": "o_orderkey"}, ["o_custkey"])


LINE_ORDER = ["l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
              "l_returnflag", "l_linestatus"]
LINE_ORDER_SQL = ", ".join(f"{c} DESC" for c in LINE_ORDER)


def _line_order():
    return [F.col(c).desc() for c in LINE_ORDER]


@query("rank_desc_in_group", f"""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice,
  row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {LINE_ORDER_SQL}) AS rn
FROM lineitem
""")
def _rank_desc_in_group(spark: SparkSession, folder: str) -> DataFrame:
    # Copies of a line are told apart by their place in the files.
    place = F.struct("_metadata.file_path", "_metadata.file_block_start", "_metadata.row_index")
    lineitem = table(spark, folder, "lineitem").withColumn("place", place)
    order = [*_line_order(), F.col("place")]
    return windows.dense_row_number(lineitem, ["l_orderkey", "l_linenumber"], order).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "rn"
    )


_RANKED_SQL = f"""
ranked AS (SELECT l_orderkey, l_linenumber, l_partkey, l_quantity,
  row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {LINE_ORDER_SQL}) AS rn FROM lineitem),
base AS (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem
         UNION ALL SELECT o_orderkey, 0 FROM orders)
"""


def _line_slots(spark: SparkSession, folder: str) -> DataFrame:
    """Every line number of every order, and a slot 0 that has no lines."""
    lineitem, orders = tables(spark, folder, "lineitem", "orders")
    return lineitem.select("l_orderkey", "l_linenumber").distinct().unionByName(
        orders.select(F.col("o_orderkey").alias("l_orderkey"), F.lit(0).alias("l_linenumber"))
    )


@query("join_composite_left", f"""
WITH {_RANKED_SQL}
SELECT base.l_orderkey, base.l_linenumber, coalesce(b.l_partkey, -1) AS second_part, coalesce(c.l_partkey, -1) AS first_part
FROM base
LEFT JOIN (SELECT * FROM ranked WHERE rn = 2) b
  ON base.l_orderkey = b.l_orderkey AND base.l_linenumber = b.l_linenumber
LEFT JOIN (SELECT * FROM ranked WHERE rn = 1) c
  ON base.l_orderkey = c.l_orderkey AND base.l_linenumber = c.l_linenumber
""")
def _join_composite_left(spark: SparkSession, folder: str) -> DataFrame:
    keys = ["l_orderkey", "l_linenumber"]
    ranked = windows.top_ranked(table(spark, folder, "lineitem"), keys, _line_order(), 2)
    out = _line_slots(spark, folder)
    for rank, name in ((2, "second_part"), (1, "first_part")):
        side = ranked.where(F.col("rn") == rank).select(*keys, F.col("l_partkey").alias(name))
        out = joins.join_composite_left(out, side, keys)
    return out.select(*keys, *[F.coalesce(c, F.lit(-1)).alias(c) for c in ("second_part", "first_part")])


@query("pivot_ranked_pairs", f"""
WITH {_RANKED_SQL}
SELECT base.l_orderkey, base.l_linenumber,
  coalesce(max(CASE WHEN rn = 2 THEN l_partkey END), -1) AS l_partkey,
  coalesce(max(CASE WHEN rn = 2 THEN l_quantity END), -1) AS l_quantity,
  coalesce(max(CASE WHEN rn = 1 THEN l_partkey END), -1) AS l_partkey_2,
  coalesce(max(CASE WHEN rn = 1 THEN l_quantity END), -1) AS l_quantity_2,
  count(rn) AS n_ranges
FROM base LEFT JOIN ranked USING (l_orderkey, l_linenumber)
GROUP BY base.l_orderkey, base.l_linenumber
""")
def _pivot_ranked_pairs(spark: SparkSession, folder: str) -> DataFrame:
    paired = windows.pivot_ranked_pairs(
        _line_slots(spark, folder), table(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"],
        _line_order(), "l_partkey", "l_quantity",
    )
    return paired.fillna(-1)


@query("join_lookup_email", """
SELECT s_suppkey, concat('n', s_nationkey) AS email, n.n_name AS empl_name
FROM supplier LEFT JOIN (SELECT * FROM nation WHERE n_regionkey <> 0) n ON n_nationkey = s_nationkey
""")
def _join_lookup_email(spark: SparkSession, folder: str) -> DataFrame:
    supplier, nation = tables(spark, folder, "supplier", "nation")
    people = nation.where("n_regionkey <> 0").select(
        F.concat(F.lit("n"), "n_nationkey").alias("CO_EMAIL"), "n_name"
    )
    rows = supplier.select("s_suppkey", F.concat(F.lit("n"), "s_nationkey").alias("email"))
    return joins.join_lookup(
        rows, joins.unique_rows(people, ["CO_EMAIL"]), {"email": "CO_EMAIL"}, {"n_name": "empl_name"}
    )


@query("join_inner_left_chain", """
SELECT o_custkey, o_orderkey, c_name, coalesce(n_quality, 0) AS n_quality
FROM orders JOIN customer ON o_custkey = c_custkey
LEFT JOIN (SELECT user_id, count(*) AS n_quality FROM events GROUP BY user_id) v ON v.user_id = o_custkey
""")
def _join_inner_left_chain(spark: SparkSession, folder: str) -> DataFrame:
    orders, customer, events = tables(spark, folder, "orders", "customer", "events")
    optional = events.groupBy(F.col("user_id").alias("o_custkey")).agg(F.count(F.lit(1)).alias("n_quality"))
    return joins.join_inner_left_chain(
        orders.select("o_custkey", "o_orderkey"),
        customer.select(F.col("c_custkey").alias("o_custkey"), "c_name"), optional, "o_custkey",
    ).fillna(0, subset=["n_quality"])


@query("join_right_dropna", """
SELECT o_orderkey, n1.n_name AS to_username, n2.n_name AS from_username
FROM orders JOIN customer ON o_custkey = c_custkey
JOIN (SELECT * FROM nation WHERE n_regionkey <> 0) n1 ON n1.n_nationkey = c_nationkey
JOIN (SELECT * FROM nation WHERE n_regionkey <> 0) n2 ON n2.n_nationkey = o_orderkey % 25
""")
def _join_right_dropna(spark: SparkSession, folder: str) -> DataFrame:
    orders, customer, nation = tables(spark, folder, "orders", "customer", "nation")
    people = nation.where("n_regionkey <> 0").select(
        F.col("n_nationkey").cast("bigint").alias("email"), F.col("n_name").alias("name")
    )
    rows = orders.join(customer, orders["o_custkey"] == customer["c_custkey"]).select(
        "o_orderkey", F.col("c_nationkey").cast("bigint").alias("to_email"),
        (F.col("o_orderkey") % 25).alias("from_email"),
    )
    return joins.join_directory_twice(rows, people, "to_email", "from_email").drop("to_email", "from_email")


@query("semi_latest_version", """
SELECT event_id, user_id FROM events WHERE ts IN (SELECT max(ts) FROM events GROUP BY user_id)
""")
def _semi_latest_version(spark: SparkSession, folder: str) -> DataFrame:
    return joins.semi_latest_version(table(spark, folder, "events"), "user_id", "ts").select("event_id", "user_id")


@query("semi_two_level", """
SELECT l_orderkey, l_partkey, l_quantity FROM lineitem WHERE l_orderkey IN (
  SELECT o_orderkey FROM orders WHERE o_custkey IN (
    SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING'))
""")
def _semi_two_level(spark: SparkSession, folder: str) -> DataFrame:
    lineitem, orders, customer = tables(spark, folder, "lineitem", "orders", "customer")
    return joins.semi_two_level(
        lineitem.select("l_orderkey", "l_partkey", "l_quantity"), orders,
        customer.where("c_mktsegment = 'BUILDING'"),
        {"l_orderkey": "o_orderkey"}, {"o_custkey": "c_custkey"},
    )


@query("semi_value_rows", """
SELECT l_orderkey, l_returnflag FROM lineitem WHERE l_orderkey IN
  (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'O')
""")
def _semi_value_rows(spark: SparkSession, folder: str) -> DataFrame:
    lineitem, orders = tables(spark, folder, "lineitem", "orders")
    return joins.semi_join(
        lineitem.select("l_orderkey", "l_returnflag"), orders.where("o_orderstatus = 'O'"),
        {"l_orderkey": "o_orderkey"},
    )


@query("anti_already_loaded", """
SELECT 'plain' AS variant, o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)
UNION ALL SELECT 'null right', o_orderkey FROM orders WHERE o_orderkey NOT IN
  (SELECT nullif(l_orderkey, (SELECT max(l_orderkey) FROM lineitem)) FROM lineitem)
UNION ALL SELECT 'null left', o_orderkey FROM orders WHERE nullif(o_orderstatus, 'P') NOT IN
  (SELECT l_linestatus FROM lineitem WHERE l_linestatus = 'O')
""")
def _anti_already_loaded(spark: SparkSession, folder: str) -> DataFrame:
    orders, lineitem = tables(spark, folder, "orders", "lineitem")
    loaded = lineitem.select("l_orderkey")
    highest = lineitem.agg(F.max("l_orderkey").alias("m"))
    with_null = loaded.select(F.nullif(F.col("l_orderkey"), highest.scalar()).alias("l_orderkey"))
    staged = orders.withColumn("flag", F.nullif("o_orderstatus", F.lit("P")))
    variants = {
        "plain": joins.not_in(orders, "o_orderkey", loaded, "l_orderkey"),
        "null right": joins.not_in(orders, "o_orderkey", with_null, "l_orderkey"),
        "null left": joins.not_in(staged, "flag", lineitem.where("l_linestatus = 'O'"), "l_linestatus"),
    }
    parts = [df.select(F.lit(n).alias("variant"), "o_orderkey") for n, df in variants.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("anti_orphans", """
SELECT o_orderkey, o_custkey FROM orders o WHERE EXISTS
  (SELECT 1 FROM lineitem WHERE l_orderkey = o.o_orderkey AND l_returnflag = 'R')
""")
def _anti_orphans(spark: SparkSession, folder: str) -> DataFrame:
    orders, lineitem = tables(spark, folder, "orders", "lineitem")
    return drop_orphans(
        orders.select("o_orderkey", "o_custkey"), lineitem.where("l_returnflag = 'R'"),
        {"o_orderkey": "l_orderkey"},
    )


@query("join_newer_than_loaded", f"""
WITH staged AS ({STAGED_SQL}), loaded AS ({LOADED_SQL})
SELECT s.event_id, s.SRC_TS AS src_ts, l.RCGNTN_MSG_ID AS msg_id
FROM staged s JOIN loaded l ON s.SRC_TS = l.SRC_TS AND s.INTRNL_TS > l.INTRNL_TS AND s.FRM_USR_SRC_ID = l.FRM_USR_ID
WHERE (s.SRC_THRD_TS IS NULL OR s.SRC_TS = s.SRC_THRD_TS) AND s.EDITED IS NOT NULL
""")
def _join_newer_than_loaded(spark: SparkSession, folder: str) -> DataFrame:
    staged = staged_messages(spark, folder)
    edited = filter_top_level(staged).where("EDITED is not null")
    return joins.join_newer_than_loaded(
        edited, loaded_messages(staged), {"SRC_TS": "SRC_TS"}, ("INTRNL_TS", "INTRNL_TS"),
        {"FRM_USR_SRC_ID": "FRM_USR_ID"}, {"RCGNTN_MSG_ID": "msg_id"},
    ).select("event_id", F.col("SRC_TS").alias("src_ts"), "msg_id")


@query("update_from_join", """
SELECT l_orderkey, l_linenumber, l_quantity,
  CASE WHEN o_orderkey IS NOT NULL THEN o_custkey ELSE l_partkey END AS l_partkey
FROM lineitem LEFT JOIN (SELECT * FROM orders WHERE o_orderstatus = 'F') o ON l_orderkey = o_orderkey
""")
def _update_from_join(spark: SparkSession, folder: str) -> DataFrame:
    lineitem, orders = tables(spark, folder, "lineitem", "orders")
    return joins.update_from_join(
        lineitem.select("l_orderkey", "l_linenumber", "l_quantity", "l_partkey"),
        orders.where("o_orderstatus = 'F'"), {"l_orderkey": "o_orderkey"}, {"l_partkey": "o_custkey"},
    )


@query("update_three_way", f"""
WITH staged AS ({STAGED_SQL}), loaded AS ({LOADED_SQL}),
late AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY SRC_TS ORDER BY INTRNL_TS DESC) AS rn
  FROM staged WHERE INTRNL_TS >= TIMESTAMP '2024-01-21 00:00:00') v WHERE rn = 1),
changes AS (SELECT late.*, n_nationkey FROM late JOIN nation ON n_name = concat('NATION_', event_id % 40))
SELECT l.SRC_TS AS src_ts, coalesce(c.MSG_TXT, l.RCGNTN_MSG_TXT) AS msg_txt,
  CASE WHEN c.SRC_TS IS NOT NULL THEN n_nationkey ELSE l.RCGNTN_TAG_ID END AS tag_id
FROM loaded l LEFT JOIN changes c ON c.SRC_TS = l.SRC_TS
""")
def _update_three_way(spark: SparkSession, folder: str) -> DataFrame:
    staged = staged_messages(spark, folder)
    late = latest_versions(staged.where(F.col("INTRNL_TS") >= F.lit("2024-01-21").cast("timestamp_ntz")))
    stage = late.withColumn("n_name", F.concat(F.lit("NATION_"), F.col("event_id") % 40))
    updated = joins.update_three_way(
        loaded_messages(staged), stage, table(spark, folder, "nation"), "SRC_TS", "n_name",
        {"RCGNTN_MSG_TXT": "MSG_TXT"}, "n_nationkey", "RCGNTN_TAG_ID",
    )
    # The update is keyed by SRC_TS on both sides here.
    return updated.select(F.col("SRC_TS").alias("src_ts"), F.col("RCGNTN_MSG_TXT").alias("msg_txt"),
                          F.col("RCGNTN_TAG_ID").alias("tag_id"))


@query("diff_lists", """
SELECT DISTINCT o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)
""")
def _diff_lists(spark: SparkSession, folder: str) -> DataFrame:
    orders, lineitem = tables(spark, folder, "orders", "lineitem")
    return joins.diff_lists(orders, lineitem.withColumnRenamed("l_orderkey", "o_orderkey"), "o_orderkey")


# --- aggregations --------------------------------------------------------------------


@query("max_high_water", """
SELECT 'events' AS log, coalesce(max(event_id), 0) AS high_water FROM events
UNION ALL SELECT 'none', coalesce(max(event_id), 0) FROM events WHERE event_type = 'absent'
""")
def _max_high_water(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events")
    return aggregates.max_high_water(events, "event_id").withColumn("log", F.lit("events")).unionByName(
        aggregates.max_high_water(events.where("event_type = 'absent'"), "event_id").withColumn("log", F.lit("none"))
    )


@query("max_per_key", """
SELECT user_id, strftime(max(ts), '%Y-%m-%d %H:%M:%S.%f') AS latest FROM events GROUP BY user_id
""")
def _max_per_key(spark: SparkSession, folder: str) -> DataFrame:
    latest = aggregates.max_per_key(table(spark, folder, "events"), ["user_id"], "ts", "latest")
    return latest.withColumn("latest", F.date_format("latest", "yyyy-MM-dd HH:mm:ss.SSSSSS"))


@query("max_filtered", """
SELECT user_id, strftime(max(ts), '%Y-%m-%d %H:%M:%S.%f') AS newest FROM events
WHERE event_type = 'purchase' GROUP BY user_id
""")
def _max_filtered(spark: SparkSession, folder: str) -> DataFrame:
    newest = aggregates.max_filtered(
        table(spark, folder, "events"), "ts", F.col("event_type") == "purchase", ["user_id"]
    ).where("newest is not null")
    return newest.withColumn("newest", F.date_format("newest", "yyyy-MM-dd HH:mm:ss.SSSSSS"))


@query("count_rows", "SELECT count(*) AS n_rows FROM lineitem")
def _count_rows(spark: SparkSession, folder: str) -> DataFrame:
    return aggregates.count_rows(table(spark, folder, "lineitem"))


@query("distinct_keys", "SELECT DISTINCT l_orderkey, l_suppkey FROM lineitem")
def _distinct_keys(spark: SparkSession, folder: str) -> DataFrame:
    return aggregates.distinct_keys(table(spark, folder, "lineitem"), "l_orderkey", "l_suppkey")


@query("count_distinct_compare", """
SELECT n_left, n_right, n_left > n_right AS left_has_more FROM
  (SELECT (SELECT count(DISTINCT o_orderkey) FROM orders) AS n_left,
          (SELECT count(DISTINCT l_orderkey) FROM lineitem) AS n_right) c
""")
def _count_distinct_compare(spark: SparkSession, folder: str) -> DataFrame:
    orders, lineitem = tables(spark, folder, "orders", "lineitem")
    return aggregates.count_distinct_compare(
        orders, lineitem.withColumnRenamed("l_orderkey", "o_orderkey"), "o_orderkey"
    )


@query("collect_distinct_per_group", """
SELECT user_id, string_agg(DISTINCT event_type, ',' ORDER BY event_type) AS kinds FROM events GROUP BY user_id
""")
def _collect_distinct_per_group(spark: SparkSession, folder: str) -> DataFrame:
    lists = aggregates.collect_distinct_per_group(table(spark, folder, "events"), ["user_id"], "event_type", "kinds")
    return lists.withColumn("kinds", F.array_join("kinds", ","))


@query("any_value_per_group", """
SELECT l_orderkey, min(l_returnflag) AS l_returnflag, min(l_linestatus) AS l_linestatus
FROM lineitem GROUP BY l_orderkey
""")
def _any_value_per_group(spark: SparkSession, folder: str) -> DataFrame:
    return aggregates.any_value_per_group(
        table(spark, folder, "lineitem"), ["l_orderkey"], ["l_returnflag", "l_linestatus"]
    )


@query("concat_accumulate", """
SELECT user_id, concat(string_agg(event_type, '|' ORDER BY event_type DESC), '|') AS kinds
FROM (SELECT DISTINCT user_id, event_type FROM events) d GROUP BY user_id
""")
def _concat_accumulate(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events").withColumn("code", F.col("event_type"))
    return aggregates.concat_accumulate(events, ["user_id"], "event_type", "code", "kinds")


@query("batch_row_counters", """
SELECT o_orderpriority, count(*) AS "Num_Rows_Read", count(*) FILTER (o_orderstatus <> 'P') AS "Num_Rows_Processed",
  count(*) AS "Total_Rows_From_Source", count(*) FILTER (o_orderstatus = 'F') AS "Total_Rows_To_Target"
FROM orders GROUP BY o_orderpriority
""")
def _batch_row_counters(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders")
    return aggregates.batch_row_counters(
        orders, orders.where("o_orderstatus = 'F'"), "o_orderpriority", F.col("o_orderstatus") != "P"
    )


@query("reconcile_counts", """
WITH c AS (SELECT 'orders' AS table_name, (SELECT count(*) FROM orders) AS source_rows,
    (SELECT count(*) FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem)) AS loaded_rows
  UNION ALL SELECT 'customer', (SELECT count(*) FROM customer), (SELECT count(*) FROM customer))
SELECT table_name, source_rows, loaded_rows, source_rows - loaded_rows AS missing_rows,
  CAST(CAST(round(CAST(loaded_rows AS DECIMAL(20,0)) * 100 / source_rows, 2) AS DECIMAL(20,2)) AS DOUBLE) AS percent_loaded
FROM c
""")
def _reconcile_counts(spark: SparkSession, folder: str) -> DataFrame:
    orders, lineitem, customer = tables(spark, folder, "orders", "lineitem", "customer")
    covered = joins.semi_join(orders, lineitem, {"o_orderkey": "l_orderkey"})
    report = aggregates.reconcile_counts({"orders": (orders, covered), "customer": (customer, customer)})
    return report.withColumn("percent_loaded", F.col("percent_loaded").cast("double"))


# --- windows --------------------------------------------------------------------------


@query("latest_row_per_key", """
SELECT user_id, event_id, event_type, value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) v
WHERE rn = 1
""")
def _latest_row_per_key(spark: SparkSession, folder: str) -> DataFrame:
    return windows.latest_row_per_key(
        table(spark, folder, "events"), ["user_id"], [F.col("ts").desc(), F.col("event_id").desc()]
    ).select("user_id", "event_id", "event_type", "value")


@query("surrogate_keys", """
SELECT p_partkey, p_name, 1000 + row_number() OVER (ORDER BY p_name, p_partkey) AS Unique_Key FROM part
""")
def _surrogate_keys(spark: SparkSession, folder: str) -> DataFrame:
    part = table(spark, folder, "part").select("p_partkey", "p_name")
    return windows.surrogate_keys(part, [F.col("p_name"), F.col("p_partkey")], "Unique_Key", offset=1000)
