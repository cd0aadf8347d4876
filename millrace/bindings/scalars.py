"""Scalar functions over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.bindings.inputs import DIRECTORY_SQL, RAW_SQL, directory
from millrace.bindings.registry import EXACT, query, table
from millrace.bindings.scans_and_sinks import scan_raw_messages
from millrace.functions import cleansing, dates, text
from millrace.functions.durations import iso_duration_seconds
from millrace.operators.codes import filter_contains_any, strip_all_values_by_index, strip_last_tag_by_index
from millrace.operators.joins import coalesce_identity
from millrace.operators.lists import explode_delimited, mention_lists, zip_recipients

RAW = f"({RAW_SQL.replace('AS user,', 'AS \"user\",')})"


@query("iso_duration_seconds", """
SELECT l_orderkey, l_linenumber, q, h * 3600 + m * 60 AS seconds,
  0 + m * CASE WHEN m = 0 THEN 1 ELSE 60 END
    + h * CASE WHEN h = 0 THEN 1 WHEN h = m THEN 60 ELSE 3600 END AS legacy_seconds
FROM (SELECT l_orderkey, l_linenumber, l_extendedprice AS q, CAST(l_quantity AS BIGINT) AS h,
      CAST(l_linenumber AS BIGINT) AS m FROM lineitem) v
""")
def _iso_duration_seconds(spark: SparkSession, folder: str) -> DataFrame:
    duration = F.concat(F.lit("PT"), F.col("l_quantity").cast("int"), F.lit("H"), "l_linenumber", F.lit("M0S"))
    return table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_extendedprice").alias("q"),
        iso_duration_seconds(duration).alias("seconds"),
        iso_duration_seconds(duration, legacy=True).alias("legacy_seconds"),
    )


@query("string_to_bits", """
SELECT doc_id, array_to_string(list_transform(regexp_extract_all(source, '.'),
    lambda c: lpad(bin(ord(c)), greatest(8, length(bin(ord(c))))::INTEGER, '0')), '') AS bits,
  md5(array_to_string(list_transform(regexp_extract_all(text, '(?s).'),
    lambda c: lpad(bin(ord(c)), greatest(8, length(bin(ord(c))))::INTEGER, '0')), '')) AS text_digest
FROM documents
""")
def _string_to_bits(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents").select(
        "doc_id", cleansing.string_to_bits(F.col("source")).alias("bits"),
        F.md5(cleansing.string_to_bits(F.col("text"))).alias("text_digest"),
    )


def _order_dates(spark: SparkSession, folder: str) -> DataFrame:
    """Order dates as text, with '0' for open and blanks for partial orders."""
    day = F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss")
    status = F.col("o_orderstatus")
    return table(spark, folder, "orders").select(
        "o_orderkey", F.when(status == "O", "0").when(status == "P", " ").otherwise(day).alias("day")
    )


@query("cast_datetime", """
SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') END AS cast_ts
FROM orders
""")
def _cast_datetime(spark: SparkSession, folder: str) -> DataFrame:
    rows = _order_dates(spark, folder).withColumn("day", F.when(F.col("day") != "0", F.col("day")))
    return rows.select("o_orderkey", dates.format_seconds(dates.cast_datetime(F.col("day"))).alias("cast_ts"))


@query("zero_to_null_date", """
SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') END AS start_ts
FROM orders
""")
def _zero_to_null_date(spark: SparkSession, folder: str) -> DataFrame:
    return _order_dates(spark, folder).select(
        "o_orderkey", dates.format_seconds(dates.zero_to_null_date(F.col("day"))).alias("start_ts")
    )


@query("blank_to_null", """
SELECT o_orderkey, CASE o_orderstatus WHEN 'O' THEN '0'
  WHEN 'F' THEN strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') END AS day FROM orders
""")
def _blank_to_null(spark: SparkSession, folder: str) -> DataFrame:
    return cleansing.blanks_to_null(_order_dates(spark, folder))


@query("date_sentinel_roundtrip", """
SELECT o_orderkey,
  CASE o_orderstatus WHEN 'O' THEN '0' WHEN 'P' THEN '2999-12-31'
       ELSE strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') END AS at_edge,
  CASE o_orderstatus WHEN 'O' THEN '0' WHEN 'F' THEN strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') END AS day
FROM orders
""")
def _date_sentinel_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    return _order_dates(spark, folder).select(
        "o_orderkey", dates.blank_date_to_sentinel(F.col("day")).alias("at_edge"),
        dates.date_sentinel_roundtrip(F.col("day")).alias("day"),
    )


def _customers_with_gaps(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "customer").select(
        "c_custkey", F.nullif("c_mktsegment", F.lit("BUILDING")).alias("segment"),
        F.when(F.col("c_acctbal") > 0, F.col("c_name")).alias("name"),
    )


@query("fill_required_strings", """
SELECT c_custkey, coalesce(nullif(c_mktsegment, 'BUILDING'), '') AS segment,
  CASE WHEN c_acctbal > 0 THEN c_name END AS name FROM customer
""")
def _fill_required_strings(spark: SparkSession, folder: str) -> DataFrame:
    return cleansing.fill_required_strings(_customers_with_gaps(spark, folder), ["segment", "c_custkey"])


@query("fill_all_blank", """
SELECT c_custkey, coalesce(nullif(c_mktsegment, 'BUILDING'), ' ') AS segment,
  CASE WHEN c_acctbal > 0 THEN c_name ELSE ' ' END AS name FROM customer
""")
def _fill_all_blank(spark: SparkSession, folder: str) -> DataFrame:
    return cleansing.fill_all_blank(_customers_with_gaps(spark, folder))


# --- mentions and lists ----------------------------------------------------------------

_MENTIONED = f"""
WITH raw AS (SELECT * FROM {RAW} r), dir AS ({DIRECTORY_SQL}),
ids AS (SELECT ts, u.p, u.id FROM raw, LATERAL (
  SELECT unnest(range(1, len(l) + 1)) AS p, unnest(l) AS id
  FROM (SELECT regexp_extract_all(text, '<.([^>]*)>', 1) AS l) e) u)
"""


@query("extract_mentions", _MENTIONED + """,
lists AS (SELECT ts, string_agg(ids.id, '|' ORDER BY p) AS ids,
  string_agg(coalesce(dir.name, ''), '|' ORDER BY p) AS names,
  string_agg(coalesce(dir.email, ''), '|' ORDER BY p) AS emails
  FROM ids LEFT JOIN dir ON dir.id = ids.id AND dir.email IS NOT NULL GROUP BY ts)
SELECT raw.ts, lists.ids AS to_ids, lists.names AS to_names, lists.emails AS to_emails,
  CASE WHEN lists.ts IS NULL THEN raw.text ELSE trim(regexp_extract(raw.text, '.*>(.*)$', 1)) END AS msg_txt,
  CASE WHEN lists.ts IS NOT NULL THEN trim(regexp_extract(raw.text, '.*>(.*)$', 1)) END AS legacy_txt
FROM raw LEFT JOIN lists ON lists.ts = raw.ts
""")
def _extract_mentions(spark: SparkSession, folder: str) -> DataFrame:
    raw = scan_raw_messages(spark, folder)
    return mention_lists(raw, directory(spark, folder), ["ts"], "text").select(
        "ts", F.col("TO_USR_SRC_ID").alias("to_ids"), F.col("TO_USRNM").alias("to_names"),
        F.col("TO_USR_EMAIL").alias("to_emails"),
        text.text_after_mentions(F.col("text")).alias("msg_txt"),
        text.text_after_mentions(F.col("text"), legacy=True).alias("legacy_txt"),
    )


_SLOTS_SQL = """
(SELECT event_id, concat('U', lpad(CAST(user_id AS VARCHAR), 8, '0'), '||', event_type) AS l FROM events)
"""


@query("explode_delimited", f"""
SELECT event_id, u.pos, u.item FROM {_SLOTS_SQL} s, LATERAL (
  SELECT unnest(range(1, 4)) AS pos, unnest(string_split(l, '|')) AS item) u
""")
def _explode_delimited(spark: SparkSession, folder: str) -> DataFrame:
    slots = F.concat(F.lit("U"), F.lpad(F.col("user_id").cast("string"), 8, "0"), F.lit("||"), "event_type")
    rows = table(spark, folder, "events").select("event_id", slots.alias("l"))
    return explode_delimited(rows, "l").withColumn("pos", F.col("pos").cast("bigint"))


@query("zip_recipients", f"""
SELECT event_id, u.pos, u.to_id, u.partner FROM (
  SELECT event_id, concat(l, '|W', lpad(CAST(event_id % 10 AS VARCHAR), 8, '0')) AS ids,
    concat('a', event_id, '|b||d', event_id) AS partners FROM {_SLOTS_SQL} s) z, LATERAL (
  SELECT unnest(range(1, 5)) AS pos, unnest(string_split(ids, '|')) AS to_id,
    unnest(string_split(partners, '|')) AS partner) u
WHERE regexp_matches(u.to_id, '^[UW][A-Z0-9]{{8}}$')
""")
def _zip_recipients(spark: SparkSession, folder: str) -> DataFrame:
    ids = F.concat(
        F.lit("U"), F.lpad(F.col("user_id").cast("string"), 8, "0"), F.lit("||"), "event_type", F.lit("|W"),
        F.lpad((F.col("event_id") % 10).cast("string"), 8, "0"),
    )
    partners = F.concat(F.lit("a"), "event_id", F.lit("|b||d"), "event_id")
    rows = table(spark, folder, "events").select("event_id", ids.alias("ids"), partners.alias("partners"))
    return zip_recipients(rows, "ids", "partners").withColumn("pos", F.col("pos").cast("bigint"))


@query("join_directory", f"""
WITH dir AS ({DIRECTORY_SQL})
SELECT event_id, coalesce(dir.name, '') AS to_name, coalesce(dir.email, '') AS to_email
FROM events LEFT JOIN dir
  ON dir.id = concat('U', lpad(CAST(CAST(floor(value * 10) AS BIGINT) AS VARCHAR), 8, '0')) AND email IS NOT NULL
""")
def _join_directory(spark: SparkSession, folder: str) -> DataFrame:
    number = F.floor(F.col("value") * 10).cast("string")
    rows = table(spark, folder, "events").select(
        "event_id", F.concat(F.lit("<@U"), F.lpad(number, 8, "0"), F.lit(">")).alias("text")
    )
    return mention_lists(rows, directory(spark, folder), ["event_id"], "text").select(
        "event_id", F.col("TO_USRNM").alias("to_name"), F.col("TO_USR_EMAIL").alias("to_email")
    )


@query("coalesce_identity", f"""
WITH dir AS (SELECT * FROM ({DIRECTORY_SQL}) d WHERE email IS NOT NULL), raw AS (SELECT * FROM {RAW} r)
SELECT ts, CASE WHEN username IS NOT NULL THEN n.id ELSE raw."user" END AS from_id,
  coalesce(username, i.name) AS from_name,
  CASE WHEN username IS NOT NULL THEN n.email ELSE i.email END AS from_email
FROM raw LEFT JOIN dir n ON n.name = username LEFT JOIN dir i ON i.id = raw."user"
""")
def _coalesce_identity(spark: SparkSession, folder: str) -> DataFrame:
    people = directory(spark, folder).where("email is not null")
    return coalesce_identity(scan_raw_messages(spark, folder), people).select(
        "ts", "from_id", "from_name", "from_email"
    )


# --- tags and values --------------------------------------------------------------------

TAGS, VALUES = ["red", "blue", "hot", "cold"], ["bolt", "gear", "ring", "rod"]


def _fold_sql(codes: list[str], trim: str, found: str) -> str:
    """One CTE per code: cut it out and note it."""
    parts = ["f0 AS (SELECT p_partkey, concat('a ', p_name, ' ', p_name) AS t, '' AS found FROM part)"]
    for i, code in enumerate(codes):
        parts.append(
            f"f{i + 1} AS (SELECT p_partkey, CASE WHEN contains(t, '{code}') "
            f"THEN {trim}(replace(t, '{code}', '')) ELSE t END AS t, "
            f"CASE WHEN contains(t, '{code}') THEN {found.format(code=code)} ELSE found END AS found FROM f{i})"
        )
    return "WITH " + ", ".join(parts)


def _part_text(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "part").select(
        "p_partkey", F.concat(F.lit("a "), "p_name", F.lit(" "), "p_name").alias("t")
    )


@query("strip_last_tag", _fold_sql(TAGS, "ltrim", "'{code}'")
       + " SELECT p_partkey, t AS msg_txt, found AS tag FROM f4")
def _strip_last_tag(spark: SparkSession, folder: str) -> DataFrame:
    rows = _part_text(spark, folder).withColumn("f", text.strip_last_tag(F.col("t"), TAGS))
    return rows.select("p_partkey", F.col("f.text").alias("msg_txt"), F.col("f.tag").alias("tag"))


@query("strip_all_values", _fold_sql(VALUES, "rtrim", "concat('{code}|', found)")
       + " SELECT p_partkey, t AS msg_txt, found AS value_cd FROM f4")
def _strip_all_values(spark: SparkSession, folder: str) -> DataFrame:
    rows = _part_text(spark, folder).withColumn("f", text.strip_all_values(F.col("t"), VALUES))
    return rows.select(
        "p_partkey", F.col("f.text").alias("msg_txt"), text.reversed_pipe_list(F.col("f.values")).alias("value_cd")
    )


def _code_table(spark: SparkSession, codes: list[str]) -> DataFrame:
    return spark.createDataFrame(list(enumerate(codes)), "position int, code string")


@query("strip_last_tag_by_index", _fold_sql(TAGS, "ltrim", "'{code}'")
       + " SELECT p_partkey, t AS msg_txt, found AS tag FROM f4")
def _strip_last_tag_by_index(spark: SparkSession, folder: str) -> DataFrame:
    """The same with the dictionary in a table, as thousands of codes need it."""
    rows = strip_last_tag_by_index(_part_text(spark, folder), "t", _code_table(spark, TAGS))
    return rows.select("p_partkey", F.col("f.text").alias("msg_txt"), F.col("f.tag").alias("tag"))


@query("strip_all_values_by_index", _fold_sql(VALUES, "rtrim", "concat('{code}|', found)")
       + " SELECT p_partkey, t AS msg_txt, found AS value_cd FROM f4")
def _strip_all_values_by_index(spark: SparkSession, folder: str) -> DataFrame:
    rows = strip_all_values_by_index(_part_text(spark, folder), "t", _code_table(spark, VALUES))
    return rows.select(
        "p_partkey", F.col("f.text").alias("msg_txt"), text.reversed_pipe_list(F.col("f.values")).alias("value_cd")
    )


@query("filter_contains_any", """
SELECT c_custkey, c_name FROM customer
WHERE EXISTS (SELECT 1 FROM supplier WHERE s_suppkey % 3 = 0 AND contains(c_name, right(s_name, 4)))
""")
def _filter_contains_any(spark: SparkSession, folder: str) -> DataFrame:
    """Customers whose name holds any of the codes of a table."""
    codes = table(spark, folder, "supplier").where("s_suppkey % 3 = 0").select(
        F.col("s_suppkey").alias("position"), F.expr("right(s_name, 4)").alias("code"))
    return filter_contains_any(table(spark, folder, "customer").select("c_custkey", "c_name"), "c_name", codes)


# --- composed messages ----------------------------------------------------------------

_GROUPED_SQL = """
(SELECT o_custkey, list_sort(list(DISTINCT lower(substr(o_orderpriority, 3)))) AS names,
   list_sort(list(DISTINCT concat(':', o_orderstatus, ':'))) AS vals FROM orders GROUP BY o_custkey)
"""


def _grouped(spark: SparkSession, folder: str) -> DataFrame:
    """Per customer: priorities as recipients, states as values, repeats removed first."""
    pairs = table(spark, folder, "orders").select(
        "o_custkey", F.lower(F.expr("substr(o_orderpriority, 3)")).alias("name"),
        F.concat(F.lit(":"), "o_orderstatus", F.lit(":")).alias("val"),
    ).distinct()
    return pairs.groupBy("o_custkey").agg(
        F.sort_array(F.collect_set("name")).alias("names"), F.sort_array(F.collect_set("val")).alias("vals")
    )


@query("compose_message", f"""
SELECT o_custkey, concat(array_to_string(list_transform(names, lambda x: concat('@', x)), ' '), ' :tag: customer ',
  o_custkey, ' ', array_to_string(vals, ' ')) AS message FROM {_GROUPED_SQL} g
""")
def _compose_message(spark: SparkSession, folder: str) -> DataFrame:
    return _grouped(spark, folder).select("o_custkey", text.compose_message(
        F.col("names"), F.lit(":tag:"), F.concat(F.lit("customer "), "o_custkey"), F.col("vals")
    ).alias("message"))


@query("expand_reactions", f"""
SELECT o_custkey, replace(u.r, ':', '') AS reaction FROM {_GROUPED_SQL} g,
  LATERAL (SELECT unnest(flatten(list_transform(vals, lambda v: [':tag:', v]))) AS r) u
UNION ALL SELECT c_custkey, 'tag' FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)
""")
def _expand_reactions(spark: SparkSession, folder: str) -> DataFrame:
    customer = table(spark, folder, "customer").select(F.col("c_custkey").alias("o_custkey"))
    rows = customer.join(_grouped(spark, folder), "o_custkey", "left").withColumn(
        "vals", F.coalesce("vals", F.array(F.lit(" ")))
    )
    return rows.select("o_custkey", F.explode(text.reactions(F.lit(":tag:"), F.col("vals"))).alias("reaction"))


# --- JSON ---------------------------------------------------------------------------------


@query("json_sections", f"""
SELECT ts, CASE WHEN n_reactions > 0 THEN concat('[{{"name":"', event_type, '","count":', n_reactions, '}}]') END AS reactn_sctn,
  CASE WHEN n_edit = 0 THEN concat('{{"user":"U1","ts":"', ts, '"}}') END AS edited FROM {RAW} r
""")
def _json_sections(spark: SparkSession, folder: str) -> DataFrame:
    return scan_raw_messages(spark, folder).select(
        "ts", F.to_json("reactions").alias("reactn_sctn"), F.to_json("edited").alias("edited")
    )


@query("json_extract", """
SELECT event_id, json_extract_string(props, '$.k') AS k, json_extract_string(props, '$.zz') AS zz FROM events
""")
def _json_extract(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").select(
        "event_id", F.get_json_object("props", "$.k").alias("k"), F.get_json_object("props", "$.zz").alias("zz")
    )


# --- dates ----------------------------------------------------------------------------------


@query("format_seconds", "SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts FROM events")
def _format_seconds(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").select("event_id", dates.format_seconds(F.col("ts")).alias("ts"))


@query("epoch_seconds", """
SELECT event_id, CAST(CAST(epoch_us(ts) AS DECIMAL(20,0)) / 1000000 AS DECIMAL(20,6))::VARCHAR AS epoch_key,
  epoch_us(ts) AS epoch_micros FROM events
""")
def _epoch_seconds(spark: SparkSession, folder: str) -> DataFrame:
    seconds = dates.epoch_seconds(F.col("ts"))
    return table(spark, folder, "events").select(
        "event_id", seconds.cast("string").alias("epoch_key"), (seconds * 1000000).cast("bigint").alias("epoch_micros")
    )


@query("date_window_bounds", """
SELECT o_orderkey, strftime(o_orderdate - INTERVAL 30 DAY, '%Y-%m-%d %H:%M:%S.%f') AS look_back,
  concat(strftime(o_orderdate, '%Y-%m-%d'), ' 23:59:59.999999') AS day_end,
  concat(strftime(o_orderdate - INTERVAL 1 DAY, '%Y-%m-%d'), ' 23:59:59.999999') AS previous_day_end FROM orders
""")
def _date_window_bounds(spark: SparkSession, folder: str) -> DataFrame:
    day = F.col("o_orderdate")
    return table(spark, folder, "orders").select(
        "o_orderkey", F.date_format(dates.days_before(day, 30), EXACT).alias("look_back"),
        F.date_format(dates.day_end(day), EXACT).alias("day_end"),
        F.date_format(dates.previous_day_end(day), EXACT).alias("previous_day_end"),
    )


@query("cast_scalar", """
SELECT event_id, CAST(trunc(value) AS BIGINT) AS whole, CAST(user_id AS VARCHAR) AS user_text FROM events
""")
def _cast_scalar(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").select(
        "event_id", F.col("value").cast("bigint").alias("whole"), F.col("user_id").cast("string").alias("user_text")
    )
