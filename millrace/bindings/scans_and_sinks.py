"""Scans, sinks and table-state writes."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.bindings.inputs import (
    PLAN_NAME_DUCK,
    RAW_SCHEMA,
    RAW_SQL,
    directory,
    plan_documents,
    raw_messages,
)
from millrace.bindings.registry import query, table, tables
from millrace.operators.projections import project
from millrace.operators.state import Child, cascade_delete, delete_batch, mark_claimed
from millrace.plans.project_plan import BATCH, plan_schema, PlanMapping
from millrace.session import scratch_path, settle
from millrace.sinks import tables as sinks
from millrace.sources.files import (
    CORRUPT,
    MEMBER,
    csv_folder_tables,
    csv_records,
    json_messages_scan,
    members,
    split_records,
    xml_records,
)
from millrace.sources.json_pages import json_items, split_items
from millrace.sources.tables import control_table_scan, table_projected_scan


#: Damaged customers of a CSV export: a balance that is no number, a date in place of the nation, a line that breaks off.
CSV_DAMAGE = "CASE WHEN c_custkey % 59 = 2 THEN 'number of cells' WHEN c_custkey % 53 = 1 AND c_custkey % 47 = 1 THEN " \
    "'c_nationkey, c_acctbal' WHEN c_custkey % 53 = 1 THEN 'c_acctbal' END"


@query("csv_scan", f"""
WITH c AS (SELECT *, {CSV_DAMAGE} AS why FROM customer)
SELECT * REPLACE (CAST(NULL AS VARCHAR) AS why), CAST(NULL AS VARCHAR) AS record_key FROM c WHERE why IS NULL
UNION ALL BY NAME SELECT why, CAST(c_custkey AS VARCHAR) AS record_key FROM c WHERE why IS NOT NULL
""")
def _csv_scan(spark: SparkSession, folder: str) -> DataFrame:
    """A folder of CSV files: readable lines, then damaged ones with the reason."""
    customer = table(spark, folder, "customer").withColumn("why", F.expr(CSV_DAMAGE))
    names = [c for c in customer.columns if c != "why"]
    first, second = scratch_path(spark, "csv"), scratch_path(spark, "csv")
    damaged = {"c_acctbal": ("%c_acctbal%", "n/a"), "c_nationkey": ("%c_nationkey%", "2024-01-01")}
    customer.where("why IS NULL OR why <> 'number of cells'").select(*[
        F.when(F.col("why").like(damaged[c][0]), damaged[c][1]).otherwise(F.col(c).cast("string")).alias(c) if c in damaged else F.col(c)
        for c in names
    ]).write.option("header", True).csv(first)
    # Lines that break off have no writer: a file of text, its header first.
    lines = customer.where("why = 'number of cells'").select(F.col("c_custkey").cast("string").alias("l"), F.concat_ws(",", "c_custkey", "c_name").alias("value"))
    header = spark.createDataFrame([("", ",".join(names))], lines.schema)
    lines.unionByName(header).repartition(1).sortWithinPartitions("l").select("value").write.text(second)
    records = settle(csv_records(spark, [first, second], table(spark, folder, "customer").schema), "records")
    good, rejects = split_records(records)
    bad = rejects.select(F.col("reason").alias("why"), F.split("record", ",")[0].alias("record_key"))
    return good.unionByName(bad, allowMissingColumns=True)


@query("csv_folder_scan", """
SELECT * FROM (SELECT 'customer' AS table_name, * FROM customer)
UNION ALL BY NAME SELECT * FROM (SELECT 'supplier' AS table_name, * FROM supplier)
""")
def _csv_folder_scan(spark: SparkSession, folder: str) -> DataFrame:
    given = dict(zip(("customer", "supplier"), tables(spark, folder, "customer", "supplier")))
    root = scratch_path(spark, "csv-folder")
    for name, df in given.items():
        # The files' columns stand in another order than the schemas'.
        df.select(*reversed(df.columns)).write.option("header", True).csv(f"{root}/{name}.csv")
    given["supplier"].write.json(f"{root}/stray")
    read = csv_folder_tables(spark, root, {name: df.schema for name, df in given.items()})
    return reduce(
        lambda a, b: a.unionByName(b, allowMissingColumns=True),
        [df.select(F.lit(name).alias("table_name"), "*") for name, df in read.items()],
    )


@query("gzip_csv_stage", "SELECT * FROM part")
def _gzip_csv_stage(spark: SparkSession, folder: str) -> DataFrame:
    return sinks.gzip_csv_stage(table(spark, folder, "part"), scratch_path(spark, "gzip"))


@query("table_full_scan", "SELECT * FROM supplier")
def _table_full_scan(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "supplier")


@query("table_projected_scan", "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem")
def _table_projected_scan(spark: SparkSession, folder: str) -> DataFrame:
    return table_projected_scan(table(spark, folder, "lineitem"), '"l_orderkey","l_linenumber","l_quantity"')


@query("control_table_scan", """
SELECT concat(p_type, '_', p_partkey) AS Source_Table_Nm,
       concat('"', replace(p_name, ' ', '","'), '"') AS Source_Column_Names
FROM part WHERE p_size >= 10 AND p_brand = 'Brand#7'
""")
def _control_table_scan(spark: SparkSession, folder: str) -> DataFrame:
    control = table(spark, folder, "part").select(
        F.col("p_brand").alias("Source_Db_Nm"),
        F.concat("p_type", F.lit("_"), "p_partkey").alias("Source_Table_Nm"),
        F.concat(F.lit('"'), F.replace("p_name", F.lit(" "), F.lit('","')), F.lit('"'))
        .alias("Source_Column_Names"),
        F.when(F.col("p_size") >= 10, "Y").otherwise("N").alias("Extract_Process_Active_Ind"),
    )
    return control_table_scan(control, "Brand#7")


#: Damaged documents: a wrong end tag, and a version that is no number.
PLAN_DAMAGE = "CASE WHEN o_orderkey % 89 = 7 THEN 'no XML' WHEN o_orderkey % 97 = 11 THEN 'violates the schema' END"
#: What a document must begin with.
PLAN_XSD = """<xs:schema xmlns:xs="http://www.w3.org/2001/XMLSchema"><xs:element name="Project"><xs:complexType><xs:sequence>
<xs:element name="Name" type="xs:string"/><xs:element name="SaveVersion" type="xs:integer"/>
<xs:any minOccurs="0" maxOccurs="unbounded" processContents="skip"/></xs:sequence></xs:complexType></xs:element></xs:schema>"""


#: Documents a file: a compressed file is read by one task.
PLAN_FILE_ROWS = 20_000


def write_plans(spark: SparkSession, folder: str, damage: str = "CAST(NULL AS STRING)") -> str:
    """Plan documents, one a line, compressed; ``damage`` says by ``o_orderkey`` which are broken (``PLAN_DAMAGE``)."""
    path = scratch_path(spark, "plans-xml")
    why = F.expr(damage.replace("o_orderkey", "_key"))
    # The name has only a part of large numbers; a document without a name is not damaged.
    documents = plan_documents(spark, folder).withColumn("why", F.when(F.col("Name").isNotNull(), why))
    text = F.to_xml(F.struct(*[
        F.when(F.col("why") == "violates the schema", "one").otherwise(F.col(c)).alias(c) if c == "SaveVersion" else F.col(c)
        for c in documents.columns if c not in ("_key", "why")
    ]), {"rowTag": "Project", "indent": ""})
    broken = F.when(F.col("why") == "no XML", F.replace(text, F.lit("</SaveVersion>"), F.lit("</Saved>"))).otherwise(text)
    lines = documents.select(F.replace(broken, F.lit("\n"), F.lit("")).alias("value"))
    # Markup takes many times the room of what it marks, and there is more of it than of anything else here.
    lines.write.option("compression", "gzip").option("maxRecordsPerFile", PLAN_FILE_ROWS).text(path)
    return path


def write_xsd(spark: SparkSession) -> str:
    """The schema file in the shared folder, by its path."""
    path = scratch_path(spark, "xsd")
    spark.createDataFrame([(PLAN_XSD.replace("\n", ""),)], "value string").coalesce(1).write.text(path)
    return spark.read.format("binaryFile").load(path).select("path").first()["path"]


@query("xml_hierarchy_scan", f"""
WITH o AS (SELECT *, {PLAN_DAMAGE} AS why FROM orders)
SELECT {PLAN_NAME_DUCK} AS Batch_Run_Id, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') AS StartDate,
  1 + o_orderkey % 3 AS n_tasks, concat('task ', 1 + o_orderkey % 3) AS last_task,
  o_orderkey % 4 AS n_times, CAST(NULL AS VARCHAR) AS reason
FROM o WHERE why IS NULL
UNION ALL SELECT {PLAN_NAME_DUCK}, NULL, CAST(NULL AS BIGINT), NULL, CAST(NULL AS BIGINT), why FROM o WHERE why IS NOT NULL
""")
def _xml_hierarchy_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Readable documents; broken ones and those against the schema with the reason."""
    path = write_plans(spark, folder, PLAN_DAMAGE)
    records = xml_records(spark, path, "Project", plan_schema(PlanMapping()), F.col("Name"), BATCH, write_xsd(spark), multi_line=False)
    times = F.get(F.get("Calendars.Calendar", F.lit(0))["WeekDays"]["WeekDay"], F.lit(1))["WorkingTimes"]["WorkingTime"]
    # What is asked of a document is taken before the settling, so that its branches are not written once more; rejects may have parts of it.
    asked = records.select(
        BATCH, "StartDate", F.size("Tasks.Task").cast("bigint").alias("n_tasks"),
        F.try_element_at("Tasks.Task.Name", F.lit(-1)).alias("last_task"),
        F.coalesce(F.array_size(times), F.lit(0)).cast("bigint").alias("n_times"),
        "file_name", "reason", CORRUPT,
    )
    good, rejects = split_records(settle(asked, "records"))
    bad = rejects.select(F.regexp_extract("record", "<Name>([^<]+)</Name>", 1).alias(BATCH), "reason")
    return good.unionByName(bad, allowMissingColumns=True)


def write_raw_messages(spark: SparkSession, folder: str) -> str:
    """A message export: pages that hold a list of messages."""
    path = scratch_path(spark, "messages-json")
    raw_messages(spark, folder).select(F.array(F.struct("*")).alias("messages")).write.json(path)
    return path


def scan_raw_messages(spark: SparkSession, folder: str) -> DataFrame:
    schema = T.StructType.fromDDL(RAW_SCHEMA)
    return json_messages_scan(spark, write_raw_messages(spark, folder), schema)


def _write_pages(rows: DataFrame, field: str, number: str, per_page: int, name: str) -> str:
    """Pages of ``per_page`` records (column ``record``), by their ``number``; some pages are cut off."""
    pages = rows.groupBy(F.expr(f"{number} div {per_page}").alias("page")).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(number, "record"))), lambda r: r["record"]), ",").alias("list"))
    text = F.concat(F.lit('{"page":'), F.col("page").cast("string"), F.lit(f',"{field}":['), "list", F.lit("]}"))
    whole = F.when(F.col("page") % 41 == 2, F.substr(text, F.lit(1), F.length(text) - 3)).otherwise(text)
    path = scratch_path(rows.sparkSession, name)
    pages.select(whole.alias("value")).write.text(path)
    return path


#: Damaged messages: an object where a number belongs, a text in place of the message, a text deep inside.
MESSAGE_DAMAGE = "CASE WHEN event_id % 97 = 5 THEN 'reply_count' WHEN event_id % 101 = 7 THEN 'no object' " \
    "WHEN event_id % 103 = 9 AND event_id % 4 > 0 THEN 'reactions' END"
MEMBER_DAMAGE = "CASE WHEN c_custkey % 61 = 3 THEN 'no object' WHEN c_custkey % 67 = 5 THEN 'profile' END"


def write_damaged_messages(spark: SparkSession, folder: str) -> str:
    """Pages of four messages: some messages are damaged (``MESSAGE_DAMAGE``) and some pages cut off."""
    text = F.to_json(F.struct(*T.StructType.fromDDL(RAW_SCHEMA).fieldNames()))
    number = F.regexp_extract("ts", r"\.0*([0-9]+)$", 1).cast("long")
    rows = raw_messages(spark, folder).select(number.alias("event_id"), text.alias("record")).withColumn("why", F.expr(MESSAGE_DAMAGE))
    record = (
        F.when(F.col("why") == "reply_count", F.regexp_replace("record", r'"reply_count":\d+', '"reply_count":{"n":1}'))
        .when(F.col("why") == "no object", F.lit('"lost"'))
        .when(F.col("why") == "reactions", F.regexp_replace("record", r'"count":\d+', '"count":"few"')).otherwise(F.col("record"))
    )
    return _write_pages(rows.select("event_id", record.alias("record")), "messages", "event_id", 4, "messages-pages")


@query("json_messages_scan", f"""
WITH r AS (
  SELECT *, {MESSAGE_DAMAGE} AS why, event_id // 4 AS page,
    row_number() OVER (PARTITION BY event_id // 4 ORDER BY event_id) - 1 AS place
  FROM ({RAW_SQL.replace('AS user,', 'AS "user",')}) x)
SELECT ts, thread_ts, subtype, text, username, reply_count,
  CASE WHEN n_reactions > 0 THEN event_type END AS first_reaction,
  CAST(NULL AS BIGINT) AS position, CAST(NULL AS VARCHAR) AS reason, CAST(NULL AS BIGINT) AS page
FROM r WHERE page % 41 <> 2 AND why IS NULL
UNION ALL SELECT NULL, NULL, NULL, NULL, NULL, NULL, NULL, place, why, NULL FROM r WHERE page % 41 <> 2 AND why IS NOT NULL
UNION ALL SELECT DISTINCT NULL, NULL, NULL, NULL, NULL, CAST(NULL AS BIGINT), NULL, CAST(NULL AS BIGINT), 'no JSON', page FROM r WHERE page % 41 = 2
""")
def _json_messages_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Readable messages, then damaged ones with their place and pages cut off with their number."""
    items = settle(json_items(spark, write_damaged_messages(spark, folder), "messages", T.StructType.fromDDL(RAW_SCHEMA)), "items")
    good, rejects = split_items(items)
    read = good.select(
        "ts", "thread_ts", "subtype", "text", "username", "reply_count", F.col("reactions")[0]["name"].alias("first_reaction"))
    return read.unionByName(_rejected(rejects), allowMissingColumns=True)


def _rejected(rejects: DataFrame) -> DataFrame:
    number = F.regexp_extract("record", r'^\{"page":(\d+),', 1)
    return rejects.select(
        F.col("position").cast("long").alias("position"), "reason",
        F.when(F.col("position").isNull(), number.cast("long")).alias("page"),
    )


@query("json_users_scan", f"""
WITH r AS (
  SELECT *, {MEMBER_DAMAGE} AS why, c_custkey // 5 AS page,
    row_number() OVER (PARTITION BY c_custkey // 5 ORDER BY c_custkey) - 1 AS place FROM customer)
SELECT concat('U', lpad(CAST(c_custkey AS VARCHAR), 8, '0')) AS id, c_name AS name,
  concat('c', c_custkey, '@x.org') AS email,
  CAST(NULL AS BIGINT) AS position, CAST(NULL AS VARCHAR) AS reason, CAST(NULL AS BIGINT) AS page
FROM r WHERE c_acctbal > 0 AND page % 41 <> 2 AND why IS NULL
UNION ALL SELECT NULL, NULL, NULL, place, why, NULL FROM r WHERE page % 41 <> 2 AND why IS NOT NULL
UNION ALL SELECT DISTINCT NULL, NULL, NULL, CAST(NULL AS BIGINT), 'no JSON', page FROM r WHERE page % 41 = 2
""")
def _json_users_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Members with an address, then damaged members and pages."""
    number = F.substring("id", 2, 8).cast("long")
    record = F.to_json(F.struct("id", "name", F.struct("email").alias("profile")))
    rows = directory(spark, folder).select(number.alias("c_custkey"), record.alias("record")).withColumn("why", F.expr(MEMBER_DAMAGE))
    damaged = (
        F.when(F.col("why") == "no object", F.lit("[1]"))
        .when(F.col("why") == "profile", F.regexp_replace("record", r'"profile":\{[^}]*\}', '"profile":"gone"')).otherwise(F.col("record"))
    )
    path = _write_pages(rows.select("c_custkey", damaged.alias("record")), "members", "c_custkey", 5, "users-pages")
    good, rejects = split_items(settle(json_items(spark, path, "members", MEMBER), "items"))
    return members(good).unionByName(_rejected(rejects), allowMissingColumns=True)


@query("truncate_load", "SELECT * FROM customer")
def _truncate_load(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "truncate")
    customer = table(spark, folder, "customer")
    sinks.truncate_load(customer, path)
    return sinks.truncate_load(customer, path)


@query("append_load", """
SELECT c_custkey, c_name, CAST(2 AS BIGINT) AS copies FROM customer
""")
def _append_load(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "append")
    rows = table(spark, folder, "customer").select("c_custkey", "c_name")
    sinks.append_load(rows, path)
    return sinks.append_load(rows, path).groupBy("c_custkey", "c_name").agg(
        F.count(F.lit(1)).alias("copies")
    )


@query("land_then_main", "SELECT c_custkey, c_name, c_mktsegment FROM customer")
def _land_then_main(spark: SparkSession, folder: str) -> DataFrame:
    return sinks.land_then_main(
        table(spark, folder, "customer"), scratch_path(spark, "land"), scratch_path(spark, "main"),
        ["c_custkey", "c_name", "c_mktsegment"],
    )


@query("ctas_temp", """
SELECT o_custkey, count(*) AS n_orders, max(strftime(o_orderdate, '%Y-%m-%d %H:%M:%S')) AS last_order
FROM orders WHERE o_orderstatus = 'F' GROUP BY o_custkey
""")
def _ctas_temp(spark: SparkSession, folder: str) -> DataFrame:
    finished = table(spark, folder, "orders").where("o_orderstatus = 'F'")
    sinks.temp_table(finished, "finished_orders")
    return spark.sql("""
        SELECT o_custkey, count(*) AS n_orders,
               date_format(max(o_orderdate), 'yyyy-MM-dd HH:mm:ss') AS last_order
        FROM finished_orders GROUP BY o_custkey""")


@query("delete_batch", """
SELECT o_orderkey, o_orderpriority, o_totalprice FROM orders WHERE o_orderpriority <> '1-URGENT'
""")
def _delete_batch(spark: SparkSession, folder: str) -> DataFrame:
    orders = project(table(spark, folder, "orders"), ["o_orderkey", "o_orderpriority", "o_totalprice"])
    return delete_batch(orders, "o_orderpriority", "1-URGENT")


@query("idempotent_batch_replace", """
SELECT 'partition' AS layout, o_orderkey, o_orderpriority,
  CASE WHEN o_orderpriority = '1-URGENT' THEN o_totalprice * 2 ELSE o_totalprice END AS o_totalprice FROM orders
WHERE o_orderpriority <> '5-LOW'
UNION ALL SELECT 'bucket', o_orderkey, o_orderpriority,
  CASE WHEN c_mktsegment = 'BUILDING' THEN o_totalprice * 2 ELSE o_totalprice END
FROM orders JOIN customer ON o_custkey = c_custkey WHERE c_mktsegment <> 'MACHINERY'
""")
def _idempotent_batch_replace(spark: SparkSession, folder: str) -> DataFrame:
    """Batches by priority in partitions of their own, and by customer in buckets, each delivered again twice.

    The later deliveries have batches without a row, which leave the table.
    """
    orders, customer = tables(spark, folder, "orders", "customer")
    doubled = F.col("o_totalprice") * 2
    path = scratch_path(spark, "batches")
    rows = project(orders, ["o_orderkey", "o_totalprice", "o_orderpriority"])
    again = rows.where("o_orderpriority = '1-URGENT'").withColumn("o_totalprice", doubled)
    batches = rows.select("o_orderpriority").where("o_orderpriority in ('1-URGENT', '5-LOW')").distinct()
    for delivery, delivered in ((rows, None), (again, batches), (again, batches)):
        by_priority = sinks.replace_batches(delivery, path, "o_orderpriority", delivered)

    path = scratch_path(spark, "bucketed-batches")
    rows = project(orders, ["o_orderkey", "o_totalprice", "o_orderpriority", "o_custkey"])
    building = customer.where("c_mktsegment = 'BUILDING'").withColumnRenamed("c_custkey", "o_custkey")
    again = rows.join(building, "o_custkey", "left_semi").select(rows.columns).withColumn("o_totalprice", doubled)
    batches = customer.where("c_mktsegment in ('BUILDING', 'MACHINERY')").select(F.col("c_custkey").alias("o_custkey"))
    for delivery, delivered in ((rows, None), (again, batches), (again, batches)):
        by_customer = sinks.replace_in_buckets(delivery, path, "o_custkey", 16, delivered)
    return by_priority.withColumn("layout", F.lit("partition")).unionByName(
        by_customer.drop("o_custkey").withColumn("layout", F.lit("bucket"))
    )


@query("cascade_delete", """
WITH gone AS (SELECT o_orderkey FROM orders JOIN customer ON o_custkey = c_custkey
              WHERE c_mktsegment = 'BUILDING')
SELECT 'customer' AS table_name, c_custkey AS row_key, CAST(0 AS BIGINT) AS sub_key
  FROM customer WHERE c_mktsegment <> 'BUILDING'
UNION ALL SELECT 'orders', o_orderkey, 0 FROM orders WHERE o_orderkey NOT IN (SELECT o_orderkey FROM gone)
UNION ALL SELECT 'lineitem', l_orderkey, l_partkey FROM lineitem
  WHERE l_orderkey NOT IN (SELECT o_orderkey FROM gone)
""")
def _cascade_delete(spark: SparkSession, folder: str) -> DataFrame:
    customer, orders, lineitem = tables(spark, folder, "customer", "orders", "lineitem")
    state = cascade_delete(
        {"customer": customer.select("c_custkey", "c_mktsegment"),
         "orders": orders.select("o_orderkey", "o_custkey"),
         "lineitem": lineitem.select("l_orderkey", "l_partkey")},
        "customer", F.col("c_mktsegment") == "BUILDING",
        [Child("orders", "customer", {"o_custkey": "c_custkey"}),
         Child("lineitem", "orders", {"l_orderkey": "o_orderkey"})],
    )
    zero = F.lit(0).cast("bigint").alias("sub_key")
    kept = [
        state["customer"].select(F.lit("customer").alias("table_name"), F.col("c_custkey").alias("row_key"), zero),
        state["orders"].select(F.lit("orders").alias("table_name"), F.col("o_orderkey").alias("row_key"), zero),
        state["lineitem"].select(F.lit("lineitem").alias("table_name"), F.col("l_orderkey").alias("row_key"),
                                 F.col("l_partkey").alias("sub_key")),
    ]
    return kept[0].unionByName(kept[1]).unionByName(kept[2])


@query("update_flag", """
SELECT o_orderkey, CASE WHEN o_orderstatus = 'O' AND o_orderkey IN
    (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R') THEN 'F' ELSE o_orderstatus END AS o_orderstatus
FROM orders
""")
def _update_flag(spark: SparkSession, folder: str) -> DataFrame:
    orders, lineitem = tables(spark, folder, "orders", "lineitem")
    queue = orders.select("o_orderkey", "o_orderstatus", F.year("o_orderdate").alias("o_year"))
    path = scratch_path(spark, "queue")
    sinks.replace_partitions(queue, path, ["o_year"])
    returned = lineitem.where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey"))
    claimed = settle(queue.where("o_orderstatus = 'O'").join(returned.distinct(), "o_orderkey", "left_semi").select("o_orderkey"), "claimed")
    # Years without a claimed order keep their files.
    return sinks.rewrite_touched(
        spark, path, queue.schema, "o_year", claimed, {"o_orderkey": "o_orderkey"},
        lambda rows: mark_claimed(rows, claimed, "o_orderkey", "o_orderstatus", "F"),
    ).select("o_orderkey", "o_orderstatus")
