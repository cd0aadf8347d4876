"""Metadata reports over the columns that a catalog declares for the test tables, their texts measured or declared."""

from __future__ import annotations

import re
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.bindings.registry import query
from millrace.operators import metadata as meta
from millrace.operators.projections import build_column_list, exclude_private_columns
from millrace.session import scratch_path
from millrace.sources.catalog import catalog_scan, measure_tables

#: Declared columns of the test tables.
TABLES = {
    "region": "r_regionkey INT, r_name STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": "c_custkey BIGINT, c_name VARCHAR(25), c_nationkey INT, c_acctbal DOUBLE, c_mktsegment VARCHAR(10)",
    "supplier": "s_suppkey BIGINT, s_name VARCHAR(25), s_nationkey INT, s_acctbal DOUBLE",
    "part": "p_partkey BIGINT, p_name VARCHAR(55), p_brand VARCHAR(10), p_type VARCHAR(25), p_size INT, "
            "p_retailprice DOUBLE",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus CHAR(1), o_totalprice DOUBLE, "
              "o_orderdate TIMESTAMP_NTZ, o_orderpriority VARCHAR(15)",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, l_quantity DOUBLE, "
                "l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, l_returnflag CHAR(1), "
                "l_linestatus CHAR(1), l_shipdate TIMESTAMP_NTZ",
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type VARCHAR(20), value DOUBLE, props STRING",
    "documents": "doc_id BIGINT, text STRING, lang CHAR(2), source VARCHAR(20), n_chars BIGINT",
    "embeddings": "vec_id BIGINT, embedding ARRAY<FLOAT>, label INT",
    "pages": "page_id BIGINT, url STRING, html STRING",
    "benchmark": "item_id BIGINT, text STRING",
    "labels": "doc_id BIGINT, quality INT, toxic INT",
    "conversations": "conv_id BIGINT, turn BIGINT, role VARCHAR(10), text STRING",
}
#: Tables whose plain text has statistics.
MEASURED = ("nation", "region")
_KINDS = {"INT": ("INT", 10, 0), "BIGINT": ("BIGINT", 19, 0), "DOUBLE": ("DOUBLE", 15, 0), "TIMESTAMP_NTZ": ("DATETIME2", 26, 6),
          "STRING": ("NVARCHAR", 0, 0), "ARRAY<FLOAT>": ("SQL_VARIANT", 0, 0)}


def _source_sql() -> str:
    """The metadata frame as SQL."""
    rows = []
    for name, columns in TABLES.items():
        for i, column in enumerate(columns.split(", ")):
            col, declared = column.split()
            kind, _, length = declared.partition("(")
            vendor, precision, scale = _KINDS.get(kind, (kind, 0, 0))
            size = length.rstrip(")") or str(precision)
            if kind == "STRING":
                size = f"(SELECT max(length({col})) FROM {name})" if name in MEASURED else "NULL"
            rows.append(
                f"SELECT '{name}' AS table_name, {i + 1} AS position, '{col}' AS column_name, '{vendor}' AS type, "
                f"CAST({size} AS INTEGER) AS size, {precision} AS precision, {scale} AS scale"
            )
    return " UNION ALL ".join(rows)


SOURCE_SQL = f"source AS MATERIALIZED ({_source_sql()})"


def _measured_sql() -> str:
    """The metadata frame as SQL: text sizes measured in all tables, the rest declared."""
    rows = []
    for name, columns in TABLES.items():
        for i, column in enumerate(columns.split(", ")):
            col, declared = column.split()
            vendor, precision, scale = _KINDS.get(declared, _KINDS["STRING"])
            size = f"(SELECT coalesce(max(length({col})), 0) FROM {name})" if vendor == "NVARCHAR" else precision
            rows.append(
                f"SELECT '{name}' AS table_name, {i + 1} AS position, '{col}' AS column_name, '{vendor}' AS type, "
                f"CAST({size} AS INTEGER) AS size, {precision} AS precision, {scale} AS scale"
            )
    return " UNION ALL ".join(rows)


MEASURED_SQL = f"source AS ({_measured_sql()})"

_CANONICAL = "CASE type {} ELSE type END".format(" ".join(
    f"WHEN '{old}' THEN '{new}'" for old, new in
    [("DATETIME2", "DATETIME"), ("INT", "INTEGER"), ("DOUBLE", "FLOAT"), ("NVARCHAR", "VARCHAR"), ("CHAR", "VARCHAR"), ("SQL_VARIANT", "BLOB")]
))


def _looked_up(spark: SparkSession, folder: str, given: Mapping[str, str], measure: Sequence[str]) -> DataFrame:
    """A database of external tables with the given columns; some are measured, all are looked up."""
    database = f"declared_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {database} LOCATION '{scratch_path(spark, 'database')}'")
    try:
        for name, columns in given.items():
            spark.sql(f"CREATE TABLE {database}.{name} ({columns}) USING parquet LOCATION '{folder}/{name}.parquet'")
        measure_tables(spark, measure, database)
        return catalog_scan(spark, database)
    finally:
        # External: only the entries go.
        spark.sql(f"DROP DATABASE {database} CASCADE")


def declared(spark: SparkSession, folder: str) -> DataFrame:
    """The test tables by their declared columns; only ``MEASURED`` are read."""
    return _looked_up(spark, folder, TABLES, MEASURED)


def measured(spark: SparkSession, folder: str) -> DataFrame:
    """The test tables with plain text of no declared length: every text of every row is measured."""
    plain = {name: re.sub(r"(VAR)?CHAR\(\d+\)", "STRING", columns) for name, columns in TABLES.items()}
    # Text without any value has no longest one.
    return _looked_up(spark, folder, plain, list(plain)).fillna(0, ["size"])


@query("catalog_scan", f"WITH {MEASURED_SQL} SELECT * FROM source")
def _catalog_scan(spark: SparkSession, folder: str) -> DataFrame:
    return measured(spark, folder)


@query("standardise_type", f"WITH {MEASURED_SQL} SELECT table_name, column_name, {_CANONICAL} AS type, size FROM source")
def _standardise_type(spark: SparkSession, folder: str) -> DataFrame:
    return meta.standardise_types(measured(spark, folder)).select("table_name", "column_name", "type", "size")


_DDL_SQL = """
CASE WHEN type IN ('DATETIME', 'INTEGER', 'FLOAT') THEN concat('[', column_name, '] ', type)
     WHEN type = 'VARCHAR' THEN concat('[', column_name, '] VARCHAR(', size, ')')
     ELSE concat('*** Unknown data type **** [', column_name, '] ', type) END
"""


@query("ddl_report", f"""
WITH {MEASURED_SQL}, canonical AS (SELECT * REPLACE ({_CANONICAL} AS type) FROM source)
SELECT table_name, string_agg({_DDL_SQL}, chr(10) || ',' ORDER BY position) AS ddl FROM canonical GROUP BY table_name
""")
def _ddl_report(spark: SparkSession, folder: str) -> DataFrame:
    return meta.ddl_report(meta.standardise_types(measured(spark, folder)))


@query("build_column_list", f"""
WITH {SOURCE_SQL}
SELECT table_name AS "Source_Table_Nm", string_agg(concat('"', column_name, '"'), ',' ORDER BY position) AS "Source_Column_Names",
  table_name AS "Target_Table_Nm", 'Y' AS "Extract_Process_Active_Ind",
  'N' AS "Extract_Processed_Ind"
FROM source GROUP BY table_name
""")
def _build_column_list(spark: SparkSession, folder: str) -> DataFrame:
    return build_column_list(declared(spark, folder))


@query("exclude_pii_columns", f"""
WITH {MEASURED_SQL}
SELECT table_name, column_name, size FROM source
WHERE column_name NOT IN ('c_acctbal', 's_acctbal', 'props')
  AND NOT (column_name = 'text' AND table_name IN ('conversations', 'documents'))
""")
def _exclude_pii_columns(spark: SparkSession, folder: str) -> DataFrame:
    rules = spark.createDataFrame(
        [(None, "c_acctbal"), (None, "s_acctbal"), (None, "props"), ("conversations", "text"), ("documents", "text")],
        "table_name string, column_name string",
    )
    return exclude_private_columns(measured(spark, folder), rules).select("table_name", "column_name", "size")


# The altered copy: one table and some columns gone, one type widened, one changed,
# text narrowed in one table.
_ALTERED_SQL = """
target AS (SELECT table_name, column_name,
  CASE WHEN column_name = 'l_linenumber' THEN 'BIGINT' WHEN column_name = 'o_totalprice' THEN 'VARCHAR'
       WHEN column_name = 'ts' THEN 'VARCHAR' ELSE type END AS type,
  CASE WHEN table_name = 'customer' THEN size - 1 WHEN column_name = 'url' THEN 2000 ELSE size END AS size, precision, scale
  FROM canonical WHERE table_name <> 'labels' AND column_name NOT IN ('l_tax', 's_name', 'p_size'))
"""


def altered(columns: DataFrame) -> DataFrame:
    name = F.col("column_name")
    kind = F.when(name == "l_linenumber", "BIGINT").when(name.isin("o_totalprice", "ts"), "VARCHAR").otherwise(F.col("type"))
    size: Column = F.when(F.col("table_name") == "customer", F.col("size") - 1).when(name == "url", 2000).otherwise(F.col("size"))
    kept = columns.where((F.col("table_name") != "labels") & ~name.isin("l_tax", "s_name", "p_size"))
    return kept.withColumns({"type": kind, "size": size})


@query("schema_drift_report", f"""
WITH {SOURCE_SQL}, canonical AS (SELECT * REPLACE ({_CANONICAL} AS type) FROM source), {_ALTERED_SQL},
columns AS (SELECT s.table_name, s.column_name,
  CASE WHEN t.type IS NULL THEN 'NOT FOUND'
       WHEN s.type <> t.type AND (s.type, t.type) NOT IN (('INTEGER', 'BIGINT'), ('DATETIME', 'VARCHAR'))
         THEN 'DATA TYPE MISMATCH'
       WHEN s.type = t.type AND s.type IN ('VARCHAR', 'DATETIME', 'BLOB') AND coalesce(s.size, 2147483647) > coalesce(t.size, 2147483647)
         THEN 'DATA SIZE MISMATCH' END AS issue,
  CASE WHEN s.type <> t.type THEN concat(s.type, ' -> ', t.type)
       WHEN s.type IN ('BIGINT', 'FLOAT', 'DATE', 'INTEGER', 'SMALLINT') THEN s.type
       ELSE concat(s.type, '(', coalesce(CAST(s.size AS VARCHAR), 'MAX'), ')') END AS detail
  FROM canonical s LEFT JOIN target t ON t.table_name = s.table_name AND t.column_name = s.column_name
  WHERE s.table_name IN (SELECT table_name FROM target))
SELECT * FROM columns WHERE issue IS NOT NULL
UNION ALL SELECT DISTINCT table_name, NULL, 'TABLE NOT FOUND', table_name FROM source
  WHERE table_name NOT IN (SELECT table_name FROM target)
""")
def _schema_drift_report(spark: SparkSession, folder: str) -> DataFrame:
    source = meta.standardise_types(declared(spark, folder))
    return meta.schema_drift_report(source, altered(source))
