"""Column metadata of tables: declared in the catalog, or measured on request."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Catalog type -> vendor type, precision, scale; the precision of other than text is its size.
_VENDOR = {
    "int": ("INT", 10, 0),
    "bigint": ("BIGINT", 19, 0),
    "smallint": ("SMALLINT", 5, 0),
    "tinyint": ("TINYINT", 3, 0),
    "boolean": ("BIT", 1, 0),
    "float": ("DOUBLE", 15, 0),
    "double": ("DOUBLE", 15, 0),
    "date": ("DATE", 10, 0),
    "timestamp": ("TIMESTAMP", 26, 6),
    "timestamp_ntz": ("DATETIME2", 26, 6),
    "string": ("NVARCHAR", 0, 0),
    "varchar": ("VARCHAR", 0, 0),
    "char": ("CHAR", 0, 0),
}
METADATA = "table_name string, position int, column_name string, type string, size int, precision int, scale int"


def _vendor(kind: str) -> tuple[str, int | None, int, int]:
    """(vendor type, size, precision, scale) of a catalog type; the size of text without a length is unknown."""
    name, first, second = re.fullmatch(r"(\w+)(?:\((\d+)(?:,\s*(\d+))?\))?.*", kind.lower(), re.DOTALL).groups()
    if name == "decimal":
        return "DECIMAL", int(first), int(first), int(second or 0)
    vendor, precision, scale = _VENDOR.get(name, ("SQL_VARIANT", 0, 0))
    if name in ("string", "varchar", "char"):
        return vendor, int(first) if first else None, precision, scale
    return vendor, precision, precision, scale


def _quoted(*names: str) -> str:
    return ".".join(f"`{n.replace('`', '``')}`" for n in names)


def registered_tables(spark: SparkSession, database: str | None = None) -> list[str]:
    """Names of the tables and views that the catalog has in a database, or that the session knows."""
    return sorted(t.name for t in spark.catalog.listTables(database) if database is None or not t.isTemporary)


def _longest(spark: SparkSession, table: str, column: str) -> int | None:
    """The longest value of a text column by the catalog's statistics; None if there are none, or no value."""
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table} {_quoted(column)}").collect()
    found = {r["info_name"]: r["info_value"] for r in rows}
    longest = found.get("max_col_len")
    # Without a value Spark puts the default size of the type there.
    return int(longest) if longest not in (None, "NULL") and found.get("distinct_count") != "0" else None


def _full(name: str, database: str | None) -> str:
    return _quoted(*([database] if database else []), name)


def declared_columns(spark: SparkSession, table: str, database: str | None = None) -> list[tuple[str, str]]:
    """Names and declared types of a table's columns (``listColumns`` shows every text as string)."""
    out = []
    for r in spark.sql(f"DESCRIBE TABLE {_full(table, database)}").collect():
        # What follows the columns is about partitions.
        if not r["col_name"] or r["col_name"].startswith("#"):
            break
        out.append((r["col_name"], r["data_type"]))
    return out


def catalog_scan(spark: SparkSession, database: str | None = None, tables: Sequence[str] | None = None) -> DataFrame:
    """Column metadata of tables as the catalog declares it (``METADATA``); no data is read.

    Text has the length of its ``char`` or ``varchar`` type, else the longest value that
    statistics know (``measure_tables`` computes them), else NULL: unlimited.  What the
    driver holds is the columns' names and types.
    """
    rows = []
    for name in registered_tables(spark, database) if tables is None else tables:
        temporary = not database and spark.catalog.getTable(name).isTemporary
        for i, (column, kind) in enumerate(declared_columns(spark, name, database)):
            vendor, size, precision, scale = _vendor(kind)
            if size is None and not temporary:
                size = _longest(spark, _full(name, database), column)
            rows.append((name, i + 1, column, vendor, size, precision, scale))
    return spark.createDataFrame(rows, METADATA)


def measure_tables(spark: SparkSession, tables: Sequence[str], database: str | None = None) -> None:
    """Compute the statistics of all text columns without a declared length; one pass over each table."""
    for name in tables:
        texts = [_quoted(column) for column, kind in declared_columns(spark, name, database) if kind.lower() == "string"]
        if texts:
            spark.sql(f"ANALYZE TABLE {_full(name, database)} COMPUTE STATISTICS FOR COLUMNS {', '.join(texts)}")


def _described(position: int, field: T.StructField) -> Column:
    """Metadata struct of one column; text sizes are its longest value."""
    vendor, _, precision, scale = _vendor(field.dataType.simpleString())
    if isinstance(field.dataType, T.StringType):
        size = F.coalesce(F.max(F.length(F.col(f"`{field.name}`"))), F.lit(0))
    else:
        size = F.lit(precision)
    return F.struct(
        F.lit(position).cast("int").alias("position"), F.lit(field.name).alias("column_name"),
        F.lit(vendor).alias("type"), size.cast("int").alias("size"),
        F.lit(precision).cast("int").alias("precision"), F.lit(scale).cast("int").alias("scale"),
    )


def measure_columns(name: str, df: DataFrame) -> DataFrame:
    """One aggregation over the table, one row per column."""
    described = [_described(i + 1, f) for i, f in enumerate(df.schema.fields)]
    return df.agg(F.count(F.lit(1)).alias("_n"), F.array(*described).alias("_c")).select(
        F.lit(name).alias("table_name"), F.inline("_c")
    )


def measured_scan(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Column metadata of frames that no catalog knows, their text sizes measured in the data."""
    return reduce(DataFrame.unionByName, [measure_columns(n, df) for n, df in tables.items()])
