"""Reports over measured columns read every table, whatever lengths are declared."""

import pytest
from pyspark.sql import types as T

from __spark_entry__ import queries
from millrace.bindings.metadata import TABLES
from millrace.session import scratch_path


@pytest.fixture(scope="module")
def folder(spark):
    """Two rows a table: the n-th text column of a table has n x 10 + 3 letters and nothing; the texts of ``part`` have no value."""
    root = scratch_path(spark, "odd-tables")
    for name, columns in TABLES.items():
        schema = T.StructType([
            T.StructField(f.name, T.StringType() if "CHAR" in kind else f.dataType)
            for f, kind in zip(T.StructType.fromDDL(columns), columns.split(", "))
        ])
        full = tuple("x" * (10 * i + 3) if f.dataType == T.StringType() and name != "part" else None for i, f in enumerate(schema))
        spark.createDataFrame([full, (None,) * len(full)], schema).write.parquet(f"{root}/{name}.parquet")
    return root


def text_sizes(name):
    """What a table's text columns must measure."""
    given = [c.split() for c in TABLES[name].split(", ")]
    return {c: 0 if name == "part" else 10 * i + 3 for i, (c, kind) in enumerate(given) if kind == "STRING" or "CHAR" in kind}


def test_catalog_scan_measures_every_text(spark, folder):
    found = {(r["table_name"], r["column_name"]): (r["type"], r["size"]) for r in queries()["catalog_scan"](spark, folder).collect()}
    assert len(found) == sum(len(columns.split(", ")) for columns in TABLES.values())
    for name in TABLES:
        for column, size in text_sizes(name).items():
            assert found[name, column] == ("NVARCHAR", size)


def test_standardise_type_keeps_measured_sizes(spark, folder):
    found = {(r["table_name"], r["column_name"]): (r["type"], r["size"]) for r in queries()["standardise_type"](spark, folder).collect()}
    for name in TABLES:
        for column, size in text_sizes(name).items():
            assert found[name, column] == ("VARCHAR", size)


def test_ddl_report_has_measured_sizes(spark, folder):
    found = {r["table_name"]: r["ddl"] for r in queries()["ddl_report"](spark, folder).collect()}
    assert set(found) == set(TABLES)
    for name in TABLES:
        for column, size in text_sizes(name).items():
            assert f"[{column}] VARCHAR({size})" in found[name]


def test_exclude_pii_columns_has_measured_sizes(spark, folder):
    found = {(r["table_name"], r["column_name"]): r["size"] for r in queries()["exclude_pii_columns"](spark, folder).collect()}
    private = {("events", "props"), ("documents", "text"), ("conversations", "text")}
    assert not private & set(found)
    for name in TABLES:
        for column, size in text_sizes(name).items():
            assert (name, column) in private or found[name, column] == size
