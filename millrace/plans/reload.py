"""CSV reload and estimate sheets."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterable, Mapping, Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.fixed_values import ESTIMATE_COLUMNS
from millrace.functions.cleansing import blank_to_null, blanks_to_null, fill_required_strings, string_to_bits
from millrace.functions.dates import cast_datetime
from millrace.operators.filters import filter_not_null
from millrace.operators.projections import (
    drop_all_null_columns,
    drop_identity_columns,
    rename_map,
    upper_columns,
)
from millrace.session import settle
from millrace.sources.catalog import declared_columns, registered_tables
from millrace.sources.files import CORRUPT, csv_folder_roots, csv_records


def column_rules(rules: DataFrame, table: str) -> tuple[list[str], list[str]]:
    """Required and identity columns of one table, from its (column-sized) metadata.

    ``rules`` has ``TABLE_NAME, COLUMN_NAME, NULLABLE, IDENTITY_COL``.
    """
    rows = rules.where(F.upper("TABLE_NAME") == table.upper()).select(
        F.upper("COLUMN_NAME").alias("c"), "NULLABLE", "IDENTITY_COL"
    ).collect()
    required = [r["c"] for r in rows if r["NULLABLE"] == 0 and r["IDENTITY_COL"] == 0]
    return required, [r["c"] for r in rows if r["IDENTITY_COL"] == 1]


def csv_cleanse(
    rows: DataFrame, required: Iterable[str] = (), identity: Iterable[str] = ()
) -> DataFrame:
    """Cleansed rows of one CSV file, for targets without a declaration.

    Upper-case names, no columns without any cell, blanks as NULL (dates included: the sentinel
    the old load wrote and cleared again is a typed NULL here), '' in required text,
    bits for encrypted text, no identity columns.
    """
    identity = set(identity)
    # Empty columns go before blanks are cleared: a column that only holds blanks today stays.
    df = blanks_to_null(drop_all_null_columns(upper_columns(rows)))
    df = drop_identity_columns(df, identity)
    dates = ("_DT", "_TS", "_DATE")
    df = fill_required_strings(df, [c for c in required if not c.endswith(dates)])
    encrypted = [
        f.name for f in df.schema.fields
        if f.name.endswith("_ENCRPTD") and isinstance(f.dataType, T.StringType)
    ]
    return df.withColumns({c: string_to_bits(F.col(c)) for c in encrypted}) if encrypted else df


class Reload(NamedTuple):
    """What a reload has done.

    ``tables`` by upper-case name; ``rejects`` has ``table_name, file_name, reason, record``;
    ``counts`` has ``table_name, source_rows, rejected_rows, loaded_rows, missing_rows,
    percent_loaded``, where loaded rows are counted in the target.
    """

    tables: dict[str, DataFrame]
    rejects: DataFrame
    counts: DataFrame


_LENGTH = re.compile(r"(?:var)?char\((\d+)\)")


def _fitted(records: DataFrame, columns: Sequence[tuple[str, str]], required: Iterable[str]) -> DataFrame:
    """Text records with the target's types, and a ``reason`` where a value does not fit its column."""
    wanted, dates = set(required), ("_DT", "_TS", "_DATE")
    values, wrong = {}, []
    for name, kind in columns:
        text = blank_to_null(F.col(f"`{name}`"))
        limit = _LENGTH.fullmatch(kind)
        if limit or kind == "string":
            value = string_to_bits(text) if name.endswith("_ENCRPTD") else text
            if name in wanted and not name.endswith(dates):
                value = F.coalesce(value, F.lit(""))
            bad = F.length(value) > int(limit[1]) if limit else F.lit(False)
        else:
            value = F.trim(text).try_cast(kind)
            bad = text.isNotNull() & value.isNull()
        values[name] = value
        wrong.append(F.when(bad, F.lit(name)))
    unfit = F.array_compact(F.array(*wrong))
    return records.select(
        *[v.alias(n) for n, v in values.items()], "file_name",
        F.coalesce("reason", F.when(F.size(unfit) > 0, F.array_join(unfit, ", "))).alias("reason"),
        F.concat_ws(",", *[f"`{n}`" for n, _ in columns]).alias("_text"), CORRUPT,
    )


def csv_reload_folder(
    spark: SparkSession, folder: str, database: str, rules: DataFrame | None = None, multi_line: bool = False,
) -> Reload:
    """Reload every table of a database that the folder has a CSV file of; other files are left alone.

    The target's declaration decides the columns, whatever the data hold: they are found by
    their names in the header, a column that the file lacks or that is blank today is NULL,
    and columns that the target lacks are not read (so numbers that the target gives itself
    are not declared there).  Blank text is NULL, '' in text that ``rules`` require;
    encrypted text becomes bits.  A line is rejected if its cells are too few or many, or if
    one is no value of its type or longer than declared.

    Rows are inserted by name under Spark's store assignment.  Source rows are observed
    where they are read; each file is read once.
    """
    texts, tables, counts, rejected = {}, {}, [], []
    for name in registered_tables(spark, database):
        declared = declared_columns(spark, name, database)
        texts[name.lower()] = name, declared, T.StructType([T.StructField(c, T.StringType()) for c, _ in declared])
    found = csv_folder_roots(spark, folder)
    for stem, roots in found.items():
        if stem.lower() not in texts:
            continue
        name, declared, schema = texts[stem.lower()]
        required = column_rules(rules, name)[0] if rules is not None else []
        read = Observation()
        records = csv_records(spark, roots, schema, multi_line).observe(read, F.count(F.lit(1)).alias("rows"))
        fitted = settle(_fitted(records, [(c, k.lower()) for c, k in declared], [c for c, _ in declared if c.upper() in required]), "reload")
        fitted.where("reason IS NULL").select(*schema.fieldNames()).createOrReplaceTempView(view := f"reload_{uuid.uuid4().hex}")
        target = f"`{database}`.`{name}`"
        spark.sql(f"INSERT OVERWRITE {target} BY NAME SELECT * FROM {view}")
        spark.catalog.dropTempView(view)
        tables[name.upper()] = spark.table(target)
        bad = fitted.where("reason IS NOT NULL").select(
            F.lit(name.upper()).alias("table_name"), "file_name", "reason", F.coalesce(CORRUPT, "_text").alias("record"))
        rejected.append(bad)
        counts.append((name.upper(), read.get["rows"], bad.count(), tables[name.upper()].count()))
    report = spark.createDataFrame(counts, "table_name string, source_rows long, rejected_rows long, loaded_rows long")
    share = F.col("loaded_rows").cast("decimal(20,0)") * 100 / F.nullif("source_rows", F.lit(0))
    none = spark.createDataFrame([], "table_name string, file_name string, reason string, record string")
    return Reload(tables, reduce(DataFrame.unionByName, rejected, none), report.withColumns({
        "missing_rows": F.col("source_rows") - F.col("loaded_rows"), "percent_loaded": F.round(share, 2).cast("decimal(20,2)"),
    }))


def estimate_rows(sheet: DataFrame, names: Mapping[str, str] = ESTIMATE_COLUMNS) -> DataFrame:
    """Estimate sheet (as text): renamed, start date cast, rows with an employee."""
    renamed = rename_map(sheet, names)
    if "PROJ_STRT_DT" in renamed.columns:
        renamed = renamed.withColumn("PROJ_STRT_DT", cast_datetime(F.col("PROJ_STRT_DT")))
    return filter_not_null(renamed, "EMPL_ID")
