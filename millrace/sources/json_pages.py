"""Exports of JSON pages, taken apart before their records are typed.

A page is parsed as a variant, its list is exploded, and each record is typed alone,
so a damaged record costs nothing but itself.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Reasons of rejects that are not about single fields.
NO_JSON, NO_LIST, NO_OBJECT = "no JSON", "no list", "no object"


def _name(name: str) -> str:
    return f"`{name.replace('`', '``')}`"


def _loose(kind: T.DataType) -> str | None:
    """The type with its parts left as variants; None if it has no parts."""
    if isinstance(kind, T.StructType):
        return f"struct<{', '.join(f'{_name(f.name)}: variant' for f in kind)}>"
    if isinstance(kind, T.ArrayType):
        return "array<variant>"
    if isinstance(kind, T.MapType):
        return "map<string, variant>"
    return None


def misfit(value: Column, kind: T.DataType) -> Column:
    """Does a variant, or any part of it, hold something that is no value of the type?  Absent and null parts do not."""
    loose = _loose(kind)
    got = F.try_variant_get(value, "$", loose or kind.simpleString())
    if loose is None:
        inner = F.lit(False)
    elif isinstance(kind, T.StructType):
        inner = reduce(or_, [misfit(got[f.name], f.dataType) for f in kind], F.lit(False))
    elif isinstance(kind, T.ArrayType):
        inner = F.exists(got, lambda x: misfit(x, kind.elementType))
    else:
        inner = F.exists(F.map_values(got), lambda x: misfit(x, kind.valueType))
    filled = value.isNotNull() & ~F.is_variant_null(value)
    return F.coalesce(filled & (got.isNull() | inner), F.lit(False))


def json_items(
    spark: SparkSession, path: str, field: str, item: T.StructType, multi_line: bool = False
) -> DataFrame:
    """(``file_name``, ``position``, ``item``, ``record``, ``reason``): one row per record of the pages' list ``field``.

    A good record has its typed ``item`` and no ``reason``.  A reject has its own text as
    ``record`` and says why: the fields that hold values of another type, ``NO_OBJECT``, or,
    for a whole page (without ``position``), ``NO_JSON`` or ``NO_LIST``.  Pages without the
    field, or with a null there, and blank lines have no records.

    A file has a page a line, or with ``multi_line`` one page, or a list of pages.  Numbers
    read as text come in their shortest form.  A page with a key twice in one object, or
    one larger than a variant may be, is no JSON here.  Read the result once, or settle it.
    """
    text = spark.read.text(path, wholetext=multi_line).select(F.col("_metadata.file_name").alias("file_name"), "value")
    parsed = text.where("value RLIKE '\\\\S'").withColumn("_v", F.try_parse_json("value"))
    several = F.coalesce(F.try_variant_get("_v", "$", "array<variant>"), F.array("_v"))
    pages = parsed.select("file_name", "value", F.explode(several).alias("_page")).withColumns({
        "_object": F.try_variant_get("_page", "$", f"struct<{_name(field)}: variant>"),
    }).withColumn("_list", F.col("_object")[field]).withColumn("_items", F.try_variant_get("_list", "$", "array<variant>"))
    items = F.col("_items")
    broken = F.when(F.col("_page").isNull(), NO_JSON).when(F.col("_object").isNull(), NO_OBJECT).when(
        F.col("_list").isNotNull() & ~F.is_variant_null("_list") & items.isNull(), NO_LIST)
    # A broken page is one record without a position.
    none = F.array(F.struct(F.lit(None).cast("int").alias("position"), F.lit(None).cast("variant").alias("v")))
    there = F.transform(items, lambda v, i: F.struct(i.alias("position"), v.alias("v")))
    rows = pages.withColumn("_broken", broken).select(
        "file_name", "value", "_broken", F.explode(F.when(F.col("_broken").isNotNull(), none).otherwise(there)).alias("_r")
    ).select("file_name", "value", "_broken", "_r.*").withColumn("_fields", F.try_variant_get("v", "$", _loose(item)))
    wrong = F.array_compact(F.array(*[
        F.when(misfit(F.col("_fields")[f.name], f.dataType), F.lit(f.name)) for f in item
    ])) if len(item) else F.array().cast("array<string>")
    judged = rows.withColumn("reason", F.coalesce("_broken", F.when(F.col("_fields").isNull(), NO_OBJECT).when(
        F.size(wrong) > 0, F.array_join(wrong, ", "))))
    good = F.col("reason").isNull()
    # Made as one row by a generator, which a filter on the reason stays above: else Spark judges every record again for it.
    return judged.select(F.inline(F.array(F.struct(
        "file_name", "position", F.when(good, F.try_variant_get("v", "$", item.simpleString())).alias("item"),
        F.when(~good, F.coalesce(F.to_json("v"), "value")).alias("record"), "reason",
    ))))


def split_items(items: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The typed records, and the rejects as ``file_name``, ``position``, ``reason``, ``record``."""
    good = items.where("reason IS NULL").select("item.*")
    return good, items.where("reason IS NOT NULL").select("file_name", "position", "reason", "record")
