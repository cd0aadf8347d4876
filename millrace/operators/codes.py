"""Dictionaries of thousands of codes: candidates by an index of their n-grams, then the ordered fold over those."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.session import settle

#: Characters of a gram; a shorter code is its own gram.
GRAM = 3


def _grams(text: Column, size: Column | int) -> Column:
    """The different grams of a text, from its characters."""
    letters = F.split(text, "")
    there = F.filter(letters, lambda c: c != "")
    size = F.lit(size) if isinstance(size, int) else size
    return F.when(F.size(there) >= size, F.array_distinct(F.transform(
        F.sequence(F.lit(1), F.size(there) - size + 1), lambda i: F.array_join(F.slice(there, i, size), "")
    ))).otherwise(F.array().cast("array<string>"))


def code_index(codes: DataFrame) -> DataFrame:
    """(``gram``, ``position``, ``code``): each code under that of its grams which fewest codes have.

    ``codes`` has ``position``, the order in which they are tried, and ``code``; empty and
    NULL codes are left out.
    """
    own = codes.where("code <> ''").select("position", "code", F.explode(
        _grams(F.col("code"), F.least(F.length("code"), F.lit(GRAM)))).alias("gram"))
    shared = own.groupBy("gram").agg(F.count(F.lit(1)).alias("n"))
    least = own.join(shared, "gram").groupBy("position", "code").agg(F.min(F.struct("n", "gram"))["gram"].alias("gram"))
    return settle(least.select("gram", "position", "code"), "code-index")


def code_hits(texts: DataFrame, index: DataFrame) -> DataFrame:
    """(``_row``, ``position``, ``code``) of the codes that the texts (``_row``, ``_text``) contain.

    Every text meets the codes of its grams only, so the plan does not depend on their number.
    """
    sizes = [r[0] for r in index.select(F.length("gram")).distinct().collect()]
    grams = F.array_distinct(F.flatten(F.array(*[_grams(F.col("_text"), n) for n in sorted(sizes)]))) if sizes else F.array().cast("array<string>")
    met = texts.select("_row", "_text", F.explode(grams).alias("gram")).join(index, "gram")
    return met.where(F.contains("_text", F.col("code"))).select("_row", "position", "code").distinct()


def filter_contains_any(rows: DataFrame, column: str, codes: DataFrame) -> DataFrame:
    """Rows whose text contains any of the codes, literally."""
    numbered = settle(rows.withColumn("_row", F.monotonically_increasing_id()), "rows")
    hits = code_hits(numbered.select("_row", F.col(column).alias("_text")), code_index(codes))
    return numbered.join(hits.select("_row").distinct(), "_row", "left_semi").drop("_row")


def _fold(rows: DataFrame, column: str, codes: DataFrame, trim: Callable[[Column], Column]) -> DataFrame:
    """``rows`` with ``_left``, the text without the codes found, and ``_found``, the codes in their order.

    A code that is cut out may bring a later one together, so the texts after each cut are
    looked up as well; where they hold a code that was no candidate, the fold is done
    again with it, until there is none.
    """
    index = code_index(codes)
    numbered = settle(rows.withColumn("_row", F.monotonically_increasing_id()), "rows")
    texts = numbered.select("_row", F.col(column).alias("_text"))
    hits = settle(code_hits(texts, index), "code-hits")

    def step(acc: Column, c: Column) -> Column:
        left = trim(F.replace(acc["left"], c["code"], F.lit("")))
        cut = F.struct(left.alias("left"), F.concat(acc["found"], F.array(c["code"])).alias("found"),
                       F.concat(acc["seen"], F.array(left)).alias("seen"))
        return F.when(F.contains(acc["left"], c["code"]), cut).otherwise(acc)

    def folded(some: DataFrame, known: DataFrame) -> DataFrame:
        listed = known.groupBy("_row").agg(F.array_sort(F.collect_list(F.struct("position", "code"))).alias("_codes"))
        none = F.array().cast("array<string>")
        start = F.struct(F.col("_text").alias("left"), none.alias("found"), none.alias("seen"))
        return some.join(listed, "_row").select("_row", "_text", F.aggregate("_codes", start, step).alias("f"))

    done, again = [], texts
    while True:
        result = settle(folded(again, hits), "code-fold")
        after = result.select("_row", F.explode("f.seen").alias("_text"))
        new = settle(code_hits(after, index).join(hits.select("_row", "position"), ["_row", "position"], "left_anti"), "code-hits")
        affected = new.select("_row").distinct()
        done.append(result.join(affected, "_row", "left_anti"))
        if new.isEmpty():
            break
        again = texts.join(affected, "_row", "left_semi")
        hits = settle(hits.join(affected, "_row", "left_semi").unionByName(new), "code-hits")
    found = reduce(DataFrame.unionByName, done).select("_row", "f.left", "f.found")
    none = F.array().cast("array<string>")
    return numbered.join(found, "_row", "left").select(
        *[f"`{c}`" for c in rows.columns], F.coalesce("left", column).alias("_left"), F.coalesce("found", none).alias("_found"))


def strip_last_tag_by_index(rows: DataFrame, column: str, codes: DataFrame, alias: str = "f") -> DataFrame:
    """``rows`` with the struct (``text``, ``tag``) that ``strip_last_tag`` gives, for any number of codes."""
    out = _fold(rows, column, codes, F.ltrim)
    tag = F.coalesce(F.try_element_at("_found", F.lit(-1)), F.lit(""))
    return out.withColumn(alias, F.struct(F.col("_left").alias("text"), tag.alias("tag"))).drop("_left", "_found")


def strip_all_values_by_index(rows: DataFrame, column: str, codes: DataFrame, alias: str = "f") -> DataFrame:
    """``rows`` with the struct (``text``, ``values``) that ``strip_all_values`` gives, for any number of codes."""
    out = _fold(rows, column, codes, F.rtrim)
    return out.withColumn(alias, F.struct(F.col("_left").alias("text"), F.col("_found").alias("values"))).drop("_left", "_found")
