"""Tags, values, mentions and lists inside message text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _codes(codes: Sequence[str]) -> Column:
    return F.array(*[F.lit(c) for c in codes]).cast("array<string>")


def strip_last_tag(text: Column, codes: Sequence[str]) -> Column:
    """Struct ``(text, tag)``: every code found is cut out, the last one is the tag.

    The codes are tried in order and each hit changes the text the next one sees,
    so this is a fold over the ordered dictionary, not a join.
    """

    def step(acc: Column, code: Column) -> Column:
        cut = F.struct(
            F.ltrim(F.replace(acc["text"], code, F.lit(""))).alias("text"), code.alias("tag")
        )
        return F.when(F.contains(acc["text"], code), cut).otherwise(acc)

    start = F.struct(text.alias("text"), F.lit("").alias("tag"))
    return F.aggregate(_codes(codes), start, step)


def strip_all_values(text: Column, codes: Sequence[str]) -> Column:
    """Struct ``(text, values)``: every code found is cut out and listed, in order."""

    def step(acc: Column, code: Column) -> Column:
        cut = F.struct(
            F.rtrim(F.replace(acc["text"], code, F.lit(""))).alias("text"),
            F.concat(acc["values"], F.array(code)).alias("values"),
        )
        return F.when(F.contains(acc["text"], code), cut).otherwise(acc)

    start = F.struct(text.alias("text"), F.array().cast("array<string>").alias("values"))
    return F.aggregate(_codes(codes), start, step)


def reversed_pipe_list(values: Column) -> Column:
    """``[a, b]`` as ``b|a|``: every item goes in front and brings its pipe."""
    return F.array_join(F.transform(F.reverse(values), lambda v: F.concat(v, F.lit("|"))), "")


def mention_ids(text: Column) -> Column:
    """Ids inside ``<@id>``; the character after ``<`` is skipped whatever it is."""
    return F.regexp_extract_all(text, F.lit("<.([^>]*)>"), F.lit(1))


def text_after_mentions(text: Column, legacy: bool = False) -> Column:
    """Text behind the last mention.  ``legacy`` gives NULL if there is no mention."""
    has_mention = F.size(mention_ids(text)) > 0
    rest = F.trim(F.regexp_extract(text, "(?s).*>(.*)$", 1))
    return F.when(has_mention, rest).otherwise(F.lit(None) if legacy else text)


def valid_user_id(user_id: Column, legacy: bool = False) -> Column:
    """Nine characters starting with U or W.

    ``legacy`` wants the U or W anywhere but in front, as the old check did.
    """
    if legacy:
        return (F.length(user_id) == 9) & user_id.rlike("(?s)^.+[UW]")
    return user_id.rlike("^[UW][A-Z0-9]{8}$")


def pipe_items(text: Column) -> Column:
    """Pipe list to array; empty slots stay."""
    return F.split(text, "[|]")


def compose_message(recipients: Column, tag: Column, text: Column, values: Column) -> Column:
    """``@a @b tag text v1 v2``."""
    names = F.array_join(F.transform(recipients, lambda r: F.concat(F.lit("@"), r)), " ")
    return F.concat_ws(" ", names, tag, text, F.array_join(values, " "))


def reactions(tag: Column, values: Column) -> Column:
    """Reaction names: tag and value for each value, the tag alone for a blank one."""
    per_value = F.transform(
        values, lambda v: F.when(v == " ", F.array(tag)).otherwise(F.array(tag, v))
    )
    return F.transform(F.flatten(per_value), lambda r: F.replace(r, F.lit(":"), F.lit("")))
