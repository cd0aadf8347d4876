"""Recognition messages: stage, find changes, load new ones, apply edits.

A *staged* frame holds versions of messages: ``SRC_TS`` is the key, ``INTRNL_TS``
the version time.  The warehouse side is three tables:

* messages ``RCGNTN_MSG_ID, INTRNL_TS, SRC_TS, RCGNTN_MSG_TXT, RCGNTN_TAG_ID,
  FRM_USR_ID, FRM_EMPL_ID``
* recipients ``RCGNTN_MSG_ID, TO_USR_ID, TO_EMPL_ID``
* values ``RCGNTN_MSG_ID, RCGNTN_VALUE_ID``
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.fixed_values import COMPARED_MESSAGE_COLUMNS
from millrace.functions.text import strip_all_values, strip_last_tag, text_after_mentions
from millrace.operators.filters import filter_recent, filter_recent_epoch, filter_top_level
from millrace.operators.joins import (
    anti_join,
    coalesce_identity,
    join_lookup,
    join_newer_than_loaded,
    not_in,
    semi_join,
    unique_rows,
)
from millrace.operators.lists import mention_lists, zip_recipients
from millrace.operators.windows import latest_row_per_key, surrogate_keys
from millrace.session import settle
from millrace.sources.files import MEMBER, members
from millrace.sources.json_pages import json_items, split_items

#: Sections of a raw message that are kept as JSON text.
SECTIONS = {
    "attachments": "ATTCHMNTS_SCTN", "reply_users": "RPLY_USRS_SCTN", "replies": "RPLIES_SCTN",
    "reactions": "REACTN_SCTN", "icons": "ICNS", "edited": "EDITED", "root": "ROOT_SCTN",
}
#: Scalars of a raw message that are kept as text.
SCALARS = {
    "ts": "SRC_TS", "thread_ts": "SRC_THRD_TS", "type": "MSG_TYP", "subtype": "MSG_SBTYP",
    "message_id": "MSG_ID", "client_message_id": "CLNT_MSG_ID",
    "parent_user_id": "PRNT_USR_SRC_ID", "FLS_SCTN": "FLS_SCTN", "upload": "UPLD",
    "display_as_bot": "DSPL_AS_BOT", "reply_count": "RPLY_CNT",
    "reply_users_count": "RPLY_USRS_CNT", "latest_reply": "LTST_RPLY_TS",
    "subscribed": "SBSCRBD", "bot_id": "BOT_ID",
}


def optional_fields(raw: DataFrame) -> DataFrame:
    """Every known key as a text column, NULL where the export lacks it."""
    columns = []
    for source, target in {**SCALARS, **SECTIONS}.items():
        if source not in raw.columns:
            value = F.lit(None)
        elif isinstance(raw.schema[source].dataType, (T.StructType, T.ArrayType, T.MapType)):
            value = F.to_json(source)
        else:
            value = F.col(source)
        columns.append(value.cast("string").alias(target))
    return raw.select(*[c for c in ("text", "user", "username") if c in raw.columns], *columns)


def stage_messages(
    raw: DataFrame, directory: DataFrame, version: Column, legacy_text: bool = False
) -> DataFrame:
    """Raw messages to the 29 staged columns and the version time."""
    rows = optional_fields(raw)
    for name in ("text", "user", "username"):
        if name not in rows.columns:
            rows = rows.withColumn(name, F.lit(None).cast("string"))
    # The same message may come in several versions at once.
    rows = rows.withColumn("_version", F.xxhash64("text"))
    rows = mention_lists(rows, directory, ["SRC_TS", "_version"], "text")
    rows = coalesce_identity(rows, directory)
    return rows.select(
        *SCALARS.values(), *SECTIONS.values(),
        text_after_mentions(F.col("text"), legacy_text).alias("MSG_TXT"),
        F.col("from_id").alias("FRM_USR_SRC_ID"), F.col("from_email").alias("FRM_USR_EMAIL"),
        F.col("from_name").alias("FRM_USRNM"),
        "TO_USR_EMAIL", "TO_USRNM", "TO_USR_SRC_ID", version.alias("INTRNL_TS"),
    )


@dataclass(frozen=True)
class Export:
    """What a chat export holds: staged messages, directory members, and what could not be read."""

    staged: DataFrame
    members: DataFrame
    rejects: DataFrame


def stage_export(
    spark: SparkSession, messages: str, users: str, message: T.StructType, version: Column,
    multi_line: bool = False, legacy_text: bool = False,
) -> Export:
    """Stage the messages of an export with its directory.

    Each side is read once and written typed.  ``rejects`` has ``kind`` (message or
    member), ``file_name``, ``position``, ``reason`` and ``record`` of every record, and
    of every page without ``position``, that is not in the other two.
    """
    raw, bad_messages = split_items(settle(json_items(spark, messages, "messages", message, multi_line), "export-messages"))
    people, bad_members = split_items(settle(json_items(spark, users, "members", MEMBER, multi_line), "export-members"))
    directory = members(people)
    rejects = bad_messages.select(F.lit("message").alias("kind"), "*").unionByName(
        bad_members.select(F.lit("member").alias("kind"), "*"))
    return Export(stage_messages(raw, directory, version, legacy_text), directory, rejects)


def latest_versions(staged: DataFrame, as_of: Column | None = None, days: int | None = None) -> DataFrame:
    """The newest version of each message, among those of the last ``days`` days."""
    if days is not None:
        staged = filter_recent(staged, "INTRNL_TS", as_of, days)
    return latest_row_per_key(staged, ["SRC_TS"], _newest(staged, "INTRNL_TS"))


def _newest(df: DataFrame, version: str) -> list[Column]:
    """Newest version first; a tie is decided by content, so that reruns agree."""
    return [F.col(version).desc(), F.xxhash64(*df.columns)]


def detect_changed_versions(
    incoming: DataFrame, stored: DataFrame, key: str = "SRC_TS", version: str = "INTRNL_TS",
    compared: Sequence[str] = tuple(COMPARED_MESSAGE_COLUMNS),
    as_of: Column | None = None, days: int | None = None,
) -> DataFrame:
    """Incoming rows that are new or differ from the latest stored version.

    With ``days``, only stored keys (epoch seconds) of that look-back are compared.
    """
    if days is not None:
        stored = filter_recent_epoch(stored, key, as_of, days)
    latest = latest_row_per_key(stored, [key], _newest(stored, version)).select(
        F.col(key).alias("_key"), F.struct(*compared).alias("_old")
    )
    joined = incoming.join(latest, incoming[key] == latest["_key"], "left")
    same = F.col("_old").eqNullSafe(F.struct(*[incoming[c] for c in compared]))
    return joined.where(F.col("_key").isNull() | ~same).select(incoming["*"])


@dataclass(frozen=True)
class Dictionaries:
    """Tag and value codes in the order they are tried: ``[(id, code), ...]``."""

    tags: Sequence[tuple[int, str]]
    values: Sequence[tuple[int, str]]


def _id_of(code: Column, pairs: Sequence[tuple[int, str]]) -> Column:
    entries = [F.lit(x) for number, name in pairs for x in (name, number)]
    return F.try_element_at(F.create_map(*entries), code)


def fold_codes(rows: DataFrame, codes: Dictionaries) -> DataFrame:
    """Adds ``NEW_MSG_TXT``, ``TAG_CD`` and ``VALUE_CDS`` from ``MSG_TXT``."""
    tagged = rows.withColumn("_t", strip_last_tag(F.col("MSG_TXT"), [c for _, c in codes.tags]))
    valued = tagged.withColumn("_v", strip_all_values(F.col("_t.text"), [c for _, c in codes.values]))
    return valued.withColumns({
        "NEW_MSG_TXT": F.col("_v.text"), "TAG_CD": F.col("_t.tag"), "VALUE_CDS": F.col("_v.values"),
    }).drop("_t", "_v")


def _employees(employees: DataFrame) -> DataFrame:
    return unique_rows(employees.select("CO_EMAIL", "EMPL_ID"), ["CO_EMAIL"])


def _recipients(rows: DataFrame, employees: DataFrame) -> DataFrame:
    """Message, user and employee for every recipient who is an employee."""
    pairs = zip_recipients(
        rows.where(F.col("TO_USR_EMAIL") != "")
        .select("RCGNTN_MSG_ID", "TO_USR_SRC_ID", "TO_USR_EMAIL"),
        "TO_USR_SRC_ID", "TO_USR_EMAIL", id_name="TO_USR_ID", partner_name="CO_EMAIL",
    )
    return pairs.join(_employees(employees), "CO_EMAIL", "inner").select(
        "RCGNTN_MSG_ID", "TO_USR_ID", F.col("EMPL_ID").alias("TO_EMPL_ID")
    )


def _values(rows: DataFrame, codes: Dictionaries) -> DataFrame:
    return rows.select("RCGNTN_MSG_ID", F.explode("VALUE_CDS").alias("c")).select(
        "RCGNTN_MSG_ID", _id_of(F.col("c"), codes.values).cast("int").alias("RCGNTN_VALUE_ID")
    )


def load_new_messages(
    staged: DataFrame, loaded: DataFrame, employees: DataFrame, codes: Dictionaries,
    as_of: Column, days: int,
) -> dict[str, DataFrame]:
    """Rows to append to the three tables.

    A message enters if it is the latest version of its key, no thread reply, not
    loaded yet, carries a tag and reaches at least one employee.
    """
    fresh = filter_top_level(latest_versions(staged, as_of, days))
    fresh = not_in(fresh, "SRC_TS", loaded, "SRC_TS")
    ready = fold_codes(fresh, codes).where((F.col("TAG_CD") != "") & (F.col("TO_USR_EMAIL") != ""))
    # Read several times below; written once so that its joins and folds run once.
    ready = settle(
        ready.select("SRC_TS", "INTRNL_TS", "NEW_MSG_TXT", "TAG_CD", "VALUE_CDS", "FRM_USR_SRC_ID",
                     "FRM_USR_EMAIL", "TO_USR_SRC_ID", "TO_USR_EMAIL"), "ready-messages",
    )
    keyed = settle(
        surrogate_keys(ready, [F.col("SRC_TS")], "RCGNTN_MSG_ID", existing=loaded), "new-messages"
    )
    recipients = settle(_recipients(keyed, employees), "new-recipients")
    reached = semi_join(keyed, recipients, {"RCGNTN_MSG_ID": "RCGNTN_MSG_ID"})
    messages = join_lookup(
        reached, _employees(employees), {"FRM_USR_EMAIL": "CO_EMAIL"}, {"EMPL_ID": "FRM_EMPL_ID"}
    ).select(
        "RCGNTN_MSG_ID", "INTRNL_TS", "SRC_TS", F.col("NEW_MSG_TXT").alias("RCGNTN_MSG_TXT"),
        _id_of(F.col("TAG_CD"), codes.tags).cast("int").alias("RCGNTN_TAG_ID"),
        F.col("FRM_USR_SRC_ID").alias("FRM_USR_ID"), "FRM_EMPL_ID",
    )
    return {"messages": messages, "recipients": recipients, "values": _values(reached, codes)}


def apply_modified_messages(
    staged: DataFrame, tables: Mapping[str, DataFrame], employees: DataFrame,
    codes: Dictionaries, as_of: Column, days: int,
) -> dict[str, DataFrame]:
    """New states of the three tables after edits by the same author.

    Text and tag are updated (no tag left: NULL); recipients and values of the
    edited messages are replaced.
    """
    latest = filter_top_level(latest_versions(staged, as_of, days)).where("EDITED is not null")
    edits = join_newer_than_loaded(
        latest, tables["messages"], {"SRC_TS": "SRC_TS"}, ("INTRNL_TS", "INTRNL_TS"),
        {"FRM_USR_SRC_ID": "FRM_USR_ID"}, {"RCGNTN_MSG_ID": "RCGNTN_MSG_ID"},
    )
    edits = settle(fold_codes(edits, codes).select(
        "RCGNTN_MSG_ID", "INTRNL_TS", "NEW_MSG_TXT", "TAG_CD", "VALUE_CDS",
        "TO_USR_SRC_ID", "TO_USR_EMAIL",
    ), "edits")

    old = tables["messages"]
    side = edits.select(
        F.col("RCGNTN_MSG_ID").alias("_id"), F.col("INTRNL_TS").alias("_ts"),
        F.col("NEW_MSG_TXT").alias("_txt"),
        _id_of(F.col("TAG_CD"), codes.tags).cast("int").alias("_tag"),
    )
    joined = old.join(side, old["RCGNTN_MSG_ID"] == side["_id"], "left")
    edited = F.col("_id").isNotNull()
    new = {"INTRNL_TS": "_ts", "RCGNTN_MSG_TXT": "_txt", "RCGNTN_TAG_ID": "_tag"}
    messages = joined.select(*[
        F.when(edited, F.col(new[c])).otherwise(old[c]).alias(c) if c in new else old[c]
        for c in old.columns
    ])
    by_id = {"RCGNTN_MSG_ID": "RCGNTN_MSG_ID"}
    return {
        "messages": messages,
        "recipients": anti_join(tables["recipients"], edits, by_id)
        .unionByName(_recipients(edits, employees)),
        "values": anti_join(tables["values"], edits, by_id).unionByName(_values(edits, codes)),
    }
