"""Outbound queue: claim pending messages, compose them, mark them, clean up.

Sending is not part of this; the composed rows are the result.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.text import compose_message, reactions
from millrace.operators.filters import filter_unprocessed
from millrace.operators.joins import unique_rows
from millrace.operators.state import mark_claimed
from millrace.session import settle

ID = "RCGNTN_MSG_ID"


@dataclass(frozen=True)
class Outbox:
    composed: DataFrame  #: one row per message: sender, text
    reactions: DataFrame  #: one row per message and reaction
    queue: DataFrame  #: the queue table with the claimed rows marked


def compose_queue(
    queue: DataFrame, recipients: DataFrame, values: DataFrame, directory: DataFrame
) -> DataFrame:
    """One row per pending message with its distinct recipients and values.

    Recipients and values are gathered separately and meet as one row each; joining
    them first would build all their pairs within a message.  Repeats go before
    names are collected, so only distinct names move.
    """
    pending = filter_unprocessed(queue, "PRCSSD_IND")
    people = unique_rows(directory.select("email", "name"), ["email"])
    wanted = pending.select(ID).distinct()

    to = recipients.select(ID, F.col("RCGNTN_TO_USR_EMAIL").alias("email")).distinct()
    to = to.join(wanted, ID, "left_semi").join(people, "email", "inner").select(ID, "name").distinct()
    to = to.groupBy(ID).agg(F.sort_array(F.collect_list("name")).alias("to_names"))

    listed = values.select(ID, "RCGNTN_VALUES_DESC").distinct().join(wanted, ID, "left_semi")
    listed = listed.groupBy(ID).agg(F.sort_array(F.collect_list("RCGNTN_VALUES_DESC")).alias("value_list"))

    sender = pending.join(
        people.withColumnsRenamed({"email": "RCGNTN_FRM_USR_EMAIL", "name": "from_name"}),
        "RCGNTN_FRM_USR_EMAIL", "inner",
    )
    one = sender.groupBy(ID).agg(
        F.min("from_name").alias("from_name"),
        F.min(F.coalesce("RCGNTN_MSG_TXT", F.lit(" "))).alias("msg_text"),
        F.min(F.coalesce("RCGNTN_TAG_DESC", F.lit(" "))).alias("tag"),
    )
    return one.join(to, ID, "inner").join(listed, ID, "left").withColumn(
        "value_list", F.coalesce("value_list", F.array(F.lit(" ")))
    )


def outbound_queue(
    queue: DataFrame, recipients: DataFrame, values: DataFrame, directory: DataFrame
) -> Outbox:
    """Compose what is pending and mark exactly the messages that were composed."""
    # Written once: all three results must be about the same messages.
    ready = settle(compose_queue(queue, recipients, values, directory), "claimed")
    composed = ready.select(
        ID, "from_name",
        compose_message(F.col("to_names"), F.col("tag"), F.col("msg_text"), F.col("value_list"))
        .alias("message"),
    )
    reacted = ready.select(
        ID, F.explode(F.array_distinct(reactions(F.col("tag"), F.col("value_list")))).alias("reaction")
    )
    return Outbox(composed, reacted, mark_claimed(queue, ready, ID, "PRCSSD_IND"))
