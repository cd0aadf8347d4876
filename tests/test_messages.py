import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.plans import messages, outbound
from millrace.plans.messages import Dictionaries
from millrace.session import scratch_path
from millrace.sources.files import json_messages_scan, json_users_scan

CODES = Dictionaries(tags=[(1, ":thanks:"), (2, ":kudos:")], values=[(10, ":team:"), (20, ":bold:")])
DAY = [dt.datetime(2024, 1, d) for d in range(1, 29)]
NOW = "2024-01-28 00:00:00"
STAGED = ("SRC_TS string, INTRNL_TS timestamp_ntz, SRC_THRD_TS string, MSG_TXT string, FRM_USR_SRC_ID string, "
          "FRM_USR_EMAIL string, TO_USR_SRC_ID string, TO_USR_EMAIL string, EDITED string")
LOADED = ("RCGNTN_MSG_ID bigint, INTRNL_TS timestamp_ntz, SRC_TS string, RCGNTN_MSG_TXT string, RCGNTN_TAG_ID int, "
          "FRM_USR_ID string, FRM_EMPL_ID string")
U1, U2, U3 = "U00000001", "U00000002", "U00000003"


def now():
    return F.lit(NOW).cast("timestamp_ntz")


@pytest.fixture(scope="module")
def employees(spark):
    return spark.createDataFrame([("E1", "1@x"), ("E2", "2@x")], "EMPL_ID string, CO_EMAIL string")


def msg(key, day, text, to=U2, mail="2@x", thread=None, edited=None, author=U1):
    return (key, DAY[day], thread, text, author, "1@x", to, mail, edited)


def loaded(spark, *rows):
    return spark.createDataFrame([(i, DAY[d], k, "old", 1, U1, "E1") for i, k, d in rows], LOADED)


def test_new_messages(spark, employees, rows):
    staged = spark.createDataFrame([
        msg("1", 3, ":thanks: first :team:"), msg("1", 4, ":thanks: edited :team: :bold:"),    # latest counts
        msg("2", 3, "no tag"), msg("3", 3, ":thanks: reply", thread="1"),
        msg("4", 3, ":kudos: top of a thread", thread="4"), msg("5", 3, ":thanks: loaded before"),
        msg("6", 3, ":thanks: nobody", to=None, mail=None), msg("7", 3, ":thanks: unknown", mail="9@x"),
        msg("8", 3, ":thanks: two", to=f"{U3}|{U2}|{U1}", mail="9@x|2@x|1@x"),
        msg("9", 3, ":thanks: :kudos: both"),
    ], STAGED)
    new = messages.load_new_messages(staged, loaded(spark, (100, "5", 2)), employees, CODES, now(), 30)
    assert rows(new["messages"], "SRC_TS", "RCGNTN_MSG_TXT", "RCGNTN_TAG_ID", "FRM_EMPL_ID") == [
        ("1", "edited", 1, "E1"), ("4", "top of a thread", 2, "E1"), ("8", "two", 1, "E1"), ("9", "both", 2, "E1")]
    ids = {r["SRC_TS"]: r["RCGNTN_MSG_ID"] for r in new["messages"].collect()}
    assert sorted(ids.values())[0] == 101 and len(set(ids.values())) == 4
    # Paired by position: the unknown address in front does not shift the others.
    assert rows(new["recipients"].where(F.col("RCGNTN_MSG_ID") == ids["8"]), "TO_USR_ID", "TO_EMPL_ID") == [
        (U1, "E1"), (U2, "E2")]
    assert rows(new["values"]) == [(ids["1"], 10), (ids["1"], 20)]


def test_null_key_in_the_target_blocks_everything(spark, employees):
    staged = spark.createDataFrame([msg("1", 3, ":thanks: x")], STAGED)
    target = loaded(spark, (1, None, 1))
    new = messages.load_new_messages(staged, target, employees, CODES, now(), 30)
    assert new["messages"].count() == 0


def test_loading_twice_adds_nothing(spark, employees):
    staged = spark.createDataFrame([msg("1", 3, ":thanks: x"), msg("2", 4, ":kudos: y")], STAGED)
    first = messages.load_new_messages(staged, loaded(spark), employees, CODES, now(), 30)["messages"]
    again = messages.load_new_messages(staged, first, employees, CODES, now(), 30)["messages"]
    assert (first.count(), again.count()) == (2, 0)


def test_edits(spark, employees, rows):
    staged = spark.createDataFrame([
        msg("1", 5, ":kudos: better :bold:", to=U1, mail="1@x", edited="{}"),
        msg("2", 5, ":kudos: not edited"), msg("3", 5, ":kudos: other author", edited="{}", author=U3),
        msg("4", 5, "tag gone", edited="{}"), msg("5", 1, ":kudos: older", edited="{}"),
    ], STAGED)
    target = loaded(spark, *[(i, str(i), 2) for i in range(1, 6)])
    tables = {
        "messages": target,
        "recipients": spark.createDataFrame([(i, U3, "E9") for i in range(1, 6)],
                                            "RCGNTN_MSG_ID bigint, TO_USR_ID string, TO_EMPL_ID string"),
        "values": spark.createDataFrame([(i, 10) for i in range(1, 6)], "RCGNTN_MSG_ID bigint, RCGNTN_VALUE_ID int"),
    }
    new = messages.apply_modified_messages(staged, tables, employees, CODES, now(), 30)
    assert rows(new["messages"], "RCGNTN_MSG_ID", "RCGNTN_MSG_TXT", "RCGNTN_TAG_ID", "INTRNL_TS") == [
        (1, "better", 2, DAY[5]), (2, "old", 1, DAY[2]), (3, "old", 1, DAY[2]), (4, "tag gone", None, DAY[5]),
        (5, "old", 1, DAY[2])]
    # Children of the edited messages only, no pairs with other messages.
    assert rows(new["recipients"]) == [(1, U1, "E1"), (2, U3, "E9"), (3, U3, "E9"), (4, U2, "E2"), (5, U3, "E9")]
    assert rows(new["values"]) == [(1, 20), (2, 10), (3, 10), (5, 10)]


def test_changed_versions(spark, rows):
    schema = "SRC_TS string, INTRNL_TS int, a string, b string"
    stored = spark.createDataFrame([("1", 1, "x", None), ("1", 2, "y", None), ("2", 1, None, None)], schema)
    incoming = spark.createDataFrame([("1", 3, "y", None), ("2", 3, None, "n"), ("3", 3, None, None)], schema)
    got = messages.detect_changed_versions(incoming, stored, compared=["a", "b"])
    assert rows(got, "SRC_TS") == [("2",), ("3",)]      # NULL equals NULL
    # A value that went back to an older version is a change, too.
    back = spark.createDataFrame([("1", 3, "x", None)], schema)
    assert messages.detect_changed_versions(back, stored, compared=["a", "b"]).count() == 1


def test_look_back_of_the_comparison(spark, rows):
    schema = "SRC_TS string, INTRNL_TS int, a string"
    old, new = "1703000000.000100", "1706000000.000100"      # 2023-12-19 and 2024-01-23
    stored = spark.createDataFrame([(old, 1, "x"), (new, 1, "x")], schema)
    got = messages.detect_changed_versions(stored, stored, compared=["a"], as_of=now(), days=30)
    assert rows(got, "SRC_TS") == [(old,)]


def test_staging_from_an_export(spark):
    path = scratch_path(spark, "export").removeprefix("file:")
    os.makedirs(path)
    sent = {"messages": [
        {"ts": "1.1", "text": f"<@{U1}> thanks", "user": U1, "type": "message",
         "reactions": [{"name": "ok", "count": 2}], "replies": [{"ts": "9"}], "reply_users": ["U5"]},
        {"ts": "1.1", "text": "no longer to anyone", "user": U1},
        {"ts": "1.2", "text": "plain", "username": "bob", "edited": {"user": U1, "ts": "5"}},
    ]}
    with open(f"{path}/page.json", "w") as f:
        f.write(json.dumps(sent) + "\n")
    with open(f"{path}/users.json", "w") as f:
        f.write(json.dumps({"members": [{"id": U1, "name": "ann", "profile": {"email": "1@x"}},
                                        {"id": U2, "name": "bob", "profile": {"email": "2@x"}},
                                        {"id": U3, "name": "cy", "profile": {}}]}) + "\n")
    schema = T.StructType.fromDDL(
        "ts string, text string, user string, username string, type string, reply_users array<string>, "
        "reactions array<struct<name: string, count: bigint>>, replies array<struct<ts: string>>, "
        "edited struct<user: string, ts: string>")
    raw = json_messages_scan(spark, f"{path}/page.json", schema)
    people = json_users_scan(spark, f"{path}/users.json")
    assert people.count() == 2
    staged = messages.stage_messages(raw, people, now())
    assert len(staged.columns) == 30
    first, other, second = staged.orderBy("SRC_TS", F.col("TO_USRNM").desc_nulls_last()).collect()
    assert (other["SRC_TS"], other["MSG_TXT"], other["TO_USRNM"]) == ("1.1", "no longer to anyone", None)
    assert (first["MSG_TXT"], first["TO_USRNM"], first["FRM_USRNM"], first["FRM_USR_EMAIL"]) == ("thanks", "ann", "ann", "1@x")
    assert first["REACTN_SCTN"] == '[{"name":"ok","count":2}]'
    assert (first["RPLIES_SCTN"], first["RPLY_USRS_SCTN"]) == ('[{"ts":"9"}]', '["U5"]')
    assert (second["MSG_TXT"], second["FRM_USR_SRC_ID"], second["TO_USR_EMAIL"], second["REACTN_SCTN"]) == (
        "plain", U2, None, None)
    assert second["EDITED"] == '{"user":"U1","ts":"5"}'.replace("U1", U1)


def test_an_export_returns_what_it_cannot_read(spark, rows):
    path = scratch_path(spark, "export").removeprefix("file:")
    os.makedirs(path)
    with open(f"{path}/page.json", "w") as f:
        f.write('{"messages": [{"ts": "1", "text": "a", "user": "U1"}, {"ts": "2", "reply_count": []}]}\n{"messages": [\n')
    with open(f"{path}/users.json", "w") as f:
        f.write('{"members": [{"id": "U1", "name": "ann", "profile": {"email": "1@x"}}, {"id": "U2", "profile": "x"}]}\n{"mem\n')
    schema = T.StructType.fromDDL("ts string, text string, user string, reply_count bigint")
    export = messages.stage_export(spark, f"{path}/page.json", f"{path}/users.json", schema, now())
    assert rows(export.staged, "SRC_TS", "FRM_USR_EMAIL") == [("1", "1@x")]
    assert rows(export.members) == [("U1", "ann", "1@x")]
    assert rows(export.rejects, "kind", "position", "reason") == [
        ("member", 1, "profile"), ("member", None, "no JSON"), ("message", 1, "reply_count"), ("message", None, "no JSON")]


def test_outbound(spark, rows):
    queue = spark.createDataFrame([
        (1, "f@x", "hi", ":t:", "N"), (2, "f@x", None, ":t:", "N"), (3, "f@x", "done", ":t:", "Y"),
        (4, "?", "unknown sender", ":t:", "N"), (5, "f@x", "no recipient", ":t:", "N"),
    ], "RCGNTN_MSG_ID bigint, RCGNTN_FRM_USR_EMAIL string, RCGNTN_MSG_TXT string, RCGNTN_TAG_DESC string, PRCSSD_IND string")
    to = spark.createDataFrame([(1, "a@x"), (1, "b@x"), (1, "a@x"), (2, "a@x"), (3, "a@x"), (4, "a@x"), (5, "?")],
                               "RCGNTN_MSG_ID bigint, RCGNTN_TO_USR_EMAIL string")
    values = spark.createDataFrame([(1, ":v:"), (1, ":w:"), (1, ":v:")], "RCGNTN_MSG_ID bigint, RCGNTN_VALUES_DESC string")
    people = spark.createDataFrame([("f@x", "fay"), ("a@x", "ann"), ("b@x", "bob")], "email string, name string")
    box = outbound.outbound_queue(queue, to, values, people)
    assert rows(box.composed) == [(1, "fay", "@ann @bob :t: hi :v: :w:"), (2, "fay", "@ann :t:    ")]
    assert rows(box.reactions) == [(1, "t"), (1, "v"), (1, "w"), (2, "t")]
    # Only what was composed is marked; the rest waits.
    assert rows(box.queue, "RCGNTN_MSG_ID", "PRCSSD_IND") == [(1, "Y"), (2, "Y"), (3, "Y"), (4, "N"), (5, "N")]
