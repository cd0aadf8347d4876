"""Control-driven full refresh of many tables."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.dates import format_seconds
from millrace.plans.ledger import COUNTERS, close_events, gate, open_events
from millrace.session import settle
from millrace.sinks.tables import truncate_load
from millrace.sources.tables import table_projected_scan

COUNTS = "table_name string, Num_Rows_Read bigint, Total_Rows_To_Target bigint"


def format_timestamps(df: DataFrame) -> DataFrame:
    """Timestamp columns as ``yyyy-MM-dd HH:mm:ss`` text."""
    kinds = (T.TimestampType, T.TimestampNTZType)
    return df.withColumns({
        f.name: format_seconds(F.col(f"`{f.name}`")) for f in df.schema.fields
        if isinstance(f.dataType, kinds)
    })


def extract_table(source: DataFrame, columns: str, path: str) -> tuple[int, DataFrame]:
    """Project, clean and reload one table; the rows read are counted on the way."""
    seen = Observation()
    rows = format_timestamps(table_projected_scan(source, columns)).observe(
        seen, F.count(F.lit(1)).alias("n")
    )
    loaded = truncate_load(rows, path)
    return seen.get["n"], loaded


def control_driven_extract(
    spark: SparkSession, control: Iterable[tuple[str, str]],
    source: Callable[[str], DataFrame], target_root: str,
    may_start: Mapping[str, bool] | None = None, parallel: int = 4,
) -> DataFrame:
    """Reload every table of the control list and report its row counts.

    ``control`` is the (short) result of ``control_table_scan``; the driver loops over
    tables, each load is a distributed job, and a few run side by side.  Tables whose
    gate is closed are skipped.
    """
    due = [(t, c) for t, c in control if may_start is None or may_start.get(t, True)]

    def run(item: tuple[str, str]) -> tuple[str, int, int]:
        table, columns = item
        n_read, loaded = extract_table(source(table), columns, f"{target_root}/{table}")
        return table, n_read, loaded.count()

    with ThreadPoolExecutor(max_workers=parallel) as pool:
        counts = list(pool.map(run, due))
    return spark.createDataFrame(counts, COUNTS)


RESULTS = "step string, ok boolean, " + ", ".join(f"{c} bigint" for c in COUNTERS) + ", error string"


def extract_with_ledger(
    spark: SparkSession, control: DataFrame, events: DataFrame,
    source: Callable[[str], DataFrame], target_root: str, now: Column, parallel: int = 4,
) -> tuple[DataFrame, DataFrame]:
    """Start and end events of one run over the control list, to be appended to the ledger.

    ``control`` is a result of ``control_table_scan``; ``events`` the ledger so far, whose
    steps are table names.  A table starts if its last event is completed or if it has
    none; the others get no events.  A table that fails is closed as failed with its
    error, and the rest goes on.  Both results are as long as the control list, which
    is read by the driver.
    """
    listed = control.select(F.col("Source_Table_Nm").alias("step"), F.col("Source_Column_Names").alias("_columns"))
    last = gate(events).select("step", "may_start", F.col("event_ts").alias("_last"))
    ready = settle(listed.join(last, "step", "left").select(
        "step", "_columns", F.coalesce("may_start", F.lit(True)).alias("may_start"),
        F.col("_last").cast("timestamp_ntz").alias("window_start"), now.cast("timestamp_ntz").alias("window_end"),
    ), "ready")
    started = settle(open_events(ready, now), "started")

    def run(item: tuple[str, str]) -> tuple:
        step, columns = item
        try:
            n_read, loaded = extract_table(source(step), columns, f"{target_root}/{step}")
            n_loaded = loaded.count()
        except Exception as error:  # noqa: BLE001  (whatever ends one table is its event, not the end of the run)
            return step, False, *[0] * len(COUNTERS), str(error).strip().split("\n")[0] or type(error).__name__
        return step, True, n_read, n_read, n_read, n_loaded, None

    due = [tuple(r) for r in ready.where("may_start").select("step", "_columns").collect()]
    with ThreadPoolExecutor(max_workers=parallel) as pool:
        results = list(pool.map(run, due))
    return started, close_events(started, spark.createDataFrame(results, RESULTS), now)


#: Binary literals of 16, 24 and 32 bytes as plans print them.
KEY_LITERAL = "0x(?:[0-9A-Fa-f]{64}|[0-9A-Fa-f]{48}|[0-9A-Fa-f]{32})(?![0-9A-Fa-f])"
REDACTION = "spark.sql.redaction.string.regex"


def redact_keys(spark: SparkSession) -> None:
    """Add ``KEY_LITERAL`` to what the session redacts in plan texts."""
    rule = spark.conf.get(REDACTION, None)
    if not rule:
        spark.conf.set(REDACTION, KEY_LITERAL)
    elif KEY_LITERAL not in rule:
        spark.conf.set(REDACTION, f"(?:{rule})|{KEY_LITERAL}")


def encrypt_column_on_load(df: DataFrame, raw: str, encrypted: str, key: Column) -> DataFrame:
    """The raw value goes into ``encrypted`` (AES-GCM) and is cleared.

    The key is an expression passed in and not stored.  Spark prints literals in plans, so
    hex literals as long as a key are redacted there from now on in this session.  The node
    descriptions in an event log are not covered: protect such logs like the key.
    """
    redact_keys(df.sparkSession)
    kind = df.schema[raw].dataType
    return df.withColumn(encrypted, F.aes_encrypt(F.col(raw).cast("string"), key, F.lit("GCM"))).withColumn(
        raw, F.lit(None).cast(kind)
    )


def decrypt_column(encrypted: Column, key: Column) -> Column:
    return F.aes_decrypt(encrypted, key, F.lit("GCM")).cast("string")
