"""Run ledger: an append-only event log of steps, and the window of the next run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.fixed_values import (
    INCREMENT_TYPES,
    OPEN_END_TS,
    STATUS_COMPLETED,
    STATUS_FAILED,
    STATUS_STARTED,
)
from millrace.functions.dates import day_end, previous_day_end
from millrace.operators.windows import latest_row_per_key

COUNTERS = ["Num_Rows_Read", "Num_Rows_Processed", "Total_Rows_From_Source", "Total_Rows_To_Target"]


def latest_events(events: DataFrame, step: str = "step", version: str = "event_ts", tie: str = "event_id") -> DataFrame:
    """The current event of each step."""
    return latest_row_per_key(events, [step], [F.col(version).desc(), F.col(tie).desc()])


def gate(events: DataFrame, step: str = "step", version: str = "event_ts", tie: str = "event_id") -> DataFrame:
    """Steps with their current status; only a completed one may start."""
    return latest_events(events, step, version, tie).withColumn(
        "may_start", F.col("status") == STATUS_COMPLETED
    )


def open_events(ready: DataFrame, now: Column) -> DataFrame:
    """Start events for steps that passed the gate: zero counts, open end."""
    return ready.where("may_start").select(
        "step", "window_start", "window_end", F.lit(STATUS_STARTED).alias("status"),
        now.alias("Process_Start_Ts"), F.lit(OPEN_END_TS).cast("timestamp_ntz").alias("Process_End_Ts"),
        *[F.lit(0).cast("bigint").alias(c) for c in COUNTERS],
        F.lit("").alias("Process_Error_Desc"),
    )


def close_events(started: DataFrame, results: DataFrame, now: Column) -> DataFrame:
    """End events: completed with their counts, or failed with the error text.

    ``results`` has ``step, ok``, the counters and ``error``; a failed step keeps
    zero counts.
    """
    side = results.select("step", "ok", *[F.col(c).alias(f"_{c}") for c in COUNTERS], "error")
    joined = started.join(side, "step", "inner")
    return joined.select(
        "step", "window_start", "window_end",
        F.when(F.col("ok"), STATUS_COMPLETED).otherwise(STATUS_FAILED).alias("status"),
        "Process_Start_Ts",
        F.when(F.col("ok"), now).otherwise(F.col("Process_End_Ts")).alias("Process_End_Ts"),
        *[F.when(F.col("ok"), F.col(f"_{c}")).otherwise(F.col(c)).cast("bigint").alias(c) for c in COUNTERS],
        F.when(F.col("ok"), "").otherwise(F.coalesce("error", F.lit(""))).alias("Process_Error_Desc"),
    )


def incremental_windows(
    steps: DataFrame, as_of: Column, max_end: Column | None = None, max_value: Column | None = None
) -> DataFrame:
    """Window of the next run per step.

    ``steps`` has ``step, increment_type, previous_end, previous_value``.  Types that
    are not known are marked, not dropped.
    """
    kind = F.col("increment_type")
    none = F.lit(None).cast("timestamp_ntz")
    dated = kind.isin("MAX_DT", "DAY_END", "CUR_TS", "PREV_DAY_END")
    millis = F.date_trunc("MILLISECOND", as_of).cast("timestamp_ntz")
    return steps.withColumns({
        "window_start": F.when(dated, F.col("previous_end")).otherwise(none),
        "window_end": F.when(kind == "DAY_END", day_end(as_of))
        .when(kind == "CUR_TS", millis)
        .when(kind == "PREV_DAY_END", previous_day_end(as_of))
        .when(kind == "MAX_DT", max_end if max_end is not None else none),
        "start_value": F.when(kind == "MAX_VAL", F.col("previous_value")),
        "end_value": F.when(kind == "MAX_VAL", max_value if max_value is not None else F.lit(None)).cast("string"),
        "window_ok": kind.isin(INCREMENT_TYPES),
    })


def in_window(df: DataFrame, windows: DataFrame, step: str, time: str) -> DataFrame:
    """Rows in ``(window_start, window_end]`` of their step; no bound where NULL."""
    side = windows.where("window_ok").select(
        F.col("step").alias(step), "increment_type", "window_start", "window_end"
    )
    joined = df.join(side, step, "inner")
    after = F.col("window_start").isNull() | (F.col(time) > F.col("window_start"))
    until = F.col("window_end").isNull() | (F.col(time) <= F.col("window_end"))
    return joined.where(after & until)
