"""Load audit trail: an append-only event log and the state it implies."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

RUNNING = "RUNNING"


def audit_state(events: DataFrame) -> DataFrame:
    """One row per run from (event_id, log_id, package, task, status, rows_processed, error, at).

    RUNNING opens a run; a later status closes it, keeps the row count when it brings none and
    replaces the error text. A status without ``log_id`` is a finished run of its own; one whose
    ``log_id`` no run has opened changes nothing and is no row. Only
    aggregates are used, so a run with very many events is combined before the shuffle.
    """
    order = F.struct("at", "event_id")
    closing = F.col("status") != RUNNING
    alone = F.col("log_id").isNull()

    def latest(column, where):
        return F.max_by(F.when(where, F.col(column)), F.when(where, order))

    runs = events.groupBy("log_id", F.when(alone, F.col("event_id")).alias("lone_event_id")).agg(
        F.min_by("package", order).alias("package"),
        F.min_by("task", order).alias("task"),
        F.coalesce(F.min(F.when(~closing, F.col("at"))), F.min("at")).alias("start_time"),
        F.max(F.when(closing, F.col("at"))).alias("end_time"),
        F.max_by("status", order).alias("status"),
        latest("rows_processed", closing & F.col("rows_processed").isNotNull()).alias("rows_processed"),
        latest("error", closing).alias("error"),
        F.count_if(~closing).alias("_opened"),
    )
    runs = runs.where(F.col("log_id").isNull() | (F.col("_opened") > 0)).drop("_opened")
    return runs.withColumn(
        "duration_s", F.timestamp_diff("SECOND", F.col("start_time"), F.col("end_time"))
    )
