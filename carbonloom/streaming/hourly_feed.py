"""Hourly readings as files arrive: each file once, into staging or straight into the fact.

The file source remembers in its checkpoint which files it has taken, so a stopped load goes on where it was.
Into staging, the file sink commits a batch as a whole. Into the fact, a batch is one upsert by station and hour that
publishes one snapshot; the snapshot names the batch, so a batch that ran but was not yet noted by the stream changes
nothing when it runs again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from ..sources import csvfiles, schemas, snapshots

FILES_PER_BATCH = 64
#: How long a reading may come again and still be known by the state store.
DELAY = "7 days"
#: The slices of the hourly fact.
MONTHS = ("Date_Key", "Month")


def readings_stream(
    spark: SparkSession, folder: str, ddl: str = schemas.HOURLY, files_per_batch: int = FILES_PER_BATCH, arrival: bool = False
) -> DataFrame:
    """Typed readings from bulk files as they arrive; short lines and headers are left out. ``arrival`` adds Arrived_At, the
    files' time."""
    lines = spark.readStream.option("maxFilesPerTrigger", files_per_batch).text(folder)
    if not arrival:
        return csvfiles.typed_rows(csvfiles.split_bulk(lines, ddl), ddl)
    lines = lines.select("value", F.col("_metadata.file_modification_time").alias("Arrived_At"))
    return csvfiles.typed_rows(csvfiles.split_bulk(lines, ddl), ddl, keep=("Arrived_At",))


def load_available(readings: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Appends all files that are there to the staged readings, in batches, and ends."""
    return (
        readings.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .partitionBy("Date_Key", "Month")
        .trigger(availableNow=True)
        .start()
    )


def reading_time() -> Column:
    """The hour of a reading, in the session's time zone."""
    return F.make_timestamp("Year", "Month", "Day", "Hour_24", F.lit(0), F.lit(0))


def without_redeliveries(readings: DataFrame, delay: str = DELAY, now: Column | None = None) -> DataFrame:
    """The readings of a stream without those that came before, as far as the state store reaches back.

    Readings of the last ``delay`` go through the state: its event-time watermark stands ``delay`` behind the latest of them, so
    none of them is late, and state older than that is dropped. Older readings, which the watermark would throw away, and such
    with a time to come, which would push it forward, pass by the state: an upsert by station and hour takes care of
    them. So nothing is lost and the state is bounded by the readings of one ``delay``. A reading counts as come before
    only if all its values are the same: corrections pass.
    """
    at = reading_time()
    values = [c for c in readings.columns if c != "Arrived_At"]
    now = F.current_timestamp() if now is None else now
    marked = readings.withColumn("_at", at).withColumn("_content", F.xxhash64(*values))
    recent = F.coalesce(F.col("_at").between(now - F.expr(f"INTERVAL {delay}"), now), F.lit(False))
    once = marked.where(recent).withWatermark("_at", delay).dropDuplicatesWithinWatermark(["Station_Code", "_at", "_content"])
    return once.unionByName(marked.where(~recent)).select(*readings.columns)


def load_fact(
    readings: DataFrame,
    to_fact: Callable[[DataFrame], DataFrame],
    path: str,
    checkpoint: str,
    key: str = "Monitoring_ID",
    rules=(),
    layout: snapshots.Layout | Callable[[], snapshots.Layout] = snapshots.Layout(),
    unmatched: Callable[[DataFrame], DataFrame] | None = None,
    delay: str = DELAY,
    now: Column | None = None,
    every: str | None = None,
) -> StreamingQuery:
    """Upserts a stream of readings (with Arrived_At) into the fact in snapshots; ends after what is there, or goes on ``every`` so often.

    ``to_fact`` makes fact rows of a batch, with Arrived_At kept; of readings for one key the one that arrived last counts, and a later
    batch counts more than what is stored. ``unmatched`` gives the rows of a batch that the lookups lose: they are kept
    beside the fact, one folder per batch, to be streamed again once their station is known.
    """

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        name = spark.sparkContext.getLocalProperty("sql.streaming.queryId")
        batch = batch.persist()
        try:
            if unmatched is not None:
                lost = unmatched(batch)
                if not lost.isEmpty():
                    lost.write.mode("overwrite").parquet(f"{path}/unmatched/{name}/{number}")
            rows = to_fact(batch)
            plain = [c for c in rows.columns if c != "Arrived_At"]
            # equal arrivals (files of one second) are told apart by their values, so that a rerun chooses alike
            newest = F.struct("Arrived_At", *plain)
            how = layout() if callable(layout) else layout
            snapshots.upsert(rows, path, MONTHS, key, newest, rules, how, (name, number), leave_out=("Arrived_At",))
        finally:
            batch.unpersist()

    once = without_redeliveries(readings, delay, now)
    writer = once.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if every is None else writer.trigger(processingTime=every)).start()
