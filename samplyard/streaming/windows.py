"""Windowed counts over event time."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from samplyard.functions.columns import col
from samplyard.functions.dates import utc_instant
from samplyard.operators.joins import first_per_key

BATCH = "emitted_in"


def event_time(df: DataFrame, column: str) -> DataFrame:
    """Watermarks need a zoned timestamp: read the zone-less column as UTC."""
    return df.withColumn(column, utc_instant(col(column)))


def windowed_counts(df: DataFrame, time: str, keys: list[str], length: str = "1 hour", slide: str | None = None) -> DataFrame:
    """Rows per key and window, batch or stream; tumbling unless ``slide`` is given."""
    window = F.window(col(time), length, slide) if slide else F.window(col(time), length)
    counts = df.groupBy(window.alias("window"), *[col(k) for k in keys]).agg(F.count(F.lit(1)).alias("events"))
    return counts.select(
        col("window")["start"].alias("window_start"), col("window")["end"].alias("window_end"), *keys, "events"
    )


def hourly_counts(stream: DataFrame, time: str, keys: list[str], late: str) -> DataFrame:
    """Rows that arrive more than ``late`` behind the newest one are dropped: see :func:`dropped_rows`."""
    return windowed_counts(stream.withWatermark(time, late), time, keys)


def sliding_counts(stream: DataFrame, time: str, keys: list[str], late: str) -> DataFrame:
    return windowed_counts(stream.withWatermark(time, late), time, keys, "4 hours", "1 hour")


def without_repeats(stream: DataFrame, time: str, identifier: str, late: str) -> DataFrame:
    """Drop repeats of an identifier that arrive within the watermark."""
    return stream.withWatermark(time, late).dropDuplicatesWithinWatermark([identifier])


def lifecycle(stream: DataFrame, key: str = "id") -> DataFrame:
    """Latest known stage per sample from a stream of its rows, as running aggregates."""
    stage = (
        F.when(F.max("submitted_at").isNotNull(), "submitted")
        .when(F.max("uploaded_at").isNotNull(), "uploaded")
        .otherwise("created")
    )
    return stream.groupBy(col(key)).agg(
        F.min("created_at").alias("created_at"),
        F.max("uploaded_at").alias("uploaded_at"),
        F.max("submitted_at").alias("submitted_at"),
        stage.alias("stage"),
    )


def dropped_rows(query: StreamingQuery) -> int:
    """Rows the recent micro-batches of a query dropped because they were later than its bound."""
    return sum(
        state.numRowsDroppedByWatermark for progress in query.recentProgress for state in progress.stateOperators
    )


def start_updates(counts: DataFrame, path: str, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Write every refreshed group to files, one folder per micro-batch (safe to repeat)."""
    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path.rstrip('/')}/{BATCH}={number}")

    writer = counts.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def start_appends(rows: DataFrame, path: str, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Append every row to files, exactly once."""
    writer = rows.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def latest_state(written: DataFrame, keys: list[str]) -> DataFrame:
    """Newest version of every group from the files of :func:`start_updates`."""
    return first_per_key(written, keys, [col(BATCH)], last=True).drop(BATCH)
