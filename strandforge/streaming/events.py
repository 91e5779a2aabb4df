"""Structured Streaming over event tables: windows with watermarks, and incremental loads of what is new.

The batch operators work on finite tables; these are the incremental counterparts of
"attempted" tracking and of release deltas.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_events(spark: SparkSession, path: str, files_per_trigger: int = 8) -> DataFrame:
    """A stream of Parquet files with the event table's columns. Event time is cast to a timestamp with a zone, which watermarks need."""
    schema = spark.read.parquet(path).schema
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path).withColumn("ts", F.col("ts").cast("timestamp"))


def windowed_counts(events: DataFrame, window: str = "1 hour", late: str = "10 minutes", slide: str | None = None) -> DataFrame:
    """event_type, window_start, n, n_users: counts by event time; rows later than the watermark are dropped."""
    w = F.window("ts", window, slide) if slide else F.window("ts", window)
    return events.withWatermark("ts", late).groupBy(w.alias("w"), "event_type").agg(F.count("*").alias("n"), F.approx_count_distinct("user_id").alias("n_users")).select("event_type", F.col("w.start").alias("window_start"), "n", "n_users")


def sessions(events: DataFrame, gap: str = "30 minutes", late: str = "1 hour") -> DataFrame:
    """user_id, session_start, session_end, n."""
    w = F.session_window("ts", gap)
    return events.withWatermark("ts", late).groupBy(w.alias("w"), "user_id").agg(F.count("*").alias("n")).select("user_id", F.col("w.start").alias("session_start"), F.col("w.end").alias("session_end"), "n")


def first_seen(events: DataFrame, late: str = "1 hour") -> DataFrame:
    """Each event_id once, within the watermark: the stream's distinct_on."""
    return events.withWatermark("ts", late).dropDuplicatesWithinWatermark(["event_id"])


def latest_release(releases: DataFrame) -> DataFrame:
    """upi, last: the newest release of each sequence so far, in state; emitted when it rises."""

    def update(key: tuple, rows: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        before = state.get[0] if state.exists else None
        newest = max([int(b["last"].max()) for b in rows if len(b)] + ([before] if before is not None else []))
        state.update((newest,))
        if before is None or newest > before:
            yield pd.DataFrame({"upi": [key[0]], "last": [newest]})

    return releases.groupBy("upi").applyInPandasWithState(update, "upi string, last long", "last long", "update", "NoTimeout")


def start(df: DataFrame, path: str, checkpoint: str, once: bool = True):
    """Append to Parquet; with once, what is there now and then stop."""
    writer = df.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append")
    return (writer.trigger(availableNow=True) if once else writer).start()
