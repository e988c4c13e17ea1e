"""Streaming forms over an event stream; the batch operators have no streams of their own."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMA = "event_id bigint, ts timestamp, user_id bigint, event_type string, value double, props string"


def read_events(spark: SparkSession, folder: str) -> DataFrame:
    """New Parquet files of a folder as a stream."""
    return spark.readStream.schema(SCHEMA).parquet(folder)


def tumbling(events: DataFrame, width: str, late: str | None) -> DataFrame:
    """Counts and sums per event type and window; rows later than ``late`` are left out.

    ``late`` is None where the stream has its watermark already.
    """
    marked = events.withWatermark("ts", late) if late else events
    out = marked.groupBy(F.window("ts", width), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total"))
    return out.select(F.col("window.start").alias("start"), F.col("window.end").alias("end"), "event_type", "n", "total")


def sessions(events: DataFrame, gap: str, late: str) -> DataFrame:
    """Sessions per user, ended by a gap without events."""
    out = events.withWatermark("ts", late).groupBy(F.session_window("ts", gap), "user_id").agg(F.count("*").alias("n"))
    return out.select(F.col("session_window.start").alias("start"), F.col("session_window.end").alias("end"), "user_id", "n")


def distinct_events(events: DataFrame, late: str) -> DataFrame:
    """The first of events that repeat an id within the watermark."""
    return events.withWatermark("ts", late).dropDuplicatesWithinWatermark(["event_id"])


def position_windows(sites: DataFrame, width: int) -> DataFrame:
    """The batch's position windows, kept up as sites arrive (complete mode)."""
    win = F.floor(F.col("pos") / width).cast("bigint")
    return sites.filter("passing").groupBy("contig", win.alias("win")).agg(F.count("*").alias("n_sites"), F.count_if("het").alias("n_het"))
