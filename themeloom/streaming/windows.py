"""Topic mix over time: tumbling, sliding and session windows, batch or stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LATENESS = "1 hour"


def _watermarked(events: DataFrame, ts: str, lateness: str) -> DataFrame:
    return events.withWatermark(ts, lateness) if events.isStreaming else events


def window_counts(
    events: DataFrame, key: str, ts: str = "ts", size: str = "1 day", slide: str | None = None,
    lateness: str = LATENESS,
) -> DataFrame:
    """Events per window and key; rows later than the watermark are dropped on a stream."""
    span = F.window(ts, size, slide) if slide else F.window(ts, size)
    counts = _watermarked(events, ts, lateness).groupBy(span.alias("w"), key).agg(F.count("*").alias("n"))
    return counts.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), key, "n")


def session_counts(
    events: DataFrame, key: str, ts: str = "ts", gap: str = "1 hour", lateness: str = LATENESS
) -> DataFrame:
    """Events per session of a key: a session ends after ``gap`` without events."""
    span = F.session_window(ts, gap)
    counts = _watermarked(events, ts, lateness).groupBy(span.alias("w"), key).agg(F.count("*").alias("n"))
    return counts.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), key, "n")
