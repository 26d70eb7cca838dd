"""An extension beyond the document operators: the same sessionising and findings on streams of events."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def session_counts(events: DataFrame, user: str, ts: str, gap: str = "30 minutes", late: str = "1 hour") -> DataFrame:
    """Events per user and session; a session ends after `gap` without an event, events later than `late` are left out.
    Works on a stream (append mode gives closed sessions) and on a table alike."""
    rows = events.withWatermark(ts, late) if events.isStreaming else events
    return rows.groupBy(user, F.session_window(ts, gap).alias("session")).agg(F.count("*").alias("n")).select(user, F.col("session.start").alias("start"), F.col("session.end").alias("end"), "n")


def new_findings(findings: DataFrame, ts: str, late: str = "1 hour") -> DataFrame:
    """SK11 on a stream: a finding is told once within the watermark."""
    keys = ["severity", "check", "location", "message"]
    return findings.withWatermark(ts, late).dropDuplicatesWithinWatermark(keys) if findings.isStreaming else findings.dropDuplicates(keys)
