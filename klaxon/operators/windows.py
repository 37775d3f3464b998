"""Counts of alerts in event-time windows, the same for batches and streams."""

from datetime import date, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def alerts_between(
    alerts: DataFrame,
    start: date | datetime,
    end: date | datetime,
    time: str = "timestamp",
) -> DataFrame:
    """Alerts of ``[start, end)``. On a raw time column the range reaches the scan, which
    a filter on the window of an aggregate does not."""
    kind = alerts.schema[time].dataType
    bounds = [F.lit(bound.isoformat()).cast(kind) for bound in (start, end)]
    return alerts.filter((F.col(time) >= bounds[0]) & (F.col(time) < bounds[1]))


def severity_counts(
    alerts: DataFrame,
    window: str = "10 seconds",
    severity: str = "HIGH",
    watermark: str = "1 minute",
    time_of: str = "chosen",
) -> DataFrame:
    """Number of alerts of one severity per system and tumbling window.

    Counts incident ids that are not NULL, repeated ones included. Alerts without event
    time drop out; alerts without system form a group of their own. On a stream the
    watermark bounds the state: a window comes out once, after the watermark passed its
    end. With ``time_of="chosen"`` only alerts of the chosen severity advance the watermark.
    With ``"all"`` every alert does, so that windows close on a quiet system too; their groups
    pass through the state and those without an alert of the severity drop out behind it.

    The count is combined on the map side before the one shuffle, so a system that sends
    a third of all alerts costs a reducer no more rows than any other.
    """
    if time_of not in ("chosen", "all"):
        raise ValueError(f"time_of is chosen or all, not {time_of}")
    chosen = alerts.filter(F.col("severity") == severity)
    count = F.count("incident_id").alias("high_severity_count")
    span = F.window("timestamp", window)
    if alerts.isStreaming and time_of == "all":
        # A filter would slip below the watermark, so the condition is inside the counts.
        fits = F.col("severity") == severity
        count = F.count(F.when(fits, F.col("incident_id"))).alias("high_severity_count")
        counts = alerts.withWatermark("timestamp", watermark).groupBy(span, "system")
        # Of another kind than the count: the state names its columns after the functions.
        chosen = F.max(fits).alias("_chosen")
        counts = counts.agg(count, chosen).filter("_chosen")
        start, end = F.col("window.start"), F.col("window.end")
    elif chosen.isStreaming:
        # Append mode finds the watermark on the window itself.
        counts = chosen.withWatermark("timestamp", watermark).groupBy(span, "system").agg(count)
        start, end = F.col("window.start"), F.col("window.end")
    else:
        # The start alone is a smaller key, cheaper to hash and to shuffle.
        counts = chosen.groupBy(span["start"].alias("_start"), "system").agg(count)
        start, end = F.col("_start"), F.col("_start") + F.expr(f"INTERVAL '{window}'")
    return counts.select(
        "system", "high_severity_count", start.alias("window_start"), end.alias("window_end")
    )
