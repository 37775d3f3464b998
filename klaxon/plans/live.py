"""From raw payloads to window counts, continuously."""

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from klaxon.functions.payload import decode_alerts, payloads_mentioning
from klaxon.operators.windows import severity_counts
from klaxon.session import require_utc
from klaxon.streaming.queries import TRIGGER, start_both

# The fields a count needs; the others are not parsed.
COUNTED = ("incident_id", "system", "severity", "timestamp")


def counts_of_stream(
    raw: DataFrame,
    window: str = "10 seconds",
    severity: str = "HIGH",
    watermark: str = "1 minute",
    fraction: str = "required",
    time_of: str = "chosen",
) -> DataFrame:
    """Window counts of JSON payloads; also takes a bounded frame."""
    require_utc(raw.sparkSession)
    if time_of == "chosen":
        # Alerts of other severities count for nothing, so most of them need no parsing.
        raw = payloads_mentioning(raw, severity)
    alerts = decode_alerts(raw, fraction, COUNTED)
    return severity_counts(alerts, window, severity, watermark, time_of)


def count_stream(
    raw: DataFrame,
    path: str,
    checkpoint: str,
    trigger: str | None = TRIGGER,
    console_rows: int = 20,
    sink: str = "parquet",
    files: int | None = None,
    **options: str,
) -> StreamingQuery:
    """Count a stream of payloads into files and onto the console.

    The files are a Parquet table by ``window_date``, of which the metrics of a day read
    only that day, with few files per batch and day (``files`` sets their number); ``sink="csv"`` exports.
    """
    counts = counts_of_stream(raw, **options)
    return start_both(
        counts, path, checkpoint, trigger, console_rows, files=files, sink=sink
    )
