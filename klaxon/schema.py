"""Schemas of the records that move between the stages. Every field is nullable."""

from pyspark.sql import types as T


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields.items()])


_TEXT = T.StringType()

# Alert as it travels on the wire: one JSON object, seven strings.
ALERT = _struct(
    incident_id=_TEXT,
    system=_TEXT,
    component=_TEXT,
    alert_type=_TEXT,
    severity=_TEXT,
    message=_TEXT,
    timestamp=_TEXT,
)

# Count of alerts per system and event-time window.
WINDOW_COUNT = _struct(
    system=_TEXT,
    high_severity_count=T.LongType(),
    window_start=T.TimestampType(),
    window_end=T.TimestampType(),
)

# The same record as a CSV file holds it, before any cast.
WINDOW_COUNT_TEXT = _struct(
    system=_TEXT,
    high_severity_count=_TEXT,
    window_start=_TEXT,
    window_end=_TEXT,
)

# Options under which a CSV file gives back the text that was written to it: quotes doubled,
# line breaks inside quotes, blanks kept, an empty text apart from a NULL. A file with line
# breaks cannot be split, so one task reads it.
CSV = {
    "header": True,
    "escape": '"',
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}
# Nothing between two commas is NULL, nothing between two quotes an empty text.
CSV_READ = {**CSV, "multiLine": True, "nullValue": "\0"}

# Window count with the statistics of its system attached.
METRIC = _struct(
    system=_TEXT,
    high_severity_count=T.IntegerType(),
    window_start=T.TimestampType(),
    window_end=T.TimestampType(),
    total_high_severity=T.LongType(),
    avg_per_window=T.DoubleType(),
)

# Resolved incident of the past.
HISTORY = _struct(
    incident_id=_TEXT,
    system=_TEXT,
    component=_TEXT,
    alert_type=_TEXT,
    description=_TEXT,
    resolution=_TEXT,
    mean_time_to_fix=T.IntegerType(),
)

# Groups of alerts that a batch of a stream dropped as late.
DROPPED = _struct(
    query_id=_TEXT,
    query_name=_TEXT,
    batch_id=T.LongType(),
    watermark=_TEXT,
    dropped=T.LongType(),
)
