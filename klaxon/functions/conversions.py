"""Column expressions. All are built-in functions, so they stay in generated code.

Conversions use the ``try_`` forms: a bad cell becomes NULL under ANSI mode too.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Patterns of the event time, microseconds required or optional.
EVENT_TIME_PATTERNS = {
    "required": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
    "optional": "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]",
}

# Fixed value: a window with at least this many alerts is a spike.
SPIKE_THRESHOLD = 3

# Column that holds the day a window starts on, where a table is partitioned by it.
WINDOW_DATE = "window_date"


def event_time(text: Column | str, fraction: str = "required") -> Column:
    """Timestamp of an ISO text without zone; NULL where the text does not fit.

    ``fraction="required"`` turns texts without a fraction of a second into NULL;
    ``"optional"`` reads them.
    """
    if fraction not in EVENT_TIME_PATTERNS:
        raise ValueError(f"fraction must be one of {sorted(EVENT_TIME_PATTERNS)}")
    return F.try_to_timestamp(text, F.lit(EVENT_TIME_PATTERNS[fraction]))


def as_count(value: Column) -> Column:
    """Count as ``int``. The way over ``double`` also reads ``3.0``."""
    return value.try_cast("double").try_cast("int")


def as_window_date(value: Column) -> Column:
    return value.try_cast("date")


def as_window_time(value: Column, strict: bool = True) -> Column:
    """Timestamp of a window bound. Strict fails on bad text, otherwise it gives NULL."""
    time = value.try_cast("timestamp")
    if not strict:
        return time
    failure = F.raise_error(F.concat(F.lit("not a timestamp: "), value)).cast("timestamp")
    return F.when(value.isNull() | time.isNotNull(), time).otherwise(failure)


def incident_text(description: str = "description") -> Column:
    """Text that stands for an incident in similarity search; NULL if any part is NULL."""
    parts = ["system", "component", "alert_type", description]
    spaced = [piece for part in parts for piece in (F.lit(" "), F.col(part))]
    return F.concat(*spaced[1:])


def is_spike(threshold: int = SPIKE_THRESHOLD, count: str = "high_severity_count") -> Column:
    return F.col(count) >= F.lit(threshold)


def is_normal(threshold: int = SPIKE_THRESHOLD, count: str = "high_severity_count") -> Column:
    """Not the complement of :func:`is_spike`: a NULL count is neither."""
    return F.col(count) < F.lit(threshold)
