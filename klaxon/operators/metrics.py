"""Daily metrics on window counts.

NULL rules are those of SQL: NULL counts are skipped, a sum of NULLs only is NULL, and the
join leaves windows without system without statistics. Averages are over the windows that
exist; a window without any alert has no row.
"""

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from klaxon.functions.conversions import (
    SPIKE_THRESHOLD,
    WINDOW_DATE,
    as_count,
    as_window_date,
    is_spike,
)
from klaxon.operators.joins import BROADCAST_BYTES, BROADCAST_ROWS, left_join_measured

COUNT = "high_severity_count"


def typed_counts(counts: DataFrame) -> DataFrame:
    """The four columns of a window count read from CSV, with the count as ``int``."""
    return counts.select("system", as_count(F.col(COUNT)).alias(COUNT), "window_start", "window_end")


def for_day(counts: DataFrame, as_of: date | str | None = None) -> DataFrame:
    """Windows that start on one day, by default the current one.

    A table partitioned by ``window_date`` skips the folders of other days, and on typed
    window bounds the half-open range of the day skips row groups. On text bounds every
    cell is parsed, and bad ones drop out.
    """
    day = F.current_date() if as_of is None else F.lit(str(as_of)).cast("date")
    if WINDOW_DATE in counts.columns:
        counts = counts.filter(F.col(WINDOW_DATE) == day)
    start = F.col("window_start")
    kind = counts.schema["window_start"].dataType
    if not kind.typeName().startswith("timestamp"):
        return counts.filter(as_window_date(start) == day)
    return counts.filter((start >= day.cast(kind)) & (start < F.date_add(day, 1).cast(kind)))


def system_stats(counts: DataFrame) -> DataFrame:
    """Total and average per system from one aggregate over one scan."""
    return counts.groupBy("system").agg(
        F.sum(COUNT).alias("total_high_severity"),
        F.avg(COUNT).alias("avg_per_window"),
    )


def totals(counts: DataFrame) -> DataFrame:
    return counts.groupBy("system").agg(F.sum(COUNT).alias("total_high_severity"))


def averages(counts: DataFrame) -> DataFrame:
    return counts.groupBy("system").agg(F.avg(COUNT).alias("avg_per_window"))


def peak_window(counts: DataFrame) -> DataFrame:
    """The window with the highest count; of equals the earliest, then by system."""
    return counts.orderBy(
        F.desc_nulls_last(COUNT), F.asc_nulls_last("window_start"), F.asc_nulls_last("system")
    ).limit(1)


def spikes(counts: DataFrame, threshold: int = SPIKE_THRESHOLD) -> DataFrame:
    """Distinct windows with at least ``threshold`` alerts."""
    return counts.filter(is_spike(threshold)).dropDuplicates()


def has_spikes(counts: DataFrame, threshold: int = SPIKE_THRESHOLD) -> bool:
    """Whether any window is a spike; stops at the first one found."""
    return not counts.filter(is_spike(threshold)).isEmpty()


def spike_check(counts: DataFrame, threshold: int = SPIKE_THRESHOLD) -> DataFrame:
    """One row: whether any window is a spike; needs no more than the first one found."""
    found = counts.filter(is_spike(threshold)).limit(1)
    return found.agg((F.count(F.lit(1)) > 0).alias("has_spikes"))


def enrich(
    counts: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """Every window with the total and average of its system.

    Reads ``counts`` twice, so pass a stored or settled table rather than a plan that
    still has to read raw alerts.
    """
    return left_join_measured(counts, system_stats(counts), ["system"], max_rows, max_bytes)
