"""From stored window counts to the metrics of a day and the overview over them."""

from datetime import date

from pyspark.sql import DataFrame

from klaxon.functions.conversions import SPIKE_THRESHOLD
from klaxon.operators.metrics import enrich, for_day, peak_window, spikes, system_stats, typed_counts
from klaxon.operators.summary import (
    ALL_SYSTEMS,
    in_time_order,
    kpis,
    series,
    system_list,
    system_summary,
)
from klaxon.session import store


def daily_metrics(
    counts: DataFrame, as_of: date | str | None = None, threshold: int = SPIKE_THRESHOLD
) -> dict[str, DataFrame]:
    """Windows of a day, statistics per system, peak window, spikes and enriched windows.

    The windows of the day are stored first: the counts are parsed once, and each result
    that is used reads only its columns. Statistics for ``enriched`` are computed here.
    """
    day = store(typed_counts(for_day(counts, as_of)), "day")
    return {
        "windows": day,
        "stats": system_stats(day),
        "peak": peak_window(day),
        "spikes": spikes(day, threshold),
        "enriched": enrich(day),
    }


def overview(
    metrics: DataFrame, threshold: int = SPIKE_THRESHOLD, system: str = ALL_SYSTEMS
) -> dict[str, DataFrame]:
    """Summary per system, grand totals, list of systems and points of the time series."""
    return {
        "summary": system_summary(metrics, threshold),
        "kpis": kpis(metrics, threshold),
        "systems": system_list(metrics),
        "series": in_time_order(series(metrics, threshold, system)),
    }
