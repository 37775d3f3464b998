from klaxon.operators.joins import left_join_measured
from klaxon.operators.metrics import (
    averages,
    enrich,
    for_day,
    has_spikes,
    peak_window,
    spike_check,
    spikes,
    system_stats,
    totals,
    typed_counts,
)
from klaxon.operators.summary import (
    in_time_order,
    kpis,
    select_system,
    series,
    system_list,
    system_summary,
    with_places,
)
from klaxon.operators.windows import alerts_between, severity_counts

__all__ = [
    "alerts_between",
    "averages",
    "enrich",
    "for_day",
    "has_spikes",
    "in_time_order",
    "kpis",
    "left_join_measured",
    "peak_window",
    "select_system",
    "series",
    "severity_counts",
    "spike_check",
    "spikes",
    "system_list",
    "system_stats",
    "system_summary",
    "totals",
    "typed_counts",
    "with_places",
]
