from klaxon.sources.alerts import read_alerts, stream_alerts
from klaxon.sources.counts import backfill, read_counts, read_metrics, typed_metrics, union_runs
from klaxon.sources.history import read_history

__all__ = [
    "backfill",
    "read_alerts",
    "read_counts",
    "read_history",
    "read_metrics",
    "stream_alerts",
    "typed_metrics",
    "union_runs",
]
