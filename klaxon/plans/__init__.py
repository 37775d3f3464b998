from klaxon.plans.daily import daily_metrics, overview
from klaxon.plans.live import count_stream, counts_of_stream
from klaxon.plans.similar import index_history, similar_incidents

__all__ = [
    "count_stream",
    "counts_of_stream",
    "daily_metrics",
    "index_history",
    "overview",
    "similar_incidents",
]
