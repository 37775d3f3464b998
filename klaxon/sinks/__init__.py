from klaxon.sinks.tables import (
    read_vectors,
    upsert_vectors,
    write_alerts,
    write_metrics,
    write_vectors,
)

__all__ = ["read_vectors", "upsert_vectors", "write_alerts", "write_metrics", "write_vectors"]
