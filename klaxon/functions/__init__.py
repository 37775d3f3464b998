from klaxon.functions.conversions import (
    as_count,
    as_window_date,
    as_window_time,
    event_time,
    incident_text,
    is_normal,
    is_spike,
)
from klaxon.functions.payload import (
    checked_alerts,
    decode_alerts,
    encode_alerts,
    payloads_mentioning,
)

__all__ = [
    "as_count",
    "as_window_date",
    "as_window_time",
    "checked_alerts",
    "decode_alerts",
    "encode_alerts",
    "event_time",
    "incident_text",
    "is_normal",
    "is_spike",
    "payloads_mentioning",
]
