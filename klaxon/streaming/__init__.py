from klaxon.streaming.queries import start_both, start_checked, start_stream
from klaxon.streaming.state import DroppedRows, open_windows, read_dropped

__all__ = [
    "DroppedRows",
    "open_windows",
    "read_dropped",
    "start_both",
    "start_checked",
    "start_stream",
]
