from tidelog.streaming.layers import process_batch, start_layers, start_table_layers
from tidelog.streaming.progress import ProgressLog, observe_events, observed_counts
from tidelog.streaming.replays import drop_replayed
from tidelog.streaming.windows import changes_per_window, start_window_counts, window_counts

__all__ = [
    "ProgressLog",
    "changes_per_window",
    "drop_replayed",
    "observe_events",
    "observed_counts",
    "process_batch",
    "start_layers",
    "start_table_layers",
    "start_window_counts",
    "window_counts",
]
