from tidelog.sources.catalog import discover, has_table
from tidelog.sources.change_log import (
    kafka_options,
    read_change_log,
    read_jdbc,
    stream_change_log,
)

__all__ = [
    "discover",
    "has_table",
    "kafka_options",
    "read_change_log",
    "read_jdbc",
    "stream_change_log",
]
