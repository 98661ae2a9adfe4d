"""Sources and sinks: parquet tables, message streams and their adapters."""

from tidemark.sources.tables import TABLES, read_table
from tidemark.sources.adapters import (
    EVENTS_ACTION_CONFIG,
    action_records,
    raw_action_messages,
    raw_vv_messages,
    vv_records,
)

__all__ = [
    "TABLES", "read_table", "EVENTS_ACTION_CONFIG", "action_records",
    "raw_action_messages", "raw_vv_messages", "vv_records",
]
