"""Move files from a landing zone to curated tables and keep schemas in step."""

from landfall.plans.ingest import sync_files
from landfall.plans.publish import copy_latest, copy_table, publish_table, register_path
from landfall.plans.sync import schema_report, sync_tables
from landfall.streaming.arrival import stream_files

__all__ = [
    "copy_latest",
    "copy_table",
    "publish_table",
    "register_path",
    "schema_report",
    "stream_files",
    "sync_files",
    "sync_tables",
]
