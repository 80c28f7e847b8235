"""Writers: bronze landing, small status documents, compaction, lookup layout."""

from gaugeflow.sinks.landing import (
    compact_bronze,
    copy_raw_feed,
    land_bronze,
    write_heartbeat,
    write_ingest_meta,
    write_lookup_table,
)

__all__ = [
    "compact_bronze",
    "copy_raw_feed",
    "land_bronze",
    "write_heartbeat",
    "write_ingest_meta",
    "write_lookup_table",
]
