"""The same work on streams: incremental ingest and windowed counts."""
