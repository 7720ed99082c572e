"""Incremental ingest as a Structured Streaming file-source query."""

from wxstar.streaming.incremental import start_incremental_ingest  # noqa: F401
