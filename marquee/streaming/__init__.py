"""Structured Streaming: incremental ingest of landing records."""

from marquee.streaming.landing import append_new, ingest_folder, start_ingest

__all__ = ["append_new", "ingest_folder", "start_ingest"]
