"""Incremental ingest and cleaning with Structured Streaming."""

from salesmart.streaming.incremental import ingest_available, merge_latest
from salesmart.streaming.ledger import FileLedger, current_rejections, ingest_files

__all__ = ["FileLedger", "current_rejections", "ingest_available", "ingest_files", "merge_latest"]
