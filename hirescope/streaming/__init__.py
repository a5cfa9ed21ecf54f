"""Incremental file ingest with Structured Streaming."""

from .ingest import ingest_bronze, ingest_files, merge_files
from .latest import ingest_latest

__all__ = ["ingest_bronze", "ingest_files", "ingest_latest", "merge_files"]
