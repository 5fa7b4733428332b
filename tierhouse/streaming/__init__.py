"""Incremental ingestion."""

from .ingest import Sink, ingest_files, ingest_sources, put_checked, run_batches, stream_files, stream_rules
