"""Structured Streaming ingestion of landing folders into bronze tables."""

from flowlog.streaming.ingest import IngestSource, ingest_all, ingest_to_bronze, read_bronze

__all__ = ["IngestSource", "ingest_all", "ingest_to_bronze", "read_bronze"]
