"""Incremental ingestion of newly landed arrival files (Structured Streaming)."""

from starmart.streaming.ingest import ingest_arrivals

__all__ = ["ingest_arrivals"]
