"""Incremental loads with Structured Streaming: bronze, and the customer models."""

from tidemark.streaming.customers import apply_batch, follow_events, refresh_customers
from tidemark.streaming.ingest import ingest_raw_stream

__all__ = ["apply_batch", "follow_events", "ingest_raw_stream", "refresh_customers"]
