"""Continuous sync with Structured Streaming."""

from catalog_sync.streaming.sync import fresh_fetches, stream_catalog, stream_upsert

__all__ = ["fresh_fetches", "stream_catalog", "stream_upsert"]
