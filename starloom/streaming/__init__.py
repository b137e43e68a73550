"""Structured Streaming forms of the ingestion operators."""

from starloom.streaming.landing_stream import stream_landing
from starloom.streaming.upsert_stream import newest_per_key, stream_upsert, upsert_batch

__all__ = ["newest_per_key", "stream_landing", "stream_upsert", "upsert_batch"]
