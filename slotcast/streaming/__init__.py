"""The recurring jobs as Structured Streaming queries."""

from .jobs import stream_dedupe, stream_hourly, stream_metrics, stream_upsert

__all__ = ["stream_dedupe", "stream_hourly", "stream_metrics", "stream_upsert"]
