"""Structured Streaming: incremental landing of CSV files into bronze."""

from paymart.streaming.landing import stream_landing_to_bronze

__all__ = ["stream_landing_to_bronze"]
