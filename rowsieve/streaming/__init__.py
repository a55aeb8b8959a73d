"""Structured Streaming entry points (extension X1)."""

from rowsieve.streaming.route import flag_stream, route_stream

__all__ = ["flag_stream", "route_stream"]
