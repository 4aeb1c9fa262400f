"""Structured Streaming feeds of the stored star."""

from starload.streaming.feed import feed_increments

__all__ = ["feed_increments"]
