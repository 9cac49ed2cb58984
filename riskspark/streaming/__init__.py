"""Incremental (Structured Streaming) forms of the analyses."""

from .activity import activity_events, latest_activity, read_last_activity, start_last_activity

__all__ = ["activity_events", "latest_activity", "read_last_activity", "start_last_activity"]
