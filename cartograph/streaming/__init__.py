"""Incremental form of the per-user aggregate on a stream of log files."""

from cartograph.streaming.features import stream_user_aggregates  # noqa: F401
