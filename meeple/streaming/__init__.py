"""Structured Streaming: incremental refresh of the daily tables as raw files arrive."""

from meeple.streaming.daily_refresh import start_daily_refresh, touched_days  # noqa: F401
