"""Structured Streaming jobs: landing -> bronze -> mart -> gold, with checkpoints."""

from contrail.streaming.jobs import (
    advance_clock, bronze_stream, flatten_stream, hourly_stream, late_hours_stream, latest_refresh_stream, recompute_hours, run_trigger,
)

__all__ = ["advance_clock", "bronze_stream", "flatten_stream", "hourly_stream", "late_hours_stream", "latest_refresh_stream",
           "recompute_hours", "run_trigger"]
