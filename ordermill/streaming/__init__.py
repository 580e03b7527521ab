"""Recurring runs over newly arrived files."""

from ordermill.streaming.incremental import run_incremental

__all__ = ["run_incremental"]
