"""Streaming deployment of the daily reports (the source workload itself is batch only)."""

from .incremental import REPORTS, refresh_days, start

__all__ = ["REPORTS", "refresh_days", "start"]
