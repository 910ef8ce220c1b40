"""Incremental (micro-batch) driving of the batch builders."""

from .monthly import latest_state, process_drop, run_available

__all__ = ["latest_state", "process_drop", "run_available"]
