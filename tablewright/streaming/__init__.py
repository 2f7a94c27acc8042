"""Loads that remember which files they have seen."""

from tablewright.streaming.incremental import incremental_load, read_loaded, reset_bookmark, store_load

__all__ = ["incremental_load", "read_loaded", "reset_bookmark", "store_load"]
