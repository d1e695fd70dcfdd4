"""Streaming form of the table load (newly landed files, exactly once)."""

from wattline.streaming.incremental import start_incremental_load

__all__ = ["start_incremental_load"]
