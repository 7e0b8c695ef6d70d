"""Incremental delivery."""

from starloom.streaming.append import deliver, landing_stream

__all__ = ["deliver", "landing_stream"]
