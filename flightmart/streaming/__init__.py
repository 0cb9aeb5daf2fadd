"""Structured Streaming forms of the landing and publishing jobs."""

from .landing import land_incrementally, landing_stream
from .publishing import publish_incrementally

__all__ = ["land_incrementally", "landing_stream", "publish_incrementally"]
