"""flightmart: clean raw flight records and their lookups into typed tables, on Spark."""

from . import functions, operators, plans, sinks, sources, streaming
from .session import get_session, shared_dir

__all__ = ["functions", "get_session", "operators", "plans", "shared_dir", "sinks", "sources", "streaming"]
