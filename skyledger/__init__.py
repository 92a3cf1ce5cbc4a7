"""Telemetry intake and queries, expressed as Spark DataFrames."""

from skyledger.session import configure, get_session

__all__ = ["configure", "get_session"]
