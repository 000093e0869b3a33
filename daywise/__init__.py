"""Daily usage and conditions analytics on Spark DataFrames."""

from .session import build_session

__all__ = ["build_session"]
