"""Data-quality profiling, cleaning, normalising and validation as Spark jobs."""

from mendwork.session import build_session

__all__ = ["build_session"]
