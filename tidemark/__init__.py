"""Measurement tables kept as many CSV files, on Spark."""

from tidemark.session import get_session

__all__ = ["get_session"]
