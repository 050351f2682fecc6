"""Spark-native operators for daily market data: landing, typed tables, cleaned tables, facts."""

from candlewick.session import build_session

__all__ = ["build_session"]
