"""Spark-native news-event analytics: articles, dated events, star schema, knowledge graph."""

from newsloom.session import build_session, materialize

__all__ = ["build_session", "materialize"]
