"""chroniq: a Spark-native engine for an incrementally grown text corpus."""

from chroniq.session import build_session

__all__ = ["build_session"]
