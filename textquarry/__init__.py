"""PySpark-native engine that turns web text into structured, queryable tables."""

__all__ = ["session"]
