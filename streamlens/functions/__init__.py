"""Scalar column functions (all JVM-side Spark SQL expressions, no Python UDFs)."""

from streamlens.functions.scalar import poly_hash, timestamp_text

__all__ = ["poly_hash", "timestamp_text"]
