"""streamlens: event-analytics operators for Spark DataFrames and Structured Streaming.

Every operator is a plain function ``DataFrame -> DataFrame`` built from Spark SQL
expressions, so Catalyst plans it (pushdown, pruning, partial aggregation, AQE).
Streaming twins live in :mod:`streamlens.streaming`.
"""

from streamlens.session import get_session, checkpoint_dir

__all__ = ["get_session", "checkpoint_dir"]
