"""Sources, parsers and sinks (batch and streaming)."""

from streamlens.sources.memory import from_rows
from streamlens.sources.lines import (
    kafka_lines,
    read_lines,
    socket_lines,
)
from streamlens.sources.parse import (
    parse_access_log,
    parse_behavior_csv,
    parse_key_seconds,
)

__all__ = [
    "from_rows", "read_lines", "socket_lines", "kafka_lines",
    "parse_behavior_csv", "parse_access_log", "parse_key_seconds",
]
