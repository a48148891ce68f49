"""Structured Streaming forms of the operators.

Aggregates run as watermarked streaming aggregations (append/update mode); keyed state and timers run as
``transformWithState`` processors (RocksDB state store): :mod:`~streamlens.streaming.ordered` brings a key's rows into
event-time order first, :mod:`~streamlens.streaming.late` sees rows behind the watermark too.
"""
