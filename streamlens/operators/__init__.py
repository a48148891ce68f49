"""Batch operators of the event model (each ``DataFrame -> DataFrame``)."""
