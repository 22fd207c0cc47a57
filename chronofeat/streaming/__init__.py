"""Incremental materialization driven by Structured Streaming."""

from .incremental import incremental_materialize  # noqa: F401
