"""Streaming."""

from . import incremental  # noqa: F401
