"""Planners."""

from . import planning  # noqa: F401
