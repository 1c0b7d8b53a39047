"""Sources and sinks."""

from . import audio, files  # noqa: F401
