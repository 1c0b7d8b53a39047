"""A session with the settings the engine is tested with."""

from __future__ import annotations

from pyspark.sql import SparkSession


def session(master: str = "local[*]", app: str = "tessera", partitions: int | None = None) -> SparkSession:
    """ANSI mode stays on, times are UTC, adaptive execution re-plans joins and splits skewed partitions."""
    b = SparkSession.builder.master(master).appName(app).config("spark.sql.session.timeZone", "UTC").config("spark.sql.adaptive.enabled", "true").config("spark.ui.enabled", "false")
    if partitions:
        b = b.config("spark.sql.shuffle.partitions", str(partitions))
    return b.getOrCreate()
