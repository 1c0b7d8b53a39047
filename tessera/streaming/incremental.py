"""An extension: new manifest files as a stream through stateless stages. The engine's own work is batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import text as X


def manifest_stream(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    """JSON lines that arrive in a folder."""
    return spark.readStream.schema(schema).option("mode", "PERMISSIVE").json(folder)


def normalized_stream(rows: DataFrame, text: str, audio: str) -> DataFrame:
    """The normalising stage: rows with audio and text, with the language inferred from script."""
    rows = rows.where(X.nonempty(F.col(text)).isNotNull() & X.nonempty(F.col(audio)).isNotNull())
    return rows.withColumn("language", X.language(F.col(text)))


def run_available(rows: DataFrame, out: str, checkpoint: str) -> None:
    """Process what is there and stop; a later call takes up where this one ended."""
    rows.writeStream.format("json").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
