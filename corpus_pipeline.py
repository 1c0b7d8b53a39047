"""From raw documents to packed training sequences, in five stages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tessera.llm import langid, mixture, near, packing, passages
from tessera.llm.runtime import Scratch, table

#: Each function takes (spark, docs, sf_dir); its result is written as Parquet and reread as the next one's docs.
STAGES = [
    ("language ID", langid.stage),
    ("MinHash near-dedup", near.stage),
    ("substring dedup", passages.stage),
    ("mixing sources", mixture.stage),
    ("best-fit packing", packing.stage),
]

#: SQL can't express the stages; tests hold them against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark)
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        docs = scratch.save(stage(spark, docs, sf_dir), name.replace(" ", "-"))
        if before is not None:
            scratch.drop(before)
        before = docs
    return STAGES[-1][1](spark, docs, sf_dir)
