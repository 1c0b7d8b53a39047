"""The queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import langid, licenses, mixture, near, packing, passages, tokenfile, toxicity, vectors

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_mix_sources": mixture.op1_mix_sources,
    "op2_substring_dedup": passages.op2_substring_dedup,
    "op3_minhash_near_dedup": near.op3_minhash_near_dedup,
    "op4_exact_top_k": vectors.op4_exact_top_k,
    "op5_best_fit_packing": packing.op5_best_fit_packing,
    "op6_toxicity_chain": toxicity.op6_toxicity_chain,
    "op7_token_id_files": tokenfile.op7_token_id_files,
    "op8_embedding_near_dedup": vectors.op8_embedding_near_dedup,
    "op9_license_scan": licenses.op9_license_scan,
    "op10_language_id": langid.op10_language_id,
}

ORACLES: dict[str, str] = {
    "op1_mix_sources": mixture.ORACLE_OP1,
    "op3_minhash_near_dedup": near.ORACLE_OP3,
    "op4_exact_top_k": vectors.ORACLE_OP4,
    "op8_embedding_near_dedup": vectors.ORACLE_OP8,
}
