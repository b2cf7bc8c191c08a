"""The operators applied to their whole tables, with production parameters.

SQL can express none of them in bearable time: encoders, XXH64, zstandard and trained models are outside it, and the transitive
groups, tree hashes and the exact shares of the mix would repeat the implementation.  They are tested against brute force.
"""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from graticule.llm import (
    op1_token_counts, op2_merkle, op3_mixture, op4_pii, op5_simhash, op6_token_files, op7_toxicity, op8_quality, op9_packing, op10_language,
    op11_bpe, op12_repair, op13_manifest,
)
from graticule.llm.common import documents, prepare
from graticule.session import scratch_dir


def vocabulary(name: str) -> str:
    """The place of a public vocabulary file; the folder can be set by LLM_TOKENIZERS."""
    folder = os.environ.get("LLM_TOKENIZERS")
    if folder:
        return os.path.join(folder, name)
    import public_tokenizers

    return str(public_tokenizers.path(name))


BYTE_BPE, WORD_BPE = "byte_bpe_50k.json", "word_bpe_49k.json"


def op1_token_counts_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op1_token_counts.token_counts(documents(spark, sf_dir), vocabulary(BYTE_BPE))


def op2_merkle_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op2_merkle.fingerprints_and_edits(documents(spark, sf_dir))


def op3_mixture_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op3_mixture.mixed_documents(documents(spark, sf_dir))


def op4_pii_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op4_pii.digest(documents(spark, sf_dir))


def op5_simhash_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op5_simhash.near_duplicates(documents(spark, sf_dir))


def op6_token_files_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    path = scratch_dir(spark)
    op6_token_files.write_tokens(docs, path, vocabulary(BYTE_BPE))
    return op6_token_files.token_index(spark, path)


def op7_toxicity_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op7_toxicity.toxicity(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op8_quality_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op8_quality.quality(documents(spark, sf_dir))


def op9_packing_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op9_packing.packed_documents(documents(spark, sf_dir), vocabulary(WORD_BPE))


def op10_language_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op10_language.languages(documents(spark, sf_dir))


def op11_bpe_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op11_bpe.round_trip(documents(spark, sf_dir), vocabulary(WORD_BPE))


def op12_repair_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = prepare(spark).read.parquet(f"{sf_dir}/conversations.parquet")
    return op12_repair.repaired(op12_repair.damaged(conversations))


def op13_manifest_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return op13_manifest.manifest(docs, tampered=F.crc32(docs["doc_id"].cast("string").cast("binary")) % 7 == 0)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_counts": op1_token_counts_query,
    "op2_merkle": op2_merkle_query,
    "op3_mixture": op3_mixture_query,
    "op4_pii": op4_pii_query,
    "op5_simhash": op5_simhash_query,
    "op6_token_files": op6_token_files_query,
    "op7_toxicity": op7_toxicity_query,
    "op8_quality": op8_quality_query,
    "op9_packing": op9_packing_query,
    "op10_language": op10_language_query,
    "op11_bpe": op11_bpe_query,
    "op12_repair": op12_repair_query,
    "op13_manifest": op13_manifest_query,
}
ORACLES: dict[str, str] = {}
