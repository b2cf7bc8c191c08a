"""From raw documents to packed training sequences: quality rules, near-dedup, personal data, mixing, packing.

Each stage is written as Parquet in the shared folder and read again as the next one's documents, so a lost executor costs the
tasks of one stage.  All but the last return the columns they were given.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from graticule.llm import op3_mixture, op4_pii, op5_simhash, op8_quality, op9_packing
from graticule.llm.common import documents, prepare
from graticule.llm.queries import WORD_BPE, vocabulary
from graticule.session import cut_lineage


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail a quality rule go."""
    prepare(spark)
    return op8_quality.good_documents(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies (SimHash of three-word shingles, linked within three bits) the document of the smallest id stays."""
    prepare(spark)
    return op5_simhash.one_of_each_group(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by its kind; no document goes."""
    prepare(spark)
    return op4_pii.redacted(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them (0 to 2 times), in training order; what is not taken goes."""
    prepare(spark)
    return op3_mixture.training_order(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of encoded documents with their sequence and offset."""
    prepare(spark)
    return op9_packing.packed_documents(docs, vocabulary(WORD_BPE))


STAGES = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("personal_data", personal_data),
    ("mix_sources", mix_sources),
    ("pack_sequences", pack_sequences),
]

# No SQL: encoders, XXH64 and zstandard are outside it; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for _, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
