"""What the operators share: session settings, the documents table, words, hashed folds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# A word: a run of anything but ASCII white space.  Python's bytes.split() cuts at the same six bytes.
WORD = r"[^\x20\x09-\x0D]+"

# Arrow batches are bounded in rows and in bytes: texts are of very unequal length.
BATCH_ROWS, BATCH_BYTES = "200", str(16 << 20)


def prepare(spark: SparkSession) -> SparkSession:
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    return spark


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/documents.parquet")


def whole_text(docs: DataFrame) -> Column:
    """The text of ``docs``; a missing one counts as empty."""
    return F.coalesce(docs["text"].cast("string"), F.lit(""))


def ids_and_texts(docs: DataFrame) -> DataFrame:
    """Only ``doc_id`` and ``text`` (never null), whatever other columns there are and however they are called."""
    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), whole_text(docs).alias("text"))


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id written as text, modulo ``folds``; a missing id is written as empty text."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(folds))


def groups_of(rows: int, each: int) -> int:
    """How many hashed groups give about ``each`` rows to one."""
    return max(1, -(-rows // each))
