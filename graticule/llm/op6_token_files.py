"""Token ids as Parquet files: one list column and its metadata, in ascending order of document ids.

Format: part files in ascending ``doc_id`` order (missing ids first), rows (doc_id, shard, shard_start, n_tokens, token_ids).
``shard`` numbers the files, ``shard_start`` counts the ids before a document within its file.  Ids are dictionary-coded
(``encoding="dictionary"``) or delta-packed (``"delta"``); row groups and pages have set sizes, and the writer adds page indexes,
so a reader of some documents, or of the metadata alone, reads only their pages.

Each document's ids end with id 0.  A missing or empty text has that id alone.  Repeated rows are written each.  Rows of equal id
are ordered by text.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from graticule.llm.common import groups_of, ids_and_texts
from graticule.llm.encoding import END, encoder

ENCODINGS = {
    "dictionary": {"parquet.enable.dictionary": "true", "parquet.dictionary.page.size": str(1 << 20), "parquet.writer.version": "PARQUET_1_0"},
    "delta": {"parquet.enable.dictionary": "false", "parquet.writer.version": "PARQUET_2_0"},
}
SCHEMA = "doc_id long, shard int, shard_start long, n_tokens long, token_ids array<int>"


def write_tokens(
    docs: DataFrame, path: str, tokenizer: str, spaces: bool = True, encoding: str = "dictionary",
    row_group_bytes: int = 16 << 20, page_bytes: int = 256 << 10, docs_per_file: int = 8192,
) -> None:
    """Encode every whole text and write the files; the texts move once, to their place in the order."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, start = encoder(tokenizer, spaces), 0
        for batch in batches:
            packed = [enc.encode(t) + END for t in batch.column("text").to_pylist()]
            lengths = np.array([len(p) // 4 for p in packed], np.int64)
            ends = np.cumsum(lengths)
            ids = pa.ListArray.from_arrays(
                pa.array(np.concatenate([[0], ends]).astype(np.int32)), pa.array(np.frombuffer(b"".join(packed), "<i4")))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("shard"), pa.array(start + ends - lengths), pa.array(lengths), ids],
                names=["doc_id", "shard", "shard_start", "n_tokens", "token_ids"])
            start += int(ends[-1]) if len(ends) else 0

    rows = ids_and_texts(docs)
    ordered = rows.repartitionByRange(groups_of(rows.count(), docs_per_file), "doc_id").sortWithinPartitions("doc_id", "text")
    numbered = ordered.withColumn("shard", F.spark_partition_id())
    options = {**ENCODINGS[encoding], "parquet.block.size": str(row_group_bytes), "parquet.page.size": str(page_bytes)}
    numbered.mapInArrow(encode, SCHEMA).write.options(**options).mode("overwrite").parquet(path)


def read_tokens(spark: SparkSession, path: str, doc_ids: list[int] | None = None) -> DataFrame:
    """The files as rows; with ``doc_ids`` only the pages that can hold them are read."""
    rows = spark.read.schema(SCHEMA).parquet(path)
    return rows if doc_ids is None else rows.where(F.col("doc_id").isin(doc_ids))


def token_index(spark: SparkSession, path: str) -> DataFrame:
    """Per document, from the files: doc_id, start among all ids, n_tokens, crc32 of its ids as little-endian 32-bit integers.

    The ids of the files before a document's are summed over one row per file.
    """

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("token_ids")
            offsets = lists.offsets.to_numpy()
            values = np.asarray(lists.values.to_numpy(zero_copy_only=False), "<u4")
            lengths = np.diff(offsets).astype(np.int64)
            crcs = [zlib.crc32(values[a:b].tobytes()) for a, b in zip(offsets[:-1], offsets[1:])]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("shard"), batch.column("shard_start"), pa.array(lengths), pa.array(crcs, pa.int64())],
                names=["doc_id", "shard", "shard_start", "n_tokens", "ids_crc32"])

    rows = read_tokens(spark, path).mapInArrow(fold, "doc_id long, shard int, shard_start long, n_tokens long, ids_crc32 long")
    sizes = read_tokens(spark, path).groupBy("shard").agg(F.max(F.col("shard_start") + F.col("n_tokens")).alias("ids"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    bases = sizes.select("shard", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("base"))
    return rows.join(bases, "shard").select("doc_id", (F.col("base") + F.col("shard_start")).alias("start"), "n_tokens", "ids_crc32")


def token_frames(spark: SparkSession, path: str) -> Iterator[pd.DataFrame]:
    """For a training reader: one pandas frame per file, in order; each file is read alone."""
    for shard in sorted(r["shard"] for r in read_tokens(spark, path).select("shard").distinct().collect()):
        yield read_tokens(spark, path).where(F.col("shard") == shard).orderBy("shard_start").toPandas()
