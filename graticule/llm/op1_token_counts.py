"""Exact length histogram: documents by encoded length, and answers for every context limit from its suffix sums.

A missing text counts as empty: its length is that of the end id alone.  Repeated rows count each.  An empty table gives an
empty histogram.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from graticule.llm.common import ids_and_texts
from graticule.llm.encoding import encoder
from graticule.session import cut_lineage


def token_lengths(docs: DataFrame, path: str, spaces: bool = True, end_id: bool = True) -> DataFrame:
    """(doc_id, n_tokens) of every whole text, by the vocabulary file ``path``; ``end_id`` adds the one that ends a document."""
    extra = int(end_id)

    def lengths(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = encoder(path, spaces).encode
        for batch in batches:
            yield pd.DataFrame({"doc_id": batch["doc_id"], "n_tokens": [len(encode(t)) // 4 + extra for t in batch["text"]]})

    return ids_and_texts(docs).mapInPandas(lengths, "doc_id long, n_tokens long")


def length_histogram(lengths: DataFrame) -> DataFrame:
    """One row per distinct length; combined on the map side, so a very common length is no hot key."""
    return lengths.groupBy("n_tokens").agg(F.count(F.lit(1)).alias("n_docs"))


def suffix_answers(histogram: DataFrame, block: int = 128) -> DataFrame:
    """For each length as a context limit: who fits, who is longer, and how many tokens stay if all are cut there.

    Suffix sums in two levels, over blocks of ``block`` lengths and inside each, so no task sorts all lengths.
    """
    rows = histogram.withColumn("block", F.floor(F.col("n_tokens") / block)).withColumn("n_mass", F.col("n_tokens") * F.col("n_docs"))
    longer_blocks = Window.orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, -1)
    blocks = rows.groupBy("block").agg(F.sum("n_docs").alias("d"), F.sum("n_mass").alias("m"))
    whole = Window.orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    blocks = blocks.select(
        "block",
        F.coalesce(F.sum("d").over(longer_blocks), F.lit(0)).alias("docs_beyond"),
        F.coalesce(F.sum("m").over(longer_blocks), F.lit(0)).alias("tokens_beyond"),
        F.sum("d").over(whole).alias("total_docs"),
        F.sum("m").over(whole).alias("total_tokens"),
    )
    inside = Window.partitionBy("block").orderBy(F.desc("n_tokens")).rowsBetween(Window.unboundedPreceding, -1)
    out = rows.join(blocks, "block").select(
        "n_tokens", "n_docs", "total_docs", "total_tokens",
        (F.col("docs_beyond") + F.coalesce(F.sum("n_docs").over(inside), F.lit(0))).alias("docs_longer"),
        (F.col("tokens_beyond") + F.coalesce(F.sum("n_mass").over(inside), F.lit(0))).alias("tokens_longer"),
    )
    return out.select(
        "n_tokens", "n_docs", "docs_longer", "tokens_longer", "total_docs", "total_tokens",
        (F.col("total_tokens") - F.col("tokens_longer") + F.col("docs_longer") * F.col("n_tokens")).alias("truncated_tokens"),
        ((F.col("total_docs") - F.col("docs_longer")) / F.col("total_docs")).alias("share_fitting"),
    )


def truncated_total(answers: DataFrame, limit: int) -> DataFrame:
    """Tokens left if every document is cut at ``limit``, any number: one row (``limit``, ``tokens``, ``docs_cut``).

    No row lies between the longest length that fits and the limit, so that row's suffix sums hold for the limit too.
    """
    last = answers.where(F.col("n_tokens") <= limit).agg(F.max_by(F.struct("docs_longer", "tokens_longer"), "n_tokens").alias("s"))
    everything = answers.agg(F.max("total_docs").alias("total_docs"), F.max("total_tokens").alias("total_tokens"))
    joined = last.join(everything, F.lit(True), "full")
    cut = F.coalesce("s.docs_longer", "total_docs", F.lit(0))
    beyond = F.coalesce("s.tokens_longer", "total_tokens", F.lit(0))
    return joined.select(
        F.lit(limit).cast("long").alias("limit"),
        (F.coalesce("total_tokens", F.lit(0)) - beyond + cut * limit).alias("tokens"),
        cut.alias("docs_cut"),
    )


def length_quantile(answers: DataFrame, q: float) -> DataFrame:
    """The smallest length at which at least the share ``q`` of the documents fits: one row (``q``, ``n_tokens``)."""
    return answers.where(F.col("share_fitting") >= q).agg(F.min("n_tokens").alias("n_tokens")).select(F.lit(q).alias("q"), "n_tokens")


def token_counts(docs: DataFrame, path: str, spaces: bool = True) -> DataFrame:
    return suffix_answers(cut_lineage(length_histogram(token_lengths(docs, path, spaces))))
