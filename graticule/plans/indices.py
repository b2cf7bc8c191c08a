"""Compute the indices the catalog does not list yet, store them, and list them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from ..operators.definitions import Definition
from ..operators.indices import compute_missing, missing_indicators
from ..session import cut_lineage
from ..sources.catalog import merge_catalog
from ..sources.daily import append_slices


def listed(defs: Sequence[Definition], ids: DataFrame, path: str) -> DataFrame:
    """Catalog rows, one per id and frequency, of finished indices."""
    by_freq: dict[str, list[str]] = {}
    for d in defs:
        by_freq.setdefault(d.freq.replace("YS", "AS-JAN"), []).append(d.output)
    rows = F.array(*[
        F.struct(F.lit(f).alias("xrfreq"), F.array(*[F.lit(v) for v in sorted(set(vs))]).alias("variable"))
        for f, vs in by_freq.items()
    ])
    return ids.select("id", F.explode(rows).alias("_r")).select(
        "id", "_r.xrfreq", "_r.variable", F.lit("derived").alias("processing_level"),
        F.concat(F.lit(f"{path}#"), "id", F.lit("_"), "_r.xrfreq").alias("path"),
    )


def run(
    daily: DataFrame, catalog: DataFrame, defs: Sequence[Definition], path: str, missing: str | float = "any"
) -> DataFrame:
    """Append what is missing to the table at ``path`` and return the updated catalog."""
    ids = cut_lineage(daily.select(F.col("dataset_id").alias("id")).distinct())
    todo = cut_lineage(missing_indicators(defs, catalog, ids))
    if todo.isEmpty():
        return catalog
    made = cut_lineage(compute_missing(daily, defs, todo, missing))
    append_slices(made, path)
    # Listed are the indices that have rows, with what the catalog had of the same dataset and frequency.
    outputs = F.create_map(*[F.lit(x) for d in defs for x in (d.name, d.output)])
    freqs = F.create_map(*[F.lit(x) for d in defs for x in (d.name, d.freq.replace("YS", "AS-JAN"))])
    new = made.select(F.col("dataset_id").alias("id"), outputs[F.col("indicator")].alias("v"), freqs[F.col("indicator")].alias("xrfreq")).distinct()
    old = catalog.join(ids, "id", "left_semi").where("processing_level = 'derived'").select("id", F.explode("variable").alias("v"), "xrfreq")
    rows = new.unionByName(old.select("id", "v", "xrfreq")).groupBy("id", "xrfreq").agg(F.sort_array(F.collect_set("v")).alias("variable"))
    return merge_catalog(catalog, rows.select(
        "id", "xrfreq", "variable", F.lit("derived").alias("processing_level"),
        F.concat(F.lit(f"{path}#"), "id", F.lit("_"), "xrfreq").alias("path")))
