"""Exact quantiles with linear interpolation.

Three cases by the size of the group:

* a sorted array already at hand (``one_of_sorted_array``, ``of_sorted_arrays_np``),
* bounded groups, such as one cell's days (``per_group``: built-in ``percentile``),
* pooled groups of any size, such as all cells and days of a region (``pooled``): a mergeable sketch brackets each
  wanted rank, exact counts locate it, and only the rows inside the brackets are sorted.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import cut_lineage, small_enough_to_broadcast


def doubles(values: Sequence[float]) -> Column:
    return F.array(*[F.lit(float(v)) for v in values])


def of_sorted_arrays_np(arrays: Sequence[np.ndarray], qs: np.ndarray) -> np.ndarray:
    """Matrix (array, level) of quantiles of many ascending arrays at once, inside a task; NaN for an empty array."""
    sizes = np.array([len(a) for a in arrays])
    flat = np.concatenate([*arrays, [np.nan]])
    first = np.concatenate([[0], np.cumsum(sizes)[:-1]])[:, None]
    pos = qs[None, :] * np.maximum(sizes - 1, 0)[:, None]
    low = np.floor(pos).astype(int)
    high = np.minimum(low + 1, np.maximum(sizes - 1, 0)[:, None])
    a, b = flat[first + low], flat[first + high]
    return np.where(sizes[:, None] > 0, a + (pos - low) * (b - a), np.nan)


def one_of_sorted_array(arr: Column, q: Column) -> Column:
    """A single quantile whose level is a column."""
    last = F.size(arr) - 1
    pos = q * last
    lo = F.floor(pos).cast("int")
    a = F.get(arr, lo)
    return a + (pos - lo) * (F.get(arr, F.least(lo + 1, last)) - a)


def per_group(df: DataFrame, keys: Sequence[str], var: str, qs: Sequence[float]) -> DataFrame:
    """Quantiles of groups whose size is bounded by the calendar; one row per (keys, q)."""
    got = df.groupBy(*keys).agg(F.percentile(F.col(var), [float(q) for q in qs]).alias("_p"))
    return got.select(
        *keys,
        F.posexplode("_p").alias("_i", "value"),
    ).select(*keys, F.element_at(doubles(qs), F.col("_i") + 1).alias("q"), "value")


def _below(cuts: Column, v: Column, most: int) -> Column:
    """How many of the ascending ``cuts`` (at most ``most``) are less than ``v``, by halving."""
    steps = F.array(*[F.lit(2**k) for k in range(most.bit_length() - 1, -1, -1)])
    return F.aggregate(
        steps, F.lit(0),
        lambda at, step: F.when((at + step <= F.size(cuts)) & (F.get(cuts, F.least(at + step, F.size(cuts)) - 1) < v), at + step).otherwise(at),
    )


def pooled(
    df: DataFrame, keys: Sequence[str], var: str, qs: Sequence[float], most: int = 1_000_000, parts: int = 1000
) -> DataFrame:
    """Exact quantiles of groups of unbounded size; one row per (keys, q).

    The values at the two ranks around each quantile are selected.  While a group holds more than ``most`` rows, a mergeable
    sketch cuts it into ``parts`` intervals, one partial aggregation counts the rows of each, and only the intervals that hold a
    wanted rank are kept, each a group of its own from then on.  Counts are exact, whatever the sketch returns.  At the end the
    rows left, combined to (value, count) on the map side, are sorted per group, and no group is large.
    """
    keys, qs = list(keys), [float(q) for q in qs]
    data = df.where(F.col(var).isNotNull()).select(*keys, F.col(var).cast("double").alias("_v"))
    levels = [(i + 1) / parts for i in range(parts - 1)]

    def sketch(rows: DataFrame, groups: Sequence[str]) -> DataFrame:
        cuts = F.percentile_approx("_v", levels, 20 * parts)
        return cut_lineage(rows.groupBy(*groups).agg(F.count(F.lit(1)).alias("_n"), F.array_distinct(F.array_sort(cuts)).alias("_cuts")))

    sizes = sketch(data, keys)
    pairs = [F.array(F.floor((F.col("_n") - 1) * q), F.least(F.floor((F.col("_n") - 1) * q) + 1, F.col("_n") - 1)) for q in qs]
    ranks = F.transform(F.array_distinct(F.flatten(F.array(*pairs))), lambda r: F.struct(r.alias("rank"), r.alias("at")))
    groups, wanted, state = keys, sizes.select(*keys, ranks.alias("_r")), sizes
    while state.where(F.col("_n") > most).where(F.size("_cuts") > 1).limit(1).count():
        bounds = small_enough_to_broadcast(state.select(*groups, "_cuts"))
        cut = data.join(bounds, groups).withColumn(f"_g{len(groups)}", _below(F.col("_cuts"), F.col("_v"), parts)).drop("_cuts")
        narrow = [*groups, f"_g{len(groups)}"]
        counts = cut.groupBy(*narrow).agg(F.count(F.lit(1)).alias("_n"))
        before = Window.partitionBy(*groups).orderBy(narrow[-1]).rowsBetween(Window.unboundedPreceding, -1)
        counts = counts.withColumn("_from", F.coalesce(F.sum("_n").over(before), F.lit(0)))
        inside = F.transform(
            F.filter("_r", lambda r: (r["at"] >= F.col("_from")) & (r["at"] < F.col("_from") + F.col("_n"))),
            lambda r: F.struct(r["rank"].alias("rank"), (r["at"] - F.col("_from")).alias("at")))
        wanted = cut_lineage(counts.join(wanted, groups).select(*narrow, inside.alias("_r")).where(F.size("_r") > 0))
        data = cut_lineage(cut.join(small_enough_to_broadcast(wanted.select(*narrow)), narrow, "left_semi"))
        groups, state = narrow, sketch(data, narrow)

    running = Window.partitionBy(*groups).orderBy("_v")
    ranked = data.groupBy(*groups, "_v").agg(F.count(F.lit(1)).alias("_c")).withColumn("_upto", F.sum("_c").over(running))
    hit = F.filter("_r", lambda r: (r["at"] >= F.col("_upto") - F.col("_c")) & (r["at"] < F.col("_upto")))
    values = ranked.join(small_enough_to_broadcast(wanted), groups).select(*keys, "_v", F.explode(hit).alias("_h"))
    found = values.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("_h.rank", "_v"))).alias("_at"))
    out = found.join(sizes.select(*keys, "_n"), keys).select(*keys, "_n", "_at", F.explode(doubles(qs)).alias("q"))
    pos = F.col("q") * (F.col("_n") - 1)
    k = F.floor(pos)
    a, b = F.col("_at")[k], F.col("_at")[F.least(k + 1, F.col("_n") - 1)]
    # Every wanted rank has a value: a missing one is an error, never a neighbour in its place.
    checked = F.when(a.isNull() | b.isNull(), F.raise_error(F.lit("a rank was not found")).cast("double")).otherwise(a + (pos - k) * (b - a))
    return out.select(*keys, "q", checked.alias("value"))
