"""Mixing sources to target weights by a time-varying curriculum, from SQL functions alone.

Every source has a weight and a schedule: how strongly it is wanted at each time of the training, from 0 to 1.  The weights
share a token budget among the sources, none above ``max_repeats`` times what it has.  A source's documents are taken in a
hashed order, again from the start once they are used up, until the target is reached; the last one taken may be taken in part.
The integral of the schedule is the source's cumulative demand; inverting it at the tokens taken before a document gives the
time at which the document is trained on.  Documents are range-sorted by that time.

Null sources are one source, the last.  Missing and empty texts have size 0 and nothing is taken of them.  Repeated rows are
separate documents.  An empty table gives an empty mix.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from graticule.llm.common import groups_of, whole_text, word_count
from graticule.session import cut_lineage

# Weights of the sources in the order of their names, repeating, and the schedule of each weight: (time, strength) knots.
WEIGHTS = (5, 2, 1)
SCHEDULES = (((0.0, 1.5), (1.0, 0.5)), ((0.0, 1.0), (1.0, 1.0)), ((0.0, 0.5), (0.5, 0.75), (1.0, 2.0)))


def source_targets(
    sized: DataFrame, weights: Sequence[int] = WEIGHTS, budget: float = 1.5, max_repeats: float = 2.0,
) -> DataFrame:
    """(source, kind, source_size, target) from rows of (source, size): water filling under the cap of each source.

    ``kind`` is the place in ``weights``.  Works on one row per source; sorted by cap over weight, the capped sources come
    first, and what they leave is shared by weight among the rest.
    """
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    per_source = sized.groupBy("source").agg(F.sum("size").alias("source_size")).withColumn("kind", (rank % len(weights)).cast("int"))
    rows = per_source.withColumn("w", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), F.col("kind") + 1))
    rows = rows.withColumn("cap", max_repeats * F.col("source_size"))
    order = Window.orderBy(F.col("cap") / F.col("w"), F.col("source").asc_nulls_last())
    everything = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    used = F.coalesce(F.sum("cap").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    rest = F.sum("w").over(order.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    rows = rows.withColumn("level", (budget * F.sum("source_size").over(everything) - used) / rest)
    rows = rows.withColumn("free", F.col("cap") / F.col("w") > F.col("level"))
    # The level at the first source that isn't capped is the highest among those.
    water = F.max(F.when(F.col("free"), F.col("level"))).over(everything)
    return rows.select(
        "source", "kind", "source_size",
        F.when(F.col("free"), water * F.col("w")).otherwise(F.col("cap")).alias("target"),
    )


def demand_time(share: Column, kind: Column, schedules: Sequence = SCHEDULES) -> Column:
    """The time at which the cumulative demand of a schedule reaches ``share`` (0 to 1) of its whole.

    Strength is linear between knots, so demand is quadratic there and is inverted in closed form.
    """
    out = None
    for k, knots in enumerate(schedules):
        areas = [(b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in zip(knots, knots[1:])]
        total, done, time = sum(areas), 0.0, None
        for (a, b), area in zip(zip(knots, knots[1:]), areas):
            slope = (b[1] - a[1]) / (b[0] - a[0])
            left = F.greatest(share * total - done, F.lit(0.0))
            root = F.sqrt(F.greatest(a[1] ** 2 + 2 * slope * left, F.lit(0.0)))
            here = F.lit(a[0]) + F.when(left == 0, 0.0).otherwise(2 * left / (a[1] + root))
            time = F.when(share * total <= done, time).otherwise(here) if time is not None else here
            done += area
        time = F.least(time, F.lit(float(knots[-1][0])))
        out = F.when(kind == k, time) if out is None else out.when(kind == k, time)
    return out


def mix(
    docs: DataFrame, keep: Sequence[str] = (), weights: Sequence[int] = WEIGHTS, schedules: Sequence = SCHEDULES,
    budget: float = 1.5, max_repeats: int = 2, rows_per_group: int = 512, seed: int = 7,
) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken and ``takes``, an array of (pass, words, time).

    ``docs`` has doc_id, source and size; columns named in ``keep`` go along.  Cumulative sizes come in two levels, over hashed
    groups of a source and inside each group, so a source that holds a third of all rows is no hot group.
    """
    groups = groups_of(docs.count(), rows_per_group)
    order = F.xxhash64("doc_id", F.lit(seed))
    rows = docs.withColumn("h", order).withColumn("g", F.pmod(F.xxhash64("doc_id", F.lit(seed + 1)), F.lit(groups)))
    per_group = rows.groupBy("source", "g").agg(F.sum("size").alias("size"))
    targets = source_targets(per_group, weights, budget, max_repeats)
    earlier = Window.partitionBy("source").orderBy("g").rowsBetween(Window.unboundedPreceding, -1)
    starts = per_group.select("source", "g", F.coalesce(F.sum("size").over(earlier), F.lit(0)).alias("group_start"))
    # Null-safe by a second key, so that both joins stay hash joins on (source, g).
    key = lambda df: df.withColumns({"_s": F.coalesce("source", F.lit("")), "_n": F.col("source").isNull()})
    starts = key(starts).drop("source").join(key(targets).drop("source"), ["_s", "_n"])
    inside = Window.partitionBy("_s", "_n", "g").orderBy("h", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    placed = key(rows).join(starts, ["_s", "_n", "g"]).withColumn(
        "before", F.col("group_start") + F.coalesce(F.sum("size").over(inside), F.lit(0)))
    goal = F.round("target").cast("long")
    takes = []
    for n in range(max_repeats):
        start = F.col("before") + n * F.col("source_size")
        words = F.greatest(F.lit(0), F.least(F.col("size"), goal - start))
        takes.append(F.struct(
            F.lit(n + 1).alias("pass"), words.alias("words"),
            demand_time(start / F.greatest(F.col("target"), F.lit(1.0)), F.col("kind"), schedules).alias("time")))
    takes = F.filter(F.array(*takes), lambda t: t["words"] > 0)
    return placed.select(*keep, "doc_id", "size", "source_size", "target", takes.alias("takes")).withColumn(
        "taken", F.aggregate("takes", F.lit(0).cast("long"), lambda total, t: total + t["words"]))


def sized(docs: DataFrame) -> DataFrame:
    """(doc_id, source, size): what the mix needs, the words of every whole text counted."""
    return docs.select(
        docs["doc_id"].cast("long").alias("doc_id"), docs["source"].cast("string").alias("source"), word_count(whole_text(docs)).alias("size"))


def mixed_documents(docs: DataFrame) -> DataFrame:
    """What the mix takes of every document, sorted by the time it is first trained on; those not taken come last."""
    out = mix(cut_lineage(sized(docs)))
    return out.select(
        "doc_id", "size", "source_size", "target", "taken",
        F.size("takes").alias("passes"), F.when(F.size("takes") > 0, F.col("takes")[0]["time"]).alias("position"),
    ).orderBy(F.col("position").asc_nulls_last(), "doc_id")


def training_order(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, all their columns, as often as they are trained on and in that order.

    The last document of a source, of which the mix takes a part, comes whole, so a source gets at most one document too much.
    """
    rows = docs.select(
        F.struct(*[docs[c] for c in docs.columns]).alias("row"), docs["doc_id"].cast("long").alias("doc_id"),
        docs["source"].cast("string").alias("source"), word_count(whole_text(docs)).alias("size"))
    taken = mix(rows, keep=["row"]).select("row", "doc_id", F.explode("takes").alias("take"))
    return taken.orderBy("take.time", "doc_id", "take.pass").select("row.*")
