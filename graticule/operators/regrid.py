"""Bilinear interpolation as a join with a weight table."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

from ..session import cut_lineage, small_enough_to_broadcast


class Axes(NamedTuple):
    """A rectilinear source grid with even steps; source cell number = row * nx + column."""

    x0: float
    dx: float
    nx: int
    y0: float
    dy: float
    ny: int


def _bracket(coord: Column, start: float, step: float, n: int) -> tuple[Column, Column]:
    """Lower corner (n-2 at most, so that the last grid line is still inside) and the fraction above it."""
    pos = (coord - start) / step
    low = F.least(F.floor(pos).cast("int"), F.lit(n - 2))
    return low, pos - low


# In place of a source cell, for targets that no source cell reaches: they get NULL on every day.
NOWHERE = -1


def bilinear_weights(axes: Axes, cells: DataFrame) -> DataFrame:
    """(src_cell, dst_cell, w): four rows per target inside the source grid, by arithmetic on the axes; one row without a
    weight for a target outside."""
    i, fx = _bracket(F.col("lon"), axes.x0, axes.dx, axes.nx)
    j, fy = _bracket(F.col("lat"), axes.y0, axes.dy, axes.ny)
    at = cells.select(F.col("cell_id").alias("dst_cell"), i.alias("i"), fx.alias("fx"), j.alias("j"), fy.alias("fy"))
    inside = (F.col("i") >= 0) & (F.col("j") >= 0) & F.col("fx").between(0, 1) & F.col("fy").between(0, 1)

    def corner(di: int, dj: int) -> Column:
        wx = F.col("fx") if di else 1 - F.col("fx")
        wy = F.col("fy") if dj else 1 - F.col("fy")
        src = (F.col("j") + dj) * axes.nx + F.col("i") + di
        return F.struct(src.cast("int").alias("src_cell"), (wx * wy).alias("w"))

    corners = F.array(*[corner(di, dj) for dj in (0, 1) for di in (0, 1)])
    nowhere = F.array(F.struct(F.lit(NOWHERE).alias("src_cell"), F.lit(None).cast("double").alias("w")))
    corners = F.when(inside, corners).otherwise(nowhere)
    return at.select("dst_cell", F.explode(corners).alias("c")).select("c.src_cell", "dst_cell", "c.w")


def regrid(
    df: DataFrame, weights: DataFrame, variables: Sequence[str], unmapped_to_null: bool = True, corners: int = 4,
    time_cols: Sequence[str] = ("calendar", "year", "month", "day", "doy", "date"), broadcast_bytes: int = 64 << 20,
    tile_cells: int = 4096, rows_per_partition: int = 1 << 19,
) -> DataFrame:
    """Weighted sums of source cells at the target cells of ``weights``, per dataset and day.

    Only coarse rows are exchanged, once.  Weights of up to ``broadcast_bytes`` are broadcast: the source rows are hashed by (dataset,
    day), the weight join multiplies rows inside the partition and the sum over corners is local to it.  Larger weights are cut
    into tiles of ``tile_cells`` successive target cells: a coarse row is copied to the few tiles that need it, both sides are
    hashed by (tile, group of days), and join and sum are local again.  There are as many groups of days as leave
    ``rows_per_partition`` coarse rows to a partition, whatever the number of days and datasets.  Neighbouring targets should have
    neighbouring numbers.  Either way the partitions follow the days times the targets too: the sums of one stay in memory, however
    much finer the targets are than the source.

    With ``unmapped_to_null`` a target with fewer than ``corners`` present corners gets NULL, and a target outside the
    source always does.  Targets may be a full grid or a list of points; a curvilinear source needs only its own weight table.
    """
    carried = [c for c in time_cols if c in df.columns]
    source = df.select("dataset_id", F.col("cell_id").alias("src_cell"), "t", *carried, *variables)
    weights, days = cut_lineage(weights), cut_lineage(source.select("dataset_id", "t", *carried).distinct())
    if not weights.where(F.col("src_cell") == NOWHERE).limit(1).isEmpty():
        source = source.unionByName(_nowhere(days, source, carried, variables))
    n_days, least = days.count(), int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sized = small_enough_to_broadcast(weights, broadcast_bytes)
    if sized is not weights:
        n = max(least, -(-n_days * weights.count() // (corners * rows_per_partition)))
        spread = source.repartition(n, "dataset_id", "t").join(sized, "src_cell")
        keys = []
    else:
        keys = ["_tile", "_days"]
        tiled = cut_lineage(weights.withColumn("_tile", F.floor(F.col("dst_cell") / tile_cells).cast("int")))
        needed = cut_lineage(tiled.select("src_cell", "_tile").distinct())
        size = needed.agg(F.count(F.lit(1)).alias("pairs"), F.count_distinct("src_cell").alias("cells"), F.count_distinct("_tile").alias("tiles")).first()
        # Rows to deal: each day of each dataset has the pairs (source cell, tile) that its cells take part in.  Sums: those of its targets.
        rows = df.count() * size["pairs"] // max(size["cells"], 1)
        groups = max(1, -(-rows // (max(size["tiles"], 1) * rows_per_partition)), -(-n_days * tile_cells // (1 << 19)))
        n = max(least, size["tiles"] * groups)
        group = F.pmod(F.xxhash64("dataset_id", "t"), F.lit(groups)).cast("int")
        dealt = source.join(small_enough_to_broadcast(needed), "src_cell").withColumn("_days", group)
        every = F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))
        spread = dealt.repartition(n, *keys).join(tiled.withColumn("_days", every).repartition(n, *keys), [*keys, "src_cell"])
    # Dataset, calendar and day tell the other columns of time: they are no keys, and move only where they are asked for.
    named = [c for c in carried if c == "calendar"]
    sums = spread.groupBy("dataset_id", "t", *named, F.col("dst_cell").alias("cell_id"), *keys).agg(
        *[F.first(c).alias(c) for c in carried if c not in named],
        *[F.when(F.count(v) == corners, F.sum(F.col("w") * F.col(v))).alias(v) if unmapped_to_null
          else (F.sum(F.col("w") * F.col(v)) / F.sum(F.when(F.col(v).isNotNull(), F.col("w")))).alias(v)
          for v in variables])
    return sums.select("dataset_id", "t", *carried, "cell_id", *variables)


def _nowhere(days: DataFrame, source: DataFrame, carried: Sequence[str], variables: Sequence[str]) -> DataFrame:
    """A row of every day that stands for "nowhere", so that targets outside the source get a row a day."""
    empty = [F.lit(None).cast(source.schema[v].dataType).alias(v) for v in variables]
    return days.select("dataset_id", F.lit(NOWHERE).cast(source.schema["src_cell"].dataType).alias("src_cell"), "t", *carried, *empty)
