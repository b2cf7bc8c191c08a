"""Bilinear weights for a source grid whose lines are curved: longitude and latitude depend on both grid numbers.

Four neighbouring source cells make a quadrilateral.  The one that holds a target is found by an index of nested tiles: level k
cuts the globe into squares of 360 / 2^k degrees, a quadrilateral is entered at the level whose squares are just larger than
itself, so in a few of them, and a target looks up its one square at each level in use.  What is found is checked by
inverting the bilinear map (u, v) -> (longitude, latitude) of the quadrilateral with Newton's method, many pairs at a time.

Longitudes are taken relative to a corner, so neither the date line nor the range in which they are given matters.  A quadrilateral
wider than half the globe holds a pole and is left out: its targets count as outside.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..session import cut_lineage
from .regrid import NOWHERE

FINEST = 20  # squares of 0.0003 degrees
CORNERS = [(0, 0), (1, 0), (0, 1), (1, 1)]
_SLACK = 1e-9  # a target on the border of the grid is inside, whatever the last digit says


def _relative(lon: Column, to: Column) -> Column:
    """Longitude from ``to``, in [-180, 180)."""
    return F.pmod(lon - to + 180.0, F.lit(360.0)) - 180.0


def _tile(level: Column) -> Column:
    return 360.0 / F.pow(F.lit(2.0), level)


def quadrilaterals(source: DataFrame) -> DataFrame:
    """(qi, qj, src[4], lon0, x[4], y[4], level) of all sets of four neighbours in ``source`` (cell_id, i, j, lat, lon)."""
    corners = F.explode(F.array(*[F.struct(F.lit(k).alias("k"), F.lit(di).alias("di"), F.lit(dj).alias("dj")) for k, (di, dj) in enumerate(CORNERS)]))
    placed = source.select("cell_id", "i", "j", "lat", "lon", corners.alias("c")).select(
        (F.col("i") - F.col("c.di")).alias("qi"), (F.col("j") - F.col("c.dj")).alias("qj"), "c.k", F.struct("cell_id", "lat", "lon").alias("at"))
    quads = placed.groupBy("qi", "qj").agg(*[F.max(F.when(F.col("k") == k, F.col("at"))).alias(f"p{k}") for k in range(4)])
    for k in range(4):
        quads = quads.where(F.col(f"p{k}").isNotNull())
    x = F.array(*[_relative(F.col(f"p{k}.lon"), F.col("p0.lon")) for k in range(4)])
    quads = quads.select(
        "qi", "qj", F.array(*[F.col(f"p{k}.cell_id") for k in range(4)]).alias("src"), F.col("p0.lon").alias("lon0"), x.alias("x"),
        F.array(*[F.col(f"p{k}.lat") for k in range(4)]).alias("y"))
    width, height = F.array_max("x") - F.array_min("x"), F.array_max("y") - F.array_min("y")
    size = F.greatest(width, height, F.lit(360.0 / 2 ** FINEST))
    return quads.where(width < 180).withColumn("level", F.greatest(F.floor(F.log2(360.0 / size)), F.lit(0)).cast("int"))


def newton_inverse(x: np.ndarray, y: np.ndarray, px: np.ndarray, py: np.ndarray, steps: int = 50) -> tuple[np.ndarray, np.ndarray]:
    """(u, v) with the bilinear map of corners (n, 4) at (px, py); NaN where the point is outside [0, 1] x [0, 1]."""
    bx, by, cx, cy = x[:, 1] - x[:, 0], y[:, 1] - y[:, 0], x[:, 2] - x[:, 0], y[:, 2] - y[:, 0]
    dx, dy = x[:, 3] - x[:, 1] - x[:, 2] + x[:, 0], y[:, 3] - y[:, 1] - y[:, 2] + y[:, 0]
    u, v = np.full(len(px), 0.5), np.full(len(px), 0.5)
    with np.errstate(all="ignore"):
        for _ in range(steps):
            fx, fy = x[:, 0] + bx * u + cx * v + dx * u * v - px, y[:, 0] + by * u + cy * v + dy * u * v - py
            jxu, jxv, jyu, jyv = bx + dx * v, cx + dx * u, by + dy * v, cy + dy * u
            det = jxu * jyv - jxv * jyu
            du, dv = (fx * jyv - fy * jxv) / det, (fy * jxu - fx * jyu) / det
            u, v = u - du, v - dv
            if not np.any(np.abs(du) + np.abs(dv) > 1e-13):
                break
        size = np.abs(bx) + np.abs(by) + np.abs(cx) + np.abs(cy)
        off = np.abs(x[:, 0] + bx * u + cx * v + dx * u * v - px) + np.abs(y[:, 0] + by * u + cy * v + dy * u * v - py)
        inside = (np.abs(u - 0.5) <= 0.5 + _SLACK) & (np.abs(v - 0.5) <= 0.5 + _SLACK) & (off <= 1e-9 * size)
    return np.where(inside, np.clip(u, 0, 1), np.nan), np.where(inside, np.clip(v, 0, 1), np.nan)


@F.pandas_udf(T.StructType([T.StructField("u", T.DoubleType()), T.StructField("v", T.DoubleType())]))
def _inverse(x: pd.Series, y: pd.Series, px: pd.Series, py: pd.Series) -> pd.DataFrame:
    if not len(px):
        return pd.DataFrame({"u": [], "v": []}, dtype=float)
    u, v = newton_inverse(np.stack(x.to_numpy()), np.stack(y.to_numpy()), px.to_numpy(), py.to_numpy())
    return pd.DataFrame({"u": u, "v": v})


def curvilinear_weights(source: DataFrame, cells: DataFrame) -> DataFrame:
    """(src_cell, dst_cell, w): four rows per target inside the source grid, one row without a weight for a target outside.

    ``source``: cell_id, its numbers i and j in the grid, lat, lon; ``cells``: the targets.  A target on an edge goes to the
    quadrilateral of the least numbers.
    """
    quads = cut_lineage(quadrilaterals(source))
    levels = sorted(r["level"] for r in quads.select("level").distinct().collect())  # at most FINEST + 1
    side = _tile(F.col("level"))
    low, base = F.pmod(F.col("lon0"), F.lit(360.0)), F.lit(90.0)
    span = lambda a, b: F.explode(F.sequence(F.floor(a / side), F.floor(b / side)))
    entered = quads.withColumn("_tx", span(low + F.array_min("x"), low + F.array_max("x"))).withColumn(
        "tx", F.pmod("_tx", F.pow(F.lit(2.0), F.col("level")).cast("long"))).withColumn(
        "ty", span(F.array_min("y") + base, F.array_max("y") + base)).drop("_tx")
    probes = cells.select(F.col("cell_id").alias("dst_cell"), "lat", "lon").withColumn(
        "level", F.explode(F.array(*[F.lit(k) for k in levels]).cast("array<int>"))).withColumns({
            "tx": F.floor(F.pmod(F.col("lon"), F.lit(360.0)) / side), "ty": F.floor((F.col("lat") + base) / side)})
    px = _relative(F.col("lon"), F.col("lon0"))
    slack = 1e-6
    near = px.between(F.array_min("x") - slack, F.array_max("x") + slack) & F.col("lat").between(F.array_min("y") - slack, F.array_max("y") + slack)
    found = probes.join(entered, ["level", "tx", "ty"]).where(near).withColumn("uv", _inverse("x", "y", px, "lat"))
    found = found.where(F.col("uv.u").isNotNull() & ~F.isnan("uv.u")).groupBy("dst_cell").agg(
        F.min(F.struct("qj", "qi", "src", "uv")).alias("best"))
    u, v = F.col("best.uv.u"), F.col("best.uv.v")
    four = F.array(*[
        F.struct(F.col("best.src")[k].cast("int").alias("src_cell"), ((u if di else 1 - u) * (v if dj else 1 - v)).alias("w"))
        for k, (di, dj) in enumerate(CORNERS)])
    nowhere = F.array(F.struct(F.lit(NOWHERE).alias("src_cell"), F.lit(None).cast("double").alias("w")))
    every = cells.select(F.col("cell_id").alias("dst_cell")).join(found, "dst_cell", "left")
    return every.select("dst_cell", F.explode(F.when(F.col("best").isNotNull(), four).otherwise(nowhere)).alias("c")).select(
        "c.src_cell", "dst_cell", "c.w")
