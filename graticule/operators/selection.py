"""Periods, boxes, regions, land mask, joins between daily tables and dimensions."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.units import threshold
from ..session import by_cell, cells_partitions, cut_lineage, small_enough_to_broadcast
from .nearest import nearest_cell  # noqa: F401


class Box(NamedTuple):
    lon: tuple[float, float]
    lat: tuple[float, float]


# Processing regions and the narrow seam boxes over their borders (bounds as given, in either order).
PROCESSING_REGIONS = {
    "north": Box((-147.55, -52.65), (74.25, 59.25)),
    "middle": Box((-147.55, -52.65), (59.25, 44.25)),
    "south": Box((-147.55, -52.65), (44.25, 19.25)),
    "fixnm": Box((-147.55, -52.65), (59.35, 59.15)),
    "fixms": Box((-147.55, -52.65), (44.35, 44.15)),
    "fixs": Box((-147.55, -52.65), (19.35, 19.15)),
}
# Diagnostic regions.
DIAGNOSTIC_REGIONS = {
    "Haudenosaunee": Box((-79.0, -71.0), (42.0, 47.0)),
    "Ute": Box((-111.0, -103.0), (35.0, 40.0)),
    "Dene": Box((-124.0, -116.0), (60.0, 65.0)),
}
# Inclusive year periods.
REFERENCE_PERIOD = (1981, 2010)
TARGET_PERIOD = (1951, 2100)
FUTURE_PERIOD = (2071, 2100)


def in_period(df: DataFrame, first: int, last: int) -> DataFrame:
    """Inclusive years; the filter reaches the scan, and prunes partitions where ``year4`` is one."""
    df = df.where(F.col("year").between(first, last))
    if "year4" in df.columns:
        df = df.where(F.col("year4").between(first - 3, last))
    return df


def inside(box: Box, buffer_lon: float = 0.0, buffer_lat: float = 0.0) -> Column:
    lon0, lon1 = sorted(box.lon)
    lat0, lat1 = sorted(box.lat)
    return F.col("lon").between(lon0 - buffer_lon, lon1 + buffer_lon) & F.col("lat").between(
        lat0 - buffer_lat, lat1 + buffer_lat
    )


def cells_in(cells: DataFrame, box: Box, buffer: int = 0, step: tuple[float, float] = (0.1, 0.1)) -> DataFrame:
    """Cells of a box widened by ``buffer`` source cells of ``step`` (lon, lat) degrees."""
    return cells.where(inside(box, buffer * step[0], buffer * step[1]))


def in_bbox(df: DataFrame, cells: DataFrame, box: Box) -> DataFrame:
    return df.join(cells_in(cells, box).select("cell_id"), "cell_id", "left_semi")


def in_region(
    df: DataFrame, cells: DataFrame, box: Box, buffer: int = 0, step: tuple[float, float] = (0.1, 0.1)
) -> DataFrame:
    return df.join(cells_in(cells, box, buffer, step).select("cell_id"), "cell_id", "left_semi")


def assign_region(cells: DataFrame, regions: dict[str, Box]) -> DataFrame:
    """One row per (cell, region holding it).  Regions are a handful of constants, so no join is needed."""
    names = F.array_compact(F.array(*[F.when(inside(box), F.lit(name)) for name, box in regions.items()]))
    return cells.withColumn("region", F.explode(names))


def land_cells(df: DataFrame, first_t: int, var: str = "tasmax", t_index: int = 130) -> DataFrame:
    """Cells whose ``var`` is present on day number ``t_index`` of the series (its first day is ``first_t``)."""
    return df.where((F.col("t") == first_t + t_index) & F.col(var).isNotNull()).select("cell_id").distinct()


def on_cells(df: DataFrame, keep: DataFrame) -> DataFrame:
    """Rows of the cells in ``keep``.  The list is written once, so that its size is known: a grid's worth of ids is broadcast
    and the days stay where they are."""
    return df.join(small_enough_to_broadcast(cut_lineage(keep.select("cell_id").distinct())), "cell_id", "left_semi")


def wet_days(df: DataFrame, thresh: str | float = "1 mm d-1") -> DataFrame:
    return df.where(F.col("pr") >= threshold(thresh))


def align(a: DataFrame, b: DataFrame, on: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Inner join on the keys; the values of ``b`` get the suffix ``_ref``.  Aggregate first, then align."""
    right = b.select(*on, *[F.col(v).alias(f"{v}_ref") for v in values])
    return a.select(*on, *[c for c in a.columns if c not in on]).join(right, list(on))


def with_cell_threshold(df: DataFrame, thr: DataFrame, on: Sequence[str] = ("cell_id",)) -> DataFrame:
    """Attach one threshold row per cell.  The strategy is left to the optimizer: the table grows with the grid."""
    return df.join(thr, list(on))


def unstack(df: DataFrame, cells: DataFrame, dataset_ids: Sequence[str], first_t: int, last_t: int, rows_per_partition: int = 1 << 20) -> DataFrame:
    """Dense output: a row for every cell and day, NULL where the stacked table has none.

    The days are generated next to each cell after cells and values are hashed by cell, so the dense rows are not exchanged; there are as many
    partitions as leave ``rows_per_partition`` of them to each.
    """
    rows = cells.count() * len(dataset_ids) * (last_t - first_t + 1)
    n = max(cells_partitions(df), -(-rows // rows_per_partition))
    dense = (
        by_cell(cells, n, exactly=True).withColumn("dataset_id", F.explode(F.array(*[F.lit(d) for d in dataset_ids])))
        .withColumn("t", F.explode(F.sequence(F.lit(first_t), F.lit(last_t))))
    )
    return dense.join(by_cell(df, n, exactly=True).hint("merge"), ["dataset_id", "cell_id", "t"], "left")


def concat_regions(dfs: Sequence[DataFrame]) -> DataFrame:
    """Union of regions.  Boxes share their edges: see ``duplicate_keys``."""
    out = dfs[0]
    for df in dfs[1:]:
        out = out.unionByName(df)
    return out


def duplicate_keys(df: DataFrame, keys: Sequence[str] = ("dataset_id", "cell_id", "t")) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def replace_cells(df: DataFrame, patch: DataFrame, keys: Sequence[str] = ("dataset_id", "cell_id", "t")) -> DataFrame:
    """Rows of ``patch`` win over rows of ``df`` with the same key (rerun of a seam box)."""
    return df.join(patch.select(*keys), list(keys), "left_anti").unionByName(patch)
