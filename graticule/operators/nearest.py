"""The nearest grid cell of every station, by descending nested boxes.

Cells are cut into boxes of rows and columns, four of a level in one of the level above.  A box knows the range of its cells as
points of the unit sphere, and one of its cells.  The straight distance to the range is never more than that to any cell in it, the
distance to the one cell never less than that to the nearest.  So a station goes down from the whole grid with the boxes that can
still hold its nearest cell, and leaves all others behind at every level; points on a sphere have neither poles nor a date line.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.geo import distance_km
from ..session import cut_lineage, small_enough_to_broadcast

AXES = ("x", "y", "z")
_SLACK = 1e-12  # of squared distances, a few metres: rounding must not cost a cell that is as near


def _point(lat: Column, lon: Column) -> dict[str, Column]:
    a, b = F.radians(lat), F.radians(lon)
    return {"x": F.cos(a) * F.cos(b), "y": F.cos(a) * F.sin(b), "z": F.sin(a)}


def _boxes(parts: DataFrame, row: Column, col: Column) -> DataFrame:
    """Boxes of ``parts``, which have a range (lo, hi per axis) and a cell (x, y, z) each."""
    return cut_lineage(parts.groupBy(row.alias("row"), col.alias("col")).agg(
        *[F.min(f"lo_{a}").alias(f"lo_{a}") for a in AXES], *[F.max(f"hi_{a}").alias(f"hi_{a}") for a in AXES],
        F.min(F.struct(*AXES)).alias("one")).select("row", "col", *[f"{e}_{a}" for e in ("lo", "hi") for a in AXES], *[F.col(f"one.{a}").alias(a) for a in AXES]))


def candidates(stations: DataFrame, cells: DataFrame, per_box: int = 16) -> tuple[DataFrame, DataFrame]:
    """Boxes that can hold a station's nearest cell (station_id, lat, lon, row, col), and the cells with their box (row, col)."""
    known = cells.agg(F.count(F.lit(1)), F.min("lat"), F.max("lat"), F.min("lon"), F.max("lon")).first()
    n, south, north, west, east = known
    levels = 0
    while per_box * 4**levels < n:
        levels += 1

    def place(value: Column, low: float, high: float) -> Column:
        at = F.floor((value - low) / ((high - low) or 1.0) * 2**levels)
        return F.least(at, F.lit(2**levels - 1)).cast("int")

    placed = cut_lineage(cells.select(
        "cell_id", "lat", "lon", place(F.col("lat"), south, north).alias("row"), place(F.col("lon"), west, east).alias("col")))
    points = placed.withColumns(_point(F.col("lat"), F.col("lon")))
    points = points.withColumns({f"{e}_{a}": F.col(a) for e in ("lo", "hi") for a in AXES})
    boxes = [_boxes(points, F.col("row"), F.col("col"))]
    for _ in range(levels - 1):
        boxes.append(_boxes(boxes[-1], F.expr("row div 2").cast("int"), F.expr("col div 2").cast("int")))

    own = {f"own_{a}": c for a, c in _point(F.col("lat"), F.col("lon")).items()}
    left = stations.select("station_id", "lat", "lon", F.lit(0).alias("row"), F.lit(0).alias("col")).withColumns(own).withColumn("best", F.lit(9.0))
    left = left.repartition("station_id")
    of_station = Window.partitionBy("station_id")
    for level in reversed(boxes[:levels]):
        below = small_enough_to_broadcast(level.withColumnsRenamed({"row": "low_row", "col": "low_col"}).withColumns(
            {"row": F.expr("low_row div 2").cast("int"), "col": F.expr("low_col div 2").cast("int")}))
        outside = [F.greatest(F.col(f"lo_{a}") - F.col(f"own_{a}"), F.col(f"own_{a}") - F.col(f"hi_{a}"), F.lit(0.0)) for a in AXES]
        least = sum((c * c for c in outside[1:]), outside[0] * outside[0])
        most = sum((F.pow(F.col(a) - F.col(f"own_{a}"), 2) for a in AXES), F.lit(0.0))
        down = left.join(below, ["row", "col"]).withColumns({"least": least, "most": F.least("best", most)})
        down = down.withColumn("best", F.min("most").over(of_station)).where(F.col("least") <= F.col("best") + _SLACK)
        left = down.select("station_id", "lat", "lon", F.col("low_row").alias("row"), F.col("low_col").alias("col"), *own, "best")
    return left, placed


def nearest_cell(stations: DataFrame, cells: DataFrame, per_box: int = 16) -> DataFrame:
    """(station_id, cell_id, distance_km) for every station: the nearest cell centre, ties to the lower cell id.

    A caller who wants only near ones filters by the distance.  Without any cell both columns are NULL.
    """
    if cells.isEmpty():
        return stations.select("station_id", F.lit(None).cast("int").alias("cell_id"), F.lit(None).cast("double").alias("distance_km"))
    left, placed = candidates(stations, cells, per_box)
    inside = small_enough_to_broadcast(placed.withColumnsRenamed({"lat": "cell_lat", "lon": "cell_lon"}))
    dist = distance_km(F.col("lat"), F.col("lon"), F.col("cell_lat"), F.col("cell_lon"))
    best = F.min(F.struct(dist.alias("distance_km"), "cell_id")).alias("_m")
    return left.join(inside, ["row", "col"]).groupBy("station_id").agg(best).select("station_id", "_m.cell_id", "_m.distance_km")
