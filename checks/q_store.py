"""Versioned tables stored by cell, changes of storage, exactly one match, and weights for a curved grid."""

from __future__ import annotations

from pyspark.sql import functions as F

from graticule.operators import curvilinear as Q, quantile_map as B, regrid as G
from graticule.session import cut_lineage, scratch_dir
from graticule.sources import catalog as T
from graticule.sources.store import Table

from . import fixtures as X
from .fixtures import CATALOG_SQL, DAILY_SQL
from .q_dqm import CONF, TRAIN_SQL
from .registry import query, r, rounded


@query("store_versions", f"""WITH {DAILY_SQL}
SELECT dataset_id, year, COUNT(*) AS n, {r('SUM(pr)', 3)} AS pr FROM daily
WHERE dataset_id = 'ref' OR (dataset_id = 'sim' AND year BETWEEN 1998 AND 1999) GROUP BY 1, 2""")
def store_versions(spark, d):
    """A dataset written for fewer years keeps none of the others; the dataset beside it stays."""
    daily = X.daily(spark, d)
    table = Table(spark, scratch_dir(spark), 4)
    table.write(daily, ["ref", "sim"], "all years")
    table.write(X.dataset(daily, "sim").where("year BETWEEN 1998 AND 1999"), ["sim"], "two years")
    return rounded(table.read().groupBy("dataset_id", "year").agg(F.count(F.lit(1)).alias("n"), F.sum("pr").alias("pr")), ["pr"], 3)


@query("train_stored_by_cell", "WITH " + TRAIN_SQL + f"""
SELECT dataset_id, cell_id, doy, var, {r('scaling')} AS scaling, {r('af[25]', 5)} AS af_mid FROM training""")
def train_stored_by_cell(spark, d):
    """Training over two tables bucketed by cell, without an exchange."""
    nl = X.noleap(spark, d)
    sides = []
    for name in ("ref", "sim"):
        table = Table(spark, scratch_dir(spark), 4)
        table.write(X.dataset(nl, name), [name], "days")
        sides.append(table.read())
    out = B.train(*sides, CONF).select("dataset_id", "cell_id", "doy", "var", "scaling", F.get("af", F.lit(24)).alias("af_mid"))
    return rounded(out, ["scaling", "af_mid"])


@query("expect_one", f"WITH {CATALOG_SQL} SELECT id, path, xrfreq FROM cat WHERE c_custkey = 4")
def expect_one(spark, d):
    """a search that must find one dataset finds it."""
    cat = X.catalog(spark, d)
    (wanted,) = [row["id"] for row in cat.where("c_custkey = 4").select("id").collect()]
    return T.expect_one(T.search(cat, id=wanted)).select("id", "path", "xrfreq")


# Every cell belongs to a part of storage; parts 1 and 2 change, part 3 goes, part 7 comes.
@query("scan_changes", f"""WITH {DAILY_SQL}, parts AS (SELECT DISTINCT cell_id % 7 AS p FROM daily)
SELECT concat('part=', p) AS part, CASE WHEN p = 3 THEN 'removed' ELSE 'changed' END AS change FROM parts WHERE p IN (1, 2, 3)
UNION ALL SELECT 'part=7', 'added' FROM parts WHERE p = 0""")
def scan_changes(spark, d):
    """Two listings of storage tell what was added, changed and removed between them."""
    rows = X.daily(spark, d).select("cell_id", "t", "pr", F.expr("CAST(cell_id % 7 AS INT)").alias("part"))
    root = scratch_dir(spark)
    rows.write.partitionBy("part").parquet(root)
    former = cut_lineage(T.listing(spark, root, "*.parquet"))
    changed = rows.where("part IN (1, 2)").withColumn("more", F.lit(1)).unionByName(
        rows.where("part = 0").withColumns({"part": F.lit(7), "more": F.lit(1)}))
    changed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("part").parquet(root)
    gone = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/part=3")
    gone.getFileSystem(spark._jsc.hadoopConfiguration()).delete(gone, True)
    out = T.listing_changes(former, T.listing(spark, root, "*.parquet"))
    return out.select(F.element_at(F.split("path", "/"), -1).alias("part"), "change")


# --- a grid turned by an angle whose cosine is 0.8: its inverse has a closed form ---------------------------------------

_SIDE = f"(SELECT CAST(ceil(sqrt(MAX({X._CELL.replace('l_suppkey', 's_suppkey')}) + 1)) AS INT) AS side FROM supplier)"
_LON, _LAT = "-75e0 + 5e-2 * (0.8e0 * i - 0.6e0 * j)", "45e0 + 5e-2 * (0.6e0 * i + 0.8e0 * j)"
_AT_LON = "-75e0 + 5e-2 * (CAST(s_suppkey * 7919 % 10007 AS DOUBLE) / 1e4 * 2.1e0 - 1.3e0) * side * 0.8e0"
_AT_LAT = "45e0 + 5e-2 * (CAST(s_suppkey * 104729 % 9973 AS DOUBLE) / 1e4 * 1.5e0 - 0.03e0) * side"

_CURVED_SQL = X.duck(f"""side AS {_SIDE},
grid AS (SELECT DISTINCT CAST({X._CELL.replace('l_suppkey', 's_suppkey')} AS INT) AS cell_id FROM supplier),
aims AS (SELECT CAST(s_suppkey AS INT) AS dst_cell, {_AT_LON} AS lon, {_AT_LAT} AS lat, side FROM supplier, side),
turned AS (SELECT dst_cell, side, (0.8e0 * (lon + 75e0) + 0.6e0 * (lat - 45e0)) / 5e-2 AS pi, (0.8e0 * (lat - 45e0) - 0.6e0 * (lon + 75e0)) / 5e-2 AS pj FROM aims),
four AS (SELECT dst_cell, CAST((floor(pj) + dj) * side + floor(pi) + di AS INT) AS src_cell, side, floor(pi) AS i, floor(pj) AS j,
   (CASE WHEN di = 1 THEN pi - floor(pi) ELSE 1 - (pi - floor(pi)) END) * (CASE WHEN dj = 1 THEN pj - floor(pj) ELSE 1 - (pj - floor(pj)) END) AS w
   FROM turned CROSS JOIN (VALUES (0, 0), (1, 0), (0, 1), (1, 1)) AS c(di, dj)),
present AS (SELECT four.* FROM four JOIN grid ON cell_id = src_cell WHERE i >= 0 AND i < side - 1 AND j >= 0),
weights AS (SELECT src_cell, dst_cell, w FROM (SELECT *, COUNT(*) OVER (PARTITION BY dst_cell) AS n FROM present) WHERE n = 4),
allweights AS (SELECT * FROM weights UNION ALL SELECT -1, dst_cell, NULL FROM aims WHERE dst_cell NOT IN (SELECT dst_cell FROM weights))""")


def curved(spark, d):
    suppliers = X.read(spark, d, "supplier")
    side = spark.sql(_SIDE[1:-1].replace("FROM supplier", "FROM {s}"), s=suppliers).first()["side"]
    ids = suppliers.select(F.expr(X._CELL.replace("l_suppkey", "s_suppkey")).alias("cell_id")).distinct()
    grid = ids.withColumns({"i": F.col("cell_id") % side, "j": F.expr(f"CAST(cell_id div {side} AS INT)")})
    source = grid.select("cell_id", "i", "j", F.expr(_LAT).alias("lat"), F.expr(_LON).alias("lon"))
    aims = suppliers.withColumn("side", F.lit(side)).select(
        F.expr("CAST(s_suppkey AS INT)").alias("cell_id"), F.expr(_AT_LAT).alias("lat"), F.expr(_AT_LON).alias("lon"))
    return Q.curvilinear_weights(source, aims)


@query("curvilinear_weights", f"WITH {_CURVED_SQL} SELECT src_cell, dst_cell, {r('w')} AS w FROM allweights")
def curvilinear_weights(spark, d):
    """Four corners and their weights by inverting the map of each quadrilateral; targets outside have one row without a weight."""
    return rounded(curved(spark, d), ["w"])


@query("regrid_curvilinear", f"""WITH {DAILY_SQL}, {_CURVED_SQL}, days AS (SELECT DISTINCT dataset_id, t FROM daily),
mapped AS (SELECT dataset_id, dst_cell, t, w, tasmax FROM daily JOIN allweights ON src_cell = daily.cell_id
  UNION ALL SELECT dataset_id, dst_cell, t, NULL, NULL FROM days CROSS JOIN allweights WHERE src_cell = -1)
SELECT dataset_id, dst_cell AS cell_id, t, {r('CASE WHEN COUNT(tasmax) = 4 THEN SUM(w * tasmax) END')} AS tasmax FROM mapped GROUP BY 1, 2, 3""")
def regrid_curvilinear(spark, d):
    """Days of a source on a curved grid at the targets; those outside are NULL."""
    out = G.regrid(X.daily(spark, d), curved(spark, d), ["tasmax"])
    return rounded(out.select("dataset_id", "cell_id", "t", "tasmax"), ["tasmax"])
