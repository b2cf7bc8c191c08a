"""Mixed calendars, gaps and second members; reading and writing of cells, catalogs, folders, definitions, metadata."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, functions as F

from graticule.functions import calendars as C
from graticule.operators import indices as I, properties as M, regrid as G, selection as S
from graticule.operators.definitions import load_definitions
from graticule.plans import indices as plan
from graticule.session import scratch_dir
from graticule.sources import catalog as T, daily as D

from . import fixtures as X
from .fixtures import CELLS_SQL, DAILY_SQL, NOLEAP_SQL
from .q_daily import _HAV, _STATIONS, stations_of
from .q_indices import FOLDED, _folded_sql
from .q_props import CELLWISE, all_measures, measures_sql
from .registry import query, r, rounded

_CAL360 = f"""c AS (SELECT *, CASE WHEN {X.LEAP_SQL} THEN 366 ELSE 365 END AS n FROM daily),
k AS (SELECT dataset_id, cell_id, year, CAST(ROUND(360.0e0 * doy / n) AS INT) AS doy, tasmax FROM c
      WHERE CAST(ROUND(360.0e0 * doy / n) AS INT) <> CAST(ROUND(360.0e0 * (doy - 1) / n) AS INT))"""


@query("calendar_mixed", f"""WITH {NOLEAP_SQL}, {_CAL360}
SELECT dataset_id, calendar, cell_id, t, {r('tasmax')} AS tasmax FROM nl WHERE dataset_id = 'ref'
UNION ALL SELECT dataset_id, '360_day', cell_id, year * 360 + doy - 1, {r('tasmax')} FROM k WHERE dataset_id = 'sim'""")
def calendar_mixed(spark, d):
    """Q2: a member of 360-day years goes through a conversion to noleap unchanged."""
    df = X.daily(spark, d)
    both = X.dataset(df, "ref").unionByName(C.convert_calendar(X.dataset(df, "sim"), "360_day"))
    out = C.convert_calendar(both, "noleap", others="keep")
    return rounded(out.select("dataset_id", "calendar", "cell_id", "t", "tasmax"), ["tasmax"])


@query("nearest_cell_all", f"""WITH {CELLS_SQL}, {_STATIONS}, far AS (SELECT station_id, lat + 3e0 AS lat, lon - 9e0 AS lon FROM stations),
d AS (SELECT station_id, cell_id, {_HAV} AS km FROM far s CROSS JOIN cells c),
k AS (SELECT *, row_number() OVER (PARTITION BY station_id ORDER BY km, cell_id) AS rn FROM d)
SELECT station_id, cell_id, {r('km')} AS distance_km FROM k WHERE rn = 1""")
def nearest_cell_all(spark, d):
    """Stations hundreds of kilometres from the grid have a nearest cell too."""
    far = stations_of(spark, d).withColumns({"lat": F.col("lat") + 3.0, "lon": F.col("lon") - 9.0})
    return rounded(S.nearest_cell(far, X.cells(spark, d)), ["distance_km"])


def _every_period_sql(defs, source: str) -> str:
    """The periods of every cell, NULL where it has no day, next to the values ``ind`` of the periods it has."""
    from .registry import _FREQ, month_date
    parts = []
    for d in defs:
        length, first = _FREQ[d.freq]
        lo, hi = (f"(m{e} - (m{e} - {first}) % {length})" for e in ("lo", "hi"))
        parts.append(f"SELECT dataset_id, '{d.name}' AS indicator, '{d.freq}' AS freq, cell_id, "
                     f"unnest(range({lo}, {hi} + 1, {length})) AS no FROM spans")
    return f"""spans AS (SELECT dataset_id, cell_id, mlo, mhi FROM (SELECT DISTINCT dataset_id, cell_id FROM {source})
  JOIN (SELECT dataset_id, MIN(year * 12 + month - 1) AS mlo, MAX(year * 12 + month - 1) AS mhi FROM {source} GROUP BY 1) USING (dataset_id)),
every AS (SELECT * EXCLUDE no, {month_date('no')} AS period_start FROM ({' UNION ALL '.join(parts)}))"""


@query("idx_absent_period", f"""WITH {DAILY_SQL}, gap AS MATERIALIZED (SELECT * FROM daily WHERE NOT (year = 1997 OR month = 2 AND year = 1999)),
ind AS ({_folded_sql(FOLDED, 'gap')}), {_every_period_sql(FOLDED, 'gap')}
SELECT dataset_id, indicator, freq, cell_id, period_start, {r('value')} AS value FROM every LEFT JOIN ind USING (dataset_id, indicator, freq, cell_id, period_start)""")
def idx_absent_period(spark, d):
    """A period without any day has a row, NULL."""
    gap = X.daily(spark, d).where("NOT (year = 1997 OR month = 2 AND year = 1999)")
    return rounded(I.compute_indicators(gap, FOLDED, "skip"), ["value"])


@query("idx_run_second_member", f"""WITH {DAILY_SQL}, ind AS ({_folded_sql(FOLDED)})
SELECT dataset_id, indicator, COUNT(*) AS n, {r('SUM(value)', 3)} AS total FROM ind GROUP BY 1, 2""")
def idx_run_second_member(spark, d):
    """I32: a member added later leaves the indices of the first where they are."""
    df, path = X.daily(spark, d), scratch_dir(spark)
    empty = spark.createDataFrame([], "id string, xrfreq string, variable array<string>, processing_level string, path string")
    catalog = plan.run(X.dataset(df, "ref"), empty, FOLDED, path, "skip")
    plan.run(df, catalog, FOLDED, path, "skip")
    out = spark.read.parquet(path).groupBy("dataset_id", "indicator").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))
    return rounded(out, ["total"], 3)


@query("cells_round_trip", f"WITH {CELLS_SQL} SELECT cell_id, {r('lat')} AS lat, {r('lon')} AS lon FROM cells")
def cells_round_trip(spark, d):
    """S2."""
    path = scratch_dir(spark)
    X.cells(spark, d).write.parquet(path)
    return rounded(D.read_cells(spark, path), ["lat", "lon"])


@query("catalog_round_trip", f"""WITH {X.CATALOG_SQL} SELECT id, path, experiment, xrfreq, CAST(year(date_start) AS VARCHAR) AS first,
array_to_string(variable, '+') AS variables FROM cat""")
def catalog_round_trip(spark, d):
    """S3: written as CSV and read back, the variables as a list."""
    path = scratch_dir(spark)
    T.write_catalog(X.catalog(spark, d), path)
    return T.read_catalog(spark, path).select(
        "id", "path", "experiment", "xrfreq", F.substring("date_start", 1, 4).alias("first"), F.array_join("variable", "+").alias("variables"))


@query("scan_and_load", f"""WITH {DAILY_SQL} SELECT dataset_id, COUNT(*) AS n, {r('SUM(CAST(CAST(pr AS FLOAT) AS DOUBLE))', 2)} AS total FROM daily WHERE dataset_id = 'sim' GROUP BY 1""")
def scan_and_load(spark, d):
    """Datasets stored in folders are found by their names, one is chosen and opened."""
    root = scratch_dir(spark)
    df = X.daily(spark, d)
    for name in ("ref", "sim"):
        D.write_table(X.dataset(df, name), f"{root}/day_RCM_{name}_1995-2001.parquet")
    found = T.scan_paths(spark, root, "*.parquet", ["{frequency}_{source}_{experiment}_{date_start}-{date_end}.parquet"], {"domain": "NAM"})
    out = D.load_selected(spark, T.expect_one(T.search(found, experiment="sim", domain="NAM")))
    return rounded(out.groupBy("dataset_id").agg(F.count(F.lit(1)).alias("n"), F.sum("pr").alias("total")), ["total"], 2)


_NOTES = {v: {"long_name": a["long_name"], "cell_methods": a["cell_methods"], "bias_adjustment": "by {method}"} for v, a in D.FINAL_ATTRS.items()}


@query("final_metadata", f"WITH {DAILY_SQL}, notes(variable, name, value) AS (VALUES " + ", ".join(
    f"('{v}', '{k}', '{x.format(method='DQM')}')" for v, a in _NOTES.items() for k, x in a.items())
    + ") SELECT dataset_id, variable, name, value FROM (SELECT DISTINCT dataset_id FROM daily) CROSS JOIN notes")
def final_metadata(spark, d):
    """Attributes are filled in, stored with the table and read back, for each dataset."""
    path = scratch_dir(spark)
    attrs = {v: {**a, "scratch": "dropped"} for v, a in _NOTES.items()}
    D.stamp_metadata(D.as_stored(X.daily(spark, d)), attrs, D.FINAL_ATTR_NAMES, method="DQM").write.parquet(path)
    stored = spark.read.parquet(path)
    rows = [F.struct(F.lit(v).alias("variable"), F.lit(k).alias("name"), F.lit(x).alias("value"))
            for v in D.VARIABLES for k, x in stored.schema[v].metadata.items()]
    return stored.select("dataset_id").distinct().select("dataset_id", F.explode(F.array(*rows)).alias("r")).select("dataset_id", "r.*")


@query("properties_and_measures", f"""WITH {measures_sql(CELLWISE)}, o AS (SELECT dataset_id, 'measures' AS kind, * EXCLUDE dataset_id FROM meas
 UNION ALL SELECT dataset_id, 'properties', * EXCLUDE dataset_id FROM p WHERE dataset_id <> 'ref')
SELECT dataset_id, kind, property, COUNT(*) AS n, {r('SUM(value)', 3)} AS total FROM o GROUP BY 1, 2, 3""")
def properties_and_measures(spark, d):
    """S14."""
    df = X.daily(spark, d)
    path = scratch_dir(spark)
    props = M.compute_properties(df.unionByName(X.scen(df)), CELLWISE, X.REF_PERIOD).where("dataset_id <> 'ref'")
    D.write_properties(props, all_measures(spark, d, CELLWISE), path)
    out = spark.read.parquet(path).groupBy("dataset_id", "kind", "property").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))
    return rounded(out, ["total"], 3)


@query("regrid_given_weights", f"""WITH {DAILY_SQL}, w AS (SELECT CAST(s_suppkey div 4 % 522500 AS INT) AS src_cell, CAST(s_suppkey % 7 AS INT) AS dst_cell,
  COUNT(*) / 8e0 AS w FROM supplier GROUP BY 1, 2)
SELECT dataset_id, dst_cell AS cell_id, t, {r('SUM(w * tasmax) / SUM(w)')} AS tasmax FROM daily JOIN w ON src_cell = cell_id GROUP BY 1, 2, 3""".replace(" div ", " // "))
def regrid_given_weights(spark, d):
    """Any table of weights, here sums over groups of cells."""
    w = X.read(spark, d, "supplier").groupBy(
        F.expr("CAST(s_suppkey div 4 % 522500 AS INT)").alias("src_cell"), F.expr("CAST(s_suppkey % 7 AS INT)").alias("dst_cell"),
    ).agg((F.count(F.lit(1)) / 8.0).alias("w"))
    out = G.regrid(X.daily(spark, d), w, ["tasmax"], unmapped_to_null=False)
    return rounded(out.select("dataset_id", "cell_id", "t", "tasmax"), ["tasmax"])


@query("idx_from_file", f"WITH {DAILY_SQL}, ind AS ({_folded_sql(FOLDED)}) SELECT dataset_id, indicator, freq, cell_id, period_start, {r('value')} AS value FROM ind")
def idx_from_file(spark, d):
    """The same definitions, written to a file and loaded."""
    import os
    import tempfile
    doc = {"indicators": {x.name: {"base": f"lib.{x.base}", "parameters": {**x.params, "freq": x.freq}, "cf_attrs": {"var_name": x.output}} for x in FOLDED}}
    with tempfile.NamedTemporaryFile("w", suffix=".json", delete=False) as f:  # read by the driver alone
        json.dump(doc, f)
    try:
        defs = load_definitions(f.name)
    finally:
        os.unlink(f.name)
    return rounded(I.compute_indicators(X.daily(spark, d), defs, "skip"), ["value"])


@query("by_time", f"WITH {DAILY_SQL} SELECT dataset_id, t, COUNT(*) AS n, 1 AS partitions FROM daily GROUP BY 1, 2")
def by_time(spark, d) -> DataFrame:
    """All cells of a day lie in one partition."""
    spread = D.by_time(X.daily(spark, d)).withColumn("p", F.spark_partition_id())
    return spread.groupBy("dataset_id", "t").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("p").cast("int").alias("partitions"))
