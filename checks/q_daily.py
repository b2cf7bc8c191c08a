"""Sources, derived columns, filters, joins, calendars, set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from graticule.functions import calendars as C, units as U
from graticule.operators import derive as P, selection as S
from graticule.sources import daily as D

from . import fixtures as X
from .fixtures import CELLS_SQL, DAILY_SQL, NOLEAP_SQL
from .registry import pstart, query, r, rounded

KEYS = ["dataset_id", "cell_id", "t"]


@query("daily_table", f"WITH {DAILY_SQL} SELECT {', '.join(X.DAILY_COLS[:9])}, {r('tasmax')} AS tasmax, {r('tasmin')} AS tasmin, {r('pr')} AS pr FROM daily")
def daily_table(spark, d):
    return rounded(X.daily(spark, d), ["tasmax", "tasmin", "pr"])


@query("dtr", f"WITH {DAILY_SQL} SELECT dataset_id, cell_id, t, {r('tasmax - tasmin')} AS dtr FROM daily")
def dtr(spark, d):
    return rounded(P.with_dtr(X.daily(spark, d)).select(*KEYS, "dtr"), ["dtr"])


@query("tasmin_from_dtr", f"WITH {DAILY_SQL} SELECT dataset_id, cell_id, t, {r('tasmax - (tasmax - tasmin)')} AS tasmin FROM daily")
def tasmin_from_dtr(spark, d):
    df = P.with_dtr(X.daily(spark, d)).drop("tasmin")
    return rounded(P.with_tasmin_from_dtr(df).select(*KEYS, "tasmin"), ["tasmin"])


@query("tas_mean", f"WITH {DAILY_SQL} SELECT dataset_id, cell_id, t, {r('(tasmax + tasmin) / 2')} AS tas FROM daily")
def tas_mean(spark, d):
    return rounded(P.with_tas(X.daily(spark, d)).select(*KEYS, "tas"), ["tas"])


@query("convert_units", f"""WITH {DAILY_SQL}
SELECT dataset_id, cell_id, t, {r('tasmax - 273.15e0')} AS tasmax, {r('pr / 86400e0', 12)} AS pr FROM daily""")
def convert_units(spark, d):
    df = U.convert_units(X.daily(spark, d).select(*KEYS, "tasmax", "pr"),
                         {"tasmax": "degC", "pr": "kg m-2 s-1"}, {"tasmax": "K", "pr": "mm d-1"})
    return rounded(rounded(df, ["tasmax"]), ["pr"], 12)


@query("noleap", f"""WITH {NOLEAP_SQL}
SELECT dataset_id, calendar, cell_id, year, month, day, doy, t, date, {r('pr')} AS pr FROM nl""")
def noleap(spark, d):
    return rounded(X.noleap(spark, d).select(*X.DAILY_COLS[:9], "pr"), ["pr"])


@query("cal360", f"""WITH {DAILY_SQL},
c AS (SELECT *, CASE WHEN {X.LEAP_SQL} THEN 366 ELSE 365 END AS n FROM daily),
m AS (SELECT *, CAST(ROUND(360.0e0 * doy / n) AS INT) AS d360, CAST(ROUND(360.0e0 * (doy - 1) / n) AS INT) AS prev FROM c),
k AS (SELECT dataset_id, '360_day' AS calendar, cell_id, year, CAST((d360 - 1) // 30 + 1 AS INT) AS month,
             CAST((d360 - 1) % 30 + 1 AS INT) AS day, d360 AS doy, year * 360 + d360 - 1 AS t, tasmax FROM m WHERE d360 <> prev)
SELECT dataset_id, calendar, cell_id, year, month, day, doy, t,
       CASE WHEN day <= day(last_day(make_date(year, month, 1))) THEN make_date(year, month, day) END AS date,
       {r('tasmax')} AS tasmax FROM k""")
def cal360(spark, d):
    df = C.convert_calendar(X.daily(spark, d), "360_day")
    return rounded(df.select(*X.DAILY_COLS[:9], "tasmax"), ["tasmax"])


@query("calendar_of", f"""WITH {NOLEAP_SQL}, b AS (SELECT dataset_id, calendar FROM nl WHERE dataset_id = 'sim'
UNION ALL SELECT dataset_id, calendar FROM daily WHERE dataset_id = 'ref')
SELECT dataset_id, array_to_string(list_sort(list(DISTINCT calendar)), ',') AS calendars FROM b GROUP BY 1""")
def calendar_of(spark, d):
    both = X.dataset(X.noleap(spark, d), "sim").unionByName(X.dataset(X.daily(spark, d), "ref"))
    return C.calendar_of(both).withColumn("calendars", F.array_join("calendars", ","))


_PERIODS = {"ys": "YS", "ms": "MS", "as_jul": "AS-JUL", "qs_dec": "QS-DEC", "half": "2QS-OCT"}


@query("period_start", f"""WITH {DAILY_SQL} SELECT year, month,
{', '.join(f'{pstart(f)} AS {n}' for n, f in _PERIODS.items())}, COUNT(*) AS n FROM daily GROUP BY ALL""")
def period_start(spark, d):
    df = X.daily(spark, d)
    return df.groupBy("year", "month", *[C.period_start("year", "month", f).alias(n) for n, f in _PERIODS.items()]).agg(
        F.count(F.lit(1)).alias("n"))


@query("in_period", f"WITH {DAILY_SQL} SELECT dataset_id, cell_id, t, {r('pr')} AS pr FROM daily WHERE year BETWEEN 1995 AND 1998")
def in_period(spark, d):
    return rounded(S.in_period(X.daily(spark, d), *X.REF_PERIOD).select(*KEYS, "pr"), ["pr"])


@query("in_bbox", f"""WITH {DAILY_SQL}, {CELLS_SQL}
SELECT dataset_id, cell_id, t, {r('tasmax')} AS tasmax FROM daily WHERE cell_id IN
(SELECT cell_id FROM cells WHERE lon BETWEEN -147.55 AND -52.65 AND lat BETWEEN 44.15 AND 44.35)""")
def in_bbox(spark, d):
    df = S.in_bbox(X.daily(spark, d), X.cells(spark, d), S.PROCESSING_REGIONS["fixms"])
    return rounded(df.select(*KEYS, "tasmax"), ["tasmax"])


@query("in_region_buffer", f"""WITH {DAILY_SQL}, {CELLS_SQL}
SELECT dataset_id, cell_id, COUNT(*) AS n FROM daily WHERE cell_id IN
(SELECT cell_id FROM cells WHERE lon BETWEEN -74.9e0 - 0.05e0 AND -74.8e0 + 0.05e0 AND lat BETWEEN 44.2e0 - 0.1e0 AND 44.3e0 + 0.1e0)
GROUP BY 1, 2""")
def in_region_buffer(spark, d):
    box = S.Box((-74.8, -74.9), (44.3, 44.2))
    df = S.in_region(X.daily(spark, d), X.cells(spark, d), box, buffer=1, step=(0.05, 0.1))
    return df.groupBy("dataset_id", "cell_id").agg(F.count(F.lit(1)).alias("n"))


@query("assign_region", f"""WITH {CELLS_SQL} SELECT cell_id, name AS region FROM cells JOIN (VALUES
('north', -147.55, -52.65, 59.25, 74.25), ('middle', -147.55, -52.65, 44.25, 59.25), ('south', -147.55, -52.65, 19.25, 44.25),
('fixnm', -147.55, -52.65, 59.15, 59.35), ('fixms', -147.55, -52.65, 44.15, 44.35), ('fixs', -147.55, -52.65, 19.15, 19.35),
('Haudenosaunee', -79.0, -71.0, 42.0, 47.0), ('Ute', -111.0, -103.0, 35.0, 40.0), ('Dene', -124.0, -116.0, 60.0, 65.0)
) AS g(name, w, e, s, n) ON lon BETWEEN w AND e AND lat BETWEEN s AND n""")
def assign_region(spark, d):
    regions = {**S.PROCESSING_REGIONS, **S.DIAGNOSTIC_REGIONS}
    return S.assign_region(X.cells(spark, d), regions).select("cell_id", "region")


@query("land_mask", f"""WITH {DAILY_SQL}, f AS (SELECT MIN(t) AS t0 FROM daily),
land AS (SELECT DISTINCT cell_id FROM daily, f WHERE t = t0 + 130 AND tasmax IS NOT NULL)
SELECT dataset_id, cell_id, COUNT(*) AS n FROM daily WHERE cell_id IN (SELECT cell_id FROM land) GROUP BY 1, 2""")
def land_mask(spark, d):
    df = X.daily(spark, d)
    first_t = df.agg(F.min("t")).first()[0]
    return S.on_cells(df, S.land_cells(df, first_t)).groupBy("dataset_id", "cell_id").agg(F.count(F.lit(1)).alias("n"))


@query("wet_days", f"WITH {DAILY_SQL} SELECT dataset_id, cell_id, t, {r('pr')} AS pr FROM daily WHERE pr >= 1")
def wet_days(spark, d):
    return rounded(S.wet_days(X.daily(spark, d)).select(*KEYS, "pr"), ["pr"])


@query("align_monthly", f"""WITH {DAILY_SQL},
m AS (SELECT dataset_id, cell_id, {pstart('MS')} AS period_start, AVG(tasmax) AS tx FROM daily GROUP BY ALL)
SELECT s.cell_id, s.period_start, {r('s.tx')} AS tx, {r('f.tx')} AS tx_ref FROM m s JOIN m f USING (cell_id, period_start)
WHERE s.dataset_id = 'sim' AND f.dataset_id = 'ref'""")
def align_monthly(spark, d):
    from graticule.operators.properties import resample
    m = resample(X.daily(spark, d), "MS", {"tx": ("mean", "tasmax")})
    on = ["cell_id", "period_start"]
    return rounded(S.align(X.dataset(m, "sim").drop("dataset_id"), X.dataset(m, "ref"), on, ["tx"]), ["tx", "tx_ref"])


@query("unstack", f"""WITH {DAILY_SQL}, {CELLS_SQL},
ends AS (SELECT MIN(t) AS a, MAX(t) AS b FROM daily), days AS (SELECT unnest(range(a, b + 1)) AS t FROM ends), ids AS (SELECT unnest(['ref', 'sim']) AS dataset_id)
SELECT dataset_id, cell_id, CAST(t AS INT) AS t, {r('tasmax')} AS tasmax, {r('lat')} AS lat, {r('lon')} AS lon
FROM cells CROSS JOIN days CROSS JOIN ids LEFT JOIN (SELECT dataset_id, cell_id, t, tasmax FROM daily) USING (dataset_id, cell_id, t)""")
def unstack(spark, d):
    values = X.daily(spark, d).select(*KEYS, "tasmax")
    ends = values.agg(F.min("t").alias("a"), F.max("t").alias("b")).first()
    return rounded(S.unstack(values, X.cells(spark, d), ["ref", "sim"], ends["a"], ends["b"]), ["tasmax", "lat", "lon"])


_STATIONS = """stations AS (SELECT concat('S', CAST(c_custkey AS VARCHAR)) AS station_id,
  44.0e0 + (c_custkey * 37 % 101) / 2e2 AS lat, -75.1e0 + (c_custkey * 53 % 211) / 3e2 AS lon FROM customer)"""


def stations_of(spark, d):
    return X.read(spark, d, "customer").select(
        F.expr("concat('S', CAST(c_custkey AS STRING))").alias("station_id"),
        F.expr("44.0e0 + (c_custkey * 37 % 101) / 2e2").alias("lat"),
        F.expr("-75.1e0 + (c_custkey * 53 % 211) / 3e2").alias("lon"),
    )


_HAV = ("12742e0 * asin(sqrt(least(1e0, pow(sin(radians(c.lat - s.lat) / 2), 2) + cos(radians(s.lat)) * cos(radians(c.lat))"
        " * pow(sin(radians(c.lon - s.lon) / 2), 2))))")


@query("nearest_cell", f"""WITH {CELLS_SQL}, {_STATIONS},
d AS (SELECT station_id, cell_id, {_HAV} AS km FROM stations s CROSS JOIN cells c),
k AS (SELECT *, row_number() OVER (PARTITION BY station_id ORDER BY km, cell_id) AS rn FROM d)
SELECT station_id, cell_id, {r('km')} AS distance_km FROM k WHERE rn = 1""")
def nearest_cell(spark, d):
    return rounded(S.nearest_cell(stations_of(spark, d), X.cells(spark, d)), ["distance_km"])


@query("region_concat", f"""WITH {DAILY_SQL}, {CELLS_SQL},
a AS (SELECT dataset_id, cell_id, t, tasmax FROM daily JOIN cells USING (cell_id) WHERE lat BETWEEN 59.25 AND 74.25
UNION ALL SELECT dataset_id, cell_id, t, tasmax FROM daily JOIN cells USING (cell_id) WHERE lat BETWEEN 44.25 AND 59.25
UNION ALL SELECT dataset_id, cell_id, t, tasmax FROM daily JOIN cells USING (cell_id) WHERE lat BETWEEN 19.25 AND 44.25)
SELECT dataset_id, cell_id, COUNT(*) AS n, COUNT(DISTINCT t) AS days, {r('AVG(tasmax)')} AS tx FROM a GROUP BY 1, 2""")
def region_concat(spark, d):
    df, cells = X.daily(spark, d).select(*KEYS, "tasmax"), X.cells(spark, d)
    parts = [S.in_bbox(df, cells, S.PROCESSING_REGIONS[n]) for n in ("north", "middle", "south")]
    out = S.concat_regions(parts).groupBy("dataset_id", "cell_id").agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("t").alias("days"), F.avg("tasmax").alias("tx"))
    return rounded(out, ["tx"])


@query("region_overlap", f"""WITH {DAILY_SQL}, {CELLS_SQL},
a AS (SELECT dataset_id, cell_id, t FROM daily JOIN cells USING (cell_id) WHERE lat BETWEEN 44.25 AND 59.25
UNION ALL SELECT dataset_id, cell_id, t FROM daily JOIN cells USING (cell_id) WHERE lat BETWEEN 19.25 AND 44.25)
SELECT dataset_id, cell_id, t, COUNT(*) AS n FROM a GROUP BY 1, 2, 3 HAVING COUNT(*) > 1""")
def region_overlap(spark, d):
    df, cells = X.daily(spark, d).select(*KEYS), X.cells(spark, d)
    parts = [S.in_bbox(df, cells, S.PROCESSING_REGIONS[n]) for n in ("middle", "south")]
    return S.duplicate_keys(S.concat_regions(parts))


@query("replace_seam", f"""WITH {DAILY_SQL}, {CELLS_SQL},
p AS (SELECT dataset_id, cell_id, t, pr + 1 AS pr FROM daily JOIN cells USING (cell_id) WHERE lat BETWEEN 44.15 AND 44.35)
SELECT dataset_id, cell_id, t, {r('pr')} AS pr FROM p UNION ALL
SELECT dataset_id, cell_id, t, {r('pr')} AS pr FROM daily WHERE (dataset_id, cell_id, t) NOT IN (SELECT (dataset_id, cell_id, t) FROM p)""")
def replace_seam(spark, d):
    df = X.daily(spark, d).select(*KEYS, "pr")
    patch = S.in_bbox(df, X.cells(spark, d), S.PROCESSING_REGIONS["fixms"]).withColumn("pr", F.col("pr") + 1)
    return rounded(S.replace_cells(df, patch.select(*df.columns)), ["pr"])


@query("records_per_day", """SELECT user_id, CAST(ts AS DATE) AS date, COUNT(*) AS n FROM events GROUP BY 1, 2""")
def records_per_day(spark, d):
    return D.records_per_day(X.read(spark, d, "events"), "ts", ["user_id"])


@query("subdaily_to_daily", f"""WITH e AS (SELECT event_type AS dataset_id, CAST(user_id % 50 AS INT) AS cell_id, CAST(ts AS DATE) AS date, value FROM events)
SELECT dataset_id, cell_id, date, CAST(dayofyear(date) AS INT) AS doy, {r('MAX(value)')} AS tasmax, {r('MIN(value)')} AS tasmin, {r('AVG(value)')} AS pr
FROM e GROUP BY 1, 2, 3""")
def subdaily_to_daily(spark, d):
    e = X.read(spark, d, "events").select(
        F.col("event_type").alias("dataset_id"), (F.col("user_id") % 50).cast("int").alias("cell_id"), "ts", "value")
    out = D.to_daily(e, {"tasmax": ("max", "value"), "tasmin": ("min", "value"), "pr": ("mean", "value")})
    return rounded(out.select("dataset_id", "cell_id", "date", "doy", "tasmax", "tasmin", "pr"), ["tasmax", "tasmin", "pr"])


@query("check_daily", f"WITH {DAILY_SQL} SELECT dataset_id, cell_id, date, {r('pr')} AS pr FROM daily")
def check_daily(spark, d):
    return rounded(D.check_daily(X.daily(spark, d)).select("dataset_id", "cell_id", "date", "pr"), ["pr"])
