"""Daily climate tables shaped from the given tables, as DataFrames and as the same SQL.

``lineitem`` becomes the daily table: a supplier group is a grid cell, a ship date a day, the line status tells reference
('O') from simulation ('F'; 3 K warmer, drier on weak days, 20 % wetter else).  The grid has 950 x 550 places of 0.1 degrees,
filled in blocks of 5 x 5 cells, so cells grow with the table until the grid is full (beyond 2 million suppliers several
share a cell; their days are aggregated, none is dropped).  All inputs are integers or single
IEEE operations on them, so both engines hold bit-identical daily values; the odd constants keep sums of them off the
rounding borders of the comparison.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from graticule.functions.calendars import convert_calendar, with_standard_calendar
from graticule.session import spread, tune

REF_PERIOD = (1995, 1998)
FUT_PERIOD = (1999, 2001)
TARGET = (1995, 2001)

_CELL = "CAST(l_suppkey div 4 % 522500 AS INT)"
_LAT = "(1935 + 10 * ((247 + cell_id % 25 div 5 + 5 * (cell_id div 25 div 190)) % 550)) / 1e2"
_LON = "(-14750 + 10 * ((725 + cell_id % 5 + 5 * (cell_id div 25 % 190)) % 950)) / 1e2"

_RAW = f"""
SELECT CASE WHEN l_linestatus = 'O' THEN 'ref' ELSE 'sim' END AS dataset_id,
       {_CELL} AS cell_id, CAST(l_shipdate AS DATE) AS date,
       MAX(l_extendedprice) AS price,
       SUM(CAST(ROUND(l_discount * 100) AS BIGINT)) AS disc, COUNT(*) AS n,
       SUM(CASE WHEN l_returnflag = 'R' AND (l_linestatus = 'O' OR l_quantity > 15) THEN l_quantity ELSE 0e0 END) AS qty
FROM lineitem GROUP BY 1, 2, 3
"""
_TASMAX = ("262e0 + price / 3.0137e3 + 15e0 - abs(doy - 197) * 1.6393e-1"
           " + CASE WHEN dataset_id = 'sim' THEN 3e0 ELSE 0e0 END")
_TASMIN = "tasmax - 2e0 - CAST(disc AS DOUBLE) / CAST(n AS DOUBLE) - price / 8.9731e4"
_PR = "qty / 1e1 * (1e0 + price / 9.8731e5) * CASE WHEN dataset_id = 'sim' THEN 1.2e0 ELSE 1e0 END"

DAILY_COLS = ["dataset_id", "calendar", "cell_id", "year", "month", "day", "doy", "t", "date", "tasmax", "tasmin", "pr"]


def duck(sql: str) -> str:
    return sql.replace(" div ", " // ")


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return tune(spark).read.parquet(f"{sf_dir}/{table}.parquet")


def daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "lineitem").select(
        F.expr("CASE WHEN l_linestatus = 'O' THEN 'ref' ELSE 'sim' END").alias("dataset_id"),
        F.expr(_CELL).alias("cell_id"),
        F.expr("CAST(l_shipdate AS DATE)").alias("date"),
        "l_extendedprice",
        F.expr("CAST(ROUND(l_discount * 100) AS BIGINT)").alias("disc"),
        F.expr("CASE WHEN l_returnflag = 'R' AND (l_linestatus = 'O' OR l_quantity > 15) THEN l_quantity ELSE 0e0 END").alias("qty"),
    )
    raw = spread(rows, "dataset_id", "cell_id", "date").groupBy("dataset_id", "cell_id", "date").agg(
        F.expr("MAX(l_extendedprice)").alias("price"), F.expr("SUM(disc)").alias("disc"), F.expr("COUNT(*)").alias("n"), F.expr("SUM(qty)").alias("qty"))
    return (
        with_standard_calendar(raw)
        .withColumn("tasmax", F.expr(_TASMAX))
        .withColumns({"tasmin": F.expr(_TASMIN), "pr": F.expr(_PR)})
        .select(*DAILY_COLS)
    )


def noleap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return convert_calendar(daily(spark, sf_dir), "noleap")


def dataset(df: DataFrame, name: str) -> DataFrame:
    return df.where(F.col("dataset_id") == name)


def scen(df: DataFrame) -> DataFrame:
    """A stand-in scenario: the simulation with its known bias taken back, more so in some cells than in others."""
    shift = 2.5 + (F.col("cell_id") % 5) * 0.25
    return dataset(df, "sim").withColumns({
        "dataset_id": F.lit("scen"),
        "tasmax": F.col("tasmax") - shift,
        "tasmin": F.col("tasmin") - shift,
        "pr": F.greatest(F.col("pr") - 0.5, F.lit(0.0)),
    })


def cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = read(spark, sf_dir, "supplier").select(F.expr(_CELL.replace("l_suppkey", "s_suppkey")).alias("cell_id")).distinct()
    return ids.select("cell_id", F.expr(_LAT).alias("lat"), F.expr(_LON).alias("lon"))


CELLS_SQL = duck(f"""
cells AS (SELECT cell_id, {_LAT} AS lat, {_LON} AS lon
          FROM (SELECT DISTINCT {_CELL.replace('l_suppkey', 's_suppkey')} AS cell_id FROM supplier))""")

DAILY_SQL = duck(f"""
raw AS ({_RAW}),
dated AS (SELECT *, 'standard' AS calendar, CAST(year(date) AS INT) AS year, CAST(month(date) AS INT) AS month,
                 CAST(day(date) AS INT) AS day, CAST(dayofyear(date) AS INT) AS doy,
                 CAST(date_diff('day', DATE '1900-01-01', date) AS INT) AS t FROM raw),
warm AS (SELECT *, {_TASMAX} AS tasmax FROM dated),
daily AS MATERIALIZED (SELECT dataset_id, calendar, cell_id, year, month, day, doy, t, date, tasmax,
                 {_TASMIN} AS tasmin, {_PR} AS pr FROM warm)""")

LEAP_SQL = "(year % 4 = 0 AND year % 100 <> 0 OR year % 400 = 0)"
NOLEAP_SQL = DAILY_SQL + f""",
nl0 AS (SELECT * REPLACE (CAST(doy - CASE WHEN {LEAP_SQL} AND month > 2 THEN 1 ELSE 0 END AS INT) AS doy, 'noleap' AS calendar)
        FROM daily WHERE NOT (month = 2 AND day = 29)),
nl AS (SELECT * REPLACE (year * 365 + doy - 1 AS t) FROM nl0)"""

SCEN_SQL = """,
scen AS (SELECT * REPLACE ('scen' AS dataset_id, tasmax - (2.5e0 + (cell_id % 5) * 0.25e0) AS tasmax,
                           tasmin - (2.5e0 + (cell_id % 5) * 0.25e0) AS tasmin, greatest(pr - 0.5e0, 0e0) AS pr)
         FROM daily WHERE dataset_id = 'sim')"""


# --- a catalog from the customers ------------------------------------------------------------------------------------

_FACETS = {
    "driving_institution": "concat('DI', CAST(k % 7 AS VARCHAR(9)))",
    "driving_model": "CASE WHEN k % 5 = 0 THEN concat('GEMatm-', CAST(k % 3 AS VARCHAR(9))) ELSE concat('DM', CAST(k % 4 AS VARCHAR(9))) END",
    "institution": "concat('INST', CAST(k % 11 AS VARCHAR(9)))",
    "source": "concat('RCM', CAST(k AS VARCHAR(9)))",
    "experiment": "CASE c_custkey % 3 WHEN 0 THEN 'historical' WHEN 1 THEN 'rcp45' ELSE 'rcp85' END",
    "frequency": "CASE WHEN k % 6 = 5 THEN 'mon' ELSE 'day' END",
    "xrfreq": "CASE k % 6 WHEN 5 THEN 'AS-JAN' WHEN 4 THEN 'QS-DEC' ELSE 'D' END",
    "processing_level": "CASE WHEN k % 2 = 0 THEN 'raw' ELSE 'biasadjusted' END",
    "resolution": "CASE WHEN c_acctbal < 3000 THEN 0.22e0 ELSE 0.44e0 END",
    "date_start": "make_date(CAST(1950 + k % 40 AS INT), 1, 1)",
    "date_end": "make_date(CAST(CASE WHEN c_custkey % 3 = 0 THEN 2005 ELSE 2100 END AS INT), 12, 31)",
}

def catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three datasets per member (historical and two futures), variables as a list."""
    base = read(spark, sf_dir, "customer").withColumn("k", F.expr("c_custkey div 3"))
    df = base.select(
        "c_custkey", *[F.expr(sql).alias(name) for name, sql in _FACETS.items()],
        F.expr("CASE k % 4 WHEN 0 THEN array('tasmax', 'tasmin') WHEN 1 THEN array('pr') "
               "WHEN 2 THEN array('tg_mean', 'rx5day', 'tasmax') ELSE array('tasmax', 'tasmin', 'pr') END").alias("variable"),
    )
    member = F.concat_ws("_", "driving_institution", "driving_model", "institution", "source", "experiment")
    return df.withColumn("id", member).withColumn(
        "path", F.concat(F.lit("/data/"), "frequency", F.lit("_"), "id", F.lit("_"), F.year("date_start").cast("string"),
                         F.lit("-"), F.year("date_end").cast("string"), F.lit(".parquet"))
    )


CATALOG_SQL = duck(
    "cat0 AS (SELECT c_custkey, " + ", ".join(f"{sql} AS {name}" for name, sql in _FACETS.items())
    + """, CASE k % 4 WHEN 0 THEN ['tasmax', 'tasmin'] WHEN 1 THEN ['pr']
          WHEN 2 THEN ['tg_mean', 'rx5day', 'tasmax'] ELSE ['tasmax', 'tasmin', 'pr'] END AS variable
      FROM (SELECT *, c_custkey div 3 AS k FROM customer)),
cat1 AS (SELECT *, concat_ws('_', driving_institution, driving_model, institution, source, experiment) AS id FROM cat0),
cat AS (SELECT *, concat('/data/', frequency, '_', id, '_', CAST(year(date_start) AS VARCHAR), '-',
                         CAST(year(date_end) AS VARCHAR), '.parquet') AS path FROM cat1)""")
