"""Scores, ensemble summaries, station evaluation, sinks read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from graticule.functions.calendars import with_standard_calendar
from graticule.operators import evaluate as E, indices as I
from graticule.session import scratch_dir
from graticule.sources import daily as D

from . import fixtures as X
from .fixtures import DAILY_SQL
from .q_indices import FOLDED, _folded_sql
from .q_props import CELLWISE, all_measures, measures_sql
from .registry import pstart, query, r, rounded

_IMP_DEFS = CELLWISE
_IMP = f"""{measures_sql(_IMP_DEFS)},
pairs AS (SELECT a.property, a.cell_id, CASE WHEN a.property = 'aca_pr' THEN 1 ELSE 0 END AS c, a.value AS sim, b.value AS scen FROM meas a JOIN meas b
  ON a.property = b.property AND a.cell_id = b.cell_id AND a.month IS NOT DISTINCT FROM b.month WHERE a.dataset_id = 'sim' AND b.dataset_id = 'scen'
  AND a.value IS NOT NULL AND b.value IS NOT NULL),
imp AS (SELECT concat('m', CAST(cell_id % 3 AS VARCHAR)) AS member, property, AVG(CASE WHEN abs(sim - c) - abs(scen - c) > 1e-9 * abs(sim - c) THEN 1e0 ELSE 0e0 END) AS imp, COUNT(*) AS n FROM pairs GROUP BY 1, 2)"""


def imp_scores(spark, d):
    """Groups of cells stand for the members."""
    m = all_measures(spark, d, _IMP_DEFS).withColumn("member", F.concat(F.lit("m"), (F.col("cell_id") % 3).cast("string")))
    return E.imp(X.dataset(m, "sim"), X.dataset(m, "scen"))


@query("imp_score", f"WITH {_IMP} SELECT member, property, {r('imp')} AS imp, n FROM imp")
def imp_score(spark, d):
    return rounded(imp_scores(spark, d), ["imp"])


@query("imp_summary", f"""WITH {_IMP}, s AS (SELECT property, AVG(imp) AS imp, COUNT(*) AS members FROM imp GROUP BY 1)
SELECT property, {r('imp')} AS imp, members, CASE WHEN imp < 0.45 THEN 'worsened' WHEN imp > 0.55 THEN 'improved' ELSE 'neutral' END AS class FROM s""")
def imp_summary(spark, d):
    return rounded(E.imp_summary(imp_scores(spark, d)), ["imp"])


@query("imp_heat_map", f"""WITH {_IMP} SELECT property, {', '.join(r(f"MAX(imp) FILTER (member = 'm{i}')") + f' AS m{i}' for i in range(3))} FROM imp GROUP BY 1""")
def imp_heat_map(spark, d):
    return rounded(E.imp_heat_map(imp_scores(spark, d), ["m0", "m1", "m2"]), ["m0", "m1", "m2"])


@query("imp_by_resolution", f"""WITH {_IMP} SELECT CASE WHEN member = 'm0' THEN 0.22e0 ELSE 0.44e0 END AS resolution, property, {r('AVG(imp)')} AS imp FROM imp GROUP BY 1, 2""")
def imp_by_resolution(spark, d):
    scores = imp_scores(spark, d)
    members = scores.select("member").distinct().withColumn("resolution", F.when(F.col("member") == "m0", 0.22).otherwise(0.44))
    return rounded(E.imp_by_resolution(scores, members), ["imp"])


@query("missing_dates", f"""WITH {DAILY_SQL}, part AS (SELECT concat(dataset_id, CAST(cell_id % 5 AS VARCHAR)) AS dataset_id, t, tasmax, tasmin, pr FROM daily),
ends AS (SELECT MIN(t) AS a, MAX(t) AS b FROM part),
span AS (SELECT dataset_id, unnest(range(a, b + 1)) AS t FROM (SELECT DISTINCT dataset_id FROM part), ends),
gone AS (SELECT dataset_id, t FROM span WHERE (dataset_id, t) NOT IN (SELECT (dataset_id, t) FROM part GROUP BY dataset_id, t HAVING COUNT(tasmax) > 0 AND COUNT(tasmin) > 0 AND COUNT(pr) > 0)),
isl AS (SELECT *, t - row_number() OVER (PARTITION BY dataset_id ORDER BY t) AS i FROM gone)
SELECT dataset_id, CAST(MIN(t) AS INT) AS first_t, CAST(MAX(t) AS INT) AS last_t FROM isl GROUP BY dataset_id, i""")
def missing_dates(spark, d):
    df = X.daily(spark, d).withColumn("dataset_id", F.concat("dataset_id", (F.col("cell_id") % 5).cast("string")))
    ends = df.agg(F.min("t").alias("a"), F.max("t").alias("b")).first()
    spans = df.select("dataset_id").distinct().select("dataset_id", F.lit(ends["a"]).alias("first_t"), F.lit(ends["b"]).alias("last_t"))
    return E.missing_dates(df, spans)


@query("change_signal", f"""WITH {DAILY_SQL} SELECT dataset_id, cell_id,
{r('AVG(tasmax) FILTER (year BETWEEN 1999 AND 2001) - AVG(tasmax) FILTER (year BETWEEN 1995 AND 1998)')} AS change FROM daily GROUP BY 1, 2""")
def change_signal(spark, d):
    return rounded(E.change_signal(X.daily(spark, d), "tasmax", X.REF_PERIOD, X.FUT_PERIOD), ["change"])


_ENS_DEFS = FOLDED
_ENS = f"""{DAILY_SQL}, part AS (SELECT * REPLACE (concat(dataset_id, CAST(cell_id % 5 AS VARCHAR)) AS dataset_id) FROM daily),
ind AS ({_folded_sql(_ENS_DEFS, 'part')}),
y AS (SELECT dataset_id, indicator, CAST(year(period_start) AS INT) AS year, AVG(value) AS v FROM ind GROUP BY ALL),
ch AS (SELECT *, v - AVG(v) FILTER (year BETWEEN 1995 AND 1998) OVER (PARTITION BY dataset_id, indicator) AS value FROM y),
ma AS (SELECT *, AVG(value) OVER (PARTITION BY dataset_id, indicator ORDER BY year RANGE BETWEEN 2 PRECEDING AND 1 FOLLOWING) AS ma FROM ch)"""


@query("ensemble_change", f"""WITH {_ENS} SELECT indicator, year, {r('AVG(ma)')} AS mean, {r('MIN(ma)')} AS min, {r('MAX(ma)')} AS max,
{r('quantile_cont(ma, 0.1)')} AS p10, {r('quantile_cont(ma, 0.5)')} AS p50, {r('quantile_cont(ma, 0.9)')} AS p90 FROM ma GROUP BY 1, 2""")
def ensemble_change(spark, d):
    df = X.daily(spark, d).withColumn("dataset_id", F.concat("dataset_id", (F.col("cell_id") % 5).cast("string")))
    out = E.ensemble_change(I.compute_indicators(df, _ENS_DEFS, "skip"), X.REF_PERIOD, smooth_years=4)
    return rounded(out, ["mean", "min", "max", "p10", "p50", "p90"])


_QS = [(2 * i + 1) / 100 for i in range(50)]


def _qq_sql(var: str, where: str) -> str:
    return f"""WITH {DAILY_SQL}, q AS (SELECT dataset_id, quantile_cont({var}, {_QS}) AS v FROM daily WHERE {where} GROUP BY 1),
u AS (SELECT dataset_id, unnest({_QS}) AS q, unnest(v) AS v FROM q)
SELECT CAST(q AS DOUBLE) AS q, {r("MAX(v) FILTER (dataset_id = 'ref')")} AS ref, {r("MAX(v) FILTER (dataset_id = 'sim')")} AS sim FROM u GROUP BY 1"""


@query("qq_tasmax", _qq_sql("tasmax", "TRUE"))
def qq_tasmax(spark, d):
    return rounded(E.qq(X.daily(spark, d), "tasmax", _QS, ["ref", "sim"]), ["ref", "sim"])


@query("qq_pr_wet_days", _qq_sql("pr", "pr >= 1"))
def qq_pr_wet_days(spark, d):
    return rounded(E.qq(X.daily(spark, d), "pr", _QS, ["ref", "sim"], wet_only=True), ["ref", "sim"])


# --- stations: every reference cell is one ------------------------------------------------------------------------------

_PAIRS = f"""{DAILY_SQL}, pairs AS (SELECT a.dataset_id, concat('S', CAST(a.cell_id AS VARCHAR)) AS station_id, a.year, a.month, a.t, a.tasmax AS a, b.tasmax AS b
 FROM daily a JOIN daily b USING (cell_id, t) WHERE a.dataset_id = 'sim' AND b.dataset_id = 'ref')"""


def pairs(spark, d):
    df = X.daily(spark, d)
    name = F.concat(F.lit("S"), F.col("cell_id").cast("string"))
    stations = X.dataset(df, "ref").select(name.alias("station_id"), "t", "tasmax")
    nearest = X.cells(spark, d).select(name.alias("station_id"), "cell_id")
    return E.paired_with_stations(X.dataset(df, "sim"), stations, nearest, "tasmax")


@query("station_annual_cycle", f"""WITH {_PAIRS}, c AS (SELECT dataset_id, station_id, month, AVG(a) AS a, AVG(b) AS b FROM pairs GROUP BY ALL)
SELECT dataset_id, station_id, {r('AVG(pow(a - b, 2))')} AS mse, {r('corr(a, b)')} AS corr FROM c GROUP BY 1, 2""")
def station_annual_cycle(spark, d):
    return rounded(E.annual_cycle_score(pairs(spark, d)), ["mse", "corr"])


@query("station_seasonal_series", f"""WITH {_PAIRS}, c AS (SELECT dataset_id, station_id, {pstart('QS-DEC')} AS start, AVG(a) AS a, AVG(b) AS b FROM pairs GROUP BY ALL)
SELECT dataset_id, station_id, CAST(month(start) AS INT) AS season, {r('AVG(pow(a - b, 2))')} AS mse, {r('corr(a, b)')} AS corr FROM c GROUP BY 1, 2, 3""")
def station_seasonal_series(spark, d):
    return rounded(E.seasonal_series_score(pairs(spark, d)), ["mse", "corr"])


@query("station_quantile_bias", f"""WITH {_PAIRS}, s AS (SELECT dataset_id, station_id, CAST(month({pstart('QS-DEC')}) AS INT) AS season, quantile_cont(a, [0.05, 0.25, 0.5, 0.75, 0.95]) AS qa,
 quantile_cont(b, [0.05, 0.25, 0.5, 0.75, 0.95]) AS qb FROM pairs GROUP BY ALL)
SELECT dataset_id, station_id, season, CAST(unnest([0.05, 0.25, 0.5, 0.75, 0.95]) AS DOUBLE) AS q, {r('unnest(qa) - unnest(qb)')} AS bias FROM s""")
def station_quantile_bias(spark, d):
    return rounded(E.seasonal_quantile_bias(pairs(spark, d)), ["bias"])


@query("valid_stations", """WITH o AS (SELECT CAST(o_custkey % 5 AS BIGINT) AS station_id, CAST(o_orderdate AS DATE) AS date, MAX(o_totalprice) AS v FROM orders GROUP BY 1, 2),
m AS (SELECT station_id, year(date) AS y, month(date) AS m, COUNT(v) AS n, day(last_day(any_value(date))) AS days FROM o GROUP BY 1, 2, 3),
f AS (SELECT station_id, y FROM m WHERE days - n <= 0.4 * days GROUP BY 1, 2 HAVING COUNT(*) = 12)
SELECT station_id, COUNT(*) AS valid_years FROM f GROUP BY 1 HAVING COUNT(*) >= 2""")
def valid_stations(spark, d):
    days = X.read(spark, d, "orders").groupBy(
        (F.col("o_custkey") % 5).alias("station_id"), F.to_date("o_orderdate").alias("date")).agg(F.max("o_totalprice").alias("v"))
    return E.valid_stations(with_standard_calendar(days), "v", years=2, max_missing=0.4)


# --- sinks, written to the shared folder and read back ------------------------------------------------------------------


@query("sink_round_trip", f"WITH {DAILY_SQL} SELECT {', '.join(X.DAILY_COLS[:9])}, {r('CAST(CAST(tasmax AS FLOAT) AS DOUBLE)', 4)} AS tasmax, {r('CAST(CAST(pr AS FLOAT) AS DOUBLE)', 4)} AS pr FROM daily")
def sink_round_trip(spark, d):
    """Written as float32, read as double."""
    path = scratch_dir(spark)
    D.write_table(X.daily(spark, d), path)
    return rounded(D.read_daily(spark, path, variables=("tasmax", "pr")), ["tasmax", "pr"], 4)


@query("sink_skip_done", f"WITH {DAILY_SQL} SELECT dataset_id, 'pr' AS var, COUNT(*) AS n, {r('SUM(pr)', 3)} AS total FROM daily GROUP BY 1")
def sink_skip_done(spark, d):
    """The second write adds only the dataset that is not there yet."""
    path = scratch_dir(spark)
    rows = X.daily(spark, d).select("dataset_id", F.lit("pr").alias("var"), "cell_id", "t", "pr")
    D.write_if_absent(X.dataset(rows, "ref"), path)
    D.write_if_absent(rows, path)
    out = spark.read.parquet(path).groupBy("dataset_id", "var").agg(F.count(F.lit(1)).alias("n"), F.sum("pr").alias("total"))
    return rounded(out, ["total"], 3)


@query("sink_slices", f"""WITH {DAILY_SQL}, ind AS ({_folded_sql(_ENS_DEFS)}) SELECT dataset_id, indicator, CAST(year(period_start) AS INT) AS period_year, COUNT(*) AS n,
{r("SUM(value) + CASE WHEN indicator = 'prcptot_annual' THEN COUNT(value) ELSE 0 END", 4)} AS total FROM ind GROUP BY 1, 2, 3""")
def sink_slices(spark, d):
    """Slices written twice stay single; one indicator is then replaced."""
    path = scratch_dir(spark)
    ind = I.compute_indicators(X.daily(spark, d), _ENS_DEFS, "skip")
    early = F.year("period_start") <= 1998
    for part in (ind.where(early), ind.where(~early), ind.where(early)):
        D.append_slices(part, path)
    fixed = spark.read.parquet(path).where("indicator = 'prcptot_annual'").withColumn("value", F.col("value") + 1)
    again = scratch_dir(spark)
    spark.read.parquet(path).write.partitionBy("dataset_id", "indicator").parquet(again)
    D.replace_partition(fixed, again, "indicator", "prcptot_annual")
    out = spark.read.parquet(again).groupBy("dataset_id", "indicator", "period_year").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))
    return rounded(out, ["total"], 4)


@query("sink_final_layout", f"""WITH {DAILY_SQL} SELECT dataset_id, CAST(year - year % 4 AS INT) AS year4, COUNT(*) AS n, COUNT(DISTINCT cell_id) AS cells FROM daily GROUP BY 1, 2""")
def sink_final_layout(spark, d):
    """S10."""
    path = scratch_dir(spark)
    D.write_final(X.daily(spark, d), X.cells(spark, d), path)
    return spark.read.parquet(path).groupBy("dataset_id", "year4").agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("cell_id").alias("cells"))
