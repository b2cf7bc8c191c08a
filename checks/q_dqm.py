"""Detrended quantile mapping.  The SQL explodes every day to the 31 windows it belongs to and ranks rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from graticule.functions.quantiles import one_of_sorted_array
from graticule.operators import quantile_map as B

from . import fixtures as X
from .fixtures import NOLEAP_SQL
from .registry import query, r, rounded

CONF = B.Conf(B.STANDARD_VARIABLES, X.REF_PERIOD, X.TARGET, loess_f=0.6)
_VARS = ("tasmax", "dtr", "pr")
_LEVELS = "[" + ", ".join(str((2 * i + 1) / 100) for i in range(50)) + "]"


def _mix(x: str) -> str:
    return (f"list_transform(list_transform([(({x}) * 1103515245 + 12345) % 2147483647], "
            "lambda y: (xor(y, y >> 15) * 950706376) % 2147483647), lambda z: xor(z, z >> 13))[1]")


def _uniform(a: str, b: str, seed: str, i: str | None = None) -> str:
    """``functions.randoms.uniform`` in SQL."""
    state = f"CAST({seed} AS BIGINT)"
    for key in (a, b) if i is None else (a, b, i):
        state = _mix(f"({_mix(state)} + CAST({key} AS BIGINT)) % 2147483647")
    return f"({state} + 1) / 2147483649e0"


SERIES_SQL = NOLEAP_SQL + ", wide AS (SELECT *, tasmax - tasmin AS dtr FROM nl),\nseries AS MATERIALIZED (" + " UNION ALL ".join(
    f"SELECT dataset_id, cell_id, '{v}' AS var, '{B.STANDARD_VARIABLES[v].kind}' AS kind, year, doy, t, {v} AS x FROM wide" for v in _VARS
) + ")"

WINDOW_SQL = SERIES_SQL + f""",
jit AS (SELECT * REPLACE (CASE WHEN var = 'pr' AND x < 0.01e0
          THEN 0.01e0 * {_uniform('cell_id', 't', "(CASE WHEN dataset_id = 'ref' THEN 42 ELSE 43 END)")} ELSE x END AS x)
        FROM series WHERE year BETWEEN 1995 AND 1998),
win AS (SELECT dataset_id, cell_id, var, kind, CAST((t + k) % 365 + 1 AS INT) AS doy, x
        FROM jit CROSS JOIN (SELECT unnest(range(-15, 16)) AS k) WHERE (t + k) // 365 BETWEEN 1995 AND 1998)"""

TRAIN_SQL = WINDOW_SQL + f""",
rstat AS (SELECT cell_id, var, doy, COUNT(*) AS nr, COUNT(*) FILTER (x < 1) AS dr, list_sort(list(x)) AS ra
          FROM win WHERE dataset_id = 'ref' GROUP BY ALL),
hrank AS (SELECT *, row_number() OVER w AS rn, COUNT(*) OVER g AS nh, COUNT(*) FILTER (x < 1) OVER g AS dh
          FROM win WHERE dataset_id = 'sim'
          WINDOW w AS (PARTITION BY cell_id, var, doy ORDER BY x), g AS (PARTITION BY cell_id, var, doy)),
hx AS (SELECT h.*, nr, dr, CASE WHEN var = 'pr' THEN greatest(0, CAST(floor((dh * nr - dr * nh) / nr) AS INT)) ELSE 0 END AS extra,
              ra, dh / nh * (nr - 1) AS pos FROM hrank h JOIN rstat USING (cell_id, var, doy)),
ht AS (SELECT *, greatest(1e0, ra[CAST(floor(pos) AS INT) + 1] + (pos - floor(pos)) *
         (ra[CAST(least(floor(pos) + 1, nr - 1) AS INT) + 1] - ra[CAST(floor(pos) AS INT) + 1])) AS top FROM hx),
hist AS (SELECT dataset_id, cell_id, var, kind, doy,
                CASE WHEN rn > dh - extra AND rn <= dh
                     THEN 1e0 + {_uniform('cell_id', 'doy', '44', 'rn - (dh - extra)')} * (top - 1e0) ELSE x END AS x FROM ht),
hm AS (SELECT *, AVG(x) OVER (PARTITION BY cell_id, var, doy) AS m FROM hist),
rm AS (SELECT *, AVG(x) OVER (PARTITION BY cell_id, var, doy) AS m FROM win WHERE dataset_id = 'ref'),
hq AS (SELECT dataset_id, cell_id, var, kind, doy, any_value(m) AS m, quantile_cont(CASE WHEN kind = '+' THEN x - m ELSE x / m END, {_LEVELS}) AS q
       FROM hm GROUP BY ALL),
rq AS (SELECT cell_id, var, doy, any_value(m) AS m, quantile_cont(CASE WHEN kind = '+' THEN x - m ELSE x / m END, {_LEVELS}) AS q
       FROM rm GROUP BY ALL),
training AS (SELECT dataset_id, cell_id, hq.doy, var, kind, hq.q AS hist_q,
       list_transform(range(1, 51), lambda i: CASE WHEN kind = '+' THEN rq.q[i] - hq.q[i] ELSE rq.q[i] / nullif(hq.q[i], 0) END) AS af,
       CASE WHEN kind = '+' THEN rq.m - hq.m ELSE rq.m / nullif(hq.m, 0) END AS scaling
       FROM hq JOIN rq USING (cell_id, var, doy))"""


@query("doy_windows", "WITH " + WINDOW_SQL + f"""
SELECT dataset_id, cell_id, var, doy, COUNT(*) AS n, {r('AVG(x)', 6)} AS mean, {r('MIN(x)', 6)} AS lowest, {r('MAX(x)', 6)} AS highest,
       {r('quantile_cont(x, 0.5)', 6)} AS median FROM win GROUP BY 1, 2, 3, 4""")
def doy_windows(spark, d):
    """B1-B2: window samples after the jitter, summarised per (series, day of year)."""
    nl = X.noleap(spark, d)
    out = None
    for name, seed in (("ref", 42), ("sim", 43)):
        series = B.jitter_under(B.to_series(X.dataset(nl, name), list(CONF.variables)), CONF, seed)
        a = B.doy_window_arrays(series, X.REF_PERIOD)
        a = a.select("dataset_id", "cell_id", "var", "doy", F.size("arr").cast("bigint").alias("n"), "mean",
                     F.get("arr", F.lit(0)).alias("lowest"), F.element_at("arr", -1).alias("highest"),
                     one_of_sorted_array(F.col("arr"), F.lit(0.5)).alias("median"))
        out = a if out is None else out.unionByName(a)
    return rounded(out, ["mean", "lowest", "highest", "median"], 6)


@query("dqm_train", "WITH " + TRAIN_SQL + f"""
SELECT dataset_id, cell_id, doy, var, kind, {r('scaling')} AS scaling, {r('af[1]', 5)} AS af_first, {r('af[25]', 5)} AS af_mid, {r('af[50]', 5)} AS af_last,
       {r('list_sum(list_transform(range(1, 51), lambda i: af[i] * i))', 4)} AS af_moment,
       {r('list_sum(list_transform(range(1, 51), lambda i: hist_q[i] * i))', 4)} AS q_moment FROM training""")
def dqm_train(spark, d):
    """Factors of all three variables in one plan; the 50 values are folded to three of them and two moments."""
    nl = X.noleap(spark, d)
    tr = B.train(X.dataset(nl, "ref"), X.dataset(nl, "sim"), CONF)

    def moment(col):
        return F.aggregate(F.transform(col, lambda v, i: v * (i + 1)), F.lit(0.0), lambda a, v: a + v)

    out = tr.select(
        "dataset_id", "cell_id", "doy", "var", "kind", "scaling",
        F.get("af", F.lit(0)).alias("af_first"), F.get("af", F.lit(24)).alias("af_mid"), F.get("af", F.lit(49)).alias("af_last"),
        moment("af").alias("af_moment"), moment("hist_q").alias("q_moment"),
    )
    return rounded(rounded(rounded(out, ["scaling"]), ["af_first", "af_mid", "af_last"], 5), ["af_moment", "q_moment"], 4)


@query("factors_rows", "WITH " + TRAIN_SQL + f"""
SELECT var, kind, CAST(i AS INT) AS i, COUNT(*) AS n, {r('AVG(af[i])')} AS af, {r('AVG(hist_q[i])')} AS hist_q
FROM training CROSS JOIN (SELECT unnest(range(1, 51)) AS i) GROUP BY 1, 2, 3""")
def factors_rows(spark, d):
    """Every one of the 50 factors, averaged over cells and days of the year."""
    nl = X.noleap(spark, d)
    tr = B.train(X.dataset(nl, "ref"), X.dataset(nl, "sim"), CONF)
    rows = tr.select("var", "kind", F.posexplode(F.arrays_zip("af", "hist_q")).alias("i", "_z"))
    out = rows.groupBy("var", "kind", (F.col("i") + 1).alias("i")).agg(
        F.count(F.lit(1)).alias("n"), F.avg("_z.af").alias("af"), F.avg("_z.hist_q").alias("hist_q"))
    return rounded(out, ["af", "hist_q"])


LOESS_SQL = """,
sims AS MATERIALIZED (SELECT *, AVG(x) OVER (PARTITION BY cell_id, var ORDER BY t RANGE BETWEEN 15 PRECEDING AND 15 FOLLOWING) AS m
         FROM series WHERE dataset_id = 'sim'),
years AS (SELECT unnest(range(1995, 2002)) AS y),
dist AS (SELECT a.y AS yi, b.y AS yj, abs(a.y - b.y) AS d FROM years a CROSS JOIN years b),
width AS (SELECT yi, d AS h FROM (SELECT *, row_number() OVER (PARTITION BY yi ORDER BY d) AS rn FROM dist) WHERE rn = 5),
wts AS (SELECT yi, yj, pow(1 - pow(CAST(d AS DOUBLE) / h, 3), 3) AS w FROM dist JOIN width USING (yi) WHERE d < h),
trend AS (SELECT s.cell_id, s.var, s.doy, yi AS year, SUM(w * m) / SUM(w) AS trend FROM sims s JOIN wts ON s.year = yj GROUP BY ALL),
withtrend AS (SELECT sims.*, trend FROM sims JOIN trend USING (cell_id, var, doy, year))"""


@query("loess_trend", "WITH " + SERIES_SQL + LOESS_SQL + f"""
SELECT dataset_id, cell_id, var, year, doy, t, {r('m', 6)} AS m, {r('trend', 6)} AS trend FROM withtrend""")
def loess_trend(spark, d):
    """B9-B10."""
    out = B.loess_trend(X.dataset(X.noleap(spark, d), "sim"), CONF)
    return rounded(out.select("dataset_id", "cell_id", "var", "year", "doy", "t", "m", "trend"), ["m", "trend"], 6)


ADJUST_SQL = TRAIN_SQL + LOESS_SQL + """,
res AS (SELECT withtrend.*, CASE WHEN withtrend.kind = '+' THEN x - trend ELSE x / nullif(trend, 0) END AS res, hist_q, af, scaling
        FROM withtrend LEFT JOIN training USING (dataset_id, cell_id, doy, var)),
near AS (SELECT *, list_transform(hist_q, lambda h: abs(res - h)) AS gap FROM res),
adj AS (SELECT dataset_id, cell_id, var, year, doy, t, CASE WHEN kind = '+'
          THEN trend + scaling + res + af[list_position(gap, list_min(gap))]
          ELSE trend * scaling * res * af[list_position(gap, list_min(gap))] END AS y FROM near),
scenario AS (SELECT dataset_id, cell_id, year, doy, t, MAX(y) FILTER (var = 'tasmax') AS tasmax,
               MAX(y) FILTER (var = 'dtr') AS dtr, MAX(y) FILTER (var = 'pr') AS pr FROM adj GROUP BY ALL),
dated2 AS (SELECT *, DATE '2001-01-01' + (doy - 1) AS d0 FROM scenario)"""


@query("dqm_adjust", "WITH " + ADJUST_SQL + f"""
SELECT dataset_id, 'noleap' AS calendar, cell_id, year, CAST(month(d0) AS INT) AS month, CAST(day(d0) AS INT) AS day, doy, t,
       make_date(year, month(d0), day(d0)) AS date, {r('tasmax', 5)} AS tasmax, {r('tasmax - dtr', 5)} AS tasmin, {r('pr', 5)} AS pr FROM dated2""")
def dqm_adjust(spark, d):
    """The scenario, all three variables."""
    nl = X.noleap(spark, d)
    training = B.train(X.dataset(nl, "ref"), X.dataset(nl, "sim"), CONF)
    out = B.adjust(training, X.dataset(nl, "sim"), CONF)
    return rounded(out.select(*X.DAILY_COLS), ["tasmax", "tasmin", "pr"], 5)


@query("dqm_check_physical", "WITH " + ADJUST_SQL + """
SELECT dataset_id, COUNT(*) FILTER (tasmax - dtr > tasmax) AS tasmin_over_tasmax, COUNT(*) FILTER (pr < 0) AS negative_pr
FROM scenario GROUP BY 1""")
def dqm_check_physical(spark, d):
    """B17."""
    nl = X.noleap(spark, d)
    training = B.train(X.dataset(nl, "ref"), X.dataset(nl, "sim"), CONF)
    return B.check_physical(B.adjust(training, X.dataset(nl, "sim"), CONF))


@query("dqm_monthly_mean", "WITH " + ADJUST_SQL + f"""
SELECT dataset_id, cell_id, make_date(year, month(d0), 1) AS period_start, {r('AVG(tasmax)', 5)} AS tx, {r('SUM(pr)', 5)} AS total
FROM dated2 GROUP BY 1, 2, 3""")
def dqm_monthly_mean(spark, d):
    from graticule.operators.properties import resample
    nl = X.noleap(spark, d)
    training = B.train(X.dataset(nl, "ref"), X.dataset(nl, "sim"), CONF)
    scen = B.adjust(training, X.dataset(nl, "sim"), CONF)
    return rounded(resample(scen, "MS", {"tx": ("mean", "tasmax"), "total": ("sum", "pr")}), ["tx", "total"], 5)
