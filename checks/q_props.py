"""Properties, measures, check-up, regridding, spatial properties."""

from __future__ import annotations

from pyspark.sql import functions as F

from graticule.functions import quantiles as Q
from graticule.operators import properties as M, regrid as G, selection as S, spatial as Z, spells as V
from graticule.operators.definitions import standard_properties

from . import fixtures as X
from .fixtures import CELLS_SQL, DAILY_SQL, SCEN_SQL
from .registry import pstart, query, r, rounded

PROPS = standard_properties()
CELLWISE = [d for d in PROPS if d.base not in ("first_eof", "spatial_correlogram")]
PERIOD = "year BETWEEN 1995 AND 1998"


def _tidy(name: str, value: str, source: str, month: str = "CAST(NULL AS INT)", where: str = "TRUE") -> str:
    return (f"SELECT dataset_id, '{name}' AS property, cell_id, {month} AS month, CAST(NULL AS INT) AS bin, {value} AS value "
            f"FROM {source} WHERE {where} GROUP BY ALL")


def _rank(var: str, part: str) -> str:
    return f"rank() OVER (PARTITION BY {part} ORDER BY {var}) + (COUNT(*) OVER (PARTITION BY {part}, {var}) - 1) / 2e0"


def _prop_sql(d, src: str) -> str:
    p = d.params
    v = p.get("da")
    if d.base == "mean":
        return _tidy(d.name, f"AVG({v})", src, "month")
    if d.base == "quantile":
        return _tidy(d.name, f"quantile_cont({v}, {p['q']})", src)
    if d.base == "relative_frequency":
        return _tidy(d.name, f"AVG(CASE WHEN {v} < 1 THEN 1e0 ELSE 0e0 END)", src)
    if d.base == "annual_cycle_amplitude":
        return _tidy(d.name, "AVG(a)", f"(SELECT dataset_id, cell_id, year, MAX({v}) - MIN({v}) AS a FROM {src} GROUP BY ALL)")
    if d.base == "relative_annual_cycle_amplitude":
        return _tidy(d.name, "AVG(a)", f"(SELECT dataset_id, cell_id, year, 100 * (MAX({v}) - MIN({v})) / nullif(AVG({v}), 0) AS a FROM {src} GROUP BY ALL)")
    if d.base == "acf":
        return _tidy(d.name, "AVG(r)", f"""(SELECT dataset_id, cell_id, year, month,
            CASE WHEN COUNT(nx) > 0 THEN SUM(({v} - m) * (nx - m)) / nullif(any_value(ss), 0) END AS r
            FROM (SELECT *, SUM(pow({v} - m, 2)) OVER (PARTITION BY dataset_id, cell_id, year, month) AS ss FROM
              (SELECT *, AVG({v}) OVER (PARTITION BY dataset_id, cell_id, year, month) AS m,
                CASE WHEN lead(t) OVER w = t + 1 THEN lead({v}) OVER w END AS nx FROM {src}
                WINDOW w AS (PARTITION BY dataset_id, cell_id, year, month ORDER BY t))) GROUP BY ALL)""", "month")
    a, b = p["da1"], p["da2"]
    return _tidy(d.name, "corr(ra, rb)", f"(SELECT dataset_id, cell_id, {_rank(a, 'dataset_id, cell_id')} AS ra, {_rank(b, 'dataset_id, cell_id')} AS rb FROM {src})")


def _props_sql(defs, src) -> str:
    return " UNION ALL ".join(_prop_sql(d, src) for d in defs)


_OUT = f"dataset_id, property, cell_id, month, bin, {r('value')} AS value"


def _register(name, defs):
    @query(name, f"WITH {DAILY_SQL}, src AS (SELECT * FROM daily WHERE {PERIOD}), p AS ({_props_sql(defs, 'src')}) SELECT {_OUT} FROM p")
    def run(spark, sf_dir):
        return rounded(M.compute_properties(X.daily(spark, sf_dir), defs, X.REF_PERIOD), ["value"])


def _of(*bases):
    return [d for d in CELLWISE if d.base in bases]


_register("prop_mean", _of("mean"))
_register("prop_quantiles", _of("quantile"))
_register("prop_dry_freq", _of("relative_frequency"))
_register("prop_aca", _of("annual_cycle_amplitude", "relative_annual_cycle_amplitude"))
_register("prop_lag1", _of("acf"))
_register("prop_spearman", _of("corr_btw_var"))
_register("prop_all", CELLWISE)


_ACF = _of("acf")[0]


@query("lag_autocorrelation", f"WITH {DAILY_SQL}, p AS ({_prop_sql(_ACF, 'daily')}) SELECT dataset_id, cell_id, month, {r('value')} AS value FROM p")
def lag_autocorrelation(spark, d):
    return rounded(M.lag_autocorrelation(X.daily(spark, d), "tasmax"), ["value"])


@query("annual_cycle_relative", f"WITH {DAILY_SQL}, p AS ({_prop_sql(_of('relative_annual_cycle_amplitude')[0], 'daily')}) SELECT dataset_id, cell_id, {r('value')} AS value FROM p")
def annual_cycle_relative(spark, d):
    return rounded(M.annual_cycle_amplitude(X.daily(spark, d), "pr", relative=True), ["value"])


@query("spearman", f"WITH {DAILY_SQL}, p AS ({_prop_sql(_of('corr_btw_var')[1], 'daily')}) SELECT dataset_id, cell_id, {r('value')} AS value FROM p")
def spearman(spark, d):
    return rounded(V.spearman(X.daily(spark, d), "tasmax", "pr"), ["value"])


@query("rel_freq_q99", f"""WITH {DAILY_SQL}, thr AS (SELECT cell_id, quantile_cont(pr, 0.99) AS q FROM daily WHERE dataset_id = 'ref' AND {PERIOD} GROUP BY 1)
SELECT dataset_id, cell_id, {r('AVG(CASE WHEN pr >= q THEN 1e0 ELSE 0e0 END)')} AS value FROM daily JOIN thr USING (cell_id) GROUP BY 1, 2""")
def rel_freq_q99(spark, d):
    df = X.daily(spark, d)
    thr = S.in_period(X.dataset(df, "ref"), *X.REF_PERIOD).groupBy("cell_id").agg(F.percentile("pr", F.lit(0.99)).alias("q"))
    return rounded(M.relative_frequency(S.with_cell_threshold(df, thr), "pr", ">=", F.col("q")), ["value"])


@query("cell_quantiles", f"""WITH {DAILY_SQL}, q AS (SELECT dataset_id, cell_id, quantile_cont(pr, [0.9, 0.99]) AS v FROM daily GROUP BY ALL)
SELECT dataset_id, cell_id, 0.9e0 AS q, {r('v[1]')} AS value FROM q UNION ALL SELECT dataset_id, cell_id, 0.99e0, {r('v[2]')} FROM q""")
def cell_quantiles(spark, d):
    return rounded(Q.per_group(X.daily(spark, d), ["dataset_id", "cell_id"], "pr", [0.9, 0.99]), ["value"])


@query("nan_count", f"""WITH {DAILY_SQL}, n AS (SELECT dataset_id, MAX(t) - MIN(t) + 1 AS days FROM daily GROUP BY 1)
SELECT dataset_id, cell_id, {r('(3 * any_value(days) - COUNT(tasmax) - COUNT(tasmin) - COUNT(pr)) / 3e0')} AS value FROM daily JOIN n USING (dataset_id) GROUP BY 1, 2""")
def nan_count(spark, d):
    df = X.daily(spark, d)
    return rounded(M.nan_count(df, M.days_expected(df)), ["value"])


@query("nan_count_all_cells", f"""WITH {DAILY_SQL}, n AS (SELECT dataset_id, MAX(t) - MIN(t) + 1 AS days FROM daily GROUP BY 1),
c AS (SELECT CAST(s_suppkey AS INT) AS cell_id FROM supplier),
k AS (SELECT dataset_id, cell_id, COUNT(tasmax) + COUNT(tasmin) + COUNT(pr) AS k FROM daily GROUP BY 1, 2)
SELECT dataset_id, cell_id, {r('(3 * days - coalesce(k, 0)) / 3e0')} AS value FROM c CROSS JOIN n LEFT JOIN k USING (dataset_id, cell_id)""")
def nan_count_all_cells(spark, d):
    """A2: cells of the cell table without a single day count as missing on every day."""
    df = X.daily(spark, d)
    cells = X.read(spark, d, "supplier").select(F.col("s_suppkey").cast("int").alias("cell_id"))
    return rounded(M.nan_count(df, M.days_expected(df), cells=cells), ["value"])


_MONTHLY = f"""m AS (SELECT dataset_id, cell_id, {pstart('MS')} AS period_start, AVG(tasmax) AS tx, AVG(tasmin) AS tn, SUM(pr) AS pt FROM daily WHERE {PERIOD} GROUP BY ALL)"""
_RMSE = """rm AS (SELECT s.dataset_id, s.cell_id, sqrt(AVG(pow(s.tx - f.tx, 2))) AS tx, sqrt(AVG(pow(s.tn - f.tn, 2))) AS tn, sqrt(AVG(pow(s.pt - f.pt, 2))) AS pt
FROM m s JOIN m f USING (cell_id, period_start) WHERE s.dataset_id = 'sim' AND f.dataset_id = 'ref' GROUP BY 1, 2)"""


@query("rmse_monthly", f"""WITH {DAILY_SQL}, {_MONTHLY}, {_RMSE}
SELECT dataset_id, cell_id, {r('tx')} AS tx_mean_rmse, {r('tn')} AS tn_mean_rmse, {r('pt')} AS prcptot_rmse FROM rm""")
def rmse_monthly(spark, d):
    df = S.in_period(X.daily(spark, d), *X.REF_PERIOD)
    ref = M.resample(X.dataset(df, "ref"), "MS", M.MONTHLY).drop("dataset_id")
    out = M.rmse(M.resample(X.dataset(df, "sim"), "MS", M.MONTHLY), ref, list(M.MONTHLY), ["cell_id", "period_start"], M.K)
    return rounded(out, list(M.MONTHLY))


_CHECK = f"""thr AS (SELECT cell_id, quantile_cont(pr, 0.99) AS q FROM daily WHERE dataset_id = 'ref' AND {PERIOD} GROUP BY 1),
f AS (SELECT dataset_id, cell_id, AVG(CASE WHEN pr >= q THEN 1e0 ELSE 0e0 END) FILTER ({PERIOD}) AS h,
       AVG(CASE WHEN pr >= q THEN 1e0 ELSE 0e0 END) FILTER (year BETWEEN 1999 AND 2001) AS u FROM daily JOIN thr USING (cell_id) WHERE dataset_id = 'sim' GROUP BY 1, 2),
days AS (SELECT MAX(t) - MIN(t) + 1 AS days FROM daily WHERE dataset_id = 'sim'),
nn AS (SELECT cell_id, (3 * any_value(days) - COUNT(tasmax) - COUNT(tasmin) - COUNT(pr)) / 3e0 AS nan_count FROM daily, days WHERE dataset_id = 'sim' GROUP BY 1)"""


@query("checkup", f"""WITH {DAILY_SQL}, {_CHECK}, {_MONTHLY}, {_RMSE}
SELECT dataset_id, cell_id, {r('h')} AS pr_wet_freq_q99_hist, {r('u')} AS pr_wet_freq_q99_fut, {r('nan_count')} AS nan_count,
       {r('tx')} AS tx_mean_rmse, {r('tn')} AS tn_mean_rmse, {r('pt')} AS prcptot_rmse FROM f JOIN nn USING (cell_id) JOIN rm USING (dataset_id, cell_id)""")
def checkup(spark, d):
    df = X.daily(spark, d)
    out = M.checkup(X.dataset(df, "sim"), X.dataset(df, "ref"), X.REF_PERIOD, X.FUT_PERIOD)
    return rounded(out, [c for c in out.columns if c not in M.K])


@query("compare_hist_future", f"""WITH {DAILY_SQL}, {_CHECK}
SELECT cell_id, {r('h - u')} AS difference, {r('abs(h - u)')} AS distance, {r('abs(h) - abs(u)')} AS improvement FROM f""")
def compare_hist_future(spark, d):
    df = X.daily(spark, d)
    c = M.checkup(X.dataset(df, "sim"), X.dataset(df, "ref"), X.REF_PERIOD, X.FUT_PERIOD)
    a = c.select("cell_id", F.col("pr_wet_freq_q99_hist").alias("v"))
    b = c.select("cell_id", F.col("pr_wet_freq_q99_fut").alias("v"))
    out = None
    for op in ("difference", "distance", "improvement"):
        m = M.compare_maps(a, b, "v", op)
        out = m if out is None else out.join(m, "cell_id")
    return rounded(out, ["difference", "distance", "improvement"])


@query("symmetric_range", f"""WITH {DAILY_SQL}, b AS (SELECT dataset_id, quantile_cont(tasmax - 280, [0.05, 0.95]) AS q FROM daily GROUP BY 1)
SELECT {r('least(MIN(q[1]), -MAX(q[2]))')} AS vmin, {r('-least(MIN(q[1]), -MAX(q[2]))')} AS vmax FROM b""")
def symmetric_range(spark, d):
    df = X.daily(spark, d).withColumn("v", F.col("tasmax") - 280)
    return rounded(M.symmetric_range(X.dataset(df, "sim"), X.dataset(df, "ref"), "v"), ["vmin", "vmax"])


@query("summary", f"WITH {DAILY_SQL} SELECT {r('MAX(pr)')} AS max, COUNT(*) AS n FROM daily")
def summary(spark, d):
    return rounded(M.summary(X.daily(spark, d), "pr"), ["max"])


def measures_sql(defs) -> str:
    return f"""{DAILY_SQL}{SCEN_SQL}, src AS MATERIALIZED (SELECT * FROM daily WHERE {PERIOD} UNION ALL SELECT * FROM scen WHERE {PERIOD}), p AS MATERIALIZED ({_props_sql(defs, 'src')}),
meas AS (SELECT a.dataset_id, a.property, a.cell_id, a.month, a.bin,
  CASE WHEN a.property = 'aca_pr' THEN a.value / nullif(b.value, 0) ELSE a.value - b.value END AS value
  FROM p a JOIN p b ON a.property = b.property AND a.cell_id = b.cell_id AND a.month IS NOT DISTINCT FROM b.month
  WHERE a.dataset_id <> 'ref' AND b.dataset_id = 'ref')"""


def all_measures(spark, d, defs):
    df = X.daily(spark, d)
    props = M.compute_properties(df.unionByName(X.scen(df)), defs, X.REF_PERIOD)
    return M.measures(props.where("dataset_id <> 'ref'"), X.dataset(props, "ref"))


@query("measures_bias", f"WITH {measures_sql(CELLWISE)} SELECT {_OUT} FROM meas")
def measures_bias(spark, d):
    return rounded(all_measures(spark, d, CELLWISE), ["value"])


@query("average_rank", f"WITH {DAILY_SQL} SELECT dataset_id, cell_id, t, {r(_rank('pr', 'dataset_id, cell_id'))} AS pr_rank FROM daily")
def average_rank(spark, d):
    out = V.average_rank(X.daily(spark, d).select("dataset_id", "cell_id", "t", "pr"), "pr")
    return rounded(out.select("dataset_id", "cell_id", "t", "pr_rank"), ["pr_rank"])


# --- regridding: the source is a strip of all cells, five wide and as long as the table needs; every supplier is a target,
# --- some of them outside

_TARGET_LAT = "44.041e0 + CAST(s_suppkey * 7919 % 10007 AS DOUBLE) / 9.8e3 * (rows * 0.1e0)"
_TARGET_LON = "-75.007e0 + CAST(s_suppkey * 53 % 211 AS DOUBLE) / 5e2"
_ROWS_SQL = X.duck(f"(SELECT MAX({X._CELL.replace('l_suppkey', 's_suppkey')}) div 5 + 1 AS rows FROM supplier)")
_TARGETS_SQL = f"targets AS (SELECT CAST(s_suppkey AS INT) AS cell_id, {_TARGET_LAT} AS lat, {_TARGET_LON} AS lon, rows FROM supplier, {_ROWS_SQL})"
_WEIGHTS_SQL = _TARGETS_SQL + """,
pos AS (SELECT cell_id AS dst_cell, rows, (lon - -75e0) / 0.1e0 AS px, (lat - 44.05e0) / 0.1e0 AS py FROM targets),
low AS (SELECT *, CAST(least(floor(px), 3) AS INT) AS i, CAST(least(floor(py), rows - 2) AS INT) AS j FROM pos),
frac AS (SELECT *, px - i AS fx, py - j AS fy FROM low),
corner(di, dj) AS (VALUES (0, 0), (1, 0), (0, 1), (1, 1)),
weights AS (SELECT CAST((j + dj) * 5 + i + di AS INT) AS src_cell, dst_cell,
   (CASE WHEN di = 1 THEN fx ELSE 1 - fx END) * (CASE WHEN dj = 1 THEN fy ELSE 1 - fy END) AS w
   FROM frac CROSS JOIN corner WHERE i >= 0 AND j >= 0 AND fx BETWEEN 0 AND 1 AND fy BETWEEN 0 AND 1
   UNION ALL SELECT -1, dst_cell, NULL FROM frac WHERE NOT (i >= 0 AND j >= 0 AND fx BETWEEN 0 AND 1 AND fy BETWEEN 0 AND 1))"""
_REGRID_SQL = """days AS (SELECT DISTINCT dataset_id, t FROM daily),
mapped AS (SELECT dataset_id, dst_cell, t, w, tasmax, pr FROM daily JOIN weights ON src_cell = daily.cell_id
  UNION ALL SELECT dataset_id, dst_cell, t, NULL, NULL, NULL FROM days CROSS JOIN weights WHERE src_cell = -1)"""


def axes(spark, d) -> G.Axes:
    rows = X.read(spark, d, "supplier").agg(F.expr(f"MAX({X._CELL.replace('l_suppkey', 's_suppkey')}) div 5 + 1")).first()[0]
    return G.Axes(-75.0, 0.1, 5, 44.05, 0.1, int(rows))


def targets(spark, d):
    return X.read(spark, d, "supplier").withColumn("rows", F.lit(axes(spark, d).ny)).select(
        F.expr("CAST(s_suppkey AS INT)").alias("cell_id"), F.expr(_TARGET_LAT).alias("lat"), F.expr(_TARGET_LON).alias("lon"))


@query("bilinear_weights", f"WITH {_WEIGHTS_SQL} SELECT src_cell, dst_cell, {r('w')} AS w FROM weights")
def bilinear_weights(spark, d):
    return rounded(G.bilinear_weights(axes(spark, d), targets(spark, d)), ["w"])


@query("regrid_bilinear", f"""WITH {DAILY_SQL}, {_WEIGHTS_SQL}, {_REGRID_SQL}
SELECT dataset_id, dst_cell AS cell_id, t, {r('CASE WHEN COUNT(tasmax) = 4 THEN SUM(w * tasmax) END')} AS tasmax, {r('CASE WHEN COUNT(pr) = 4 THEN SUM(w * pr) END')} AS pr
FROM mapped GROUP BY 1, 2, 3""")
def regrid_bilinear(spark, d):
    out = G.regrid(X.daily(spark, d), G.bilinear_weights(axes(spark, d), targets(spark, d)), ["tasmax", "pr"])
    return rounded(out.select("dataset_id", "cell_id", "t", "tasmax", "pr"), ["tasmax", "pr"])


@query("regrid_unmapped", f"""WITH {DAILY_SQL}, {_WEIGHTS_SQL}, {_REGRID_SQL}
SELECT dataset_id, dst_cell AS cell_id, COUNT(*) AS n FROM mapped WHERE w IS NULL GROUP BY 1, 2""")
def regrid_unmapped(spark, d):
    """Targets outside the source have a NULL on every day of a dataset."""
    weights = G.bilinear_weights(axes(spark, d), targets(spark, d))
    outside = weights.where(F.col("src_cell") == G.NOWHERE).select(F.col("dst_cell").alias("cell_id"))
    out = G.regrid(X.daily(spark, d), weights, ["tasmax"]).join(outside, "cell_id", "left_semi")
    return out.where("tasmax IS NULL").groupBy("dataset_id", "cell_id").agg(F.count(F.lit(1)).alias("n"))


@query("regrid_renormalised", f"""WITH {DAILY_SQL}, {_WEIGHTS_SQL}, {_REGRID_SQL}
SELECT dataset_id, dst_cell AS cell_id, t, {r('SUM(w * tasmax) / nullif(SUM(w), 0)')} AS tasmax
FROM mapped GROUP BY 1, 2, 3""")
def regrid_renormalised(spark, d):
    """Without ``unmapped_to_null`` the present corners share the weight."""
    out = G.regrid(X.daily(spark, d), G.bilinear_weights(axes(spark, d), targets(spark, d)), ["tasmax"], unmapped_to_null=False)
    return rounded(out.select("dataset_id", "cell_id", "t", "tasmax"), ["tasmax"])


# --- spatial ----------------------------------------------------------------------------------------------------------

_DIST = ("12742e0 * asin(sqrt(least(1e0, pow(sin(radians(cb.lat - ca.lat) / 2), 2) + cos(radians(ca.lat)) * cos(radians(cb.lat))"
         " * pow(sin(radians(cb.lon - ca.lon) / 2), 2))))")
_BOX = """box AS (SELECT MIN(lat) AS s, MAX(lat) AS n, MIN(lon) AS w, MAX(lon) AS e FROM cells),
span AS (SELECT greatest(
 12742e0 * asin(sqrt(pow(sin(radians(n - s) / 2), 2) + cos(radians(s)) * cos(radians(n)) * pow(sin(radians(e - w) / 2), 2))),
 12742e0 * asin(sqrt(pow(cos(radians(s)), 2) * pow(sin(radians(e - w) / 2), 2))),
 12742e0 * asin(sqrt(pow(cos(radians(n)), 2) * pow(sin(radians(e - w) / 2), 2)))) AS max_km FROM box)"""


def _correlogram_sql(var: str, bins: int = 99) -> str:
    return f"""{DAILY_SQL}, {CELLS_SQL}, {_BOX},
rk AS (SELECT dataset_id, cell_id, t, {_rank(var, 'dataset_id, cell_id')} AS rk FROM daily),
pairs AS (SELECT a.dataset_id, a.cell_id AS a, b.cell_id AS b, corr(a.rk, b.rk) AS c FROM rk a JOIN rk b ON a.dataset_id = b.dataset_id AND a.t = b.t AND a.cell_id < b.cell_id
          GROUP BY 1, 2, 3 HAVING COUNT(*) > 1 AND isfinite(corr(a.rk, b.rk))),
binned AS (SELECT dataset_id, c, max_km, CAST(least(floor({_DIST} / max_km * {bins}), {bins} - 1) AS INT) AS bin
           FROM pairs JOIN cells ca ON ca.cell_id = a JOIN cells cb ON cb.cell_id = b, span),
cg AS (SELECT dataset_id, bin, (bin + 0.5e0) * any_value(max_km) / {bins} AS distance, COUNT(*) AS n, AVG(c) AS value FROM binned GROUP BY 1, 2)"""


def _register_correlogram(var):
    @query(f"correlogram_{var}", f"WITH {_correlogram_sql(var)} SELECT dataset_id, bin, {r('distance')} AS distance, n, {r('value')} AS value FROM cg")
    def run(spark, sf_dir):
        out = Z.spatial_correlogram(X.daily(spark, sf_dir), X.cells(spark, sf_dir), var, block=8)
        return rounded(out, ["distance", "value"])


for _v in ("tasmax", "tasmin", "pr"):
    _register_correlogram(_v)


@query("correlation_length", f"""WITH {_correlogram_sql('tasmax')} SELECT dataset_id, {r('MIN(distance) FILTER (value < 0.68)')} AS length_km FROM cg GROUP BY 1""")
def correlation_length(spark, d):
    cg = Z.spatial_correlogram(X.daily(spark, d), X.cells(spark, d), "tasmax", block=8)
    return rounded(Z.correlation_length(cg, 0.68), ["length_km"])


def _eof_sql(x: str, squarings: int = 14) -> str:
    """Covariance of all cells, squared until only its leading pattern is left."""
    steps = [f"""m{k + 1} AS MATERIALIZED (SELECT dataset_id, i, j, v / SUM(CASE WHEN i = j THEN v END) OVER (PARTITION BY dataset_id) AS v FROM
  (SELECT a.dataset_id, a.i, b.j, SUM(a.v * b.v) AS v FROM m{k} a JOIN m{k} b ON a.dataset_id = b.dataset_id AND a.j = b.i GROUP BY ALL))"""
             for k in range(squarings)]
    return f"""WITH {DAILY_SQL}, x AS (SELECT dataset_id, cell_id, t, {x} AS x FROM daily),
d AS MATERIALIZED (SELECT dataset_id, cell_id, t, x - AVG(x) OVER (PARTITION BY dataset_id, cell_id) AS x FROM x),
c AS (SELECT a.dataset_id, a.cell_id AS i, b.cell_id AS j, SUM(a.x * b.x) AS v FROM d a JOIN d b USING (dataset_id, t) GROUP BY ALL),
m0 AS MATERIALIZED (SELECT dataset_id, i, j, v / SUM(CASE WHEN i = j THEN v END) OVER (PARTITION BY dataset_id) AS v FROM c), {', '.join(steps)},
top AS (SELECT dataset_id, arg_max(i, v) AS j FROM m{squarings} WHERE i = j GROUP BY 1),
u AS (SELECT m.dataset_id, m.i AS cell_id, m.v AS w FROM m{squarings} m JOIN top USING (dataset_id, j)),
n AS (SELECT dataset_id, sqrt(SUM(w * w)) * CASE WHEN SUM(w) < 0 THEN -1 ELSE 1 END AS s FROM u GROUP BY 1)
SELECT dataset_id, cell_id, {r('w / s', 4)} AS value FROM u JOIN n USING (dataset_id)"""


@query("first_eof_tasmax", _eof_sql("tasmax"))
def first_eof_tasmax(spark, d):
    return rounded(Z.first_eof(X.daily(spark, d), "tasmax"), ["value"], 4)


@query("first_eof_tasmin", _eof_sql("tasmin"))
def first_eof_tasmin(spark, d):
    return rounded(Z.first_eof(X.daily(spark, d), "tasmin"), ["value"], 4)


@query("first_eof_pr", _eof_sql("ln(greatest(pr, 0.1e0))"))
def first_eof_pr(spark, d):
    return rounded(Z.first_eof(X.daily(spark, d), "pr", "*", "0.1 mm/d"), ["value"], 4)
