"""Climate indices, spells, rolling sums, frequency rules."""

from __future__ import annotations

from pyspark.sql import functions as F

from graticule.functions import calendars as C
from graticule.operators import indices as I, spells as V
from graticule.operators.definitions import define, standard_indicators
from graticule.plans.indices import listed

from . import fixtures as X
from .fixtures import DAILY_SQL, NOLEAP_SQL
from .registry import month_date, period_no, pstart, query, r, rounded

DEFS = standard_indicators()
TAS = "((tasmin + tasmax) / 2)"

# Per base: SQL of the daily value, of the inputs that must be present, and how days combine.
_SQL = {
    "tg_mean": (TAS, TAS, "AVG"), "tx_mean": ("tasmax", "tasmax", "AVG"), "tn_mean": ("tasmin", "tasmin", "AVG"),
    "prcptot": ("pr", "pr", "SUM"),
    "liquidprcptot": (f"CASE WHEN {TAS} >= 273.15 THEN pr ELSE 0 END", f"pr + {TAS}", "SUM"),
    "solidprcptot": (f"CASE WHEN {TAS} < 273.15 THEN pr ELSE 0 END", f"pr + {TAS}", "SUM"),
    "dlyfrzthw": ("CASE WHEN tasmax > 273.15 AND tasmin <= 273.15 THEN 1 ELSE 0 END", "tasmax + tasmin", "SUM"),
    "growing_degree_days": (f"greatest({TAS} - 277.15e0, 0)", TAS, "SUM"),
    "freezing_degree_days": (f"greatest(273.15e0 - {TAS}, 0)", TAS, "SUM"),
}


def _daily_sql(d) -> tuple[str, str, str]:
    if d.base in _SQL:
        return _SQL[d.base]
    var = "tasmin" if d.base.startswith("tn") else "tasmax"
    op = ">" if d.base.endswith("above") else "<"
    kelvin = float(d.params["thresh"].split()[0]) + 273.15
    return f"CASE WHEN {var} {op} {kelvin}e0 THEN 1 ELSE 0 END", var, "SUM"


def _folded_sql(defs, source="daily") -> str:
    parts = []
    for d in defs:
        value, have, how = _daily_sql(d)
        parts.append(f"SELECT dataset_id, '{d.name}' AS indicator, '{d.freq}' AS freq, cell_id, {pstart(d.freq)} AS period_start, "
                     f"{how}(CASE WHEN {have} IS NOT NULL THEN {value} END) AS value FROM {source} GROUP BY ALL")
    return " UNION ALL ".join(parts)


def _tidy_sql(body: str, ctes: str = DAILY_SQL) -> str:
    return f"WITH {ctes}, ind AS ({body}) SELECT dataset_id, indicator, freq, cell_id, period_start, {r('value')} AS value FROM ind"


FOLDED = [d for d in DEFS if d.base in I.BASES]


def _register_folded(name, defs):
    @query(name, _tidy_sql(_folded_sql(defs)))
    def run(spark, sf_dir):
        return rounded(I.compute_indicators(X.daily(spark, sf_dir), defs, missing="skip"), ["value"])


def _base_group(*bases):
    return [d for d in FOLDED if d.base in bases]


_register_folded("idx_tg_mean", _base_group("tg_mean"))
_register_folded("idx_tx_mean", _base_group("tx_mean"))
_register_folded("idx_tn_mean", _base_group("tn_mean"))
_register_folded("idx_prcptot", _base_group("prcptot"))
_register_folded("idx_liquid_solid_pr", _base_group("liquidprcptot", "solidprcptot"))
_register_folded("idx_freeze_thaw", _base_group("dlyfrzthw"))
_register_folded("idx_degree_days", _base_group("growing_degree_days", "freezing_degree_days"))
_register_folded("idx_tn_days", _base_group("tn_days_above", "tn_days_below"))
_register_folded("idx_tx_days", _base_group("tx_days_above"))

_ROLL = """roll AS (SELECT *, COUNT(pr) OVER w AS n5, SUM(pr) OVER w AS s5 FROM daily
  WINDOW w AS (PARTITION BY dataset_id, cell_id ORDER BY t RANGE BETWEEN 4 PRECEDING AND CURRENT ROW)),
april AS (SELECT dataset_id AS ds, MIN(t) AS t0 FROM daily WHERE month = 4 GROUP BY 1)"""
_RX_SQL = f"""
SELECT dataset_id, 'max_n_day_precipitation_amount_n_5_annual' AS indicator, 'YS' AS freq, cell_id, {pstart('YS')} AS period_start,
       MAX(CASE WHEN n5 = 5 THEN s5 END) AS value FROM roll GROUP BY ALL
UNION ALL
SELECT dataset_id, 'max_n_day_precipitation_amount_n_5_biannual', '2QS-OCT', cell_id, {pstart('2QS-OCT')},
       MAX(CASE WHEN n5 = 5 AND t - 4 >= t0 THEN s5 END) FROM roll JOIN april ON ds = dataset_id WHERE t >= t0 GROUP BY ALL"""
ROLLING = [d for d in DEFS if d.base == I.ROLLING]


@query("idx_rx5day", _tidy_sql(_RX_SQL, DAILY_SQL + ", " + _ROLL))
def idx_rx5day(spark, d):
    return rounded(I.compute_indicators(X.daily(spark, d), ROLLING, missing="skip"), ["value"])


def _heat_sql() -> str:
    parts = []
    for n, (tn, tx) in enumerate(((293.15, 306.15), (291.15, 304.15), (289.15, 304.15)), start=1):
        for base, agg in (("heat_wave_total_length", "SUM(len)"), ("heat_wave_frequency", "COUNT(len)")):
            parts.append(f"""
SELECT p.dataset_id, '{base}_class{n}' AS indicator, 'YS' AS freq, p.cell_id, make_date(p.year, 1, 1) AS period_start, COALESCE({agg}, 0) AS value
FROM (SELECT DISTINCT dataset_id, cell_id, year FROM daily) p LEFT JOIN
     (SELECT dataset_id, cell_id, year, isl, COUNT(*) AS len FROM
        (SELECT *, t - row_number() OVER (PARTITION BY dataset_id, cell_id, year ORDER BY t) AS isl FROM daily WHERE tasmin > {tn}e0 AND tasmax > {tx}e0)
      GROUP BY ALL HAVING COUNT(*) >= 3) h USING (dataset_id, cell_id, year) GROUP BY ALL""")
    return " UNION ALL ".join(parts)


HEAT = [d for d in DEFS if d.base in I.SPELLS]


@query("idx_heat_waves", _tidy_sql(_heat_sql()))
def idx_heat_waves(spark, d):
    return rounded(I.compute_indicators(X.daily(spark, d), HEAT, missing="skip"), ["value"])


@query("idx_all", _tidy_sql(_folded_sql(FOLDED) + " UNION ALL " + _RX_SQL + " UNION ALL " + _heat_sql(), DAILY_SQL + ", " + _ROLL))
def idx_all(spark, d):
    """The 30 definitions in one plan."""
    return rounded(I.compute_indicators(X.daily(spark, d), DEFS, missing="skip"), ["value"])


def _days_sql(freq: str) -> str:
    length = {"YS": 12, "QS-DEC": 3}[freq]
    return f"date_diff('day', {pstart(freq)}, {pstart(freq)} + INTERVAL {length} MONTH)"


_STRICT = [define("tx_mean_annual", "tx_mean", "YS"), define("prcptot_seasonal", "prcptot", "QS-DEC")]


@query("idx_missing_policy", f"""WITH {DAILY_SQL}, pooled AS (SELECT 'all' AS dataset_id, cell_id // 5 AS cell_id, year, month, t, AVG(tasmax) AS tasmax, AVG(pr) AS pr FROM daily GROUP BY ALL),
ind AS (SELECT 'tx_mean_annual' AS indicator, 'YS' AS freq, cell_id, {pstart('YS')} AS period_start, AVG(tasmax) AS value, COUNT(tasmax) AS n, {_days_sql('YS')} AS days FROM pooled GROUP BY ALL
UNION ALL SELECT 'prcptot_seasonal', 'QS-DEC', cell_id, {pstart('QS-DEC')}, SUM(pr), COUNT(pr), {_days_sql('QS-DEC')} FROM pooled GROUP BY ALL)
SELECT indicator, freq, cell_id, period_start, {r('CASE WHEN n >= days THEN value END')} AS strict, {r('CASE WHEN n >= 0.98 * days THEN value END')} AS tolerant FROM ind""")
def idx_missing_policy(spark, d):
    """Periods with missing days: NULL under ``any``, kept under a tolerance.  Cells are pooled so that some are complete."""
    df = X.daily(spark, d).groupBy(
        F.lit("all").alias("dataset_id"), "calendar", F.expr("CAST(cell_id div 5 AS INT)").alias("cell_id"), "year", "month", "t"
    ).agg(F.avg("tasmax").alias("tasmax"), F.avg("tasmin").alias("tasmin"), F.avg("pr").alias("pr"))
    keys = ["indicator", "freq", "cell_id", "period_start"]
    strict = I.compute_indicators(df, _STRICT, "any").select(*keys, F.col("value").alias("strict"))
    loose = I.compute_indicators(df, _STRICT, 0.02).select(*keys, F.col("value").alias("tolerant"))
    return rounded(strict.join(loose, keys), ["strict", "tolerant"])


@query("rolling_sum", f"WITH {DAILY_SQL}, {_ROLL} SELECT dataset_id, cell_id, t, {r('CASE WHEN n5 = 5 THEN s5 END')} AS pr_sum5 FROM roll")
def rolling_sum(spark, d):
    out = V.rolling_sum(X.daily(spark, d).select("dataset_id", "cell_id", "t", "pr"), "pr", 5)
    return rounded(out.select("dataset_id", "cell_id", "t", "pr_sum5"), ["pr_sum5"])


@query("dry_spells", f"""WITH {DAILY_SQL}, p AS (SELECT *, {pstart('QS-DEC')} AS period_start FROM daily WHERE pr < 1),
i AS (SELECT *, t - row_number() OVER (PARTITION BY dataset_id, cell_id, period_start ORDER BY t) AS isl FROM p)
SELECT dataset_id, cell_id, period_start, MIN(t) AS start_t, CAST(COUNT(*) AS INT) AS length FROM i
GROUP BY dataset_id, cell_id, period_start, isl HAVING COUNT(*) >= 3""")
def dry_spells(spark, d):
    df = X.daily(spark, d).withColumn("period_start", C.period_start("year", "month", "QS-DEC"))
    return V.spells(df, F.col("pr") < 1, 3).select("dataset_id", "cell_id", "period_start", "start_t", "length")


@query("moving_mean", f"""WITH {DAILY_SQL}, y AS (SELECT dataset_id, cell_id, year, AVG(tasmax) AS tx FROM daily GROUP BY ALL)
SELECT dataset_id, cell_id, year, {r('AVG(tx) OVER (PARTITION BY dataset_id, cell_id ORDER BY year RANGE BETWEEN 2 PRECEDING AND 1 FOLLOWING)')} AS tx_ma4 FROM y""")
def moving_mean(spark, d):
    y = X.daily(spark, d).groupBy("dataset_id", "cell_id", "year").agg(F.avg("tasmax").alias("tx"))
    out = V.moving_mean(y, "tx", 4, ("dataset_id", "cell_id"))
    return rounded(out.select("dataset_id", "cell_id", "year", "tx_ma4"), ["tx_ma4"])


@query("period_max_of_rolling_sum", f"""WITH {DAILY_SQL}, {_ROLL}
SELECT dataset_id, cell_id, {pstart('AS-JUL')} AS period_start, {r('MAX(CASE WHEN n5 = 5 THEN s5 END)')} AS value FROM roll GROUP BY ALL""")
def period_max_of_rolling_sum(spark, d):
    return rounded(V.period_max_of_rolling_sum(X.daily(spark, d), "pr", 5, "AS-JUL"), ["value"])


@query("idx_noleap_calendar", _tidy_sql(_folded_sql(FOLDED, "nl"), NOLEAP_SQL))
def idx_noleap_calendar(spark, d):
    return rounded(I.compute_indicators(X.noleap(spark, d), FOLDED, "skip"), ["value"])


_WANTED = ", ".join(f"('{d.name}', '{d.freq.replace('YS', 'AS-JAN')}', '{d.output}')" for d in DEFS)


@query("catalog_missing", f"""WITH {X.CATALOG_SQL}, wanted(indicator, xrfreq, variable) AS (VALUES {_WANTED}),
have AS (SELECT id, xrfreq, unnest(variable) AS variable FROM cat)
SELECT id, indicator, w.xrfreq, w.variable FROM (SELECT DISTINCT id FROM cat WHERE processing_level = 'biasadjusted') CROSS JOIN wanted w
WHERE NOT EXISTS (SELECT 1 FROM have h WHERE h.id = cat.id AND h.xrfreq = w.xrfreq AND h.variable = w.variable)""".replace(
    "(SELECT DISTINCT id FROM cat WHERE processing_level = 'biasadjusted')", "(SELECT DISTINCT id FROM cat WHERE processing_level = 'biasadjusted') AS cat"))
def catalog_missing(spark, d):
    cat = X.catalog(spark, d)
    out = I.missing_indicators(DEFS, cat, cat.where("processing_level = 'biasadjusted'"))
    return out.select("id", "indicator", "xrfreq", "variable")


@query("idx_compute_missing", _tidy_sql(_folded_sql(FOLDED), DAILY_SQL).replace(
    "FROM ind", "FROM ind WHERE dataset_id = 'sim' AND NOT (indicator = 'tx_mean_annual')"))
def idx_compute_missing(spark, d):
    """I32: the catalog already lists everything for ``ref`` and one index for ``sim``."""
    df = X.daily(spark, d)
    ids = df.select(F.col("dataset_id").alias("id")).distinct()
    one = [x for x in FOLDED if x.name == "tx_mean_annual"]
    have = listed(FOLDED, ids.where("id = 'ref'"), "indices").unionByName(listed(one, ids.where("id = 'sim'"), "indices"))
    gaps = I.missing_indicators(FOLDED, have, ids)
    return rounded(I.compute_missing(df, FOLDED, gaps, "skip"), ["value"])
