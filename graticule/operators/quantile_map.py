"""Detrended quantile mapping over 31-day windows around each day of the year.

Data flow, with one exchange per input (by ``cell_id``) and none after it:

* training: daily values -> one row per (dataset, cell) that holds its days as arrays -> joined to the reference's row of the cell ->
  an Arrow-batched kernel (``day_windows``: every series sorted once, 31-day windows cut out of it; quantiles, means, frequency
  adaptation) -> adjustment factors per (dataset, cell, variable, day of year);
* adjustment by stored factors: 31-day moving means -> one row per day of year holding its years as arrays -> joined to the factors ->
  an Arrow-batched kernel (LOESS trend across years, nearest-quantile lookup, recombination) -> daily rows;
* adjustment by factors ``train`` has just described: the days of reference, training and target side by side in one exchange by
  cell -> a kernel that trains a (dataset, cell), adjusts its days and forgets the factors -> daily rows.

The three variables share the exchanges.  Factors are 100 numbers per variable and day of the year, most often far more bytes than
the days they come from: they leave the kernel only to be stored or looked at, and rows of them given to ``apply_factors`` are
hashed by cell once.  Every group is bounded by the calendar: a (dataset, cell) has at most one row per day, a day of year at most
one row per year.

Choices the published method leaves open, fixed here: windows stop at the ends of the period; quantiles interpolate
linearly; a dry day has less than the threshold; of equally near quantiles the lowest is taken; a zero mean, trend or
quantile in a quotient gives NULL.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from ..functions.calendars import fixed_year_length, required_year_length, with_civil_parts
from ..functions.randoms import uniform, uniform_np
from ..session import by_cell, cells_partitions, hashed_by_cell
from .day_windows import Windows, adapted, windows
from .derive import with_dtr, with_tasmin_from_dtr


@dataclass(frozen=True)
class VariableConf:
    kind: str = "+"                     # "+" additive, "*" multiplicative
    jitter_under: float | None = None   # replace smaller values by random ones in (0, threshold), training only
    adapt_freq: float | None = None     # dry-day threshold of the frequency adaptation, training only


@dataclass(frozen=True)
class Conf:
    variables: dict[str, VariableConf]
    reference_period: tuple[int, int] = (1981, 2010)
    target_period: tuple[int, int] = (1951, 2100)
    window: int = 31
    nquantiles: int = 50
    loess_f: float = 0.2
    seed: int = 42

    @property
    def levels(self) -> list[float]:
        return [(2 * i + 1) / (2 * self.nquantiles) for i in range(self.nquantiles)]


# How each variable is adjusted.
STANDARD_VARIABLES = {
    "dtr": VariableConf("*"),
    "tasmax": VariableConf("+"),
    "pr": VariableConf("*", jitter_under=0.01, adapt_freq=1.0),
}

SERIES = ["dataset_id", "calendar", "cell_id", "var"]


def _per_var(conf: Conf, pick, default: Column) -> Column:
    """CASE over the variables with a non-None ``pick(conf)``."""
    out = None
    for name, vc in conf.variables.items():
        value = pick(vc)
        if value is not None:
            branch = (F.col("var") == name, value if isinstance(value, Column) else F.lit(value))
            out = F.when(*branch) if out is None else out.when(*branch)
    return default if out is None else out.otherwise(default)


def to_series(df: DataFrame, variables: Sequence[str]) -> DataFrame:
    """Wide daily rows -> (dataset_id, calendar, cell_id, var, year, doy, t, x), hashed by cell while still wide."""
    if "dtr" in variables and "dtr" not in df.columns:
        df = with_dtr(df)
    wide = by_cell(df.select("dataset_id", "calendar", "cell_id", "year", "doy", "t", *variables))
    pairs = F.array(*[F.struct(F.lit(v).alias("var"), F.col(v).cast("double").alias("x")) for v in variables])
    return (
        wide.withColumn("_p", F.explode(pairs))
        .select("dataset_id", "calendar", "cell_id", "_p.var", "year", "doy", "t", "_p.x")
        .where(F.col("x").isNotNull())
    )


# --- training --------------------------------------------------------------------------------------------------------


def jitter_under(series: DataFrame, conf: Conf, seed: int) -> DataFrame:
    """Replace values under a variable's jitter threshold by reproducible random ones in (0, threshold)."""
    limit = _per_var(conf, lambda c: c.jitter_under, F.lit(None).cast("double"))
    noise = uniform(F.col("cell_id"), F.col("t"), seed) * limit
    return series.withColumn("x", F.when(F.col("x") < limit, noise).otherwise(F.col("x")))


def _jittered(x: np.ndarray, limit: float | None, cell: int, t: np.ndarray, seed: int) -> np.ndarray:
    """``jitter_under`` of one series."""
    if limit is None:
        return x
    return np.where(x < limit, uniform_np(seed, np.full(len(t), cell), t) * limit, x)


def _lists(column: pa.ListArray) -> tuple[np.ndarray, dict[str, np.ndarray]]:
    """Offsets and flat fields of a column of lists of structs; NULL becomes NaN."""
    flat, offsets = column.values, column.offsets.to_numpy()
    return offsets, {f.name: flat.field(i).to_numpy(zero_copy_only=False) for i, f in enumerate(flat.type)}


def _list_column(values: np.ndarray) -> pa.ListArray:
    """A matrix as a column of lists; NaN becomes NULL."""
    offsets = np.arange(len(values) + 1, dtype=np.int32) * values.shape[1]
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.ravel(), from_pandas=True))


def doy_window_arrays(series: DataFrame, period: tuple[int, int], window: int = 31) -> DataFrame:
    """(series keys, doy, arr, mean): all values within ``window`` days around the day of year, ascending.

    Windows stop at the ends of the period; a day of year whose window holds no value has no row.
    """
    half = window // 2
    rows = series.where(F.col("year").between(*period)).groupBy(*SERIES).agg(F.collect_list(F.struct("year", "doy", "x")).alias("days"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            offsets, days = _lists(batch.column("days"))
            lengths = batch.column("n").to_pylist()
            for i, n in enumerate(lengths):
                at = slice(offsets[i], offsets[i + 1])
                found = windows(days["year"][at], days["doy"][at], days["x"][at], n, period, half)
                some = np.flatnonzero(found.counts)
                ends = np.concatenate([[0], np.cumsum(found.counts[some])]).astype(np.int32)
                own = batch.slice(i, 1).select(SERIES).take(pa.array(np.zeros(len(some), np.int64)))
                yield pa.RecordBatch.from_arrays([
                    *own.columns, pa.array((some + 1).astype(np.int32)),
                    pa.ListArray.from_arrays(pa.array(ends), pa.array(found.values)), pa.array(found.means()[some]),
                ], names=[*SERIES, "doy", "arr", "mean"])

    kinds = dict(series.dtypes)
    schema = ", ".join(f"{c} {kinds[c]}" for c in SERIES) + ", doy int, arr array<double>, mean double"
    return rows.withColumn("n", required_year_length("calendar")).mapInArrow(run, schema)


def days_of_cells(df: DataFrame, conf: Conf, partitions: int) -> DataFrame:
    """One row per (dataset, calendar, cell) with its days of the reference period as a list, hashed by cell; at most one element a day."""
    names = list(conf.variables)
    if "dtr" in names and "dtr" not in df.columns:
        df = with_dtr(df)
    df = df.where(F.col("year").between(*conf.reference_period))
    wide = df.select("dataset_id", "calendar", "cell_id", "year", "doy", "t", *[F.col(v).cast("double").alias(f"x_{v}") for v in names])
    return by_cell(wide, partitions, exactly=True).groupBy("dataset_id", "calendar", "cell_id").agg(
        F.collect_list(F.struct("year", "doy", "t", *[f"x_{v}" for v in names])).alias("days"))


def factors_of(ref: Windows, sim: Windows, kind: str, levels: np.ndarray) -> tuple[np.ndarray, ...]:
    """(days of the year, factors, simulated quantiles of the anomalies, scaling) where both sides have values.

    Anomalies keep the order of the values, so their quantiles are those of the values minus, or over, the mean.
    """
    some = np.flatnonzero((ref.counts > 0) & (sim.counts > 0))
    means = [w.means()[some] for w in (ref, sim)]
    quantiles = [w.quantiles(levels)[some] for w in (ref, sim)]
    with np.errstate(divide="ignore", invalid="ignore"):
        if kind == "+":
            r, h = (q - m[:, None] for q, m in zip(quantiles, means))
            return some + 1, r - h, h, means[0] - means[1]
        r, h = (np.where(m[:, None] != 0, q / m[:, None], np.nan) for q, m in zip(quantiles, means))
        return some + 1, np.where(h != 0, r / h, np.nan), h, np.where(means[1] != 0, means[0] / means[1], np.nan)


def _windows_of_cell(conf: Conf, days: dict[str, np.ndarray], n: int, cell: int, seed: int) -> dict[str, Windows]:
    """The windows of every variable on one side, after the jitter."""
    return {
        v: windows(days["year"], days["doy"], _jittered(days[f"x_{v}"], c.jitter_under, cell, days["t"], seed), n, conf.reference_period, conf.window // 2)
        for v, c in conf.variables.items()
    }


def _factors_of_cell(conf: Conf, ref: dict[str, Windows], sim: dict[str, Windows], cell: int) -> dict[str, tuple[np.ndarray, ...]]:
    """``factors_of`` every variable, after the frequency adaptation."""
    levels, out = np.asarray(conf.levels)[None, :], {}
    for v, c in conf.variables.items():
        side = sim[v] if c.adapt_freq is None else adapted(ref[v], sim[v], c.adapt_freq, cell, conf.seed + 2)
        out[v] = factors_of(ref[v], side, c.kind, levels)
    return out


def training_kernel(conf: Conf):
    """Rows (dataset_id, calendar, cell_id, n, ref, sim) of a cell's days on both sides -> its factors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, reference = None, {}
        for batch in batches:
            columns = {side: _lists(batch.column(side)) for side in ("ref", "sim")}
            keys = [batch.column(c).to_pylist() for c in ("calendar", "cell_id", "n")]
            for i, (calendar, cell, n) in enumerate(zip(*keys)):
                found = {}
                for side, seed in (("ref", conf.seed), ("sim", conf.seed + 1)):
                    # The join sorts by cell: the members of a cell follow each other and share the reference's windows.
                    if side == "ref" and known == (calendar, cell):
                        continue
                    offsets, days = columns[side]
                    at = slice(offsets[i], offsets[i + 1])
                    found[side] = _windows_of_cell(conf, {name: values[at] for name, values in days.items()}, n, cell, seed)
                if "ref" in found:
                    known, reference = (calendar, cell), found["ref"]
                for v, (doy, af, hist_q, scaling) in _factors_of_cell(conf, reference, found["sim"], cell).items():
                    own = batch.slice(i, 1).select(["dataset_id", "calendar", "cell_id"]).take(pa.array(np.zeros(len(doy), np.int64)))
                    yield pa.RecordBatch.from_arrays([
                        *own.columns, pa.array(doy.astype(np.int32)), pa.array([v] * len(doy), pa.string()),
                        pa.array([conf.variables[v].kind] * len(doy), pa.string()),
                        _list_column(af), _list_column(hist_q), pa.array(scaling, from_pandas=True),
                    ], names=["dataset_id", "calendar", "cell_id", "doy", "var", "kind", "af", "hist_q", "scaling"])

    return run


def train(ref: DataFrame, hist: DataFrame, conf: Conf) -> DataFrame:
    """(dataset_id, calendar, cell_id, doy, var, kind, af[], hist_q[], scaling) for every dataset of ``hist``.

    ``ref`` must hold one reference per (calendar, cell, day) in the calendars of ``hist`` (see ``convert_calendar``).  The table
    remembers the days it comes from, so that ``adjust`` can train where it adjusts; one made from it by any further step does not.
    """
    # Both sides in the same partitions, and merged by cell: the join moves nothing, and the members of a cell follow each other.
    n = max([p for p in map(hashed_by_cell, (ref, hist)) if p] or map(cells_partitions, (ref, hist)))
    r = days_of_cells(ref, conf, n).select("calendar", "cell_id", F.col("days").alias("ref"))
    h = days_of_cells(hist, conf, n).withColumnRenamed("days", "sim")
    pairs = h.join(r.hint("merge"), ["calendar", "cell_id"]).withColumn("n", required_year_length("calendar"))
    schema = (
        f"dataset_id string, calendar string, cell_id {dict(hist.dtypes)['cell_id']}, doy int, var string, kind string, "
        "af array<double>, hist_q array<double>, scaling double")
    factors = pairs.select("dataset_id", "calendar", "cell_id", "n", "ref", "sim").mapInArrow(training_kernel(conf), schema)
    factors._trained_on = (ref, hist, conf)
    return factors


# --- adjustment ------------------------------------------------------------------------------------------------------


def loess_weights(n: int, f: float) -> np.ndarray:
    """Row i: tricube weights of the years around year i, for local regression of degree 0 in one pass.

    With k = ceil(f*n) neighbours, the half-width of year i is the distance to its k-th nearest year (itself included),
    so the window becomes one-sided towards the ends of the series.
    """
    k = max(1, math.ceil(f * n - 1e-9))
    years = np.arange(n)
    dist = np.abs(years[:, None] - years[None, :]).astype(float)
    h = np.sort(dist, axis=1)[:, k - 1][:, None]
    with np.errstate(divide="ignore", invalid="ignore"):
        w = np.where(dist < h, (1.0 - (dist / h) ** 3) ** 3, 0.0)
    return np.where(h == 0, np.eye(n), w)


def _smooth(m: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Weighted means along the years; years without a value drop out and the other weights are renormalised."""
    have = ~np.isnan(m)
    den = have.astype(float) @ weights.T
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(den > 0, (np.where(have, m, 0.0) @ weights.T) / den, np.nan)


def _dense(years: pd.Series, values: Sequence[pd.Series], first: int, n: int) -> list[np.ndarray]:
    """Ragged per-row arrays -> matrices (row, year) with NaN for absent years."""
    sizes = years.map(len).to_numpy()
    rows = np.repeat(np.arange(len(years)), sizes)
    cols = np.concatenate(years.to_numpy()).astype(int) - first
    out = []
    for v in values:
        m = np.full((len(years), n), np.nan)
        m[rows, cols] = np.concatenate(v.to_numpy()).astype(float)
        out.append(m)
    return out


def _nearest(hist_q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Per row, the index of the nearest of the ascending ``hist_q`` for each x; the lowest of equally near ones.

    Values outside the range take the first or last index, i.e. constant extrapolation.
    """
    mids = (hist_q[:, 1:] + hist_q[:, :-1]) / 2
    at = np.zeros(x.shape, np.int64)
    for k in range(mids.shape[1]):
        at += x > mids[:, k:k + 1]
    # The first index of each run of equal quantiles.
    new = np.concatenate([np.ones((len(hist_q), 1), bool), hist_q[:, 1:] != hist_q[:, :-1]], axis=1)
    lowest = np.maximum.accumulate(np.where(new, np.arange(hist_q.shape[1]), 0), axis=1)
    return np.take_along_axis(lowest, at, axis=1)


def _matrix(lists: pd.Series, width: int) -> np.ndarray:
    """Lists of ``width`` numbers as rows; NaN for a missing list and for its missing elements."""
    out = np.full((len(lists), width), np.nan)
    have = lists.notna().to_numpy()
    if have.any():
        out[have] = np.concatenate(lists[have].to_numpy()).astype(float).reshape(-1, width)
    return out


def trend_kernel(first: int, n: int, f: float):
    """years[], moving means[] -> trend[]."""
    weights = loess_weights(n, f)

    @F.pandas_udf(T.ArrayType(T.DoubleType()))
    def trend(years: pd.Series, means: pd.Series) -> pd.Series:
        (m,) = _dense(years, [means], first, n)
        smooth = _smooth(m, weights)
        return pd.Series([s[np.asarray(y) - first] for s, y in zip(smooth, years)])

    return trend


def _adjusted(m: np.ndarray, x: np.ndarray, af: np.ndarray, hist_q: np.ndarray, scaling: np.ndarray, weights: np.ndarray, kind: str) -> np.ndarray:
    """Adjusted values of (row, year) matrices of moving means and values, with the factors of each row."""
    trend, additive, c = _smooth(m, weights), kind == "+", scaling[:, None]
    with np.errstate(divide="ignore", invalid="ignore"):
        residual = x - trend if additive else np.where(trend != 0, x / trend, np.nan)
    picked = np.take_along_axis(af, _nearest(hist_q, np.nan_to_num(residual)), axis=1)
    picked[np.isnan(hist_q).any(axis=1)] = np.nan
    return trend + c + residual + picked if additive else trend * c * residual * picked


def adjust_kernel(first: int, n: int, f: float, kind: str, nquantiles: int):
    """years[], moving means[], values[], factors[], quantiles[], scaling -> adjusted values[]."""
    weights = loess_weights(n, f)

    @F.pandas_udf(T.ArrayType(T.DoubleType()))
    def adjusted(
        years: pd.Series, means: pd.Series, values: pd.Series, af: pd.Series, hist_q: pd.Series, scaling: pd.Series,
    ) -> pd.Series:
        m, x = _dense(years, [means, values], first, n)
        y = _adjusted(m, x, _matrix(af, nquantiles), _matrix(hist_q, nquantiles), scaling.to_numpy(dtype=float), weights, kind)
        out = []
        for row, at in zip(y, years):
            got = row[np.asarray(at) - first]
            out.append([None if np.isnan(v) else v for v in got] if np.isnan(got).any() else got)
        return pd.Series(out)

    return adjusted


CELL = ["dataset_id", "calendar", "cell_id"]


def _years_as_arrays(sim: DataFrame, conf: Conf, partitions: int | None = None) -> DataFrame:
    """One row per (dataset, cell, doy) with parallel arrays over its years: year, t, and per variable value and moving mean.

    The variables stay side by side, so the days are sorted once and the adjusted days come out whole.
    """
    names = list(conf.variables)
    if "dtr" in names and "dtr" not in sim.columns:
        sim = with_dtr(sim)
    sim = sim.where(F.col("year").between(*conf.target_period))
    wide = by_cell(sim.select(*CELL, "year", "doy", "t", *[F.col(v).cast("double").alias(f"x_{v}") for v in names]), partitions)
    half = conf.window // 2
    w = Window.partitionBy(*CELL).orderBy("t").rangeBetween(-half, half)
    wide = wide.withColumns({f"m_{v}": F.avg(f"x_{v}").over(w) for v in names})
    fields = ["year", "t", *[f"{p}_{v}" for v in names for p in ("x", "m")]]
    lists = wide.groupBy(*CELL, "doy").agg(F.array_sort(F.collect_list(F.struct(*fields))).alias("_y"))
    return lists.select(*CELL, "doy", *[F.col(f"_y.{c}").alias(c) for c in fields])


def _as_rows(arrays: DataFrame, fields: Sequence[str]) -> DataFrame:
    zipped = arrays.withColumn("_z", F.explode(F.arrays_zip("year", "t", *fields)))
    return zipped.select(*CELL, "_z.year", "doy", "_z.t", *[F.col(f"_z.{c}").alias(c) for c in fields])


def loess_trend(sim: DataFrame, conf: Conf) -> DataFrame:
    """(series keys, year, doy, t, x, m, trend): moving mean and its LOESS trend across the years of each day of year."""
    first, last = conf.target_period
    names = list(conf.variables)
    trend = trend_kernel(first, last - first + 1, conf.loess_f)
    arrays = _years_as_arrays(sim, conf)
    arrays = arrays.withColumns({f"trend_{v}": trend("year", f"m_{v}") for v in names})
    rows = _as_rows(arrays, [f"{p}_{v}" for v in names for p in ("x", "m", "trend")])
    long = F.array(*[F.struct(
        F.lit(v).alias("var"), F.col(f"x_{v}").alias("x"), F.col(f"m_{v}").alias("m"), F.col(f"trend_{v}").alias("trend")
    ) for v in names])
    return rows.withColumn("_p", F.explode(long)).select(*CELL, "_p.var", "year", "doy", "t", "_p.x", "_p.m", "_p.trend").where(
        F.col("x").isNotNull()
    )


def apply_factors(training: DataFrame, sim: DataFrame, conf: Conf) -> DataFrame:
    """(dataset_id, calendar, cell_id, year, doy, t, one column per variable): adjusted values.

    The training table is folded to one row per (dataset, cell, doy) and hashed by cell like the simulation, so neither the
    join nor anything after it moves the days again.
    """
    first, last = conf.target_period
    keys = [*CELL, "doy"]
    # A calendar that training refuses must not come out as rows of NULL here.
    sim = sim.where(required_year_length("calendar").isNotNull())
    # The same partitions on both sides: a join of unequal ones would move the factors, far more bytes than the days, once more.
    n = hashed_by_cell(sim) or max(map(cells_partitions, (training, sim)))
    folded = by_cell(training, n, exactly=True).groupBy(*keys).agg(*[
        F.first(F.when(F.col("var") == v, F.struct("af", "hist_q", "scaling")), ignorenulls=True).alias(f"f_{v}")
        for v in conf.variables
    ])
    joined = _years_as_arrays(sim, conf, n).join(folded.hint("merge"), keys, "left")
    out = joined.withColumns({
        v: adjust_kernel(first, last - first + 1, conf.loess_f, vc.kind, conf.nquantiles)(
            "year", f"m_{v}", f"x_{v}", f"f_{v}.af", f"f_{v}.hist_q", F.coalesce(f"f_{v}.scaling", F.lit(float("nan")))
        ) for v, vc in conf.variables.items()
    })
    return _as_rows(out, list(conf.variables))


_REF, _HIST, _SIM = 0, 1, 2  # a cell's days come in this order


def _runs(batches: Iterator[pa.RecordBatch], keys: Sequence[str]) -> Iterator[tuple[tuple, pa.Table]]:
    """The rows of equal ``keys`` that follow each other, over the borders of batches."""
    held, known = [], None
    for batch in batches:
        if not batch.num_rows:
            continue
        codes = [batch.column(k).dictionary_encode("encode").indices.to_numpy() for k in keys]
        cuts = np.flatnonzero(np.any([c[1:] != c[:-1] for c in codes], axis=0)) + 1
        for low, high in zip([0, *cuts], [*cuts, batch.num_rows]):
            key = tuple(batch.column(k)[low].as_py() for k in keys)
            if held and key != known:
                yield known, pa.Table.from_batches(held)
                held = []
            known = key
            held.append(batch.slice(low, high - low))
    if held:
        yield known, pa.Table.from_batches(held)


def _moving_means(t: np.ndarray, x: np.ndarray, half: int) -> np.ndarray:
    """Means of the values of each row of ``x`` within ``half`` days of each day, added up in the order of the days."""
    order = np.argsort(t, kind="stable")
    t, x = t[order].astype(np.int64), x[:, order]
    have = ~np.isnan(x)
    filled = np.where(have, x, 0.0)
    low, high = np.searchsorted(t, t - half, "left"), np.searchsorted(t, t + half, "right")
    total, n = np.zeros(x.shape), np.zeros(x.shape, np.int64)
    for k in range((high - low).max()):
        inside, at = low + k < high, np.minimum(low + k, len(t) - 1)
        total += np.where(inside, filled[:, at], 0.0)
        n += inside & have[:, at]
    out = np.empty(x.shape)
    out[:, order] = np.where(n > 0, total / np.maximum(n, 1), np.nan)
    return out


def train_and_adjust_kernel(trained: Conf, conf: Conf):
    """Days of reference, training and target, sorted by cell, calendar, dataset and side -> adjusted days of the target.

    The factors of a (dataset, cell) last until its days are adjusted.  Without any the adjusted values are NULL.
    """
    first, last = conf.target_period
    names, nyears = list(conf.variables), last - first + 1
    weights = loess_weights(nyears, conf.loess_f)

    def numbers(rows: pa.Table, variables: Sequence[str]) -> dict[str, np.ndarray]:
        return {c: rows.column(c).to_numpy() for c in ("year", "doy", "t", *[f"x_{v}" for v in variables])}

    def adjusted(days: dict[str, np.ndarray], factors: dict[str, tuple[np.ndarray, ...]]) -> list[np.ndarray]:
        doys, row = np.unique(days["doy"], return_inverse=True)
        place = row, days["year"] - first
        x = np.array([days[f"x_{v}"] for v in names])
        out = []
        for values, means, v in zip(x, _moving_means(days["t"], x, conf.window // 2), names):
            if v not in factors:
                out.append(np.full(len(values), np.nan))
                continue
            doy, *own = factors[v]
            m, dense = np.full((2, len(doys), nyears), np.nan)
            m[place], dense[place] = means, values
            have = np.isin(doys, doy)
            of_days = [np.full((len(doys), *f.shape[1:]), np.nan) for f in own]
            for f, all_days in zip(own, of_days):
                all_days[have] = f[np.searchsorted(doy, doys[have])]
            out.append(_adjusted(m, dense, *of_days, weights, conf.variables[v].kind)[place])
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reference = windows_ref = of_ref = of_factors = None
        factors = {}
        for (cell, calendar, member, side), rows in _runs(batches, ["cell_id", "calendar", "dataset_id", "side"]):
            if side == _REF:
                reference, of_ref, windows_ref = numbers(rows, trained.variables), (cell, calendar), None
            elif side == _HIST:
                if of_ref != (cell, calendar):
                    continue
                n = rows.column("n")[0].as_py()
                if n is None:
                    raise ValueError(f"years of equal length are needed, not calendar {calendar}")
                windows_ref = windows_ref or _windows_of_cell(trained, reference, n, cell, trained.seed)
                windows_sim = _windows_of_cell(trained, numbers(rows, trained.variables), n, cell, trained.seed + 1)
                factors, of_factors = _factors_of_cell(trained, windows_ref, windows_sim, cell), (cell, calendar, member)
            else:
                values = adjusted(numbers(rows, names), factors if of_factors == (cell, calendar, member) else {})
                keys = [rows.column(c).combine_chunks() for c in (*CELL, "year", "doy", "t")]
                yield pa.RecordBatch.from_arrays([*keys, *[pa.array(y, from_pandas=True) for y in values]], names=[*CELL, "year", "doy", "t", *names])

    return run


def train_and_apply(ref: DataFrame, hist: DataFrame, trained: Conf, sim: DataFrame, conf: Conf) -> DataFrame:
    """``apply_factors`` of those ``train`` makes from ``ref`` and ``hist``, in one exchange of the days and none of the factors."""
    names = list(dict.fromkeys([*trained.variables, *conf.variables]))

    def side(df: DataFrame, number: int, variables: Sequence[str], period: tuple[int, int]) -> DataFrame:
        if "dtr" in variables and "dtr" not in df.columns:
            df = with_dtr(df)
        member = F.lit(None).cast("string") if number == _REF else F.col("dataset_id")
        values = [(F.col(v) if v in variables else F.lit(None)).cast("double").alias(f"x_{v}") for v in names]
        return df.where(F.col("year").between(*period)).select(
            "cell_id", "calendar", member.alias("dataset_id"), F.lit(number).alias("side"), "year", "doy", "t", *values)

    # A calendar that training refuses must not come out as rows of NULL here.
    target = sim.where(required_year_length("calendar").isNotNull())
    days = side(ref, _REF, trained.variables, trained.reference_period).unionByName(
        side(hist, _HIST, trained.variables, trained.reference_period)).unionByName(side(target, _SIM, conf.variables, conf.target_period))
    # The days of a partition are sorted at once: few enough to need no disk.
    laid = days.repartition(cells_partitions(days, 32 << 20), "cell_id").sortWithinPartitions("cell_id", "calendar", "dataset_id", "side")
    kinds, of_sim = dict(days.dtypes), dict(sim.dtypes)
    keys = [*CELL, "year", "doy", "t"]
    schema = ", ".join([*[f"{c} {kinds[c]}" for c in keys], *[f"`{v}` double" for v in conf.variables]])
    out = laid.withColumn("n", fixed_year_length("calendar")).mapInArrow(train_and_adjust_kernel(trained, conf), schema)
    return out.withColumns({c: F.col(c).cast(of_sim[c]) for c in keys if kinds[c] != of_sim[c]})


def assemble(adjusted: DataFrame) -> DataFrame:
    """Adjusted values -> daily table; tasmin rebuilt from tasmax and dtr."""
    if "dtr" in adjusted.columns and "tasmax" in adjusted.columns:
        adjusted = with_tasmin_from_dtr(adjusted)
    return with_civil_parts(adjusted)


def adjust(training: DataFrame, sim: DataFrame, conf: Conf) -> DataFrame:
    """The adjusted scenario as a daily table.

    Factors that ``train`` describes and nothing has stored are made where the days are adjusted; others are joined to the days.
    """
    described = vars(training).get("_trained_on")
    if described is None or training.is_cached:
        return assemble(apply_factors(training, sim, conf))
    return assemble(train_and_apply(*described, sim, conf))


def check_physical(df: DataFrame) -> DataFrame:
    """Counts of physically impossible rows per dataset; all must be 0."""
    return df.groupBy("dataset_id").agg(
        F.count_if(F.col("tasmin") > F.col("tasmax")).alias("tasmin_over_tasmax"),
        F.count_if(F.col("pr") < 0).alias("negative_pr"),
    )
