"""Spatial properties of a region: leading pattern of variability and correlogram."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ..functions.geo import distance_km_np
from ..functions.randoms import uniform
from ..functions.units import threshold
from ..session import by_cell, cells_partitions, cut_lineage
from .spells import average_rank

K = ["dataset_id", "cell_id"]


# Directions followed at once, and the bytes of directions that the driver keeps for all datasets.
DIRECTIONS, BASIS_BYTES = 8, 256 << 20
_CHUNK_BYTES = 32 << 20


def _centred(batch: pa.RecordBatch, spans: dict[str, tuple[int, int]]) -> Iterator[tuple[str, np.ndarray, np.ndarray]]:
    """(dataset, rows of the batch, their anomalies as a matrix (cell, day)); a missing day counts as the cell's mean."""
    names = np.array(batch.column("dataset_id").to_pylist())
    for name in np.unique(names):
        if name not in spans:
            continue
        first, n = spans[name]
        rows = np.flatnonzero(names == name)
        step = max(1, _CHUNK_BYTES // (8 * n))
        for at in range(0, len(rows), step):
            some = batch.take(pa.array(rows[at:at + step]))
            x = _dense(some.column("t"), some.column("x"), first, n, np.nan, "f8")
            have = ~np.isnan(x)
            x -= np.where(have, x, 0.0).sum(axis=1, keepdims=True) / np.maximum(have.sum(axis=1, keepdims=True), 1)
            yield name, rows[at:at + step], np.where(have, x, 0.0)


def _image(spans: dict[str, tuple[int, int]], vectors: dict[str, np.ndarray]):
    """Rows of days -> each dataset's sum over cells of (anomalies, transposed) x (anomalies x vectors): (dataset_id, day, y0, y1, ...)."""
    width = max(v.shape[1] for v in vectors.values())
    asked = {name: spans[name] for name in vectors}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = {}
        for batch in batches:
            for name, _, x in _centred(batch, asked):
                part = x.T @ (x @ vectors[name])
                sums[name] = sums[name] + part if name in sums else part
        for name, y in sums.items():
            y = np.pad(y, ((0, 0), (0, width - y.shape[1])))
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(y), pa.string()), pa.array(np.arange(len(y), dtype=np.int32)), *[pa.array(c) for c in y.T.copy()]],
                names=["dataset_id", "day", *[f"y{k}" for k in range(width)]])

    return run, "dataset_id string, day int, " + ", ".join(f"y{k} double" for k in range(width)), width


def _scores(spans: dict[str, tuple[int, int]], vectors: dict[str, np.ndarray]):
    """Rows of days -> (dataset_id, cell_id, v): anomalies x vector."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, rows, x in _centred(batch, spans):
                own = batch.select(K).take(pa.array(rows))
                yield pa.RecordBatch.from_arrays([*own.columns, pa.array(x @ vectors[name])], names=[*K, "v"])

    return run


def _orthonormal(block: np.ndarray, least: float) -> np.ndarray:
    """Basis of a block's columns, without directions shorter than ``least``."""
    u, s, _ = np.linalg.svd(block, full_matrices=False)
    return u[:, s > least]


class _Krylov:
    """Directions over the days of one dataset, in blocks, and the covariance of days projected on them."""

    def __init__(self, start: np.ndarray, most: int):
        self.most, self.basis, self.projected = most, np.zeros((len(start), 0)), np.zeros((0, 0))
        self.block = _orthonormal(start, 0.0)
        self.value, self.error, self.best = 0.0, math.inf, self.block[:, 0]

    def step(self, image: np.ndarray) -> None:
        """``image``: the covariance times ``block``."""
        old = self.basis.shape[1]
        self.basis = np.hstack([self.basis, self.block])
        columns = self.basis.T @ image
        grown = np.zeros((self.basis.shape[1],) * 2)
        grown[:old, :old] = self.projected
        grown[:, old:], grown[old:, :] = columns, columns.T
        self.projected = (grown + grown.T) / 2
        rest = image - self.basis @ columns
        rest -= self.basis @ (self.basis.T @ rest)  # a second time: orthogonal to rounding
        values, vectors = np.linalg.eigh(self.projected)
        self.value, self.best = float(values[-1]), self.basis @ vectors[:, -1]
        self.error = float(np.linalg.norm(rest @ vectors[old:, -1]))
        self.block = _orthonormal(rest, 1e-12 * abs(self.value))
        if self.basis.shape[1] + self.block.shape[1] > self.most or not self.block.shape[1]:
            self._shorten(values, vectors)

    def _shorten(self, values: np.ndarray, vectors: np.ndarray) -> None:
        """Only the best directions so far stay; the newest block goes on from them."""
        if not self.block.shape[1]:
            self.block, self.basis, self.projected = self.basis @ vectors[:, -DIRECTIONS:], self.basis[:, :0], np.zeros((0, 0))
            return
        keep = min(DIRECTIONS, len(values))
        self.basis, self.projected = self.basis @ vectors[:, -keep:], np.diag(values[-keep:])


def first_eof(
    df: DataFrame, var: str, kind: str = "+", thresh: str | float | None = None,
    tol: float = 1e-8, max_steps: int = 60, seed: int = 42, max_restarts: int = 40,
) -> DataFrame:
    """Leading spatial pattern per dataset: (dataset_id, cell_id, value), unit norm, its sum >= 0.

    Multiplicative variables are taken as log(max(x, thresh)).  Each cell is centred on its own mean, a missing day counts
    as the mean.  The pattern is the leading eigenvector of the cell covariance, found by block Lanczos steps over the days: with X the
    anomalies (cell, day) and u the leading eigenvector of X'X, the pattern is Xu.  Neither covariance is formed.  A step is one pass
    over the stored days, a row per cell: each task multiplies its cells by ``DIRECTIONS`` vectors and back, the products are summed by
    day.  The driver keeps vectors over days, bounded by the calendar and by ``BASIS_BYTES``; where they are full, or after
    ``max_steps`` blocks, the best ones stay and the steps go on.  Raises if ``max_steps * (max_restarts + 1)`` steps don't reach ``tol``.
    A dataset that doesn't vary gets a pattern of random numbers.
    """
    x = F.col(var)
    if kind == "*":
        x = F.log(F.greatest(x, F.lit(threshold(thresh)))) if thresh is not None else F.log(x)
    table = _series(df.where(F.col(var).isNotNull()), x.cast("double"))
    extent = table.groupBy("dataset_id").agg(F.min(F.array_min("t")), F.max(F.array_max("t")))
    spans = {name: (low, high - low + 1) for name, low, high in extent.toLocalIterator()}
    if not spans:
        return table.select(*K, F.lit(None).cast("double").alias("value"))
    rng, days = np.random.default_rng(seed), sum(n for _, n in spans.values())
    most = max(3, min(max_steps, BASIS_BYTES // (8 * days * DIRECTIONS))) * DIRECTIONS
    found = {name: _Krylov(rng.normal(size=(n, min(n, DIRECTIONS))), most) for name, (_, n) in sorted(spans.items())}
    left = set(found)
    for _ in range(max_steps * (max_restarts + 1)):
        run, schema, width = _image(spans, {name: found[name].block for name in left})
        sums = table.where(F.col("dataset_id").isin(sorted(left))).mapInArrow(run, schema).groupBy("dataset_id", "day").agg(
            *[F.sum(f"y{k}").alias(f"y{k}") for k in range(width)]).toPandas()  # at most one row for each dataset and day
        for name, rows in sums.groupby("dataset_id"):
            k = found[name]
            image = np.zeros((spans[name][1], width))
            image[rows["day"]] = rows[[f"y{k}" for k in range(width)]]
            k.step(image[:, :k.block.shape[1]])
            if k.error <= tol * max(k.value, 1e-300):
                left.discard(name)
        if not left:
            break
    else:
        raise RuntimeError(f"no convergence after {max_restarts} restarts of {max_steps} steps")
    pattern = cut_lineage(table.mapInArrow(
        _scores(spans, {name: k.best for name, k in found.items()}), f"dataset_id string, cell_id {dict(df.dtypes)['cell_id']}, v double"))
    pattern = pattern.withColumn("_u", 1.0 + uniform(F.col("cell_id"), F.lit(0), seed))
    size = pattern.groupBy("dataset_id").agg(
        F.sqrt(F.sum(F.col("v") * F.col("v"))).alias("_norm"), F.sqrt(F.sum(F.col("_u") * F.col("_u"))).alias("_any"),
        F.when(F.sum("v") < 0, -1.0).otherwise(1.0).alias("_sign"))
    value = F.when(F.col("_norm") > 0, F.col("v") / F.col("_norm") * F.col("_sign")).otherwise(F.col("_u") / F.col("_any"))
    return pattern.join(F.broadcast(size), "dataset_id").select(*K, value.alias("value"))


# A block of cells is at most that large as a dense matrix of 4-byte numbers; below that a region has at most so many blocks.
BLOCK_BYTES, MOST_BLOCKS = 16 << 20, 32


def _series(df: DataFrame, value: Column) -> DataFrame:
    """One row per (dataset, cell), stored, with its days ``t`` and values ``x`` side by side: bounded by the calendar."""
    days = by_cell(df.select(*K, "t", value.alias("x"))).groupBy(*K).agg(F.collect_list(F.struct("t", "x")).alias("_s"))
    return cut_lineage(days.select(*K, F.col("_s.t").alias("t"), F.col("_s.x").alias("x")))


def _dense(days: pa.ListArray, values: pa.ListArray, first: int, n: int, empty: float, kind: str) -> np.ndarray:
    """Lists of days and of values -> matrix (list, day from ``first``), ``empty`` where there is no value."""
    rows = np.repeat(np.arange(len(days)), days.value_lengths().to_numpy(zero_copy_only=False))
    out = np.full((len(days), n), empty, kind)
    out[rows, days.flatten().to_numpy(zero_copy_only=False) - first] = values.flatten().to_numpy(zero_copy_only=False)
    return out


def _pair_correlations(a: np.ndarray, b: np.ndarray, days: int = 1024) -> np.ndarray:
    """Correlation of every row of ``a`` with every row of ``b`` over the days both have (NaN = absent).

    The sums add up over slices of days, so the temporaries stay small however long the series are.
    """
    mean_a, mean_b = (np.nanmean(m, axis=1, keepdims=True, dtype=float) for m in (a, b))
    n, sa, sb, sab, saa, sbb = (np.zeros((len(a), len(b))) for _ in range(6))
    for start in range(0, a.shape[1], days):
        ya, yb = a[:, start:start + days], b[:, start:start + days]
        ma, mb = ~np.isnan(ya), ~np.isnan(yb)
        xa, xb = np.where(ma, ya - mean_a, 0.0), np.where(mb, yb - mean_b, 0.0)
        ma, mb = ma.astype(float), mb.astype(float)
        n += ma @ mb.T
        sa += xa @ mb.T
        sb += ma @ xb.T
        sab += xa @ xb.T
        saa += (xa * xa) @ mb.T
        sbb += ma @ (xb * xb).T
    va, vb = n * saa - sa * sa, n * sbb - sb * sb
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where((n > 1) & (va > 0) & (vb > 0), (n * sab - sa * sb) / np.sqrt(va * vb), np.nan)


def _tile(bins: int, max_km: float, side: int = 1024):
    """Sums of the correlations of all cell pairs of a pair of blocks, per distance bin.  The pairs themselves are not emitted; they are
    looked at in squares of ``side`` cells."""

    def block(cells: pa.StructArray, first: int, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        lat, lon = (cells.field(f).to_numpy(zero_copy_only=False) for f in ("lat", "lon"))
        return lat, lon, _dense(cells.field("t"), cells.field("x"), first, n, np.nan, "f4")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, (dataset, same, first, n) in enumerate(zip(*[batch.column(c).to_pylist() for c in ("dataset_id", "same", "first", "n")])):
                sums, counts = np.zeros(bins), np.zeros(bins, dtype=np.int64)
                left = block(batch.column("left")[i].values, first, n)
                right = left if same else block(batch.column("right")[i].values, first, n)
                for p in range(0, len(left[0]), side):
                    for q in range(p if same else 0, len(right[0]), side):
                        a, b = ([m[at:at + side] for m in one] for one, at in ((left, p), (right, q)))
                        corr = _pair_correlations(a[2], b[2])
                        dist = distance_km_np(a[0][:, None], a[1][:, None], b[0][None, :], b[1][None, :])
                        use = ~np.isnan(corr)
                        if same and p == q:
                            use &= np.triu(np.ones(corr.shape, dtype=bool), k=1)
                        where = np.minimum((dist[use] / max_km * bins).astype(int), bins - 1)
                        sums += np.bincount(where, weights=corr[use], minlength=bins)
                        counts += np.bincount(where, minlength=bins)
                hit = np.flatnonzero(counts)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([dataset] * len(hit), pa.string()), pa.array(hit.astype(np.int32)), pa.array(sums[hit]), pa.array(counts[hit])],
                    names=["dataset_id", "bin", "s", "n"])

    return run


def box_width_km(cells: DataFrame) -> float:
    """Longest side or diagonal of the box around the cells; no two of them are farther apart."""
    r = cells.agg(F.min("lat").alias("s"), F.max("lat").alias("n"), F.min("lon").alias("w"), F.max("lon").alias("e")).first()
    return float(max(
        distance_km_np(r["s"], r["w"], r["n"], r["e"]),
        distance_km_np(r["s"], r["w"], r["s"], r["e"]),
        distance_km_np(r["n"], r["w"], r["n"], r["e"]),
    ))


def spatial_correlogram(
    df: DataFrame, cells: DataFrame, var: str, bins: int = 99, max_km: float | None = None, block: int = 256
) -> DataFrame:
    """Mean Spearman correlation of the cell pairs of a region per distance bin: (dataset_id, bin, distance, n, value).

    All pairs are counted.  Cells are hashed to blocks of about ``block``, larger ones where there would be more than ``MOST_BLOCKS``, up
    to ``BLOCK_BYTES``.  A block is one row, stored once; a Cartesian product of the stored blocks reads them pair by pair, so series are
    exchanged once however many pairs there are, no task holds more than a few blocks, and a pair returns one row per bin.
    """
    max_km = box_width_km(cells) if max_km is None else max_km
    ranked = average_rank(by_cell(df.where(F.col(var).isNotNull()).select(*K, "t", var)), var, "r", K)
    # Halves up to the number of days: exact as 4-byte numbers.
    series = _series(ranked, F.col("r").cast("float"))
    span = series.groupBy("dataset_id").agg(
        F.min(F.array_min("t")).alias("first"), (F.max(F.array_max("t")) - F.min(F.array_min("t")) + 1).alias("n"))
    longest = span.agg(F.max("n")).first()[0] or 1
    n_cells = cells.count()
    largest = max(1, BLOCK_BYTES // (4 * longest))
    blocks = max(1, math.ceil(n_cells / max(block, min(math.ceil(n_cells / MOST_BLOCKS), largest))))
    located = series.join(cells.select("cell_id", "lat", "lon"), "cell_id").withColumn("block", F.pmod(F.hash("cell_id"), F.lit(blocks)))
    packed = located.repartition(max(cells_partitions(series), blocks), "dataset_id", "block").groupBy("dataset_id", "block").agg(
        F.collect_list(F.struct("lat", "lon", "t", "x")).alias("cells"))
    packed = cut_lineage(packed.join(F.broadcast(span), "dataset_id"))
    left = packed.select("dataset_id", "block", "first", "n", F.col("cells").alias("left"))
    right = packed.select(F.col("dataset_id").alias("_d"), F.col("block").alias("_b"), F.col("cells").alias("right"))
    # Of (i, j) and (j, i) one is taken, in turns, so that all tasks of the product have their share.
    once = (F.col("block") < F.col("_b")) == ((F.col("block") + F.col("_b")) % 2 == 0)
    same = F.col("block") == F.col("_b")
    pairs = left.join(right.hint("shuffle_replicate_nl"), (F.col("dataset_id") == F.col("_d")) & (same | once))
    sums = pairs.select("dataset_id", same.alias("same"), "first", "n", "left", "right").mapInArrow(
        _tile(bins, max_km), "dataset_id string, bin int, s double, n long")
    width = max_km / bins
    return sums.groupBy("dataset_id", "bin").agg(
        ((F.col("bin") + 0.5) * width).alias("distance"),
        F.sum("n").alias("n"),
        (F.sum("s") / F.sum("n")).alias("value"),
    )


def correlation_length(correlogram: DataFrame, thresh: float = 0.35) -> DataFrame:
    """Shortest distance at which the correlation is below the threshold; NULL if it never is."""
    below = F.when(F.col("value") < thresh, F.col("distance"))
    return correlogram.groupBy("dataset_id").agg(F.min(below).alias("length_km"))
