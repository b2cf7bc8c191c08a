"""Brute force in numpy against the distributed kernels."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from graticule.functions import geo, quantiles as Q
from graticule.operators import properties as M, regrid as G, selection as S, spatial as Z, spells as V


@pytest.fixture(scope="module")
def field(spark):
    rng = np.random.default_rng(3)
    lat, lon = np.meshgrid(45 + 0.5 * np.arange(5), -75 + 0.5 * np.arange(6), indexing="ij")
    common = rng.normal(size=80)
    rows = []
    for c, (a, o) in enumerate(zip(lat.ravel(), lon.ravel())):
        x = common * (1 + 0.1 * c) + rng.normal(size=80)
        for t in range(80):
            if (t * 7 + c) % 11:
                rows.append(("d", c, t, float(np.round(x[t], 1))))
    cells = pd.DataFrame({"cell_id": range(30), "lat": lat.ravel(), "lon": lon.ravel()})
    daily = pd.DataFrame(rows, columns=["dataset_id", "cell_id", "t", "x"])
    return daily, cells, spark.createDataFrame(daily).cache(), spark.createDataFrame(cells).cache()


def test_correlogram_counts_every_pair(field):
    daily, cells, sdaily, scells = field
    ranks = daily.assign(r=daily.groupby("cell_id").x.rank()).pivot(index="t", columns="cell_id", values="r")
    corr = ranks.corr(min_periods=2).to_numpy()
    la, lo = cells.lat.to_numpy(), cells.lon.to_numpy()
    dist = geo.distance_km_np(la[:, None], lo[:, None], la[None], lo[None])
    i, j = np.triu_indices(30, 1)
    bins = np.minimum((dist[i, j] / Z.box_width_km(scells) * 12).astype(int), 11)
    want = pd.DataFrame({"bin": bins, "c": corr[i, j]}).groupby("bin").c.agg(["mean", "size"])
    got = Z.spatial_correlogram(sdaily, scells, "x", bins=12, block=7).toPandas().set_index("bin").sort_index()
    assert got.n.sum() == 30 * 29 // 2
    assert np.allclose(got.value, want["mean"]) and (got.n == want["size"]).all()
    assert Z.correlation_length(sdaily.sparkSession.createDataFrame(got.assign(dataset_id="d")), -2.0).first().length_km is None


def test_correlogram_copies_no_series_to_other_blocks(field, monkeypatch):
    _, _, sdaily, scells = field
    want = Z.spatial_correlogram(sdaily, scells, "x", bins=12, block=30).orderBy("bin").collect()
    for most, size in ((32, 16 << 20), (3, 16 << 20), (3, 4 * 80 * 6)):
        monkeypatch.setattr(Z, "MOST_BLOCKS", most)
        monkeypatch.setattr(Z, "BLOCK_BYTES", size)
        out = Z.spatial_correlogram(sdaily, scells, "x", bins=12, block=1)
        plan = out._jdf.queryExecution().toString()
        assert "CartesianProduct" in plan and "explode" not in plan
        got = out.orderBy("bin").collect()
        assert [(r.bin, r.n) for r in got] == [(r.bin, r.n) for r in want]
        assert np.allclose([r.value for r in got], [r.value for r in want])


@pytest.mark.parametrize("kind, thresh", [("+", None), ("*", 0.1)])
def test_first_eof_equals_dense_svd(field, kind, thresh):
    daily, _, sdaily, _ = field
    m = daily.pivot(index="t", columns="cell_id", values="x")
    m = m if kind == "+" else np.log(np.maximum(m, thresh))
    v = np.linalg.svd((m - m.mean()).fillna(0).to_numpy(), full_matrices=False)[2][0]
    got = Z.first_eof(sdaily, "x", kind, thresh).orderBy("cell_id").toPandas().value.to_numpy()
    assert np.allclose(got, v * np.sign(v.sum()), atol=1e-6)


def test_first_eof_restarts(field):
    daily, _, sdaily, _ = field
    m = daily.pivot(index="t", columns="cell_id", values="x")
    v = np.linalg.svd((m - m.mean()).fillna(0).to_numpy(), full_matrices=False)[2][0]
    got = Z.first_eof(sdaily, "x", max_steps=4, tol=1e-6).orderBy("cell_id").toPandas().value.to_numpy()
    assert np.allclose(got, v * np.sign(v.sum()), atol=1e-4)
    with pytest.raises(RuntimeError, match="restarts"):
        Z.first_eof(sdaily, "x", max_steps=2, tol=0.0, max_restarts=1)


def test_first_eof_of_noise_takes_few_passes(spark):
    m = np.random.default_rng(5).normal(size=(60, 90))
    rows = [("d", c, 700 + t, float(m[t, c])) for t in range(60) for c in range(90)] + [("flat", c, 5, 1.0) for c in range(4)]
    df = spark.createDataFrame(rows, "dataset_id string, cell_id int, t int, x double")
    got = Z.first_eof(df, "x", max_steps=9, max_restarts=0).orderBy("dataset_id", "cell_id").toPandas()
    v = np.linalg.svd(m - m.mean(axis=0), full_matrices=False)[2][0]
    assert np.allclose(got[got.dataset_id == "d"].value, v * np.sign(v.sum()), atol=1e-6)
    assert np.isclose((got[got.dataset_id == "flat"].value ** 2).sum(), 1.0)


@pytest.mark.parametrize("values", [
    np.arange(7.0), np.r_[np.zeros(4000), np.arange(2000.0)], np.random.default_rng(1).normal(size=5000), np.array([3.0]),
])
def test_pooled_quantiles_are_exact(spark, values):
    qs = [0.0, 0.01, 0.25, 1 / 3, 0.5, 0.9, 0.999, 1.0]
    df = spark.createDataFrame(pd.DataFrame({"k": "a", "x": values}))
    for most, parts in ((10**6, 1000), (300, 10), (50, 7)):
        got = {r.q: r.value for r in Q.pooled(df, ["k"], "x", qs, most, parts).collect()}
        assert np.allclose([got[q] for q in qs], np.quantile(values, qs)), (most, parts)


def test_ragged_quantiles():
    arrays = [np.array([1.0]), np.array([]), np.arange(10.0)]
    got = Q.of_sorted_arrays_np(arrays, np.array([0.0, 0.5, 1.0]))
    assert np.allclose(got, [[1, 1, 1], [np.nan] * 3, [0, 4.5, 9]], equal_nan=True)


def test_average_ranks_with_ties(spark):
    df = spark.createDataFrame([("d", 1, t, v) for t, v in enumerate([3.0, 1.0, 3.0, None, 2.0, 3.0])], "dataset_id string, cell_id int, t int, x double")
    got = [r.x_rank for r in V.average_rank(df, "x").orderBy("t").collect()]
    assert got == [4.0, 1.0, 4.0, None, 2.0, 4.0]


def test_bilinear_is_exact_on_a_plane_and_null_outside(spark):
    axes = G.Axes(-75.0, 0.5, 5, 45.0, 0.5, 5)
    src = spark.range(25).select(
        F.lit("d").alias("dataset_id"), F.col("id").cast("int").alias("cell_id"), F.lit(0).alias("t"),
        ((45 + F.expr("id div 5") * 0.5) * 2 - (-75 + F.col("id") % 5 * 0.5) * 3).alias("x"),
    )
    targets = spark.createDataFrame([(0, 45.2, -74.3), (1, 47.0, -73.0), (2, 45.0, -75.0), (3, 44.9, -74.0), (4, 46.1, -72.9)], "cell_id int, lat double, lon double")
    weights = G.bilinear_weights(axes, targets)
    got = {r.cell_id: r.x for r in G.regrid(src, weights, ["x"]).collect()}
    assert set(got) == {0, 1, 2, 3, 4} and got[3] is None and got[4] is None
    for c, lat, lon in ((0, 45.2, -74.3), (1, 47.0, -73.0), (2, 45.0, -75.0)):
        assert got[c] == pytest.approx(2 * lat - 3 * lon)
    holed = src.withColumn("x", F.when(F.col("cell_id") != 0, F.col("x")))
    assert {r.cell_id: r.x for r in G.regrid(holed, weights, ["x"]).collect()}[2] is None


def test_large_weights_move_coarse_rows_only(spark):
    axes = G.Axes(-75.0, 0.5, 5, 45.0, 0.5, 5)
    src = spark.range(25 * 40).select(
        F.lit("d").alias("dataset_id"), (F.col("id") % 25).cast("int").alias("cell_id"), F.expr("cast(id div 25 as int)").alias("t"),
        F.sin(F.col("id")).alias("x"))
    targets = spark.range(900).select(
        F.col("id").cast("int").alias("cell_id"), (44.9 + F.expr("id div 30") * 0.07).alias("lat"), (-75.0 + F.col("id") % 30 * 0.07).alias("lon"))
    weights = G.bilinear_weights(axes, targets)
    small = G.regrid(src, weights, ["x"])
    tiled = G.regrid(src, weights, ["x"], broadcast_bytes=0, tile_cells=90, rows_per_partition=200)
    key = lambda r: (r.t, r.cell_id)
    a, b = sorted(small.collect(), key=key), sorted(tiled.collect(), key=key)
    assert [key(r) for r in a] == [key(r) for r in b] and len(a) == 900 * 40
    assert all(x.x is None and y.x is None or abs(x.x - y.x) < 1e-12 for x, y in zip(a, b))
    plan = tiled._jdf.queryExecution().executedPlan().toString()
    above = plan[:plan.index("Join")]
    assert "Exchange" not in above


def test_nearest_cell_equals_brute_force(spark):
    rng = np.random.default_rng(5)
    cells = pd.DataFrame({"cell_id": range(400), "lat": 60 + rng.uniform(0, 3, 400), "lon": -120 + rng.uniform(0, 3, 400)})
    st = pd.DataFrame({"station_id": [f"s{i}" for i in range(60)], "lat": 59.8 + rng.uniform(0, 3.4, 60), "lon": -120.2 + rng.uniform(0, 3.4, 60)})
    got = {r.station_id: r.cell_id for r in S.nearest_cell(spark.createDataFrame(st), spark.createDataFrame(cells)).collect()}
    d = geo.distance_km_np(st.lat.to_numpy()[:, None], st.lon.to_numpy()[:, None], cells.lat.to_numpy()[None], cells.lon.to_numpy()[None])
    want = {s: int(i) for s, i in zip(st.station_id, d.argmin(1))}
    assert got == want and (d.min(1) > 10).any()


def test_nearest_cell_across_the_date_line_and_far_away(spark):
    cells = spark.createDataFrame([(1, 0.0, -179.9), (2, 0.0, 179.0), (3, 60.0, 10.0)], "cell_id int, lat double, lon double")
    st = spark.createDataFrame([("a", 0.0, 179.95), ("b", -80.0, 12.0), ("c", 59.0, -170.0), ("d", 60.0, 10.0)], "station_id string, lat double, lon double")
    got = {r.station_id: r.cell_id for r in S.nearest_cell(st, cells).collect()}
    assert got["a"] == 1 and got["d"] == 3 and set(got) == set("abcd")
    assert {r.cell_id for r in S.nearest_cell(st, cells.limit(0)).collect()} == {None}


def test_nearest_cell_of_far_stations_looks_at_few_boxes(spark):
    from graticule.operators import nearest as N
    rng = np.random.default_rng(6)
    cells = pd.DataFrame({"cell_id": range(40_000), "lat": 40 + np.repeat(np.arange(200), 200) * 0.1, "lon": -120 + np.tile(np.arange(200), 200) * 0.1})
    st = pd.DataFrame({"station_id": range(200), "lat": np.r_[40 + rng.uniform(0, 20, 100), rng.uniform(-89, 0, 100)],
                       "lon": np.r_[-120 + rng.uniform(0, 20, 100), 40 + rng.uniform(0, 60, 100)]})
    frames = [spark.createDataFrame(x) for x in (st, cells)]
    got = {r.station_id: (r.cell_id, r.distance_km) for r in N.nearest_cell(*frames).collect()}
    d = geo.distance_km_np(st.lat.to_numpy()[:, None], st.lon.to_numpy()[:, None], cells.lat.to_numpy()[None], cells.lon.to_numpy()[None])
    assert all(got[i][1] == pytest.approx(d[i].min(), abs=1e-6) for i in range(200)) and len(got) == 200
    left, placed = N.candidates(*frames)
    boxes = left.groupBy("station_id").count().toPandas()["count"]
    assert boxes.max() <= 128 and boxes.mean() < 16 and placed.groupBy("row", "col").count().agg(F.max("count")).first()[0] <= 64


def test_annual_cycle_of_a_sine(spark):
    df = spark.range(730).select(
        F.lit("d").alias("dataset_id"), F.lit(1).alias("cell_id"), (2001 + F.expr("id div 365")).cast("int").alias("year"),
        (283 + 10 * F.sin(2 * np.pi * (F.col("id") % 365 + 1) / 365)).alias("tasmax"))
    assert M.annual_cycle_amplitude(df, "tasmax").first().value == pytest.approx(20, abs=0.01)


def test_tiled_regridding_moves_coarse_rows_once_in_groups_of_a_set_size(spark):
    from graticule.operators import regrid as G
    axes = G.Axes(0.0, 1.0, 8, 0.0, 1.0, 8)
    cells = spark.range(400).selectExpr("CAST(id AS INT) AS cell_id", "(id div 20) * 0.4D AS lat", "(id % 20) * 0.36D AS lon")
    weights = G.bilinear_weights(axes, cells)
    src = spark.range(64 * 50).selectExpr("'a' AS dataset_id", "CAST(id % 64 AS INT) AS cell_id", "CAST(id div 64 AS INT) AS t", "CAST(id AS DOUBLE) AS x")
    whole = G.regrid(src, weights, ["x"])
    tiled = G.regrid(src, weights, ["x"], broadcast_bytes=0, tile_cells=100, rows_per_partition=100)
    plan = tiled._jdf.queryExecution().executedPlan().toString()
    # Coarse rows and weights are dealt to their tiles; the days that stand for targets outside are found apart.
    assert plan.count("Exchange hashpartitioning(_tile") == 2 and "Window" not in plan
    key = lambda df: sorted(map(tuple, df.select("dataset_id", "t", "cell_id", "x").collect()), key=repr)
    assert key(whole) == key(tiled) and whole.where("x IS NULL").count() == 50 * weights.where("src_cell = -1").count() > 0


def test_regridding_has_partitions_for_its_sums(spark):
    from graticule.operators import regrid as G
    cells = spark.range(300).selectExpr("CAST(id AS INT) AS cell_id", "(id div 20) * 0.4D AS lat", "(id % 20) * 0.3D AS lon")
    weights = G.bilinear_weights(G.Axes(0.0, 1.0, 8, 0.0, 1.0, 8), cells)
    src = spark.range(64 * 50).selectExpr("'a' AS dataset_id", "CAST(id % 64 AS INT) AS cell_id", "CAST(id div 64 AS INT) AS t", "CAST(id AS DOUBLE) AS x")
    whole, fine = G.regrid(src, weights, ["x"]), G.regrid(src, weights, ["x"], rows_per_partition=500)
    parts = lambda df: df._jdf.queryExecution().executedPlan().toString()
    assert ", 30), REPARTITION_BY_NUM" in parts(fine) and ", 30), REPARTITION_BY_NUM" not in parts(whole)
    key = lambda df: sorted(map(tuple, df.select("dataset_id", "t", "cell_id", "x").collect()), key=repr)
    assert key(whole) == key(fine) and len(key(fine)) == 300 * 50


def rotated(n, angle, step=0.3, lon0=179.5, lat0=60.0):
    """A curved grid over the date line: rows and columns on circles."""
    i, j = (a.ravel() for a in np.meshgrid(np.arange(n), np.arange(n)))
    r, phi = 20 + step * j, np.deg2rad(angle + step * i)
    return i, j, lat0 + r * np.sin(phi) - 10, (lon0 + r * np.cos(phi) + 180) % 360 - 180


def test_curvilinear_weights_reproduce_the_targets(spark):
    from graticule.operators import curvilinear as Q, regrid as G
    n = 14
    i, j, lat, lon = rotated(n, 20)
    rows = [(int(k), int(a), int(b), float(y), float(x)) for k, (a, b, y, x) in enumerate(zip(i, j, lat, lon))]
    source = spark.createDataFrame(rows, "cell_id int, i int, j int, lat double, lon double")
    rng = np.random.default_rng(5)
    u, v = rng.uniform(0, n - 1.001, 300), rng.uniform(0, n - 1.001, 300)
    rel = (lon - lon[0] + 180) % 360 - 180
    a, b = u.astype(int), v.astype(int)
    at = lambda grid, x, y: grid[y * n + x]
    mix = lambda g: sum(
        at(g, a + di, b + dj) * np.abs(1 - di - (u - a)) * np.abs(1 - dj - (v - b)) for di in (0, 1) for dj in (0, 1))
    aims = [(k, float(y), float(x)) for k, (y, x) in enumerate(zip(mix(lat), mix(rel) + lon[0]))] + [(900, 0.0, 0.0), (901, 89.0, 10.0)]
    # A corner of the grid and longitudes given in another range.
    aims += [(902, float(lat[0]), float(lon[0])), (903, aims[0][1], aims[0][2] + 360), (904, aims[1][1], aims[1][2] - 360)]
    got = Q.curvilinear_weights(source, spark.createDataFrame(aims, "cell_id int, lat double, lon double")).toPandas()
    by = dict(tuple(got.groupby("dst_cell")))
    assert set(by) == {t for t, _, _ in aims}
    for t, y, x in aims:
        w = by[t]
        if t in (900, 901):
            assert w.src_cell.tolist() == [G.NOWHERE] and w.w.isna().all()
            continue
        src = w.src_cell.to_numpy()
        assert len(w) == 4 and w.w.sum() == pytest.approx(1) and (w.w >= 0).all()
        assert w.w.to_numpy() @ lat[src] == pytest.approx(y, abs=1e-9)
        assert (w.w.to_numpy() @ rel[src] - (x - lon[0]) + 180) % 360 - 180 == pytest.approx(0, abs=1e-9)
        if t < 300:
            assert set(src) == {(b[t] + dj) * n + a[t] + di for di in (0, 1) for dj in (0, 1)}
    assert Q.curvilinear_weights(source.where("i < 1"), spark.createDataFrame(aims, "cell_id int, lat double, lon double")).where("src_cell >= 0").count() == 0
