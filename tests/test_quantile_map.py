"""Closed forms and brute force for the bias adjustment."""

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from graticule.functions import calendars as C
from graticule.operators import day_windows as D, quantile_map as B

PERIOD = (2001, 2004)


def series(spark, name, expr, years=PERIOD, cells=2, calendar="noleap", var="tasmax"):
    n = 365 if calendar == "noleap" else 360
    df = (
        spark.range(cells).select(F.col("id").cast("int").alias("cell_id"))
        .withColumn("year", F.explode(F.sequence(F.lit(years[0]), F.lit(years[1]))))
        .withColumn("doy", F.explode(F.sequence(F.lit(1), F.lit(n))))
        .withColumns({"dataset_id": F.lit(name), "calendar": F.lit(calendar), "t": (F.col("year") * n + F.col("doy") - 1).cast("int")})
        .withColumn("noise", F.pmod(F.col("t").cast("long") * 7919 + F.col("cell_id") * 31, F.lit(1009)) / 100.0)
    )
    return C.with_civil_parts(df.withColumn(var, F.expr(expr)))


def conf(var, kind, **kw):
    return B.Conf({var: B.VariableConf(kind, **kw)}, PERIOD, PERIOD, loess_f=0.6)


def adjusted(ref, sim, c):
    var = next(iter(c.variables))
    out = B.adjust(B.train(ref, sim, c), sim, c)
    both = out.select("cell_id", "t", F.col(var).alias("y")).join(sim.select("cell_id", "t", F.col(var).alias("x")), ["cell_id", "t"])
    return both.toPandas()


def test_identity(spark):
    x = series(spark, "a", "280 + noise")
    got = adjusted(x, x.withColumn("dataset_id", F.lit("sim")), conf("tasmax", "+"))
    assert len(got) == 2 * 4 * 365
    assert np.allclose(got.x, got.y)


def test_additive_shift_is_removed(spark):
    ref, hist = series(spark, "ref", "280 + noise"), series(spark, "sim", "283 + noise")
    got = adjusted(ref, hist, conf("tasmax", "+"))
    assert np.allclose(got.x - 3, got.y)


def test_factor_is_removed_in_360_day_calendar(spark):
    ref = series(spark, "ref", "5 + noise", calendar="360_day", var="pr")
    hist = series(spark, "sim", "1.5 * (5 + noise)", calendar="360_day", var="pr")
    got = adjusted(ref, hist, conf("pr", "*"))
    assert len(got) == 2 * 4 * 360
    assert np.allclose(got.x / 1.5, got.y)


def test_trend_is_preserved(spark):
    ref = series(spark, "ref", "280 + noise")
    hist = series(spark, "sim", "283 + noise + 0.5 * (year - 2001)")
    got = adjusted(ref, hist, conf("tasmax", "+"))
    means = got.assign(year=got.t // 365).groupby("year")[["x", "y"]].mean()
    assert np.allclose(np.diff(means.x), np.diff(means.y), atol=0.05)


def test_tasmin_never_exceeds_tasmax(spark):
    base = series(spark, "ref", "280 + noise").withColumns({"tasmin": F.col("tasmax") - 1 - F.col("noise"), "pr": F.col("noise") - 3})
    base = base.withColumn("pr", F.greatest("pr", F.lit(0.0)))
    sim = base.withColumns({"dataset_id": F.lit("sim"), "tasmax": F.col("tasmax") + 2, "pr": F.greatest(F.col("pr") - 1, F.lit(0.0))})
    c = B.Conf(B.STANDARD_VARIABLES, PERIOD, PERIOD, loess_f=0.6)
    out = B.adjust(B.train(base, sim, c), sim, c)
    row = B.check_physical(out).first()
    assert row.tasmin_over_tasmax == 0 and row.negative_pr == 0
    assert out.where("tasmin IS NULL").count() == 0


def test_windows_equal_brute_force_with_gaps(spark):
    x = series(spark, "ref", "noise", cells=1).where("pmod(t, 7) <> 3 AND doy NOT BETWEEN 100 AND 140")
    got = B.doy_window_arrays(B.to_series(x, ["tasmax"]), PERIOD).toPandas()
    raw = x.select("t", "tasmax").toPandas()
    first, last = PERIOD[0] * 365, PERIOD[1] * 365 + 364
    want = {}
    for t, v in zip(raw.t, raw.tasmax):
        for target in range(max(first, t - 15), min(last, t + 15) + 1):
            want.setdefault(target % 365 + 1, []).append(v)
    assert set(got.doy) == set(want)
    for doy, arr, mean in zip(got.doy, got.arr, got["mean"]):
        assert np.array_equal(arr, np.sort(want[doy]))
        assert mean == pytest.approx(np.mean(want[doy]))


def test_jitter_is_reproducible_and_inside_the_bounds(spark):
    c = conf("pr", "*", jitter_under=0.01)
    x = B.to_series(series(spark, "sim", "CASE WHEN doy % 2 = 0 THEN 0.0D ELSE noise + 1 END", var="pr"), ["pr"])
    a = B.jitter_under(x, c, 7).orderBy("cell_id", "t").toPandas().x.to_numpy()
    b = B.jitter_under(x.repartition(3), c, 7).orderBy("cell_id", "t").toPandas().x.to_numpy()
    assert np.array_equal(a, b)
    low = a[a < 1]
    assert len(low) and (low > 0).all() and (low < 0.01).all() and len(np.unique(low)) > len(low) // 2


def flat(*rows):
    return D.Windows(np.concatenate([np.sort(np.array(r, float)) for r in rows]), np.array([len(r) for r in rows]))


def test_frequency_adaptation():
    ref, hist = [0.0] * 4 + [2.0, 3.0, 4.0, 5.0, 6.0, 7.0], [0.0] * 7 + [0.5, 4.0, 6.0]
    out = D.adapted(flat(ref, hist, [], ref), flat(hist, ref, hist, []), 1.0, 1, 5)
    assert out.counts.tolist() == [10, 10, 10, 0]
    got = out.values[:10].tolist()
    # 8 of 10 are dry, 4 of 10 in the reference: 4 dry days become wet, up to the reference's 0.8 quantile (5.2).
    assert sum(v < 1 for v in got) == 4 and len(got) == 10 and got == sorted(got)
    assert all(1 <= v <= 5.2 for v in sorted(set(got) - {0.0, 4.0, 6.0}))
    assert out.values[10:20].tolist() == ref and out.values[20:].tolist() == hist


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 2**31), st.sampled_from([360, 365]), st.integers(0, 20), st.floats(0, 1))
def test_windows_equal_a_search_for_each_day(seed, n, half, share):
    rng = np.random.default_rng(seed)
    year, doy = (a.ravel() for a in np.meshgrid([2001, 2002, 2004], np.arange(1, n + 1)))
    x = np.round(rng.normal(size=len(doy)), 1)
    x[rng.random(len(x)) < share] = np.nan
    keep = rng.random(len(x)) < 0.9
    year, doy, x = year[keep], doy[keep], x[keep]
    got = D.windows(year, doy, x, n, (2001, 2004), half)
    t = year * n + doy - 1
    means, q = got.means(), got.quantiles(np.array([[0.0, 0.3, 1.0]]))
    for d in [1, 2, half + 1, 100, n - half, n]:
        if not 1 <= d <= n:
            continue
        want = [v for y in (2001, 2002, 2003, 2004) for v in x[(np.abs(t - (y * n + d - 1)) <= half) & ~np.isnan(x)]]
        at = got.starts[d - 1]
        assert got.values[at:at + got.counts[d - 1]].tolist() == sorted(want)
        if want:
            assert means[d - 1] == pytest.approx(np.mean(want)) and np.allclose(q[d - 1], np.quantile(want, [0, 0.3, 1]))
        else:
            assert np.isnan(means[d - 1]) and np.isnan(q[d - 1]).all()


def test_loess_weights():
    w = B.loess_weights(150, 0.2)
    assert (w[75] > 0).sum() == 29 and w[75].argmax() == 75
    assert (w[0] > 0).sum() == 29 and w[0, 29] == 0
    assert np.allclose(B._smooth(np.full((3, 150), 280.0), w), 280.0)
    m = np.full((1, 150), 280.0)
    m[0, 40:60] = np.nan
    assert np.allclose(B._smooth(m, w), 280.0)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.floats(-50, 50), min_size=2, max_size=30), st.lists(st.floats(-60, 60), min_size=1, max_size=10))
def test_nearest_is_the_lowest_of_the_nearest(levels, xs):
    q = np.sort(np.array(levels))
    (got,) = B._nearest(q[None, :], np.array([xs]))
    for x, i in zip(xs, got):
        gaps = np.abs(q - x)
        assert gaps[i] <= gaps.min() + 1e-9
        assert i == 0 or q[i - 1] < q[i]


def test_training_on_years_of_unequal_length_raises(spark, sf_dir):
    from checks import fixtures as X
    daily = X.daily(spark, sf_dir)
    conf = B.Conf(B.STANDARD_VARIABLES, X.REF_PERIOD, X.TARGET, loess_f=0.6)
    with pytest.raises(Exception, match="equal length"):
        B.train(X.dataset(daily, "ref"), X.dataset(daily, "sim"), conf).count()
    nl = X.noleap(spark, sf_dir)
    training = B.train(X.dataset(nl, "ref"), X.dataset(nl, "sim"), conf)
    with pytest.raises(Exception, match="equal length"):
        B.apply_factors(training, X.dataset(daily, "sim"), conf).count()


def test_seeds_cells_and_days_give_unrelated_numbers(spark):
    from graticule.functions.randoms import uniform
    rows = spark.range(40_000).select(
        *[uniform(F.expr("id div 200"), F.expr("id % 200"), s).alias(f"s{s}") for s in (42, 43)],
        uniform(F.expr("id div 200 + 1"), F.expr("id % 200"), 42).alias("cell"), uniform(F.expr("id div 200"), F.expr("id % 200 + 1"), 42).alias("day"),
    ).toPandas()
    c = np.corrcoef(rows.to_numpy().T)
    assert np.abs(c - np.eye(4)).max() < 0.02 and rows.min().min() > 0 and rows.max().max() < 1
    assert abs(rows.s42.mean() - 0.5) < 0.01 and len(rows.s42.unique()) > 39_900
    # The gaps of neighbouring days fill the circle evenly: no lattice.
    gaps = (rows.day - rows.s42) % 1
    assert np.abs(np.histogram(gaps, 20, (0, 1))[0] - 2000).max() < 250


def test_numbers_in_numpy_and_in_columns_agree_and_plans_stay_short(spark):
    from graticule.functions.randoms import uniform, uniform_np
    a, b, c = F.col("id"), F.col("id") % 7 - 3, F.col("id") * 1_000_003
    rows = spark.range(2000).select("id", uniform(a, b, 42).alias("two"), uniform(a, b, 43, c).alias("three")).toPandas()
    assert np.array_equal(rows.two, uniform_np(42, rows.id, np.fmod(rows.id, 7) - 3))
    assert np.array_equal(rows.three, uniform_np(43, rows.id, np.fmod(rows.id, 7) - 3, rows.id * 1_000_003))
    plan = spark.range(5).select(uniform(a, b, 42))._jdf.queryExecution().optimizedPlan().toString()
    assert len(plan) < 3000


def test_training_moves_days_once_per_side(spark, sf_dir):
    from checks import fixtures as X
    nl = X.noleap(spark, sf_dir).persist()
    conf = B.Conf(B.STANDARD_VARIABLES, X.REF_PERIOD, X.TARGET, loess_f=0.6)
    plan = B.train(X.dataset(nl, "ref"), X.dataset(nl, "sim"), conf)._jdf.queryExecution().executedPlan().toString()
    nl.unpersist()
    initial = plan[plan.index("Initial Plan"):] if "Initial Plan" in plan else plan
    assert initial.split("InMemoryRelation")[0].count("Exchange") <= 4


def test_adjustment_moves_factors_once(spark, sf_dir):
    from checks import fixtures as X
    nl = X.noleap(spark, sf_dir)
    conf = B.Conf(B.STANDARD_VARIABLES, X.REF_PERIOD, X.TARGET, loess_f=0.6)
    training = B.train(X.dataset(nl, "ref"), X.dataset(nl, "sim"), conf)
    assert B.hashed_by_cell(training) is None
    plan = B.apply_factors(training, X.dataset(nl, "sim"), conf)._jdf.queryExecution().executedPlan().toString()
    below = plan[:plan.index("MapInArrow")]
    moved = [line for line in below.splitlines() if "Exchange hashpartitioning" in line and "date#" not in line]  # not those that make the daily table
    assert len(moved) == 2 and all("hashpartitioning(cell_id" in line for line in moved)


def test_training_where_the_days_are_adjusted_gives_what_rows_of_factors_give(spark):
    """Two members in two calendars, gaps, NULLs, a cell without reference, one without training days, batches that end inside cells."""
    years = (2001, 2006)

    def days(name, calendar, cells, shift):
        x = series(spark, name, f"280 + noise + {shift}", years, cells, calendar)
        return x.withColumns({
            "tasmin": F.expr(f"tasmax - 1 - pmod(t * 31 + cell_id, 17) / (3.0 + {shift})"),
            "pr": F.expr(f"CASE WHEN pmod(t, 11) <> 5 THEN greatest(0, noise - 4 - {shift}) END").cast("double"),
        }).where("pmod(t * 7 + cell_id, 13) <> 3 AND NOT (cell_id = 1 AND doy BETWEEN 100 AND 180)")

    ref = days("ref", "noleap", 3, 0).unionByName(days("ref", "360_day", 3, 0))
    sim = days("a", "noleap", 4, 2).unionByName(days("b", "360_day", 3, 1).where("cell_id <> 2 OR year > 2004")).unionByName(days("c", "noleap", 2, 1))
    c = B.Conf(B.STANDARD_VARIABLES, PERIOD, years, loess_f=0.6)
    training = B.train(ref, sim, c)
    got, want = B.adjust(training, sim, c), B.assemble(B.apply_factors(training, sim, c))
    assert got.dtypes == want.dtypes
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "700")
    try:
        got, want = (df.toPandas().sort_values(["dataset_id", "cell_id", "t"], ignore_index=True) for df in (got, want))
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    assert len(got) == sim.count() and got.drop(columns=["tasmax", "tasmin", "pr"]).equals(want.drop(columns=["tasmax", "tasmin", "pr"]))
    for v in ("tasmax", "tasmin", "pr"):
        assert np.allclose(got[v].astype(float), want[v].astype(float), rtol=1e-12, atol=1e-12, equal_nan=True)
    no_factors = got.tasmax.isna().groupby([got.dataset_id, got.cell_id]).mean()
    assert no_factors["a", 3] == no_factors["b", 2] == 1 and (no_factors.drop([("a", 3), ("b", 2)]) < 0.3).all()


def test_adjustment_after_training_moves_days_alone(spark, sf_dir):
    from checks import fixtures as X
    daily, nl = X.daily(spark, sf_dir), X.noleap(spark, sf_dir)
    conf = B.Conf(B.STANDARD_VARIABLES, X.REF_PERIOD, X.TARGET, loess_f=0.6)
    training = B.train(X.dataset(nl, "ref"), X.dataset(nl, "sim"), conf)
    plan = B.adjust(training, X.dataset(nl, "sim"), conf)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1 and "ArrowEvalPython" not in plan and "Exchange" not in plan[:plan.index("MapInArrow")]
    moved = [line for line in plan.splitlines() if "Exchange hashpartitioning(cell_id" in line]
    assert len(moved) == 1 and "af#" not in plan and "hist_q#" not in plan
    # A table made from the factors is joined as it is, and years of unequal length still raise.
    changed = training.withColumn("scaling", F.lit(None).cast("double"))
    assert B.adjust(changed, X.dataset(nl, "sim"), conf).where("pr IS NOT NULL OR tasmax IS NOT NULL").count() == 0
    with pytest.raises(Exception, match="equal length"):
        B.adjust(training, X.dataset(daily, "sim"), conf).count()
    with pytest.raises(Exception, match="equal length"):
        B.adjust(B.train(X.dataset(daily, "ref"), X.dataset(daily, "sim"), conf), X.dataset(nl, "sim"), conf).count()


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 2**31), st.integers(1, 40), st.integers(0, 16))
def test_moving_means_equal_a_search_for_each_day(seed, n, half):
    rng = np.random.default_rng(seed)
    t, x = rng.integers(0, 60, n).astype(np.int32), rng.normal(size=(2, n))
    x[rng.random(x.shape) < 0.3] = np.nan
    got = B._moving_means(t, x, half)
    for row, means in zip(x, got):
        for day, mean in zip(t, means):
            near = row[(np.abs(t - day) <= half) & ~np.isnan(row)]
            assert mean == pytest.approx(near.mean()) if len(near) else np.isnan(mean)


def exchanges_around_the_kernel(spark, sf_dir, name):
    """Exchanges above the kernel that trains and adjusts, and those by cell below it."""
    import __spark_entry__ as entry
    plan = entry.queries()[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    above, below = plan.split("MapInArrow")
    return [[line for line in part.splitlines() if f"Exchange hashpartitioning({key}" in line] for part, key in ((above, ""), (below, "cell_id"))]


def test_monthly_means_of_a_scenario_move_days_and_months(spark, sf_dir):
    above, below = exchanges_around_the_kernel(spark, sf_dir, "dqm_monthly_mean")
    assert len(above) == 1 and "hashpartitioning(dataset_id" in above[0] and "_groupingexpression" in above[0] and len(below) == 1


def test_check_of_a_scenario_moves_days_and_counts(spark, sf_dir):
    above, below = exchanges_around_the_kernel(spark, sf_dir, "dqm_check_physical")
    assert len(above) == 1 and "hashpartitioning(dataset_id" in above[0] and "cell_id" not in above[0] and len(below) == 1
