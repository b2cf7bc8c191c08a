"""The three workflows end to end on the smallest tables."""

import pytest
from pyspark.sql import functions as F

from checks import fixtures as X
from graticule.operators import quantile_map as B, regrid as G, selection as S
from graticule.operators.definitions import named, standard_indicators, standard_properties
from graticule.plans import diagnostics, indices, scenario


@pytest.fixture(scope="module")
def inputs(spark, sf_dir):
    daily = X.daily(spark, sf_dir)
    # One source cell per corner of a 2 x 2 grid, one target in its middle, reference values at the target.
    sim = X.dataset(daily, "sim").where("cell_id = 0")
    corners = sim.drop("cell_id").withColumn("cell_id", F.explode(F.array(*[F.lit(i) for i in range(4)])))
    ref = X.dataset(daily, "ref").where("cell_id = 0")
    cells = spark.createDataFrame([(0, 45.05, -74.95)], "cell_id int, lat double, lon double")
    weights = G.bilinear_weights(G.Axes(-75.0, 0.1, 2, 45.0, 0.1, 2), cells)
    return ref, corners, cells, weights


def test_scenario_is_produced_and_continued(spark, inputs, tmp_path):
    ref, sim, cells, weights = inputs
    conf = B.Conf(B.STANDARD_VARIABLES, X.REF_PERIOD, X.TARGET, loess_f=0.6)
    # The land mask looks at day 130 of the series, which this thin table must have.
    t0 = ref.agg(F.min("t")).first()[0]
    ref = ref.withColumn("t", F.when(F.col("t") == ref.where(f"t >= {t0 + 130}").agg(F.min("t")).first()[0], F.lit(t0 + 130)).otherwise(F.col("t")))
    args = (spark, ref, sim, cells, weights, S.PROCESSING_REGIONS["middle"], conf, X.FUT_PERIOD, str(tmp_path / "s"))
    scen = scenario.produce(*args)
    want = sim.where("cell_id = 0 AND NOT (month = 2 AND day = 29)").count()
    assert scen.count() == want
    again = scenario.produce(*args)
    assert again.count() == want
    store = scenario.Store.at(spark, str(tmp_path / "s"), sim)
    final = store.final.read()
    assert final.count() == (X.TARGET[1] - X.TARGET[0] + 1) * 365 and final.where("tasmax IS NOT NULL").count() == want
    assert final.schema["pr"].metadata["standard_name"] == "precipitation_flux"
    # A second run reads no days: inputs that would fail are never touched.
    broken = sim.withColumn("tasmax", F.raise_error(F.lit("read")).cast("double"))
    scenario.produce(spark, ref, broken, *args[3:], ids=["sim"])
    # A member added later leaves the first one as it is.
    two = sim.unionByName(sim.withColumn("dataset_id", F.lit("sim2")))
    both = scenario.produce(spark, ref, two, *args[3:], ids=["sim", "sim2"])
    assert {r["dataset_id"]: r["n"] for r in both.groupBy("dataset_id").agg(F.count(F.lit(1)).alias("n")).collect()} == {"sim": want, "sim2": want}
    bias = scen.where("year <= 1998").agg(F.avg("tasmax")).first()[0] - ref.where("year <= 1998").agg(F.avg("tasmax")).first()[0]
    assert abs(bias) < 0.5
    assert {r.step for r in spark.read.parquet(str(tmp_path / "s" / "checkup")).collect()} == {"sim", "scen"}
    report = {(r.cell_id, r.measure): r for r in spark.read.parquet(str(tmp_path / "s" / "report")).collect()}
    assert {m for _, m in report} > {"nan_count", "tx_mean_rmse", "pr_wet_freq_q99_change"}
    row = report[0, "tx_mean_rmse"]
    assert row.difference == row.sim - row.scen and row.improvement > 0
    # A shorter target period replaces the longer one, in the scenario and in the final store.
    short = B.Conf(B.STANDARD_VARIABLES, X.REF_PERIOD, (1996, 1999), loess_f=0.6)
    less = scenario.produce(spark, ref, sim, cells, weights, args[5], short, X.FUT_PERIOD, args[8], ids=["sim"])
    assert {r.year for r in less.select("year").distinct().collect()} <= {1996, 1997, 1998, 1999}
    assert store.final.read(["sim"]).count() == 4 * 365 and store.final.read(["sim2"]).count() == 7 * 365
    # What lies in the buckets is grouped and joined where it is: only factors and rows per cell or dataset are exchanged.
    table = lambda name, *by: store.table(name, by).read()
    reference, regridded = table("reference", "calendar"), table("regridded")
    exchanges = lambda df: df._jdf.queryExecution().executedPlan().toString().count("Exchange ")
    assert exchanges(B.train(reference, regridded, short)) == 0
    assert exchanges(B.adjust(table("training"), regridded, short)) == 0
    assert store.table("scenario").stale() and store.table("scenario").remove_stale() and not store.table("scenario").stale()
    assert store.table("scenario").read(["sim"]).count() == less.count()


def test_a_broken_write_leaves_the_former_version(spark, sf_dir, tmp_path):
    from graticule.sources.store import Table
    days = X.dataset(X.daily(spark, sf_dir), "sim")
    for buckets in (0, 3):
        table = Table(spark, str(tmp_path / f"t{buckets}"), buckets)
        with pytest.raises(FileNotFoundError):
            table.read()
        table.write(days, ["sim"], "a")
        n = table.read().count()
        broken = days.withColumn("pr", F.when(F.col("year") == 1997, F.raise_error(F.lit("broken")).cast("double")).otherwise(F.col("pr")))
        with pytest.raises(Exception, match="broken"):
            table.write(broken, ["sim"], "b")
        assert table.finished("a") == {"sim"} and not table.finished("b") and table.read().count() == n and len(table.stale()) <= 1
        table.write(days.where("year > 3000"), ["sim"], "c")
        assert table.read().count() == 0 and table.finished("c") == {"sim"}


def test_indices_are_computed_once(spark, sf_dir, tmp_path):
    daily = X.daily(spark, sf_dir)
    defs = named(standard_indicators(), "tx_mean_annual", "prcptot_seasonal")
    empty = spark.createDataFrame([], "id string, xrfreq string, variable array<string>, processing_level string, path string")
    path = str(tmp_path / "ind")
    catalog = indices.run(daily, empty, defs, path, "skip")
    n = spark.read.parquet(path).count()
    assert n > 0 and catalog.count() == 4
    assert indices.run(daily, catalog, defs, path, "skip").count() == 4
    assert spark.read.parquet(path).count() == n


def test_a_second_member_leaves_the_first(spark, sf_dir, tmp_path):
    daily = X.daily(spark, sf_dir)
    defs = named(standard_indicators(), "tx_mean_annual")
    empty = spark.createDataFrame([], "id string, xrfreq string, variable array<string>, processing_level string, path string")
    path = str(tmp_path / "ind")
    catalog = indices.run(X.dataset(daily, "ref"), empty, defs, path, "skip")
    first = spark.read.parquet(path).count()
    indices.run(daily, catalog, defs, path, "skip")
    both = spark.read.parquet(path)
    assert both.where("dataset_id = 'ref'").count() == first and both.where("dataset_id = 'sim'").count() > 0


def test_diagnostics(spark, sf_dir, tmp_path):
    daily = X.daily(spark, sf_dir)
    defs = [d for d in standard_properties() if d.name in ("mean_tasmax", "q99_pr", "aca_pr", "correlogram_pr")]
    sim = X.dataset(daily, "sim").withColumn("dataset_id", F.lit("m1"))
    scen = X.scen(daily).withColumn("dataset_id", F.lit("m1"))
    imp = diagnostics.run(X.dataset(daily, "ref"), sim, scen, X.cells(spark, sf_dir), defs, X.REF_PERIOD, str(tmp_path / "d"))
    got = {r.property: r.imp for r in imp.collect()}
    assert got["mean_tasmax"] > 0.7 and set(got) == {"mean_tasmax", "q99_pr", "aca_pr", "correlogram_pr"}
