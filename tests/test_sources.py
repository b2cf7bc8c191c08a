"""Loading, checks, sinks and catalog files."""

import pytest
from pyspark.sql import functions as F

from checks import fixtures as X
from graticule.operators import evaluate as E, selection as S
from graticule.sources import catalog as T, daily as D


@pytest.fixture(scope="module")
def daily(spark, sf_dir):
    return X.daily(spark, sf_dir).cache()


def test_nan_becomes_null_and_units_are_canonical(spark, daily, tmp_path):
    path = str(tmp_path / "flux")
    flux = daily.withColumn("pr", F.when(F.col("day") == 1, F.lit(float("nan"))).otherwise(F.col("pr") / 86400))
    D.write_table(flux, path)
    got = D.read_daily(spark, path, {"pr": "kg m-2 s-1"})
    assert got.where("isnan(pr)").count() == 0
    assert got.where("pr IS NULL").count() == daily.where("day = 1").count()
    assert got.agg(F.max("pr")).first()[0] == pytest.approx(daily.where("day <> 1").agg(F.max("pr")).first()[0], rel=1e-6)
    assert "ReadSchema: struct<pr:float>" in _plan(got.select("pr")).replace("\n", "")


def _plan(df):
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def test_write_modes(daily, tmp_path):
    path = str(tmp_path / "w")
    small = daily.limit(10)
    D.write_table(small, path)
    with pytest.raises(Exception):
        D.write_table(small, path)
    D.write_table(small, path, "a")
    assert daily.sparkSession.read.parquet(path).count() == 20
    D.write_table(small, path, "o")
    assert daily.sparkSession.read.parquet(path).count() == 10


def test_check_daily_raises_on_two_records(daily):
    assert D.check_daily(daily).count() == daily.count()
    with pytest.raises(ValueError):
        D.check_daily(daily.unionByName(daily.limit(1)))


def test_metadata_is_templated_and_whitelisted(daily):
    attrs = {"pr": {"long_name": "rain of {member}", "secret": "x"}}
    out = D.stamp_metadata(daily, attrs, D.FINAL_ATTR_NAMES, member="m1")
    assert out.schema["pr"].metadata == {"long_name": "rain of m1"}


def test_period_filter_prunes_partitions(spark, sf_dir, daily, tmp_path):
    path = str(tmp_path / "final")
    D.write_final(daily, X.cells(spark, sf_dir), path)
    stored = S.in_period(spark.read.parquet(path), 2000, 2001)
    assert stored.count() == daily.where("year >= 2000").count()
    assert "PartitionFilters: [isnotnull(year4" in _plan(stored)


def test_catalog_from_folders(spark, daily, tmp_path):
    for name in ("day_CC_Can_UQ_RCM_rcp85_1951-2100.parquet", "day_MP_ESM_UQ_RCM_rcp45_1951-2100.parquet", "notes.parquet"):
        D.write_table(daily.limit(3), str(tmp_path / "store" / name))
    pattern = "{frequency}_{driving_institution}_{driving_model}_{institution}_{source}_{experiment}_{date_start}-{date_end}.parquet"
    cat = T.scan_paths(spark, str(tmp_path / "store"), "*.parquet", [pattern], {"domain": "AMNO"})
    rows = {r.driving_model: r for r in cat.collect()}
    assert set(rows) == {"Can", "ESM"} and rows["Can"].experiment == "rcp85" and rows["ESM"].domain == "AMNO"
    assert D.load_selected(spark, T.search(cat, experiment="rcp85")).count() == 3
    with pytest.raises(ValueError):
        D.load_selected(spark, T.search(cat, experiment="none"))
    T.write_catalog(cat.withColumn("variable", F.array(F.lit("pr"), F.lit("tasmax"))), str(tmp_path / "cat"))
    assert T.read_catalog(spark, str(tmp_path / "cat")).select(F.size("variable")).distinct().collect()[0][0] == 2


def test_expect_one(spark):
    df = spark.range(2)
    with pytest.raises(ValueError, match="more than one"):
        T.expect_one(df)
    with pytest.raises(ValueError, match="no dataset"):
        T.expect_one(df.limit(0))
    assert T.expect_one(df.limit(1)).count() == 1


def test_upsert_is_idempotent(spark):
    old = spark.createDataFrame([("p1", "a"), ("p2", "b")], "path string, v string")
    new = spark.createDataFrame([("p2", "c"), ("p3", "d")], "path string, v string")
    once = T.merge_catalog(old, new)
    assert sorted(map(tuple, once.collect())) == [("p1", "a"), ("p2", "c"), ("p3", "d")]
    assert sorted(map(tuple, T.merge_catalog(once, new).collect())) == sorted(map(tuple, once.collect()))


def test_imp_of_identical_inputs_is_zero(spark):
    m = spark.createDataFrame([("m", "p", c, None, None, v) for c, v in enumerate([1.0, -2.0, 0.0])],
                              "member string, property string, cell_id int, month int, bin int, value double")
    assert E.imp(m, m).first().imp == 0.0
    assert E.imp(m, m.withColumn("value", F.col("value") / 2)).first().imp == pytest.approx(2 / 3)


def test_partitions_follow_the_input(spark, tmp_path, sf_dir):
    from checks import fixtures as X
    from graticule import session as N
    from graticule.operators import selection as S
    from graticule.sources import store
    path = str(tmp_path / "days")
    X.daily(spark, sf_dir).select("dataset_id", "cell_id", "t", "pr").write.parquet(path)
    df = spark.read.parquet(path)
    assert N.spread(df, "cell_id", most_bytes=N.input_bytes(df) // 9).rdd.getNumPartitions() >= 9
    assert N.spread(df, "cell_id") is df
    cells = df.select("cell_id").distinct()
    dense = S.unstack(df, cells, ["ref"], 0, 99, rows_per_partition=20)
    assert f", {cells.count() * 5}), REPARTITION_BY_NUM" in dense._jdf.queryExecution().executedPlan().toString()
    assert dense.count() == cells.count() * 100
    table = store.Table(spark, str(tmp_path / "table"), 2)
    before, store.WRITE_BYTES = store.WRITE_BYTES, N.input_bytes(df) // 8
    try:
        table.write(df, ["ref", "sim"], "k")
    finally:
        store.WRITE_BYTES = before
    files = [f for f in (tmp_path / "table" / "data").rglob("*.parquet") if "dataset_id=ref" in str(f)]
    assert len(files) >= min(cells.count(), 3) and sorted(map(tuple, table.read().select(*df.columns).collect())) == sorted(map(tuple, df.collect()))
