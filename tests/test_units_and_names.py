import pytest
from pyspark.sql import functions as F

from graticule.functions import names as N, units as U


def test_thresholds():
    assert U.threshold("4 degC", "K") == pytest.approx(277.15)
    assert U.threshold("1 mm d-1") == 1.0
    assert U.threshold("0.1 mm/d") == 0.1
    with pytest.raises(ValueError):
        U.threshold("1 mm d-1", "K")
    with pytest.raises(ValueError):
        U.threshold("3 furlong")


def test_convert_flux(spark):
    df = spark.createDataFrame([(1.0 / 86400, 0.0)], "pr double, tasmax double")
    row = U.convert_units(df, {"pr": "mm d-1", "tasmax": "K"}, {"pr": "kg m-2 s-1", "tasmax": "degC"}).first()
    assert row.pr == pytest.approx(1.0) and row.tasmax == pytest.approx(273.15)
    with pytest.raises(ValueError):
        U.convert_units(df, {"pr": "K"}, {"pr": "mm d-1"})


def test_parse_takes_the_first_pattern_that_fits(spark):
    df = spark.createDataFrame([("/d/a_b_x.zarr",), ("/d/only_x.zarr",), ("/d/none.txt",)], "path string")
    cols = N.parse_path(F.col("path"), ["{one}_{two}_{?kind}.zarr", "{one}_{?kind}.zarr"])
    rows = df.select(*[c.alias(n) for n, c in cols.items()]).collect()
    assert [tuple(r) for r in rows] == [("a", "b"), ("only", None), (None, None)]


def test_title(spark):
    assert spark.range(1).select(N.title_of(F.lit("pr_wet_Freq"))).first()[0] == "Pr wet freq"
