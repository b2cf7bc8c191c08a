"""Spells, rolling sums and the missing-day policy on hand-made days."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from graticule.functions.calendars import period_start, with_standard_calendar
from graticule.operators import indices as I, spells as V
from graticule.operators.definitions import define, load_definitions, named, standard_indicators, standard_properties


def days(spark, values, start="2000-12-25", var="tasmax"):
    """One row per value; None leaves the day out."""
    d0 = dt.date.fromisoformat(start)
    rows = [("a", 1, d0 + dt.timedelta(i), float(v)) for i, v in enumerate(values) if v is not None]
    df = with_standard_calendar(spark.createDataFrame(rows, f"dataset_id string, cell_id int, date date, {var} double"))
    for other in {"tasmax", "tasmin", "pr"} - {var}:
        df = df.withColumn(other, F.col(var) if other == "tasmin" else F.lit(1.0))
    return df


def test_runs_are_cut_at_the_border_and_by_gaps(spark):
    hot = [1, 1, 0, 1, 1, 1, 1, 1, 1, 1, 0, 1, None, 1, 1]  # 25 Dec .. ; 28 Dec - 3 Jan is one run over New Year
    df = days(spark, hot).withColumn("period_start", period_start("year", "month", "YS"))
    got = sorted((r.period_start.year, r.length) for r in V.spells(df, F.col("tasmax") > 0).collect())
    assert got == [(2000, 2), (2000, 4), (2001, 1), (2001, 2), (2001, 3)]


def test_heat_waves_count_runs_of_three_and_more(spark):
    hot, cold = 310.0, 280.0
    df = days(spark, [hot] * 2 + [cold] + [hot] * 3 + [cold] + [hot] * 5, "2001-07-01")
    defs = named(standard_indicators(), "heat_wave_total_length_class1", "heat_wave_frequency_class1")
    got = {r.indicator: r.value for r in I.compute_indicators(df, defs, "skip").collect()}
    assert got == {"heat_wave_total_length_class1": 8.0, "heat_wave_frequency_class1": 2.0}
    none = {r.value for r in I.compute_indicators(df.withColumn("tasmin", F.lit(280.0)), defs, "skip").collect()}
    assert none == {0.0}


def test_rx5day_needs_five_present_days(spark):
    df = days(spark, [1, 2, 3, 4, None, 5, 6, 7, 8, 9, 0], "2001-05-01", "pr")
    out = V.rolling_sum(df, "pr", 5).where("pr_sum5 IS NOT NULL").orderBy("t").collect()
    assert [r.pr_sum5 for r in out] == [35.0, 30.0]


def test_half_years_start_with_the_first_april(spark):
    df = days(spark, [10.0] * 5 + [1.0] * 40, "2001-03-27", "pr")
    defs = named(standard_indicators(), "max_n_day_precipitation_amount_n_5_annual", "max_n_day_precipitation_amount_n_5_biannual")
    got = {r.indicator: (r.period_start, r.value) for r in I.compute_indicators(df, defs, "skip").collect()}
    assert got["max_n_day_precipitation_amount_n_5_annual"] == (dt.date(2001, 1, 1), 50.0)
    assert got["max_n_day_precipitation_amount_n_5_biannual"] == (dt.date(2001, 4, 1), 5.0)


@pytest.mark.parametrize("policy, want", [("any", None), ("skip", 280.0), (0.05, 280.0), (0.01, None)])
def test_missing_policy(spark, policy, want):
    df = days(spark, [280.0] * 20 + [None] + [280.0] * 10, "2001-01-01")
    (row,) = I.compute_indicators(df, [define("tx", "tx_mean", "MS")], policy).collect()
    assert row.value == want


def test_complete_month_passes_any(spark):
    (row,) = I.compute_indicators(days(spark, [280.0] * 31, "2001-01-01"), [define("tx", "tx_mean", "MS")]).collect()
    assert row.value == 280.0 and row.period_start == dt.date(2001, 1, 1)


def test_null_day_is_not_a_zero_degree_day(spark):
    df = days(spark, [274.15] * 31, "2001-01-01").withColumn("tasmax", F.when(F.col("day") != 5, F.col("tasmax")))
    (row,) = I.compute_indicators(df, [define("gdd", "growing_degree_days", "MS", thresh="0 degC")], "any").collect()
    assert row.value is None


def test_definition_lists_and_files(tmp_path):
    assert len(standard_indicators()) == 30 and len(standard_properties()) == 22
    path = tmp_path / "defs.json"
    path.write_text(json.dumps({"indicators": {"hot": {
        "base": "tx_days_above", "cf_attrs": {"var_name": "h"}, "parameters": {"thresh": "30 degC", "freq": "AS-JUL"}}}}))
    (d,) = load_definitions(str(path))
    assert (d.name, d.base, d.freq, d.output, d.params) == ("hot", "tx_days_above", "AS-JUL", "h", {"thresh": "30 degC"})


def test_yaml_definitions(tmp_path):
    pytest.importorskip("yaml")
    path = tmp_path / "defs.yml"
    path.write_text("indicators:\n  q:\n    base: some.module.quantile\n    input: {da: pr}\n    parameters: {q: 0.5}\n")
    (d,) = load_definitions(str(path))
    assert d.base == "quantile" and d.params == {"q": 0.5, "da": "pr"}


def test_a_user_can_register_an_index(spark):
    I.register("cold_sum", ["tasmin"])(lambda p: F.greatest(F.lit(300.0) - F.col("tasmin"), F.lit(0.0)))
    (row,) = I.compute_indicators(days(spark, [290.0] * 31, "2001-01-01"), [define("c", "cold_sum", "MS")]).collect()
    assert row.value == pytest.approx(310.0)


def test_unknown_base_raises(spark):
    with pytest.raises(ValueError):
        I.compute_indicators(days(spark, [1.0]), [define("x", "nope")])
