"""Scores of the adjustment, ensemble summaries, and the evaluation against stations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from ..functions import quantiles as Q
from ..functions.calendars import period_start
from ..session import small_enough_to_broadcast
from .properties import RATIO_PROPERTIES
from .selection import wet_days
from .spells import moving_mean, ranges_of_days


ROUNDING = 1e-9


def imp(sim_measures: DataFrame, scen_measures: DataFrame, ratios: Sequence[str] = RATIO_PROPERTIES) -> DataFrame:
    """Share of the cells (months, bins) the adjustment improved, per member and property.

    Improved: the measure of the scenario is nearer to 0 (to 1 for a ratio) than that of the simulation; equal is not, and
    what differs by rounding alone (``ROUNDING`` of the distance) is equal.
    Both inputs carry ``member`` next to the tidy columns.
    """
    on = ["member", "property", "cell_id", "month", "bin"]
    sim = sim_measures.select(*on, F.col("value").alias("_sim"))
    scen = scen_measures.select(*[F.col(c).alias(f"_{c}") for c in on], F.col("value").alias("_scen"))
    cond = None
    for c in on:
        e = F.col(c).eqNullSafe(F.col(f"_{c}"))
        cond = e if cond is None else cond & e
    centre = F.when(F.col("property").isin(list(ratios)), 1.0).otherwise(0.0)
    before, after = F.abs(F.col("_sim") - centre), F.abs(F.col("_scen") - centre)
    better = before - after > ROUNDING * before
    return (
        sim.join(scen, cond).where(F.col("_sim").isNotNull() & F.col("_scen").isNotNull())
        .groupBy("member", "property")
        .agg(F.avg(F.when(better, 1.0).otherwise(0.0)).alias("imp"), F.count(F.lit(1)).alias("n"))
    )


def imp_summary(scores: DataFrame, neutral: tuple[float, float] = (0.45, 0.55)) -> DataFrame:
    """Mean IMP over the members and its class.  "Around 50 %" is taken as ``neutral``."""
    mean = scores.groupBy("property").agg(F.avg("imp").alias("imp"), F.count(F.lit(1)).alias("members"))
    label = F.when(F.col("imp") < neutral[0], "worsened").when(F.col("imp") > neutral[1], "improved").otherwise("neutral")
    return mean.withColumn("class", label)


def imp_heat_map(scores: DataFrame, members: Sequence[str]) -> DataFrame:
    """One row per property, one column per member."""
    return scores.groupBy("property").pivot("member", list(members)).agg(F.first("imp"))


def imp_by_resolution(scores: DataFrame, members: DataFrame) -> DataFrame:
    return scores.join(members.select("member", "resolution"), "member").groupBy("resolution", "property").agg(
        F.avg("imp").alias("imp")
    )


def days_of_calendar(spans: DataFrame) -> DataFrame:
    """Every day number between ``first_t`` and ``last_t`` of each dataset."""
    return spans.select("dataset_id", F.explode(F.sequence("first_t", "last_t")).alias("t"))


def missing_dates(df: DataFrame, spans: DataFrame, variables: Sequence[str] = ("tasmax", "tasmin", "pr")) -> DataFrame:
    """Days on which at least one variable has no value in any cell, as ranges (dataset_id, first_t, last_t).

    ``spans`` holds the days each dataset should cover.
    """
    have = df.groupBy("dataset_id", "t").agg(*[F.count(v).alias(v) for v in variables])
    complete = have.where(F.least(*[F.col(v) for v in variables]) > 0).select("dataset_id", "t")
    return ranges_of_days(days_of_calendar(spans).join(complete, ["dataset_id", "t"], "left_anti"))


def change_signal(df: DataFrame, var: str, before: tuple[int, int], after: tuple[int, int]) -> DataFrame:
    """Difference of two long-term means per dataset and cell."""
    year = F.col("year")
    return df.groupBy("dataset_id", "cell_id").agg(
        (F.avg(F.when(year.between(*after), F.col(var))) - F.avg(F.when(year.between(*before), F.col(var)))).alias("change")
    )


def yearly_change(indices: DataFrame, period: tuple[int, int]) -> DataFrame:
    """Annual index values minus their mean over ``period``: (dataset_id, indicator, year, value).

    Cells are averaged first; the mean of the period is one value per dataset and indicator.
    """
    yearly = indices.groupBy("dataset_id", "indicator", F.year("period_start").alias("year")).agg(F.avg("value").alias("v"))
    base = yearly.where(F.col("year").between(*period)).groupBy("dataset_id", "indicator").agg(F.avg("v").alias("base"))
    return yearly.join(base, ["dataset_id", "indicator"]).select(
        "dataset_id", "indicator", "year", (F.col("v") - F.col("base")).alias("value")
    )


def ensemble_change(
    indices: DataFrame, period: tuple[int, int], smooth_years: int = 10, qs: Sequence[float] = (0.1, 0.5, 0.9),
    members: DataFrame | None = None, by: Sequence[str] = (),
) -> DataFrame:
    """Smoothed change of each member, then mean, range and quantiles across the members of each year.

    ``members`` (dataset_id and the columns ``by``, such as the experiment) keeps scenarios apart.
    """
    change = moving_mean(yearly_change(indices, period), "value", smooth_years, ("dataset_id", "indicator"), "ma")
    if members is not None:
        change = change.join(small_enough_to_broadcast(members.select("dataset_id", *by).distinct()), "dataset_id")
    stats = change.groupBy(*by, "indicator", "year").agg(
        F.avg("ma").alias("mean"), F.min("ma").alias("min"), F.max("ma").alias("max"),
        F.percentile("ma", [float(q) for q in qs]).alias("_p"),
    )
    return stats.select(*by, "indicator", "year", "mean", "min", "max",
                        *[F.col("_p")[i].alias(f"p{round(q * 100):02d}") for i, q in enumerate(qs)])


def qq(df: DataFrame, var: str, qs: Sequence[float], datasets: Sequence[str], wet_only: bool = False) -> DataFrame:
    """Quantiles of all points of a region, one column per dataset.  The sample has no size bound: pooled quantiles."""
    if wet_only:
        df = wet_days(df)
    q = Q.pooled(df.where(F.col("dataset_id").isin(list(datasets))), ["dataset_id"], var, qs)
    return q.groupBy("q").pivot("dataset_id", list(datasets)).agg(F.first("value"))


def member_counts(catalog: DataFrame) -> DataFrame:
    return catalog.groupBy("experiment").agg(F.countDistinct("id").alias("members"))


# --- stations --------------------------------------------------------------------------------------------------------


def valid_stations(df: DataFrame, var: str, years: int = 25, max_missing: float = 0.1) -> DataFrame:
    """Stations with at least ``years`` valid years; in a valid year every month lacks at most ``max_missing``."""
    in_month = F.dayofmonth(F.last_day(F.make_date("year", "month", F.lit(1))))
    months = df.groupBy("station_id", "year", "month").agg(F.count(var).alias("n"))
    good = months.where(in_month - F.col("n") <= max_missing * in_month)
    full = good.groupBy("station_id", "year").agg(F.count(F.lit(1)).alias("months")).where("months = 12")
    return full.groupBy("station_id").agg(F.count(F.lit(1)).alias("valid_years")).where(F.col("valid_years") >= years)


def _score(pairs: DataFrame, keys: Sequence[str]) -> DataFrame:
    return pairs.groupBy(*keys).agg(
        F.avg(F.pow(F.col("a") - F.col("b"), 2)).alias("mse"), F.corr("a", "b").alias("corr")
    )


def paired_with_stations(grid: DataFrame, stations: DataFrame, nearest: DataFrame, var: str) -> DataFrame:
    """(dataset_id, station_id, year, month, t, a, b): grid value at the nearest cell and station value of each day."""
    near = small_enough_to_broadcast(nearest.select("station_id", "cell_id"))
    at = grid.join(near, "cell_id").select(
        "dataset_id", "station_id", "year", "month", "t", F.col(var).alias("a")
    )
    return at.join(stations.select("station_id", "t", F.col(var).alias("b")), ["station_id", "t"])


def annual_cycle_score(pairs: DataFrame) -> DataFrame:
    """MSE and correlation of the mean annual cycles (twelve monthly means)."""
    cycle = pairs.groupBy("dataset_id", "station_id", "month").agg(F.avg("a").alias("a"), F.avg("b").alias("b"))
    return _score(cycle, ["dataset_id", "station_id"])


def seasonal_series_score(pairs: DataFrame) -> DataFrame:
    """MSE and correlation of the inter-annual series of seasonal means, per season (its first month)."""
    start = period_start("year", "month", "QS-DEC")
    means = pairs.groupBy("dataset_id", "station_id", start.alias("start")).agg(F.avg("a").alias("a"), F.avg("b").alias("b"))
    return _score(means.withColumn("season", F.month("start")), ["dataset_id", "station_id", "season"])


def seasonal_quantile_bias(pairs: DataFrame, qs: Sequence[float] = (0.05, 0.25, 0.5, 0.75, 0.95)) -> DataFrame:
    """Quantile of the grid minus quantile of the station, per season."""
    season = F.month(period_start("year", "month", "QS-DEC"))
    levels = [float(q) for q in qs]
    got = pairs.where(F.col("a").isNotNull() & F.col("b").isNotNull()).groupBy(
        "dataset_id", "station_id", season.alias("season")
    ).agg(F.percentile("a", levels).alias("pa"), F.percentile("b", levels).alias("pb"))
    diff = F.zip_with("pa", "pb", lambda x, y: x - y)
    return got.select("dataset_id", "station_id", "season", F.posexplode(diff).alias("_i", "bias")).select(
        "dataset_id", "station_id", "season", F.element_at(Q.doubles(levels), F.col("_i") + 1).alias("q"), "bias"
    )
