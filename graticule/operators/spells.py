"""Rolling sums, runs of days, moving means, lags and ranks.

Windows are partitioned by (dataset, cell).  Such a group is bounded by the calendar: one row per day.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.calendars import month_number, month_to_date, period_number

KEYS = ("dataset_id", "cell_id")


def rolling_sum(df: DataFrame, var: str, n: int, out: str | None = None, keys: Sequence[str] = KEYS) -> DataFrame:
    """Sum of the ``n`` days ending on each day; NULL unless all ``n`` are present."""
    w = Window.partitionBy(*keys).orderBy("t").rangeBetween(-(n - 1), 0)
    full = F.count(var).over(w) == n
    return df.withColumn(out or f"{var}_sum{n}", F.when(full, F.sum(var).over(w)))


def period_max_of_rolling_sum(
    df: DataFrame, var: str, n: int, freq: str, keys: Sequence[str] = KEYS
) -> DataFrame:
    """Largest n-day sum per period, counted in the period of its last day."""
    rolled = rolling_sum(df.select(*keys, "year", "month", "t", var), var, n, "_s", keys)
    start = month_to_date(period_number(month_number("year", "month"), freq))
    return rolled.groupBy(*keys, start.alias("period_start")).agg(F.max("_s").alias("value"))


def spells(
    df: DataFrame, cond: Column, min_len: int = 1, within: Sequence[str] = ("period_start",), keys: Sequence[str] = KEYS
) -> DataFrame:
    """Runs of consecutive days that meet ``cond``, cut at the borders of ``within``: (keys, within, start_t, length).

    Only the days that meet the condition are exchanged.  Within a run ``t - row_number`` is constant.
    """
    keys = [*keys, *within]
    days = df.where(cond).select(*keys, "t")
    island = F.col("t") - F.row_number().over(Window.partitionBy(*keys).orderBy("t"))
    return (
        days.withColumn("_island", island)
        .groupBy(*keys, "_island")
        .agg(F.min("t").alias("start_t"), F.count(F.lit(1)).cast("int").alias("length"))
        .where(F.col("length") >= min_len)
        .drop("_island")
    )


def longest_sums(days: Sequence[Column], n: int) -> Column:
    """The largest sum of ``n`` neighbours among columns that hold consecutive days; a missing day takes part in no sum."""
    sums = [sum(days[i + 1:i + n], days[i]) for i in range(len(days) - n + 1)]
    return F.greatest(*sums) if len(sums) > 1 else sums[0] if sums else F.lit(None).cast("double")


def run_lengths(months: str, bits: str, min_len: int) -> Column:
    """Runs of set bits in a period: struct (total length, count) of those of ``min_len`` days and more.

    ``months`` is the sorted list of the period's months: month_no, length in days and a map of bits whose highest of 31 is the first
    day.  A run goes on from a month to the next, not over a month that is absent.
    """
    text = lambda m: F.substring(F.lpad(F.bin(m[bits]), 31, "0"), F.lit(1), m["length"])
    gap = lambda m, i: F.when((i > 0) & (F.get(months, i - 1)["month_no"] != m["month_no"] - 1), "0").otherwise("")
    # Few periods have such a run: the others are told by their bits alone.
    some = F.exists(months, lambda m: m[bits] != 0)
    line = F.when(some, F.array_join(F.transform(months, lambda m, i: F.concat(gap(m, i), text(m))), "")).otherwise("")
    runs = F.regexp_extract_all(line, F.lit(f"(1{{{min_len},}})"), F.lit(1))
    return F.struct(F.length(F.array_join(runs, "")).cast("long").alias("total"), F.size(runs).cast("long").alias("count"))


def ranges_of_days(days: DataFrame, keys: Sequence[str] = ("dataset_id",)) -> DataFrame:
    """Consecutive days folded to (first_t, last_t)."""
    runs = spells(days, F.lit(True), 1, (), keys)
    return runs.select(*keys, F.col("start_t").alias("first_t"), (F.col("start_t") + F.col("length") - 1).alias("last_t"))


def moving_mean(
    df: DataFrame, var: str, years: int = 10, keys: Sequence[str] = ("dataset_id",), out: str | None = None
) -> DataFrame:
    """Moving mean over years; the window of even length reaches one year further back than ahead."""
    w = Window.partitionBy(*keys).orderBy("year").rangeBetween(-(years // 2), years - years // 2 - 1)
    return df.withColumn(out or f"{var}_ma{years}", F.avg(var).over(w))


def with_next_day(df: DataFrame, var: str, lag: int = 1, out: str = "_next", keys: Sequence[str] = KEYS) -> DataFrame:
    """The value ``lag`` days later, NULL if that day is not the ``lag``-th next row."""
    w = Window.partitionBy(*keys).orderBy("t")
    return df.withColumn(out, F.when(F.lead("t", lag).over(w) == F.col("t") + lag, F.lead(var, lag).over(w)))


def average_rank(
    df: DataFrame, var: str, out: str | None = None, keys: Sequence[str] = KEYS, where: Column | None = None
) -> DataFrame:
    """Ranks with ties averaged among the non-NULL values (that meet ``where``); the others get no rank.

    Rank and tie count share one sort.
    """
    counted = F.col(var).isNotNull() if where is None else F.col(var).isNotNull() & where
    w = Window.partitionBy(*keys, counted).orderBy(var)
    ties = F.count(F.lit(1)).over(w.rangeBetween(0, 0))
    return df.withColumn(out or f"{var}_rank", F.when(counted, F.rank().over(w) + (ties - 1) / 2.0))


def spearman(df: DataFrame, a: str, b: str, keys: Sequence[str] = KEYS) -> DataFrame:
    """Rank correlation of two variables per cell over the days that have both."""
    both = df.where(F.col(a).isNotNull() & F.col(b).isNotNull()).select(*keys, "t", a, b)
    ranked = average_rank(average_rank(both, a, "_ra", keys), b, "_rb", keys)
    return ranked.groupBy(*keys).agg(F.corr("_ra", "_rb").alias("value"))
