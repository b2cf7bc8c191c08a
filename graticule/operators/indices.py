"""Climate indices per cell and period from declarative definitions.

All periods begin with a month, so one pass over the daily table folds it to one row per cell and month, and the much smaller
monthly table is folded again to the periods of every frequency.  What a month keeps is a summary that can be merged:

* of an index folded from days, a sum and a count;
* of a rolling sum, the days of the month side by side: sums inside the month need no more, sums that begin in the month before
  need its last days, which the previous row of the cell has;
* of runs of days, one bit per day and condition.  The bits of a period's months one after the other, a missing day or month
  being no hot day, are a string in which runs are counted.

So the days are read once, nothing but the monthly rows is exchanged, and there is no window over days.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.calendars import FREQUENCIES, days_in_period, month_number, month_to_date, period_number
from ..functions.units import threshold
from ..session import cut_lineage, small_enough_to_broadcast, spread
from .definitions import Definition
from .derive import with_tas
from .spells import longest_sums, run_lengths

KEYS = ["dataset_id", "calendar", "cell_id"]


@dataclass(frozen=True)
class Base:
    """An index folded from days: a value per day, NULL if an input is, and how days combine."""

    inputs: tuple[str, ...]
    value: Callable[[dict], Column]
    how: str = "sum"


BASES: dict[str, Base] = {}


def register(name: str, inputs: Sequence[str], how: str = "sum"):
    """Decorator: make a ``params -> Column`` function available to definitions as base ``name``."""
    def add(fn: Callable[[dict], Column]):
        BASES[name] = Base(tuple(inputs), fn, how)
        return fn
    return add


def _degrees(params: dict, default: str = "0 degC") -> float:
    return threshold(params.get("thresh", default), "K")


_COMPARE: dict[str, Callable[[Column, float], Column]] = {
    ">": lambda c, v: c > v, ">=": lambda c, v: c >= v, "<": lambda c, v: c < v, "<=": lambda c, v: c <= v,
}


def compare(col: Column, op: str, value: float | Column) -> Column:
    return _COMPARE[op](col, value)


def _days(cond: Column) -> Column:
    return cond.cast("int").cast("double")


for _name, _var in (("tg_mean", "tas"), ("tx_mean", "tasmax"), ("tn_mean", "tasmin")):
    register(_name, [_var], "mean")(lambda p, v=_var: F.col(v))

register("prcptot", ["pr"])(lambda p: F.col("pr"))


@register("liquidprcptot", ["pr", "tas"])
def _liquid(p):
    return F.when(F.col("tas") >= _degrees(p), F.col("pr")).otherwise(0.0)


@register("solidprcptot", ["pr", "tas"])
def _solid(p):
    return F.when(F.col("tas") < _degrees(p), F.col("pr")).otherwise(0.0)


@register("dlyfrzthw", ["tasmax", "tasmin"])
def _freeze_thaw(p):
    return _days((F.col("tasmax") > threshold(p.get("thresh_tasmax", "0 degC"))) &
                 (F.col("tasmin") <= threshold(p.get("thresh_tasmin", "0 degC"))))


@register("growing_degree_days", ["tas"])
def _growing(p):
    return F.greatest(F.col("tas") - _degrees(p, "4 degC"), F.lit(0.0))


@register("freezing_degree_days", ["tas"])
def _freezing(p):
    return F.greatest(F.lit(_degrees(p)) - F.col("tas"), F.lit(0.0))


for _name, _var, _op in (
    ("tn_days_above", "tasmin", ">"), ("tn_days_below", "tasmin", "<"),
    ("tx_days_above", "tasmax", ">"), ("tx_days_below", "tasmax", "<"),
):
    register(_name, [_var])(
        lambda p, v=_var, o=_op: _days(compare(F.col(v), p.get("op", o), _degrees(p)))
    )

ROLLING = "max_n_day_precipitation_amount"
SPELLS = {"heat_wave_total_length": "total", "heat_wave_frequency": "count"}


def _enough(n_valid: Column, expected: Column, missing: str | float) -> Column:
    """``any``: every day of the period is needed; ``skip``: one day suffices; a number: the tolerated missing share."""
    if missing == "any":
        return n_valid >= expected
    if missing == "skip":
        return n_valid > 0
    return n_valid >= (1.0 - float(missing)) * expected


def _needs(d: Definition) -> int:
    return int(d.params.get("window", 5 if d.base == ROLLING else 3))


def _hot(d: Definition) -> tuple[float, float]:
    return threshold(d.params["thresh_tasmin"], "K"), threshold(d.params["thresh_tasmax"], "K")


@dataclass(frozen=True)
class Plan:
    """The definitions by what a month keeps for them."""

    folded: list[Definition]
    rolling: list[Definition]
    runs: list[Definition]

    @classmethod
    def of(cls, defs: Sequence[Definition]) -> Plan:
        return cls([d for d in defs if d.base in BASES], [d for d in defs if d.base == ROLLING], [d for d in defs if d.base in SPELLS])

    @property
    def freqs(self) -> list[str]:
        return sorted({d.freq for d in [*self.folded, *self.rolling, *self.runs]})

    @property
    def windows(self) -> list[int]:
        return sorted({_needs(d) for d in self.rolling})

    @property
    def conditions(self) -> list[tuple[float, float]]:
        return sorted({_hot(d) for d in self.runs})


def monthly_summaries(df: DataFrame, plan: Plan) -> DataFrame:
    """One row per (cell, month): s/n of each folded index, the days of ``pr``, a bit map per condition of runs."""
    parts = []
    for i, d in enumerate(plan.folded):
        base = BASES[d.base]
        have = reduce(lambda a, b: a & b, [F.col(v).isNotNull() for v in base.inputs])
        parts += [F.sum(F.when(have, base.value(d.params))).alias(f"s{i}"), F.count_if(have).alias(f"n{i}")]
    if plan.rolling:
        parts += [F.count("pr").alias("n_pr"), *[F.max(F.when(F.col("day") == k, F.col("pr"))).alias(f"d{k}") for k in range(1, 32)]]
    if plan.runs:
        hot = F.col("tasmax").isNotNull() & F.col("tasmin").isNotNull()
        bit = F.expr("shiftleft(1, 31 - day)")  # the first day is the highest bit
        parts += [F.count_if(hot).alias("n_hot"), *[
            F.bit_or(F.when((F.col("tasmin") > tn) & (F.col("tasmax") > tx), bit).otherwise(0)).alias(f"b{i}")
            for i, (tn, tx) in enumerate(plan.conditions)]]
    needs_tas = any("tas" in BASES[d.base].inputs for d in plan.folded)
    days = with_tas(df) if needs_tas else df
    days = spread(days.withColumn("month_no", month_number("year", "month")), "cell_id")
    monthly = days.groupBy(*KEYS, "month_no").agg(*parts, F.max("month").alias("month"))
    if not plan.rolling:
        return monthly
    reach = max(plan.windows) - 1
    length = days_in_period("calendar", "month_no", "MS")
    by_month = Window.partitionBy(*KEYS).orderBy("month_no")
    follows = F.lag("month_no").over(by_month) == F.col("month_no") - 1
    tail = F.array(*[F.get(F.array(*[F.col(f"d{k}") for k in range(1, 32)]), length - j) for j in range(reach, 0, -1)])
    before = F.when(follows, F.lag(tail).over(by_month))
    monthly = monthly.withColumn("_before", before)
    sums = {}
    for n in plan.windows:
        row = [F.get("_before", F.lit(reach - j)) for j in range(n - 1, 0, -1)] + [F.col(f"d{k}") for k in range(1, 32)]
        sums[f"r{n}"] = longest_sums(row, n)
        sums[f"own{n}"] = longest_sums(row[n - 1:], n)
    return monthly.withColumns(sums).drop("_before", *[f"d{k}" for k in range(1, 32)])


def _periods(monthly: DataFrame, plan: Plan) -> DataFrame:
    """The months of each period of every frequency merged."""
    folds = [c for i in range(len(plan.folded)) for c in (F.sum(f"s{i}").alias(f"s{i}"), F.sum(f"n{i}").alias(f"n{i}"))]
    if plan.rolling:
        folds.append(F.sum("n_pr").alias("n_pr"))
        for n in plan.windows:
            # A half-yearly series starts with its dataset's first April; of that month only sums inside it count.
            first = F.when(F.col("month") == 4, F.col(f"own{n}")).otherwise(F.col(f"r{n}"))
            folds += [F.max(f"r{n}").alias(f"r{n}"), F.max(first).alias(f"first{n}")]
    if plan.runs:
        folds.append(F.sum("n_hot").alias("n_hot"))
        bits = F.struct("month_no", days_in_period("calendar", "month_no", "MS").alias("length"), *[f"b{i}" for i in range(len(plan.conditions))])
        of_runs = F.col("freq").isin(sorted({d.freq for d in plan.runs}))
        folds.append(F.collect_list(F.when(of_runs, bits)).alias("months"))
    choices = F.array(*[F.struct(F.lit(f).alias("freq"), period_number("month_no", f).alias("period_no")) for f in plan.freqs])
    spread = monthly.withColumn("_f", F.explode(choices)).select("*", "_f.freq", "_f.period_no").drop("_f")
    out = spread.groupBy(*KEYS, "freq", "period_no").agg(*folds, F.bool_or(F.col("month") == 4).alias("april"))
    expected = None
    for f in plan.freqs:
        days = days_in_period("calendar", "period_no", f)
        expected = F.when(F.col("freq") == f, days) if expected is None else expected.when(F.col("freq") == f, days)
    return out.withColumn("_expected", expected)


def _values(periods: DataFrame, plan: Plan, missing: str | float) -> DataFrame:
    """(dataset_id, cell_id, indicator, freq, period_no, value, first, april): every definition at every period of its frequency."""
    enough = lambda n: _enough(F.col(n), F.col("_expected"), missing)
    rows = []
    for i, d in enumerate(plan.folded):
        value = F.col(f"s{i}") / F.col(f"n{i}") if BASES[d.base].how == "mean" else F.col(f"s{i}")
        rows.append((d, F.when(enough(f"n{i}"), value), None))
    for d in plan.rolling:
        n = _needs(d)
        rows.append((d, F.when(enough("n_pr"), F.col(f"r{n}")), F.when(enough("n_pr"), F.col(f"first{n}"))))
    if plan.runs:
        periods = periods.withColumn("months", F.array_sort("months"))
        runs = {}
        for d in plan.runs:
            key = plan.conditions.index(_hot(d)), _needs(d)
            runs[f"run{key[0]}_{key[1]}"] = run_lengths("months", f"b{key[0]}", key[1])
        periods = periods.withColumns(runs)
        for d in plan.runs:
            found = F.col(f"run{plan.conditions.index(_hot(d))}_{_needs(d)}.{SPELLS[d.base]}")
            rows.append((d, F.when(enough("n_hot"), found), None))
    null = F.lit(None).cast("double")
    values = F.array_compact(F.array(*[
        F.when(F.col("freq") == d.freq, F.struct(
            F.lit(d.name).alias("indicator"), value.cast("double").alias("value"), (null if first is None else first).cast("double").alias("first"),
        )) for d, value, first in rows
    ]))
    return periods.withColumn("_r", F.explode(values)).select("dataset_id", "cell_id", "_r.indicator", "freq", "period_no", "_r.value", "_r.first", "april")


def compute_indicators(df: DataFrame, defs: Sequence[Definition], missing: str | float = "any") -> DataFrame:
    """All definitions from one scan: (dataset_id, indicator, freq, cell_id, period_start, value).

    There is a row for every cell of a dataset and every period between the dataset's first and last month: NULL where a cell has no day in
    a period, whatever the rule for missing days.  Half-yearly rolling sums begin with the dataset's first April.
    """
    unknown = [d.base for d in defs if d.base not in BASES and d.base != ROLLING and d.base not in SPELLS]
    if unknown:
        raise ValueError(f"unknown index bases: {unknown}")
    plan = Plan.of(defs)
    # The periods a dataset spans and its first April are known when all its cells are folded, so the folded rows are stored.
    found = cut_lineage(_values(_periods(monthly_summaries(df, plan), plan), plan, missing))
    half_yearly = [d.name for d in plan.rolling if d.freq == "2QS-OCT"]
    spans = found.groupBy("dataset_id", "indicator", "freq").agg(
        F.min("period_no").alias("lo"), F.max("period_no").alias("hi"), F.min(F.when(F.col("april"), F.col("period_no"))).alias("april"))
    starts = F.when(F.col("indicator").isin(half_yearly), F.col("april")).otherwise(F.col("lo"))
    step = F.element_at(F.create_map(*[c for f in plan.freqs for c in (F.lit(f), F.lit(FREQUENCIES[f][0]))]), F.col("freq"))
    spans = cut_lineage(spans.select(
        "dataset_id", "indicator", "freq", "april", F.when(starts <= F.col("hi"), F.sequence(starts, F.col("hi"), step)).alias("numbers")))
    spans = small_enough_to_broadcast(spans)  # one row per dataset and definition
    every = found.select("dataset_id", "cell_id").distinct().join(spans, "dataset_id").select(
        "dataset_id", "indicator", "freq", "cell_id", "april", F.explode("numbers").alias("period_no"))
    keys = ["dataset_id", "indicator", "freq", "cell_id", "period_no"]
    value = F.when(F.col("indicator").isin(half_yearly) & (F.col("period_no") == F.col("april")), F.col("first")).otherwise(F.col("value"))
    return every.join(found.drop("april"), keys, "left").select(
        "dataset_id", "indicator", "freq", "cell_id", month_to_date("period_no").alias("period_start"), value.alias("value"))


def missing_indicators(defs: Sequence[Definition], catalog: DataFrame, ids: DataFrame) -> DataFrame:
    """(id, indicator) pairs the catalog does not list yet, matched on the catalog's frequency and variable name.

    The definitions are a short fixed list and are exploded next to each id; the anti-join is an equi-join.
    """
    wanted = ids.select("id").distinct().withColumn("_d", F.explode(F.array(*[
        F.struct(F.lit(d.name).alias("indicator"), F.lit(d.freq.replace("YS", "AS-JAN")).alias("xrfreq"),
                 F.lit(d.output).alias("variable")) for d in defs
    ]))).select("id", "_d.*")
    have = catalog.select("id", "xrfreq", F.explode("variable").alias("variable")).distinct()
    return wanted.join(have, ["id", "xrfreq", "variable"], "left_anti")


def compute_missing(df: DataFrame, defs: Sequence[Definition], todo: DataFrame, missing: str | float = "any") -> DataFrame:
    """Compute what ``missing_indicators`` lists: only the datasets with a gap are read, only their gaps returned."""
    pairs = cut_lineage(todo.select(F.col("id").alias("dataset_id"), "indicator").distinct())
    wanted = {r["indicator"] for r in pairs.select("indicator").distinct().collect()}  # names of ``defs`` at most
    if not wanted:
        return compute_indicators(df.limit(0), list(defs), missing)
    pairs = small_enough_to_broadcast(pairs)
    pending = df.join(pairs, "dataset_id", "left_semi")
    found = compute_indicators(pending, [d for d in defs if d.name in wanted], missing)
    return found.join(pairs, ["dataset_id", "indicator"], "left_semi")
