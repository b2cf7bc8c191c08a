"""From a raw simulation to an adjusted, checked, stored scenario.

Tables are written, each read by more than one later step: the reference, the regridded simulation, the factors and the
scenario, and at the end the final store.  They are versioned (``sources.store``): a step looks up which datasets are valid under the
present settings, filters its inputs to the others before the plan is built, writes them to a version of their own and switches to
it.  So a broken run is continued by running it again, a finished one reads no days, and changed settings make everything anew and
leave nothing of what was there.

All but the final store are bucketed by cell.  The days are exchanged when the reference is cut and when the simulation is
regridded; training, adjustment and check-up join and group what lies in place.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.calendars import convert_calendar, fixed_year_length
from ..operators import properties as M, quantile_map as B, regrid as G, selection as S
from ..session import cells_partitions, cut_lineage
from ..sources import daily as D
from ..sources.store import Table


@dataclass(frozen=True)
class Store:
    """Where the tables of a workflow lie; ``buckets`` by cell in each of them."""

    spark: SparkSession
    root: str
    buckets: int

    @classmethod
    def at(cls, spark: SparkSession, root: str, sim: DataFrame) -> Store:
        """The store at ``root``; a new one gets as many buckets as its simulation's size asks for and keeps them."""
        layout = f"{root.rstrip('/')}/layout"
        if not D.exists(spark, layout):
            rows = spark.createDataFrame([(cells_partitions(sim),)], "buckets int")
            rows.coalesce(1).write.mode("ignore").parquet(layout)
        return cls(spark, root.rstrip("/"), spark.read.parquet(layout).first()["buckets"])

    def table(self, name: str, partition_by: Sequence[str] = ()) -> Table:
        return Table(self.spark, f"{self.root}/{name}", self.buckets, tuple(partition_by))

    @property
    def final(self) -> Table:
        """Tiles of cells and years, in the order maps are read in."""
        return Table(self.spark, f"{self.root}/final", 0, ("year4",))


def settings_key(*settings: object) -> str:
    """A short name for the settings of a step."""
    return hashlib.sha256(repr(settings).encode()).hexdigest()[:16]


def fill(table: Table, key: str, ids: Sequence[str], build: Callable[[list[str]], DataFrame], in_place: bool = False) -> list[str]:
    """Write the datasets of ``ids`` that the table lacks under these settings, made by ``build`` from their ids, and return those."""
    done = table.finished(key)
    todo = [i for i in ids if i not in done]
    if todo:
        table.write(D.as_stored(build(todo)), todo, key, in_place)
    return todo


def checked(df: DataFrame) -> DataFrame:
    """Every window rests on one row per day: raise if a cell has two on one."""
    if not S.duplicate_keys(df).isEmpty():
        raise ValueError("the data are labelled daily, but some days have more than one record")
    return df


def _of(df: DataFrame, ids: Sequence[str]) -> DataFrame:
    return df.where(F.col("dataset_id").isin(list(ids)))


def make_reference(ref: DataFrame, cells: DataFrame, box: S.Box, store: Store, name: str = "reference") -> DataFrame:
    """Cut the reference to the box and its land cells, and store it in the two calendars of the simulations.

    The fine days are read once, to be cut; what is checked, searched for land and converted is the stored cut.
    """
    table, key = store.table("reference", ["calendar"]), settings_key(box, name)

    def build(_: list[str]) -> DataFrame:
        cut = store.table("reference_cut")
        fill(cut, key, [name], lambda _: S.in_bbox(ref, cells, box).withColumn("dataset_id", F.lit(name)))
        days = checked(D.canonical(cut.read(), {}))
        first_t = days.agg(F.min("t")).first()[0]
        land = S.on_cells(days, S.land_cells(days, first_t))
        return convert_calendar(land, "noleap").unionByName(convert_calendar(land, "360_day"))

    fill(table, key, [name], build, in_place=True)
    return D.canonical(table.read([name]), {})


def regrid_simulation(sim: DataFrame, weights: DataFrame, store: Store, ids: Sequence[str], key: str = "") -> DataFrame:
    """Interpolate to the reference cells; standard calendars lose 29 February.  The coarse days are checked first."""
    table = store.table("regridded")

    def build(todo: list[str]) -> DataFrame:
        fine = G.regrid(checked(_of(sim, todo)), weights, D.VARIABLES)
        return convert_calendar(fine, "noleap", others="keep")

    fill(table, settings_key("regrid", key), ids, build)
    return D.canonical(table.read(ids), {})


def train_and_adjust(
    ref: DataFrame, sim: DataFrame, conf: B.Conf, store: Store, ids: Sequence[str], key: str = "",
) -> tuple[DataFrame, list[str]]:
    """The scenario of all ``ids``, and those made just now."""
    own, training, scenario = settings_key(conf, key), store.table("training"), store.table("scenario")
    fill(training, own, ids, lambda todo: B.train(ref, S.in_period(_of(sim, todo), *conf.reference_period), conf))
    made = fill(scenario, own, ids, lambda todo: B.adjust(training.read(todo), _of(sim, todo), conf), in_place=True)
    return D.canonical(scenario.read(ids), {}), made


def check(ref: DataFrame, sim: DataFrame, scen: DataFrame, conf: B.Conf, future: tuple[int, int], store: Store) -> DataFrame:
    """Check-up properties of simulation and scenario, and the report that sets them side by side; impossible rows raise."""
    bad = B.check_physical(scen).where("tasmin_over_tasmax > 0 OR negative_pr > 0")
    if not bad.isEmpty():
        raise ValueError(f"physically impossible rows: {bad.limit(5).collect()}")
    # A reference row exists in both calendars; the check-up needs one of them.
    one = ref.where(F.col("calendar") == "noleap")
    sides = [
        M.checkup(df, one, conf.reference_period, future).withColumn("step", F.lit(step))
        for step, df in (("sim", sim), ("scen", scen))
    ]
    both = cut_lineage(sides[0].unionByName(sides[1]))
    D.replace_datasets(both, f"{store.root}/checkup", ["dataset_id", "step"])
    D.replace_datasets(M.checkup_report(both), f"{store.root}/report", ["dataset_id"])
    return both


def finish(scen: DataFrame, cells: DataFrame, conf: B.Conf, store: Store, ids: Sequence[str], key: str, **notes: str) -> DataFrame:
    """The final store: a row for every land cell and day of the target period, attributes, tiles of cells and years."""
    first, last = conf.target_period

    def build(todo: list[str]) -> DataFrame:
        rows = _of(scen, todo)
        grid = cut_lineage(rows.select("dataset_id", "calendar", "cell_id").distinct())
        length = fixed_year_length("calendar")
        days = F.explode(F.sequence((first * length).cast("int"), ((last + 1) * length - 1).cast("int")))
        dense = grid.withColumn("t", days).join(rows.select("dataset_id", "cell_id", "t", *D.VARIABLES), ["dataset_id", "cell_id", "t"], "left")
        dense = dense.withColumns({"year": F.floor(F.col("t") / length).cast("int"), "doy": (F.col("t") % length + 1).cast("int")})
        return D.stamp_metadata(D.final_rows(dense, cells), D.FINAL_ATTRS, D.FINAL_ATTR_NAMES, **notes)

    fill(store.final, settings_key(conf, key, notes), ids, build)
    return store.final.read(ids)


def produce(
    spark: SparkSession, ref: DataFrame, sim: DataFrame, cells: DataFrame, weights: DataFrame, box: S.Box, conf: B.Conf,
    future: tuple[int, int], root: str, ids: Sequence[str] | None = None,
) -> DataFrame:
    """All steps for the datasets ``ids`` of ``sim``, by default all; returns the scenario.

    With ``ids``, known from the catalog, a second call reads no daily rows.
    """
    store = Store.at(spark, root, sim)
    if ids is None:
        ids = sorted(r["dataset_id"] for r in sim.select("dataset_id").distinct().collect())
    reference = make_reference(ref, cells, box, store)
    regridded = regrid_simulation(sim, weights, store, ids, repr(box))
    scen, made = train_and_adjust(reference, regridded, conf, store, ids, repr(box))
    if made:
        check(reference, _of(regridded, made), _of(scen, made), conf, future, store)
    finish(scen, cells, conf, store, ids, repr((box, future)))
    return scen


def from_catalog(
    spark: SparkSession, catalog: DataFrame, facets: dict, units: dict[str, str] | None = None,
) -> tuple[DataFrame, list[str]]:
    """Search members, add the historical years of each, open their daily tables: the rows and the ids of the members."""
    from ..sources import catalog as T

    chosen = T.pair_hist_future(T.search(catalog, **facets))
    ids = sorted(r["id"] for r in chosen.select("id").distinct().collect())
    return D.load_selected(spark, chosen, units), ids
