"""Reading, checking and writing the long daily table (one row per dataset, cell and day)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..functions.calendars import with_standard_calendar
from ..functions.units import CANONICAL, convert
from ..session import small_enough_to_broadcast, spread
from ..session import by_cell  # noqa: F401  (the other of the two layouts)

VARIABLES = ("tasmax", "tasmin", "pr")

DAILY_SCHEMA = T.StructType([
    T.StructField("dataset_id", T.StringType(), False),
    T.StructField("calendar", T.StringType(), False),
    T.StructField("cell_id", T.IntegerType(), False),
    T.StructField("year", T.IntegerType(), False),
    T.StructField("month", T.IntegerType(), False),
    T.StructField("day", T.IntegerType(), False),
    T.StructField("doy", T.IntegerType(), False),
    T.StructField("t", T.IntegerType(), False),
    T.StructField("date", T.DateType(), True),
    T.StructField("tasmax", T.FloatType(), True),
    T.StructField("tasmin", T.FloatType(), True),
    T.StructField("pr", T.FloatType(), True),
])


def nan_to_null(df: DataFrame, variables: Sequence[str]) -> DataFrame:
    """Missing values are NULL, never NaN: ``percentile`` and comparisons rank NaN as the largest value."""
    return df.withColumns({v: F.when(~F.isnan(v), F.col(v)) for v in variables})


def read_daily(
    spark: SparkSession,
    path: str | Sequence[str],
    units: dict[str, str] | None = None,
    variables: Sequence[str] = VARIABLES,
) -> DataFrame:
    """Open a stored daily table in canonical units, values as double, NaN as NULL."""
    paths = [path] if isinstance(path, str) else list(path)
    keep = [f.name for f in DAILY_SCHEMA if f.name not in VARIABLES] + list(variables)
    df = spark.read.schema(T.StructType([DAILY_SCHEMA[c] for c in keep])).parquet(*paths)
    return canonical(df, units or {}, variables)


def canonical(df: DataFrame, units: dict[str, str], variables: Sequence[str] = VARIABLES) -> DataFrame:
    df = df.withColumns({v: F.col(v).cast("double") for v in variables})
    df = nan_to_null(df, variables)
    return df.withColumns({
        v: convert(F.col(v), units[v], CANONICAL[v]) for v in variables if v in units and units[v] != CANONICAL[v]
    })


def read_cells(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("cell_id int, lat double, lon double").parquet(path)


def load_selected(spark: SparkSession, selected: DataFrame, units: dict[str, str] | None = None) -> DataFrame:
    """Open the datasets a catalog search found, as one frame.

    The driver takes only the paths; their number is that of the members chosen.  ``time_bnds`` is never read, and
    rows of other than daily frequency are ignored.
    """
    daily = selected.where(F.col("frequency").isin("day", "D"))
    paths = [r["path"] for r in daily.select("path").distinct().toLocalIterator()]
    if not paths:
        raise ValueError("no daily dataset selected")
    return read_daily(spark, paths, units)


# --- checks and resampling -------------------------------------------------------------------------------------------


def records_per_day(df: DataFrame, stamp: str = "ts", keys: Sequence[str] = ("dataset_id", "cell_id")) -> DataFrame:
    """Number of records of every key and civil day."""
    days = spread(df.select(*keys, F.to_date(stamp).alias("date")), *keys, "date")
    return days.groupBy(*keys, "date").agg(F.count(F.lit(1)).alias("n"))


def check_daily(df: DataFrame, keys: Sequence[str] = ("dataset_id", "cell_id"), stamp: str = "date") -> DataFrame:
    """Raise if a key has two records on one day; otherwise return ``df`` with the stamp cut to midnight."""
    doubles = records_per_day(df, stamp, keys).where("n > 1").limit(1)
    if not doubles.isEmpty():
        raise ValueError("the data are labelled daily, but some days have more than one record")
    return df.withColumn(stamp, F.date_trunc("day", stamp).cast(df.schema[stamp].dataType))


def to_daily(
    df: DataFrame, how: dict[str, tuple[str, str]], keys: Sequence[str] = ("dataset_id", "cell_id"), stamp: str = "ts"
) -> DataFrame:
    """Sub-daily to daily, e.g. ``{"tasmax": ("max", "tas"), "tasmin": ("min", "tas"), "pr": ("mean", "pr")}``."""
    agg = {"max": F.max, "min": F.min, "mean": F.avg, "sum": F.sum}
    daily = df.groupBy(*keys, F.to_date(stamp).alias("date")).agg(
        *[agg[op](src).alias(name) for name, (op, src) in how.items()]
    )
    return with_standard_calendar(daily)


# --- layouts and sinks -----------------------------------------------------------------------------------------------


def by_time(df: DataFrame) -> DataFrame:
    """All cells of a day in one partition, for regridding."""
    return df.repartition("dataset_id", "t")


def as_stored(df: DataFrame, variables: Sequence[str] = VARIABLES) -> DataFrame:
    # A column that is float already keeps its attributes.
    kinds = dict(df.dtypes)
    return df.withColumns({v: F.col(v).cast("float") for v in variables if kinds.get(v, "float") != "float"})


_MODES = {"f": "errorifexists", "o": "overwrite", "a": "append"}


def write_table(df: DataFrame, path: str, mode: str = "f", partition_by: Sequence[str] = ()) -> None:
    """Write as float32.  Modes: ``f`` fail if present, ``o`` overwrite, ``a`` append."""
    as_stored(df).write.mode(_MODES[mode]).partitionBy(*partition_by).parquet(path)


def exists(spark: SparkSession, path: str) -> bool:
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop_path)


def write_if_absent(df: DataFrame, path: str, key: Sequence[str] = ("dataset_id", "var")) -> None:
    """Append only the keys the table does not hold yet; rerunning a finished step writes nothing."""
    spark = df.sparkSession
    if exists(spark, path):
        done = small_enough_to_broadcast(spark.read.parquet(path).select(*key).distinct())
        df = df.join(done, list(key), "left_anti")
    df.write.mode("append").partitionBy(*key).parquet(path)


def _overwrite_partitions(df: DataFrame, path: str, partition_by: Sequence[str]) -> None:
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_by)
        .parquet(path)
    )


def replace_datasets(df: DataFrame, path: str, partition_by: Sequence[str] = ("dataset_id",)) -> None:
    """Write the partitions ``df`` has rows for, as float32, in place of what they held; others stay."""
    _overwrite_partitions(as_stored(df), path, partition_by)


def append_slices(df: DataFrame, path: str, files: int = 8) -> None:
    """Write successive time slices of indicators; a slice of a dataset written twice replaces itself and nothing else."""
    sliced = df.withColumn("period_year", F.year("period_start"))
    # A year of one indicator holds every cell of a dataset: spread it over several files.
    spread = sliced.repartition("dataset_id", "indicator", "period_year", F.pmod("cell_id", F.lit(files)))
    _overwrite_partitions(spread, path, ["dataset_id", "indicator", "period_year"])


def replace_partition(df: DataFrame, path: str, column: str, value: str) -> None:
    """Replace one variable of an output partitioned by (dataset_id, ``column``), for the datasets of ``df`` alone."""
    _overwrite_partitions(df.where(F.col(column) == value), path, ["dataset_id", column])


def final_layout(df: DataFrame, cells: DataFrame, block: int = 50, years: int = 4, step: float = 0.1) -> DataFrame:
    """Tag rows with a ``block`` x ``block`` cell tile and a ``years`` long slice of time."""
    tile = F.concat_ws(
        "_",
        F.floor(F.col("lat") / (block * step)).cast("int"),
        F.floor(F.col("lon") / (block * step)).cast("int"),
    )
    tiles = cells.select("cell_id", tile.alias("block"))
    return df.join(small_enough_to_broadcast(tiles), "cell_id").withColumn("year4", (F.col("year") - F.pmod(F.col("year"), F.lit(years))).cast("int"))


def final_rows(df: DataFrame, cells: DataFrame) -> DataFrame:
    """Rows in the order of the final store: one task per tile and 4-year slice, a cell's days together."""
    laid = final_layout(as_stored(df), cells)
    return laid.repartition("dataset_id", "block", "year4").sortWithinPartitions("dataset_id", "year4", "block", "cell_id", "t")


def write_final(df: DataFrame, cells: DataFrame, path: str, mode: str = "f") -> None:
    """Final store: one file per tile and 4-year slice, sorted so that a cell's days lie together."""
    final_rows(df, cells).write.mode(_MODES[mode]).partitionBy("dataset_id", "year4").parquet(path)


def stamp_metadata(df: DataFrame, attrs: dict[str, dict[str, str]], keep: Sequence[str], **fmt: str) -> DataFrame:
    """Fill attribute templates per column and keep only the whitelisted names."""
    for col, values in attrs.items():
        present = dict(df.schema[col].metadata)
        present.update({k: v.format(**fmt) for k, v in values.items()})
        df = df.withMetadata(col, {k: v for k, v in present.items() if k in keep})
    return df


# Attributes of the final variables.
FINAL_ATTRS = {
    "tasmax": {
        "standard_name": "air_temperature", "long_name": "Maximal daily temperature",
        "cell_methods": "time: maximum within days",
    },
    "tasmin": {
        "standard_name": "air_temperature", "long_name": "Minimal daily temperature",
        "cell_methods": "time: minimum within days",
    },
    "pr": {
        "standard_name": "precipitation_flux", "long_name": "Mean daily precipitation flux",
        "cell_methods": "time: mean within days",
    },
}
# The attribute names kept.
FINAL_ATTR_NAMES = (
    "bias_adjustment", "cell_methods", "coordinates", "history", "long_name", "standard_name", "units",
)


def write_properties(props: DataFrame, measures: DataFrame, path: str) -> None:
    """Properties and measures of a dataset in one write, told apart by the ``kind`` partition."""
    both = props.withColumn("kind", F.lit("properties")).unionByName(measures.withColumn("kind", F.lit("measures")))
    _overwrite_partitions(both, path, ["dataset_id", "kind"])
