"""Session settings and the shared scratch folder."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

# Runtime settings the plans rely on for speed; results do not depend on them.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Data hashed by cell alone may be joined on (cell, day of year, variable) without another exchange.
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    # Rows that hold all days of a cell are large.
    "spark.sql.execution.arrow.maxBytesPerBatch": str(32 << 20),
}


def tune(spark: SparkSession) -> SparkSession:
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def scratch_dir(spark: SparkSession) -> str:
    """A fresh folder below the shared one named in ``spark.checkpoint.dir``.

    Where that is not set, the warehouse folder, which driver and executors share too, takes its place.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    base = base or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/scratch"
    return f"{base.rstrip('/')}/{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: a short plan that survives lost executors.

    The size of the written files is known to the optimizer, so it broadcasts such a table only where it is small.
    """
    path = scratch_dir(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _row_bytes(df: DataFrame) -> int:
    """Bytes of a row in memory, strings and lists taken as 64."""
    wide = {"string": 64, "binary": 64}
    return 16 + sum(64 if "<" in kind else wide.get(kind, 8) for _, kind in df.dtypes)


def small_enough_to_broadcast(df: DataFrame, max_bytes: int = 64 << 20) -> DataFrame:
    """Mark a dimension table for broadcast after counting it; beyond ``max_bytes`` it is left to a shuffled join.

    The count stops past the limit, so it is cheap for a table read from storage.
    """
    most = max_bytes // _row_bytes(df)
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df


def input_bytes(df: DataFrame) -> int:
    """Size of all tables a plan reads, as the optimizer knows it without a job."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size())]
    return sum(s for s in sizes if s < 1 << 60)


def hashed_by_cell(df: DataFrame) -> int | None:
    """The number of partitions if a plan's rows are hashed by ``cell_id`` alone, from bucketed storage or by an exchange.

    A plan that ends in an Arrow kernel still names its child's partitioning, by a column that is no longer its own: that is none.
    """
    plan = df._jdf.queryExecution().sparkPlan()
    found = re.fullmatch(r"hashpartitioning\((cell_id#\d+), (\d+)\)", plan.outputPartitioning().toString())
    own = re.findall(r"cell_id#\d+", plan.output().toString())
    return int(found.group(2)) if found and found.group(1) in own else None


def cells_partitions(df: DataFrame, most_bytes: int = 64 << 20) -> int:
    """A partition for each ``most_bytes`` of input, with the session's shuffle partitions as the least."""
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-input_bytes(df) // most_bytes))


def spread(df: DataFrame, *keys: str, most_bytes: int = 16 << 20) -> DataFrame:
    """Rows dealt by ``keys`` where the session's shuffle partitions would each get more than ``most_bytes`` of input.

    Adaptive execution merges small partitions of an aggregation but splits no large ones, so their memory would grow with the table.
    """
    wanted = -(-input_bytes(df) // most_bytes)
    return df.repartition(wanted, *keys) if wanted > int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) else df


def by_cell(df: DataFrame, partitions: int | None = None, exactly: bool = False) -> DataFrame:
    """All days of a cell in one partition, for per-cell statistics.  A cell has at most one row per dataset and day.

    Rows that are hashed by cell already stay where they are, unless ``exactly`` asks for another number of partitions.  That
    number is given, so that adaptive execution does not merge partitions by their bytes: window samples and sorts make the work
    per byte far larger than the exchange suggests.  It follows the size of the input, with the session's shuffle partitions as
    the least.
    """
    have = hashed_by_cell(df)
    if have is not None and (not exactly or have == partitions):
        return df
    if exactly:
        return df.repartition(partitions, "cell_id")
    return df.repartition(max(partitions or 0, cells_partitions(df)), "cell_id")
