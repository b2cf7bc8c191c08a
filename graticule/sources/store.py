"""Tables of a workflow: written in versions, valid by one switch, stored by cell.

A table is a folder with ``data/version=<name>/dataset_id=<id>/...`` and ``current/<number>``.  A write goes to a version of its own and
touches nothing that is there.  When all its files are complete, a list of which version holds which dataset, under which
settings, is written as the next number; that list is the switch.  Readers take the highest number whose list is complete.  So a
broken write leaves what was valid, a dataset that shrinks keeps no rows of its former self, and other datasets keep theirs.

Data are bucketed by cell: rows of a cell lie in one bucket, the same in every table of equal bucket count.  Grouping by cell and
joins on cell need no exchange of them.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Row, SparkSession, functions as F, types as T

from ..session import by_cell, input_bytes

WRITE_BYTES = 16 << 20  # input to a task that writes

_LIST = "dataset_id string, version string, key string, columns string"


def _path(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def _children(spark: SparkSession, path: str) -> list[str]:
    fs, p = _path(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []


def _complete(spark: SparkSession, path: str) -> bool:
    fs, p = _path(spark, f"{path}/_SUCCESS")
    return fs.exists(p)


@dataclass(frozen=True)
class Table:
    """A versioned table at ``path``; ``buckets`` by cell, the same number in all tables that are joined (0: not bucketed)."""

    spark: SparkSession
    path: str
    buckets: int = 0
    partition_by: tuple[str, ...] = ()

    # --- the switch ---

    def _numbers(self) -> list[int]:
        names = _children(self.spark, f"{self.path}/current")
        return sorted(int(n) for n in names if n.isdigit() and _complete(self.spark, f"{self.path}/current/{n}"))

    def listed(self) -> list[Row]:
        """(dataset_id, version, key, columns) of what is valid: one per dataset."""
        numbers = self._numbers()
        if not numbers:
            return []
        return sorted(self.spark.read.schema(_LIST).parquet(f"{self.path}/current/{numbers[-1]:08d}").collect())

    def finished(self, key: str) -> set[str]:
        """Datasets that are valid under the settings ``key``."""
        return {r["dataset_id"] for r in self.listed() if r["key"] == key}

    def _switch(self, rows: list) -> None:
        number = max([*self._numbers(), 0]) + 1
        self.spark.createDataFrame(rows, _LIST).coalesce(1).write.mode("overwrite").parquet(f"{self.path}/current/{number:08d}")

    # --- data ---

    def write(self, df: DataFrame, ids: Sequence[str], key: str, in_place: bool = False) -> None:
        """``df`` becomes all there is of the datasets ``ids``, also of one it has no rows for.

        ``in_place``: it comes from tables of this bucket count without an exchange in between, so each of its partitions holds rows of one
        bucket and need not be dealt anew.  Rows get to their bucket either way; it is files that would be many.
        """
        version = uuid.uuid4().hex
        folder = f"{self.path}/data/version={version}"
        by = ["dataset_id", *self.partition_by]
        if self.buckets:
            # A multiple of the buckets: a task sorts a part of one bucket, of bounded size, and writes a file of it for each dataset.
            parts = self.buckets * max(1, -(-input_bytes(df) // (self.buckets * WRITE_BYTES)))
            rows = df if in_place else by_cell(df, parts, exactly=True)
            name = f"store_{uuid.uuid4().hex}"
            (rows.write.format("parquet").option("path", folder).partitionBy(*by).bucketBy(self.buckets, "cell_id").saveAsTable(name))
            self.spark.sql(f"DROP TABLE {name}")  # the files stay: the table is external
        else:
            df.write.partitionBy(*by).parquet(folder)
        kept = [tuple(r) for r in self.listed() if r["dataset_id"] not in set(ids)]
        self._switch(kept + [(i, version, key, df.schema.json()) for i in ids])

    def read(self, ids: Sequence[str] | None = None) -> DataFrame:
        """The valid rows, of all datasets or of ``ids``; columns in the order and with the attributes in which they were written last."""
        rows = [r for r in self.listed() if ids is None or r["dataset_id"] in set(ids)]
        if not rows:
            raise FileNotFoundError(f"nothing is stored at {self.path}" + ("" if ids is None else f" for {sorted(ids)}"))
        fields = T.StructType.fromJson(json.loads(rows[-1]["columns"])).fields
        shape = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields) + ", version string"
        data = f"{self.path}/data"
        versions = sorted({r["version"] for r in rows})
        if self.buckets:
            name = f"store_{uuid.uuid4().hex}"
            by = ", ".join(["version", "dataset_id", *self.partition_by])
            self.spark.sql(
                f"CREATE TABLE {name} ({shape}) USING parquet PARTITIONED BY ({by}) "
                f"CLUSTERED BY (cell_id) INTO {self.buckets} BUCKETS LOCATION '{data}'")
            self.spark.catalog.recoverPartitions(name)
            df = self.spark.table(name)
        else:
            df = self.spark.read.schema(shape).option("basePath", data).parquet(*[f"{data}/version={v}" for v in versions])
        valid = None
        for v in versions:
            of = (F.col("version") == v) & F.col("dataset_id").isin([r["dataset_id"] for r in rows if r["version"] == v])
            valid = of if valid is None else valid | of
        return df.where(valid).select(*[F.col(f.name).alias(f.name, metadata=f.metadata) if f.metadata else f.name for f in fields])

    def stale(self) -> list[str]:
        """Versions that the valid list does not name: former ones and those of broken writes."""
        used = {r["version"] for r in self.listed()}
        names = [n.split("=", 1)[1] for n in _children(self.spark, f"{self.path}/data") if n.startswith("version=")]
        return sorted(set(names) - used)

    def remove_stale(self) -> list[str]:
        """Delete them; not while another run writes to this table or reads a former version."""
        gone = self.stale()
        for v in gone:
            fs, p = _path(self.spark, f"{self.path}/data/version={v}")
            fs.delete(p, True)
        return gone

