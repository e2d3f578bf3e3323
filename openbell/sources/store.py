"""Stage tables: versioned parquet folders, prerequisite checks, model files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from openbell.sources.snapshots import SnapshotTable


class TableStore:
    """Tables below one shared root, each replaced by writing a new version.

    A job that dies half-way leaves a folder without ``_SUCCESS``, which readers
    skip, and a table can be rewritten from its own previous version.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self._layout: dict[str, tuple[str, tuple[str, ...]]] = {}

    def declare(self, name: str, schema: str, partition_by: tuple[str, ...]) -> None:
        """Give a table its schema (an empty partitioned table has no file to tell it) and partition columns."""
        self._layout[name] = (schema, partition_by)

    def snapshots(self, name: str, partition: str = "", sort: tuple[str, ...] = ()) -> SnapshotTable:
        """The table as one of snapshots, of which parts can be replaced."""
        return SnapshotTable(self.spark, f"{self.root}/{name}", partition, sort)

    def _path(self, *parts: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path("/".join([self.root, *parts]))

    def _fs(self):
        return self._path().getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _versions(self, name: str, committed: bool) -> list[int]:
        fs, folder = self._fs(), self._path(name)
        if not fs.exists(folder):
            return []
        found = [s.getPath().getName() for s in fs.listStatus(folder)]
        numbers = [int(n[1:]) for n in found if n.startswith("v") and n[1:].isdigit()]
        if committed:
            numbers = [n for n in numbers if fs.exists(self._path(name, f"v{n}", "_SUCCESS"))]
        return sorted(numbers)

    def _newest(self, name: str) -> int | None:
        """The newest committed version; older ones are not looked at."""
        fs = self._fs()
        for n in reversed(self._versions(name, committed=False)):
            if fs.exists(self._path(name, f"v{n}", "_SUCCESS")):
                return n
        return None

    def _by_snapshots(self, name: str) -> bool:
        return self._fs().exists(self._path(name, "log"))

    def exists(self, name: str) -> bool:
        return self._newest(name) is not None or self._by_snapshots(name)

    def location(self, name: str) -> str:
        newest = self._newest(name)
        if newest is None:
            raise FileNotFoundError(f"no table {name!r} below {self.root}")
        return f"{self.root}/{name}/v{newest}"

    def prune(self, keep: int = 3) -> None:
        """Delete all but the last ``keep`` committed versions of every table (whole
        versions, never rows), and uncommitted ones that are older than those."""
        fs = self._fs()
        if not fs.exists(self._path()):
            return
        for status in fs.listStatus(self._path()):
            name = status.getPath().getName()
            if self._by_snapshots(name):
                self.snapshots(name).vacuum(keep)
            good = self._versions(name, committed=True) if status.isDirectory() else []
            if len(good) > keep:
                for n in self._versions(name, committed=False):
                    if n < good[-keep]:
                        fs.delete(self._path(name, f"v{n}"), True)

    def read(self, name: str) -> DataFrame:
        if self._by_snapshots(name):
            return self.snapshots(name).read()
        return self._scan(name, self.location(name))

    def _scan(self, name: str, path: str) -> DataFrame:
        schema, _ = self._layout.get(name, (None, ()))
        reader = self.spark.read.schema(schema) if schema else self.spark.read
        return reader.parquet(path)

    def replace(self, name: str, df: DataFrame, partition_by: tuple[str, ...] = ()) -> DataFrame:
        """Write the next version and return it as a fresh scan."""
        path = self.next_location(name)
        partition_by = partition_by or self._layout.get(name, ("", ()))[1]
        df.write.partitionBy(*partition_by).parquet(path)
        return self._scan(name, path)

    def next_location(self, name: str) -> str:
        versions = self._versions(name, committed=False)
        return f"{self.root}/{name}/v{(versions[-1] + 1) if versions else 1}"

    def append(self, name: str, df: DataFrame) -> None:
        """Add rows to the current version (delta of one scoring batch)."""
        path = self.location(name) if self.exists(name) else self.next_location(name)
        df.write.mode("append").partitionBy(*self._layout.get(name, ("", ()))[1]).parquet(path)

    def overwrite(self, name: str, df: DataFrame) -> None:
        """Replace the partitions of a declared table that ``df`` has rows of; all others keep their files."""
        if not self.exists(name):  # a dynamic overwrite leaves no mark of success
            self.replace(name, df)
            return
        path = self.location(name)
        (
            df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            .partitionBy(*self._layout[name][1]).parquet(path)
        )

    def prerequisites(self, **how_to_create: str) -> DataFrame:
        """(table, remedy, present, n): one row per wanted table; n is null where it is missing."""
        found = None
        for name, how in how_to_create.items():
            present = self.exists(name)
            rows = self.read(name).agg(F.count("*").alias("n")) if present else self.spark.range(1).select(F.lit(None).cast("bigint").alias("n"))
            rows = rows.select(F.lit(name).alias("table"), F.lit(how).alias("remedy"), F.lit(present).alias("present"), "n")
            found = rows if found is None else found.unionByName(rows)
        return found

    def require(self, **how_to_create: str) -> None:
        """Raise one error that names every missing table and its remedy."""
        missing = [f"{n} ({how})" for n, how in how_to_create.items() if not self.exists(n)]
        if missing:
            raise FileNotFoundError("required tables missing: " + "; ".join(missing))
