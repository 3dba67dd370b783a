"""Stored tables: one folder per layer and table, replaced by whole snapshots.

Plain Parquet has no UPDATE or DELETE. A table is a folder of numbered
snapshots; the current one is the highest that Spark finished writing, which
its ``_SUCCESS`` file tells. A rewrite therefore never touches files that are
being read, and a writer that dies leaves the table as it was.

Within a snapshot, loads are written as slices (``batch_id=7``). Writing a
slice again replaces it, so a repeated load adds nothing.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from ordermill.session import CODEC, freed


class Warehouse:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self.views: list[str] = []  # SQL views registered on these tables

    def path(self, layer: str, table: str) -> str:
        return f"{self.root}/{layer}/{table}"

    def _folder(self, path: str):
        jvm = self.spark.sparkContext._jvm
        folder = jvm.org.apache.hadoop.fs.Path(path)
        return folder.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), folder

    def _exists(self, path: str) -> bool:
        fs, folder = self._folder(path)
        return fs.exists(folder)

    def _numbers(self, layer: str, table: str) -> list[int]:
        """Numbers of all snapshots, also of those a writer left unfinished, oldest first."""
        fs, folder = self._folder(self.path(layer, table))
        if not fs.exists(folder):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(folder) if s.isDirectory()]
        return sorted(int(n[1:]) for n in names if n.startswith("v"))

    def _finished(self, layer: str, table: str, version: int) -> bool:
        return self._exists(f"{self._snapshot(layer, table, version)}/_SUCCESS")

    def version(self, layer: str, table: str) -> int:
        """Newest finished snapshot, looked for from the top; -1 without one."""
        found = (v for v in reversed(self._numbers(layer, table)) if self._finished(layer, table, v))
        return next(found, -1)

    def versions(self, layer: str, table: str) -> list[int]:
        """Finished snapshots, oldest first."""
        return [v for v in self._numbers(layer, table) if self._finished(layer, table, v)]

    def _snapshot(self, layer: str, table: str, version: int) -> str:
        return f"{self.path(layer, table)}/v{version:09d}"

    def current(self, layer: str, table: str) -> str | None:
        newest = self.version(layer, table)
        return self._snapshot(layer, table, newest) if newest >= 0 else None

    def exists(self, layer: str, table: str) -> bool:
        return self.current(layer, table) is not None

    def read(self, layer: str, table: str, schema: str | None = None) -> DataFrame:
        path = self.current(layer, table)
        if path is None:
            if schema is None:
                raise ValueError(f"{layer}.{table} does not exist")
            return self.spark.createDataFrame([], schema)
        reader = self.spark.read if schema is None else self.spark.read.schema(schema)
        return reader.parquet(path)

    def read_version(self, layer: str, table: str, version: int, schema: str | None = None) -> DataFrame:
        reader = self.spark.read if schema is None else self.spark.read.schema(schema)
        return reader.parquet(self._snapshot(layer, table, version))

    def commit(self, df: DataFrame, layer: str, table: str, partition_by: tuple[str, ...] = (),
               version: int | None = None, more: bool = False) -> DataFrame:
        """Write the next snapshot and return it; or ``more`` rows of one that was begun."""
        number = version if version is not None else self.version(layer, table) + 1
        path = self._snapshot(layer, table, number)
        with freed(self.spark):
            df.write.option("compression", CODEC).mode("append" if more else "overwrite").partitionBy(*partition_by).parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def write_slice(self, df: DataFrame, layer: str, table: str, column: str, value: int,
                    partition_by: tuple[str, ...] = (), version: int | None = None) -> None:
        """Write or replace the slice ``column=value`` of a snapshot, the current one unless told."""
        path = self._snapshot(layer, table, max(self.version(layer, table), 0) if version is None else version)
        with freed(self.spark):
            df.write.option("compression", CODEC).mode("overwrite").partitionBy(*partition_by).parquet(f"{path}/{column}={value}")
        fs, done = self._folder(f"{path}/_SUCCESS")
        if not fs.exists(done):
            fs.create(done).close()

    @contextmanager
    def writing(self, layer: str, table: str, column: str, value: int, partition_by: tuple[str, ...] = (),
                version: int | None = None) -> Iterator[Callable[[DataFrame], None]]:
        """Write or replace a slice by several frames: gives a function that adds one.

        They are added beside the table, and no reader sees any before all are there.
        """
        path = self._snapshot(layer, table, max(self.version(layer, table), 0) if version is None else version)
        fs, aside = self._folder(f"{path}/_writing/{column}={value}")
        fs.delete(aside, True)  # of a writer that stopped

        def add(df: DataFrame) -> None:
            with freed(self.spark):
                df.write.option("compression", CODEC).mode("append").partitionBy(*partition_by).parquet(aside.toString())

        yield add
        _, slice_ = self._folder(f"{path}/{column}={value}")
        fs.mkdirs(aside)
        fs.delete(slice_, True)
        if not fs.rename(aside, slice_):
            raise OSError(f"{aside} could not be moved to {slice_}")
        _, done = self._folder(f"{path}/_SUCCESS")
        if not fs.exists(done):
            fs.create(done).close()

    def buckets(self, layer: str, table: str, schema: str, column: str, count: int) -> str:
        """Name of a table whose rows lie in ``count`` buckets by a column; rows are only ever added.

        Joins on that column read it without a shuffle. The files alone count: any
        session that names the table finds what others have added.
        """
        path = self.path(layer, table)
        name = f"{re.sub(r'\W', '_', table)}_{hashlib.md5(path.encode()).hexdigest()[:16]}"
        fs, folder = self._folder(path)
        fs.mkdirs(folder)
        self.spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({schema}) USING parquet OPTIONS (compression '{CODEC}') "
                       f"CLUSTERED BY ({column}) SORTED BY ({column}) INTO {count} BUCKETS LOCATION '{path}'")
        self.spark.catalog.refreshTable(name)
        return name

    def overwrite_slices(self, df: DataFrame, layer: str, table: str, partition_by: tuple[str, ...], version: int | None = None) -> None:
        """Write or replace the slices that ``df`` has rows of; others are not touched."""
        path = self._snapshot(layer, table, max(self.version(layer, table), 0) if version is None else version)
        with freed(self.spark):
            df.write.option("compression", CODEC).mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by).parquet(path)
        fs, done = self._folder(f"{path}/_SUCCESS")
        if not fs.exists(done):
            fs.create(done).close()

    def slices(self, layer: str, table: str, version: int | None = None, within: str = "") -> set[str]:
        """Names of the slices in a snapshot, the current one unless told, or of those below the slice ``within``."""
        path = self.current(layer, table) if version is None else self._snapshot(layer, table, version)
        if path is None or not self._exists(f"{path}/{within}".rstrip("/")):
            return set()
        fs, folder = self._folder(f"{path}/{within}".rstrip("/"))
        names = [s.getPath().getName() for s in fs.listStatus(folder) if s.isDirectory()]
        return {n for n in names if "=" in n}

    def files(self, layer: str, table: str, version: int, within: str = "") -> list[str]:
        """Paths, below a snapshot, of its Parquet files, or of those below the slice ``within``."""
        root = self._snapshot(layer, table, version)
        fs, folder = self._folder(f"{root}/{within}".rstrip("/"))
        top = fs.makeQualified(self._folder(root)[1]).toUri().getPath()
        found, listed = [], fs.listFiles(folder, True) if fs.exists(folder) else None
        while listed is not None and listed.hasNext():
            name = listed.next().getPath().toUri().getPath()[len(top) + 1:]
            if name.endswith(".parquet") and "_temporary/" not in name:
                found.append(name)
        return sorted(found)

    def read_files(self, layer: str, table: str, version: int, names: Iterable[str], schema: str) -> DataFrame:
        """Rows of some files of a snapshot, with the columns of their folders."""
        root = self._snapshot(layer, table, version)
        return self.spark.read.schema(schema).option("basePath", root).parquet(*[f"{root}/{n}" for n in names])

    def replace_files(self, layer: str, table: str, version: int, names: Iterable[str], aside: tuple[str, str]) -> None:
        """Delete files of a snapshot and move those of the table ``aside`` in; repeated, it does what is left of that."""
        root, parents = self._snapshot(layer, table, version), set()
        for name in names:
            fs, old = self._folder(f"{root}/{name}")
            fs.delete(old, False)
            parents.add(name.rpartition("/")[0])
        number = self.version(*aside)
        for name in self.files(*aside, number) if number >= 0 else []:
            fs, new = self._folder(f"{root}/{name}")
            fs.mkdirs(new.getParent())
            if not fs.rename(self._folder(f"{self._snapshot(*aside, number)}/{name}")[1], new):
                raise OSError(f"{name} could not be moved to {root}")
        for folder in parents:  # those without a file are gone, as if written anew
            while folder and not self.files(layer, table, version, folder):
                fs, path = self._folder(f"{root}/{folder}")
                fs.delete(path, True)
                folder = folder.rpartition("/")[0]

    def drop_slices(self, layer: str, table: str, names: Iterable[str], version: int | None = None) -> None:
        """Delete slices of a snapshot, the current one unless told; one that is not there is passed over."""
        path = self.current(layer, table) if version is None else self._snapshot(layer, table, version)
        for name in names:
            fs, folder = self._folder(f"{path}/{name}")
            fs.delete(folder, True)

    def drop(self, layer: str, table: str) -> None:
        """Delete a table with all its snapshots."""
        fs, folder = self._folder(self.path(layer, table))
        fs.delete(folder, True)

    def prune(self, layer: str, table: str, keep: int = 1) -> None:
        """Delete all finished snapshots but the last ``keep``."""
        for version in self.versions(layer, table)[:-keep]:
            fs, folder = self._folder(self._snapshot(layer, table, version))
            fs.delete(folder, True)

    def drop_versions(self, layer: str, table: str, but: int) -> None:
        """Delete every snapshot of a table but one, also unfinished ones."""
        for version in self._numbers(layer, table):
            if version != but:
                fs, folder = self._folder(self._snapshot(layer, table, version))
                fs.delete(folder, True)
