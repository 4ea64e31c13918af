"""Layered tables on shared storage."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from datetime import datetime, timezone
from threading import Lock
from typing import NamedTuple, TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

T = TypeVar("T")

LAYERS = ("bronze", "staging", "silver", "gold", "ops")
# Where a loaded delivery has its records, inside its version's folder.
LOADED = "_load=records"
# Folder of the records that say which version of every table is current.
COMMITS = "_commits"


def shared_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder all executors can reach: under ``spark.checkpoint.dir`` or, where
    that is unset, under the warehouse."""
    base = spark.conf.get("spark.checkpoint.dir", None) or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"
    return f"{base.rstrip('/')}/{name}-{run_id()}"


def stored(frame: DataFrame, name: str) -> DataFrame:
    """A frame written to a fresh shared folder and read back, so that what follows neither
    repeats it nor sees another outcome of it."""
    folder = shared_folder(frame.sparkSession, name)
    frame.write.parquet(folder)
    return frame.sparkSession.read.schema(frame.schema).parquet(folder)


def run_id() -> str:
    """Sorts by time."""
    return datetime.now(timezone.utc).strftime("%Y%m%dT%H%M%S%f")


def side_by_side(spark: SparkSession, jobs: list[Callable[[], T]]) -> list[T]:
    """Run independent Spark jobs at the same time, so that the last tasks of one
    do not leave the cluster idle."""
    with ThreadPoolExecutor(len(jobs)) as pool:
        started = [pool.submit(inheritable_thread_target(spark)(job)) for job in jobs]
        return [job.result() for job in started]


def _placed(spark: SparkSession, name: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(name)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, file: str) -> bool:
    path, fs = _placed(spark, file)
    return fs.exists(path)


def folders(spark: SparkSession, parent: str) -> list[str]:
    path, fs = _placed(spark, parent)
    if not fs.exists(path):
        return []
    return sorted(s.getPath().toString() for s in fs.listStatus(path) if s.isDirectory())


def delete(spark: SparkSession, folder: str) -> None:
    path, fs = _placed(spark, folder)
    fs.delete(path, True)


class Version(NamedTuple):
    """Where the files of one version of a table lie, and its columns."""

    folder: str
    schema: StructType
    partition_by: tuple[str, ...] = ()

    def read(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema(self.schema).parquet(self.folder)


Tables = dict[tuple[str, str], Version]


class Snapshot:
    """The tables of one build, whatever is built meanwhile."""

    def __init__(self, spark: SparkSession, number: int, versions: Tables) -> None:
        self.spark, self.number, self.versions = spark, number, versions

    def table(self, layer: str, table: str) -> DataFrame:
        return self.versions[layer, table].read(self.spark)

    def tables(self, *layers: str) -> list[tuple[str, str]]:
        return sorted((t for t in self.versions if t[0] in layers), key=lambda t: (layers.index(t[0]), t[1]))

    def views(self, prefix: str = "") -> list[str]:
        """Temporary views ``<prefix><layer>_<table>``, for SQL over one build."""
        names = {f"{prefix}{layer}_{table}": (layer, table) for layer, table in self.versions}
        for name, where in names.items():
            self.table(*where).createOrReplaceTempView(name)
        return sorted(names)


class Lake:
    """Tables in schemas bronze, staging, silver, gold and ops under one root.

    ``replace`` writes a full new version of a table beside the current one. What is current
    is said by the last *commit record*, a small file that names the version of every table.
    A build (``with lake.build()``) commits all its tables by one record, so readers see the
    tables of one build, never some of the next: ``table`` and ``snapshot`` go by the record.
    A build that fails commits nothing, and a build may read the tables it replaces.

    The session catalog is pointed at the versions after each commit, table by table, for SQL
    by table name; ``Snapshot.views`` has SQL names that change together.

    Versions named by the last two records stay, for readers still at them; older and broken
    ones are deleted. Raw personal data is in bronze and staging only, which are never
    published; staging tables made in a build last as long as the build.
    """

    def __init__(self, spark: SparkSession, root: str, prefix: str = "") -> None:
        self.spark, self.root, self.prefix = spark, root.rstrip("/"), prefix
        self._building: Tables | None = None
        self._lock = Lock()
        for layer in LAYERS:
            spark.sql(f"CREATE SCHEMA IF NOT EXISTS {prefix}{layer} LOCATION '{self.root}/{layer}'")

    def name(self, layer: str, table: str) -> str:
        return f"{self.prefix}{layer}.{table}"

    def table(self, layer: str, table: str) -> DataFrame:
        """A table as the running build has it, else as the last commit has it."""
        versions = {**self._last_commit()[1], **(self._building or {})}
        found = versions.get((layer, table))
        return self.spark.table(self.name(layer, table)) if found is None else found.read(self.spark)

    def snapshot(self) -> Snapshot:
        return Snapshot(self.spark, *self._last_commit())

    @contextmanager
    def build(self) -> Iterator[None]:
        """All tables replaced within become current together, at the end. A build within a
        build is part of it."""
        if self._building is not None:
            yield
            return
        made = self._building = {}
        try:
            yield
            self._building = None
            self._commit({where: v for where, v in made.items() if where[0] != "staging"})
        finally:
            self._building = None
            for layer, table in made:
                if layer == "staging":
                    self._delete(f"{self.root}/{layer}/{table}")

    def tables(self, *layers: str) -> list[tuple[str, str]]:
        return [
            (layer, t.name)
            for layer in layers
            for t in sorted(self.spark.catalog.listTables(f"{self.prefix}{layer}"), key=lambda t: t.name)
            if not t.isTemporary
        ]

    def replace(
        self, frame: DataFrame, layer: str, table: str, partition_by: tuple[str, ...] = (), **counts: Column
    ) -> tuple[DataFrame, dict[str, int]]:
        """Store a frame as the table's new contents.

        Gives the stored table and its row count, with any further ``counts``
        (aggregate columns), all observed while writing.
        """
        seen = Observation()
        path = f"{self.root}/{layer}/{table}/{run_id()}"
        observed = frame.observe(seen, F.count("*").alias("rows"), *[c.alias(n) for n, c in counts.items()])
        observed.write.partitionBy(*partition_by).parquet(path)
        return self._made(layer, table, Version(path, frame.schema, partition_by)), seen.get

    def load(self, layer: str, table: str, write: Callable[[str], tuple[str, StructType, int]]) -> int:
        """As ``replace``, for contents that ``write`` stores under the folder it is given. It
        tells the folder of the table's files, their columns and the row count."""
        folder, schema, rows = write(f"{self.root}/{layer}/{table}/{run_id()}")
        self._made(layer, table, Version(folder, schema))
        return rows

    def _made(self, layer: str, table: str, version: Version) -> DataFrame:
        if self._building is None:
            self._commit({(layer, table): version})
        else:
            self._building[layer, table] = version
        return version.read(self.spark)

    # --- commits ---------------------------------------------------------------------

    def _records(self) -> list[str]:
        """Names of the commit records, the last one last."""
        path = self._path(f"{self.root}/{COMMITS}")
        fs = path.getFileSystem(self._conf())
        if not fs.exists(path):
            return []
        return sorted(n for s in fs.listStatus(path) if not (n := s.getPath().getName()).startswith((".", "_")))

    def _commit_of(self, record: str) -> Tables:
        path = self._path(f"{self.root}/{COMMITS}/{record}")
        stream = path.getFileSystem(self._conf()).open(path)
        try:
            text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return {
            tuple(name.split(".", 1)): Version(v["folder"], StructType.fromJson(v["schema"]), tuple(v["partition_by"]))
            for name, v in json.loads(text).items()
        }

    def _last_commit(self) -> tuple[int, Tables]:
        while records := self._records():
            try:
                return int(records[-1]), self._commit_of(records[-1])
            except Exception:  # replaced by later ones while it was read
                if records[-1] in self._records():
                    raise
        return 0, {}

    def _commit(self, made: Tables) -> None:
        """Name the new versions, and those of all other tables, in a record of the next number.
        A record appears whole, by a rename; who comes second to a number takes the next."""
        with self._lock:
            while True:
                number, versions = self._last_commit()
                if self._write_record(f"{number + 1:012d}", {**versions, **made}):
                    break
            for (layer, table), version in made.items():
                self._point(layer, table, version.folder, version.schema, version.partition_by)
            records = self._records()
            kept = {v.folder for r in records[-2:] for v in self._commit_of(r).values()}
            for layer, table in made:
                self._forget_old_versions(layer, table, made[layer, table].folder, kept)
            for record in records[:-2]:
                self._delete(f"{self.root}/{COMMITS}/{record}")

    def _write_record(self, record: str, versions: Tables) -> bool:
        told = {
            ".".join(where): {"folder": v.folder, "schema": v.schema.jsonValue(), "partition_by": list(v.partition_by)}
            for where, v in versions.items()
        }
        draft, final = (self._path(f"{self.root}/{COMMITS}/{n}") for n in (f".{record}-{run_id()}", record))
        fs = final.getFileSystem(self._conf())
        stream = fs.create(draft)
        try:
            stream.write(bytearray(json.dumps(told).encode()))
        finally:
            stream.close()
        if not fs.exists(final) and fs.rename(draft, final):
            return True
        fs.delete(draft, False)
        return False

    def append(self, frame: DataFrame, layer: str, table: str) -> None:
        path = f"{self.root}/{layer}/{table}"
        frame.write.mode("append").parquet(path)
        self._point(layer, table, path, frame.schema)

    def drop(self, layer: str, table: str) -> None:
        """Forget a table and delete its files."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name(layer, table)}")
        self._delete(f"{self.root}/{layer}/{table}")

    def attach(self) -> None:
        """Point the catalog of a new session at the tables of the last commit, and at those that
        are appended to."""
        versions = self._last_commit()[1]
        for (layer, table), version in versions.items():
            self._point(layer, table, version.folder, version.schema, version.partition_by)
        for layer in LAYERS:
            for folder in self._folders(f"{self.root}/{layer}"):
                if (layer, folder.rsplit("/", 1)[1]) not in versions and self._exists(f"{folder}/_SUCCESS"):
                    self._point(layer, folder.rsplit("/", 1)[1], folder)

    def _point(
        self, layer: str, table: str, path: str, schema: StructType | None = None, partition_by: tuple[str, ...] = ()
    ) -> None:
        """Make the catalog show a folder as the table. Without a schema Spark
        reads it, and any partitions, from the folder.

        A table whose columns stay is moved, not made anew, so readers always find it."""
        name = self.name(layer, table)
        if schema is not None and self._columns(name) == [
            (f.name, f.dataType) for f in sorted(schema.fields, key=lambda f: f.name in partition_by)
        ]:
            self._move(name, path, bool(partition_by))
            return
        self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        if schema is None or partition_by:
            self.spark.sql(f"CREATE TABLE {name} USING parquet LOCATION '{path}'")
            if any("=" in f.rsplit("/", 1)[1] for f in self._folders(path)):
                self.spark.catalog.recoverPartitions(name)
        else:
            self.spark.catalog.createTable(name, path, "parquet", schema)

    def _columns(self, name: str) -> list | None:
        if not self.spark.catalog.tableExists(name):
            return None
        return [(f.name, f.dataType) for f in self.spark.table(name).schema.fields]

    def _move(self, name: str, path: str, partitioned: bool) -> None:
        """Point a table, partition by partition, at another folder."""
        if partitioned:
            found = {tuple(f.rsplit("/", 1)[1].split("=", 1)): f for f in self._folders(path)}
            known = {tuple(r[0].split("=", 1)) for r in self.spark.sql(f"SHOW PARTITIONS {name}").collect()}
            for (column, value), folder in found.items():
                part = f"PARTITION ({column} = '{value}')"
                if (column, value) in known:
                    self.spark.sql(f"ALTER TABLE {name} {part} SET LOCATION '{folder}'")
                else:
                    self.spark.sql(f"ALTER TABLE {name} ADD {part} LOCATION '{folder}'")
            for column, value in known - found.keys():
                self.spark.sql(f"ALTER TABLE {name} DROP PARTITION ({column} = '{value}')")
        self.spark.sql(f"ALTER TABLE {name} SET LOCATION '{path}'")
        self.spark.catalog.refreshTable(name)

    def _forget_old_versions(self, layer: str, table: str, current: str, kept: set[str], keep: int = 2) -> None:
        """Delete versions but those in use and the last complete ones, and what failed builds left."""
        home = f"{self.root}/{layer}/{table}"
        here = current.removeprefix(home).strip("/").split("/")[0]
        older = [v for v in self._folders(home) if v.rsplit("/", 1)[1] <= here]
        used = {f.removeprefix(home).strip("/").split("/")[0] for f in kept if f.startswith(home + "/")}
        used |= {v.rsplit("/", 1)[1] for v in [v for v in older if self._complete(v)][-keep:]}
        for old in older:
            if old.rsplit("/", 1)[1] not in used:
                self._delete(old)

    def _complete(self, version: str) -> bool:
        records = f"{version}/{LOADED}"
        return self._exists(f"{records if self._exists(records) else version}/_SUCCESS")

    def _delete(self, folder: str) -> None:
        delete(self.spark, folder)

    def _folders(self, parent: str) -> list[str]:
        return folders(self.spark, parent)

    def _exists(self, file: str) -> bool:
        return exists(self.spark, file)

    def _path(self, text: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(text)

    def _conf(self):
        return self.spark._jsc.hadoopConfiguration()
