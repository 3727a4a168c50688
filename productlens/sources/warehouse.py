"""Layered table storage.

Tables belong to one of the layers ``raw``, ``core`` and ``marts``, and every
write is a full refresh. A write goes to a folder of its own,
``<root>/<layer>/<table>/v_<id>``; the newest manifest below
``<root>/_manifests`` names the version of every table that readers get, so a
table, or several written in one ``publishing()`` block, changes at once, and a
write that fails midway is never seen. Manifests are numbered; a publisher
creates the next number, which only one can, and starts again from the new one
if another came first. ``pinned()`` gives a reader that stays at one manifest.
Versions are kept until ``vacuum``. ``root`` must be shared storage on a
cluster (the jobs read back what they wrote).

With ``catalog=True`` the layers are databases, each version is a table of the
session catalog (``saveAsTable``) and the table's name is a view that is
replaced last; user-keyed tables can then be bucketed by ``user_id`` so later
joins on it read co-partitioned data without a shuffle.
"""

from __future__ import annotations

import contextlib
import json
import re
import threading
import time
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

LAYERS = ("raw", "core", "marts")


class Warehouse:
    def __init__(self, spark: SparkSession, root: str, catalog: bool = False, buckets: int | None = None):
        self.spark, self.root, self.catalog, self.buckets = spark, root.rstrip("/"), catalog, buckets
        self._pending: dict[str, str] | None = None  # versions of an open publishing() block
        self._pin: dict[str, str] | None = None
        self._lock = threading.RLock()
        if catalog:
            for layer in LAYERS:
                spark.sql(f"CREATE DATABASE IF NOT EXISTS {layer} LOCATION '{self.root}/{layer}'")

    # files of the shared storage, through Spark's own file systems
    def _path(self, path: str):
        return self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)

    def _fs(self):
        return self._path(self.root).getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def _children(self, folder: str) -> list[tuple[str, int]]:
        """Names and modification times (ms)."""
        fs, path = self._fs(), self._path(folder)
        return [(s.getPath().getName(), s.getModificationTime()) for s in fs.listStatus(path)] if fs.exists(path) else []

    def _manifests(self) -> list[tuple[int, int]]:
        """Numbers and times of all manifests, oldest first."""
        found = ((re.fullmatch(r"(\d{8})\.json", name), at) for name, at in self._children(f"{self.root}/_manifests"))
        return sorted((int(m[1]), at) for m, at in found if m)

    def _manifest(self, number: int) -> dict[str, str]:
        stream = self._fs().open(self._path(f"{self.root}/_manifests/{number:08d}.json"))
        try:
            return json.loads(self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def _current(self) -> tuple[int, dict[str, str]]:
        numbers = self._manifests()
        return (numbers[-1][0], self._manifest(numbers[-1][0])) if numbers else (0, {})

    def _publish(self, versions: dict[str, str]) -> None:
        """A new manifest in which ``versions`` replace those before."""
        jvm, fs = self.spark.sparkContext._jvm, self._fs()
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
            self._fs().getUri(), self.spark.sparkContext._jsc.hadoopConfiguration())
        no_overwrite = self.spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
        while True:
            number, tables = self._current()
            draft = self._path(f"{self.root}/_manifests/draft-{uuid.uuid4().hex}")
            out = fs.create(draft, False)
            out.write(bytearray(json.dumps({**tables, **versions}, indent=1).encode()))
            out.close()
            try:
                context.rename(draft, self._path(f"{self.root}/_manifests/{number + 1:08d}.json"), no_overwrite)
                break
            except Py4JJavaError as e:
                fs.delete(draft, False)
                if "FileAlreadyExistsException" not in str(e.java_exception.getClass()):
                    raise
        if self.catalog:
            for key, version in versions.items():
                layer, table = key.split("/")
                self.spark.sql(f"CREATE OR REPLACE VIEW {layer}.{table} AS SELECT * FROM {layer}.{table}__{version}")

    @contextlib.contextmanager
    def publishing(self):
        """Tables written in the block become visible together when it ends; if it fails, none does."""
        if self._pending is not None:  # part of an outer block
            yield self
            return
        self._pending = {}
        try:
            yield self
            if self._pending:
                self._publish(self._pending)
        finally:
            self._pending = None

    def pinned(self) -> "Warehouse":
        """A reader that stays at the tables published now."""
        reader = Warehouse(self.spark, self.root, buckets=self.buckets)
        reader.catalog, reader._pin = self.catalog, self._current()[1]
        return reader

    def _version(self, layer: str, table: str) -> str:
        if layer not in LAYERS:
            raise ValueError(f"unknown layer {layer!r}")
        key = f"{layer}/{table}"
        known = self._pin if self._pin is not None else {**self._current()[1], **(self._pending or {})}
        if key not in known:
            raise LookupError(f"no published table {key!r} in {self.root}")
        return known[key]

    def path(self, layer: str, table: str) -> str:
        """Folder of the table's published version."""
        return f"{self.root}/{layer}/{table}/{self._version(layer, table)}"

    def table_name(self, layer: str, table: str) -> str:
        """Catalog name of the table's published version."""
        return f"{layer}.{table}__{self._version(layer, table)}"

    def write(self, df: DataFrame, layer: str, table: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
        """Full-refresh write, then return the table read back (lineage cut at the write)."""
        if layer not in LAYERS:
            raise ValueError(f"unknown layer {layer!r}")
        version = f"v_{uuid.uuid4().hex[:16]}"
        bucketed = self.catalog and self.buckets and "user_id" in df.columns and not partition_by
        if partition_by:
            # rows of a partition value meet in few tasks (a large value is split), so files follow the data
            df = df.hint("rebalance", *partition_by)
        elif bucketed:
            df = df.repartition(self.buckets, "user_id")  # one file for each bucket
        w = df.write.mode("errorifexists")
        if partition_by:
            w = w.partitionBy(*partition_by)
        if self.catalog:
            if bucketed:
                w = w.bucketBy(self.buckets, "user_id").sortBy("user_id")
            w.format("parquet").saveAsTable(f"{layer}.{table}__{version}")
        else:
            w.parquet(f"{self.root}/{layer}/{table}/{version}")
        with self._lock:
            if self._pending is not None:
                self._pending[f"{layer}/{table}"] = version
            else:
                self._publish({f"{layer}/{table}": version})
        return self._read_version(layer, table, version)

    def _read_version(self, layer: str, table: str, version: str) -> DataFrame:
        if self.catalog:
            return self.spark.table(f"{layer}.{table}__{version}")
        return self.spark.read.parquet(f"{self.root}/{layer}/{table}/{version}")

    def read(self, layer: str, table: str) -> DataFrame:
        return self._read_version(layer, table, self._version(layer, table))

    def vacuum(self, hours: float) -> list[str]:
        """Delete versions that no reader can have got for so many hours, unfinished ones too, and their manifests."""
        before = (time.time() - hours * 3600) * 1000
        numbers = self._manifests()
        # a manifest was current until the next one came
        keep = [n for i, (n, _) in enumerate(numbers) if i + 1 == len(numbers) or numbers[i + 1][1] >= before]
        used = {f"{key}/{version}" for n in keep for key, version in self._manifest(n).items()}
        gone = []
        for layer in LAYERS:
            for table, at in self._children(f"{self.root}/{layer}"):
                if self.catalog:
                    name, _, version = table.partition("__")
                    if version and f"{layer}/{name}/{version}" not in used and at < before:
                        self.spark.sql(f"DROP TABLE IF EXISTS {layer}.{table}")
                        gone.append(f"{layer}/{table}")
                    continue
                for version, at_version in self._children(f"{self.root}/{layer}/{table}"):
                    if f"{layer}/{table}/{version}" not in used and at_version < before:
                        self._fs().delete(self._path(f"{self.root}/{layer}/{table}/{version}"), True)
                        gone.append(f"{layer}/{table}/{version}")
        for n, _ in numbers:
            if n not in keep:
                self._fs().delete(self._path(f"{self.root}/_manifests/{n:08d}.json"), False)
        return gone
