"""Tables in versions: a run becomes visible as a whole, or not at all.

``<folder>/<table>/run=<run>/`` holds the rows a run wrote, sorted by key: files and row groups of other
keys are skipped by their statistics, and many small keys do not become many small files. A version is a manifest, a table that names for every (table, key) the run whose rows count. Publishing writes the
next manifest and then swaps one small file that names it, so a reader sees the old or the new state
of all tables. A run that ended half-way is in no manifest: nothing of it can be read.

A run replaces the keys it holds and leaves the others to the runs that wrote them. A key that it
holds without any row is empty from then on.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

_POINTER = "_current"
_MANIFESTS = "_manifests"


class SharedFiles:
    """The few file operations that need no job, on any file system Spark knows."""

    def __init__(self, spark: SparkSession, folder: str):
        self._jvm, self._gateway = spark._jvm, spark.sparkContext._gateway
        self._conf = spark._jsc.hadoopConfiguration()
        self._fs = self._path(folder).getFileSystem(self._conf)

    def _path(self, path: str):
        return self._jvm.org.apache.hadoop.fs.Path(path)

    def exists(self, path: str) -> bool:
        return self._fs.exists(self._path(path))

    def read(self, path: str) -> str | None:
        if not self.exists(path):
            return None
        stream = self._fs.open(self._path(path))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def swap(self, path: str, text: str) -> None:
        """Replace a small file: written beside it under another name, then renamed over it."""
        beside, target = (self._fs.makeQualified(self._path(p)) for p in (f"{path}.{uuid.uuid4().hex}", path))
        stream = self._fs.create(beside, True)
        try:
            stream.write(bytearray(text, "utf-8"))
        finally:
            stream.close()
        kind = self._jvm.org.apache.hadoop.fs.Options.Rename
        options = self._gateway.new_array(kind, 1)
        options[0] = kind.OVERWRITE
        context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), self._conf)
        context.rename(beside, target, options)

    def names(self, path: str) -> list[str]:
        if not self.exists(path):
            return []
        return [s.getPath().getName() for s in self._fs.listStatus(self._path(path))]

    def remove(self, path: str) -> None:
        self._fs.delete(self._path(path), True)


class VersionedTables:
    """Tables below ``folder`` whose rows belong to ``keys`` (with ``marks``: columns a manifest keeps per key)."""

    def __init__(
        self, spark: SparkSession, folder: str, keys: Mapping[str, str], marks: Mapping[str, str] | None = None
    ):
        self.spark, self.folder = spark, folder.rstrip("/")
        self.keys, self.marks = dict(keys), dict(marks or {})
        self.files = SharedFiles(spark, self.folder)

    @property
    def _schema(self) -> str:
        columns = {"table": "string", **self.keys, "run": "string", **self.marks}
        return ", ".join(f"`{n}` {kind}" for n, kind in columns.items())

    def version(self) -> int:
        """The number of the version that counts now; 0 before the first."""
        return int(self.files.read(f"{self.folder}/{_POINTER}") or 0)

    def manifest(self, version: int | None = None) -> DataFrame:
        """(table, keys, run, marks) of a version, of the newest one if none is given."""
        number = self.version() if version is None else version
        if not number:
            return self.spark.createDataFrame([], self._schema)
        return self.spark.read.schema(self._schema).parquet(f"{self.folder}/{_MANIFESTS}/{number:010d}")

    def write(self, table: str, rows: DataFrame, run: str, order: Sequence[str] = ()) -> None:
        """Write the rows of one table of a run; not visible before ``publish``. Repeating it is harmless.

        Range partitions follow the keys and then ``order``, so a large key becomes several sorted files.
        """
        lead = [*self.keys, *[c for c in order or ("event_key", "team_key") if c in rows.columns and c not in self.keys]]
        spread = rows.repartitionByRange(*lead).sortWithinPartitions(*lead)
        spread.write.mode("overwrite").parquet(f"{self.folder}/{table}/run={run}")
        self.files.swap(f"{self.folder}/{table}/_schema", json.dumps(rows.schema.jsonValue()))

    def publish(self, tables: Sequence[str], held: DataFrame, run: str) -> int:
        """Make a run visible. ``held``: the keys (and marks) whose rows it replaces in ``tables``.

        Two publishers must not run at once: the later one fails instead of losing the earlier one's keys.
        """
        before = self.version()
        names = F.explode(F.array(*[F.lit(t) for t in tables]))
        new = held.select(names.alias("table"), *self.keys, F.lit(run).alias("run"), *self.marks)
        old = self.manifest(before).join(new, ["table", *self.keys], "left_anti")
        path = f"{self.folder}/{_MANIFESTS}/{before + 1:010d}"
        if self.files.exists(path) and self.version() != before:
            raise RuntimeError(f"version {before + 1} of {self.folder} was published meanwhile")
        columns = ["table", *self.keys, "run", *self.marks]
        old.select(*columns).unionByName(new.select(*columns)).write.mode("overwrite").parquet(path)
        if self.version() != before:
            raise RuntimeError(f"version {before + 1} of {self.folder} was published meanwhile")
        self.files.swap(f"{self.folder}/{_POINTER}", str(before + 1))
        return before + 1

    def read(self, table: str, schema: str | None = None, version: int | None = None) -> DataFrame:
        """The rows of a table in a version. Folders of other runs are pruned by the manifest.

        Without a ``schema`` the columns are those that were written last.
        """
        path = f"{self.folder}/{table}"
        written = self.files.read(f"{path}/_schema")
        if schema is None and written is None:
            raise ValueError(f"{path} was never written")
        fields = T.StructType.fromDDL(schema) if schema else T.StructType.fromJson(json.loads(written))
        if written is None:
            return self.spark.createDataFrame([], fields)
        known = T.StructType(fields.fields)
        for name, kind in {**self.keys, "run": "string"}.items():
            if name not in fields.names:
                known = known.add(name, kind)
        counted = self.manifest(version).where(F.col("table") == table).select(*self.keys, "run")
        rows = self.spark.read.schema(known).parquet(path)
        return rows.join(counted, [*self.keys, "run"], "left_semi").select(*fields.names)

    def vacuum(self, keep: int = 2) -> list[str]:
        """Remove manifests but the newest ``keep``, and runs that none of these names; returns the runs."""
        newest = self.version()
        stay = range(max(1, newest - keep + 1), newest + 1)
        named = {r["run"] for n in stay for r in self.manifest(n).select("run").distinct().collect()}
        gone = set()
        for table in self.files.names(self.folder):
            for name in self.files.names(f"{self.folder}/{table}") if not table.startswith("_") else []:
                if name.startswith("run=") and name[4:] not in named:
                    self.files.remove(f"{self.folder}/{table}/{name}")
                    gone.add(name[4:])
        for name in self.files.names(f"{self.folder}/{_MANIFESTS}"):
            if int(name) not in stay:
                self.files.remove(f"{self.folder}/{_MANIFESTS}/{name}")
        return sorted(gone)
