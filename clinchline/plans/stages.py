"""Cut points of a run: results that several later steps read."""

from __future__ import annotations

import json
import re
import tempfile
import uuid
from collections.abc import Callable, Iterable, Mapping, Sequence
from concurrent.futures import FIRST_COMPLETED, ThreadPoolExecutor, wait
from contextlib import contextmanager
from threading import Lock

from pyspark.sql import Column, DataFrame, SparkSession, types as T
from pyspark.storagelevel import StorageLevel

from clinchline.sources.versions import SharedFiles

#: Stages that are submitted together, at most.
TOGETHER = 6
#: Bytes that rows of a staged file take in memory, for each byte of the file.
ROWS_PER_FILE = 30
_FACTOR = "spark.sql.sources.fileCompressionFactor"
_ALL_KEYS = "spark.sql.requireAllClusterKeysForCoPartition"
_setting = Lock()
_inside: dict[tuple[str, str], tuple[int, str]] = {}


def new_folder(spark: SparkSession) -> str:
    """A new folder that all executors see; a local one only where the cluster names none (tests)."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return f"{shared.rstrip('/')}/tables-{uuid.uuid4()}"
    if not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors see")
    return f"file://{tempfile.mkdtemp(prefix='tables-')}"


@contextmanager
def _set(spark: SparkSession, key: str, value: str | None):
    """A setting of the session, changed for a while; nothing changes if ``value`` is none.

    Steps that run together share the session's settings, so the last one to end gives a setting back.
    """
    use = (spark.sparkContext.applicationId, key)
    with _setting:
        users, given = _inside.get(use, (0, spark.conf.get(key)))
        _inside[use] = (users + 1, given)
        if value is not None:
            spark.conf.set(key, value)
    try:
        yield
    finally:
        with _setting:
            users, given = _inside.pop(use)
            if users > 1:
                _inside[use] = (users - 1, given)
            else:
                spark.conf.set(key, given)


def planned_by_rows(spark: SparkSession):
    """Plan joins by the size of rows in memory, not by that of their files; a factor the cluster sets stays.

    Keys of staged tables are dictionary-encoded, so a file is a small part of its rows. Spark takes the
    one for the other and would have the driver make broadcasts of several hundred megabytes, some at the same time.
    What is small in truth is still broadcast, once a stage has shown its size.
    """
    given = float(spark.conf.get(_FACTOR))
    return _set(spark, _FACTOR, str(float(ROWS_PER_FILE)) if given == 1.0 else None)


def joined_where_kept(spark: SparkSession):
    """Join rows by event and team where their event is kept, not dealt anew by both.

    Meant for tables in buckets by event, all rows of which are read by one task anyway.
    """
    return _set(spark, _ALL_KEYS, "false")


class Stages:
    """Keeps shared intermediate results.

    Where the cluster names a shared folder in ``spark.checkpoint.dir`` a stage is a table
    written there: its lineage is cut, so a lost executor costs a re-read and not a
    recomputation, and later steps read only the columns they need and know its size.
    Otherwise it is persisted with disk spill, and recomputed when lost.

    With a ``folder`` of its own, on shared storage, stages survive the driver: each named stage
    leaves a mark when it is written, and a later run with the same folder reads what is marked
    and builds the rest.
    """

    def __init__(self, spark: SparkSession, folder: str | None = None):
        self.spark = spark
        shared = spark.conf.get("spark.checkpoint.dir", None)
        self.folder = f"{shared.rstrip('/')}/stages-{uuid.uuid4()}" if shared else None
        self.resumed = folder is not None
        if folder is not None:
            self.folder = folder.rstrip("/")
        self._files = SharedFiles(spark, self.folder) if self.folder else None
        self._kept: list[DataFrame] = []
        self._dealt: list[str] = []
        self._tables = 0

    def marked(self, name: str) -> str | None:
        """What the mark of a finished stage says; null if it has none."""
        return self._files.read(f"{self.folder}/_done/{name}") if self.resumed else None

    def mark(self, name: str, text: str = "") -> None:
        self._files.swap(f"{self.folder}/_done/{name}", text)

    def keep(self, result: DataFrame | Callable[[], DataFrame], name: str | None = None) -> DataFrame:
        """The rows of a stage, kept. ``result`` may be a function, which a finished stage does not call."""
        if self.resumed and name is not None:
            return self._named(result, name)
        df = result() if callable(result) else result
        if self.folder is None:
            kept = df.persist(StorageLevel.MEMORY_AND_DISK)
            self._kept.append(kept)
            return kept
        self._tables += 1
        path = f"{self.folder}/{uuid.uuid4()}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def keep_dealt(self, df: DataFrame, key: str, within: Sequence[str] = ()) -> DataFrame:
        """The rows, kept in buckets by ``key``, so that grouping and joining by it later moves no row.

        ``df`` must be dealt by ``key`` into ``deals()`` partitions, by ``deal`` or by an equal expression; a bucket is then one
        file, sorted by ``key`` and ``within``. All rows of a key are in one bucket, which is read by one task.
        """
        if self.folder is None:
            return self.keep(df)
        self._tables += 1
        name = f"dealt_{uuid.uuid4().hex}"
        buckets = df.write.format("parquet").bucketBy(self.deals(), key).sortBy(key, *within)
        buckets.option("path", f"{self.folder}/{name}").saveAsTable(name)
        self._dealt.append(name)
        return self.spark.table(name)

    def deals(self) -> int:
        """Number of buckets: as many as the cluster sets for its shuffles, so that joins keep them."""
        return int(self.spark.conf.get("spark.sql.shuffle.partitions"))

    def deal(self, df: DataFrame, key: str | Column) -> DataFrame:
        return df.repartition(self.deals(), key)

    def _named(self, result: DataFrame | Callable[[], DataFrame], name: str) -> DataFrame:
        path, mark = f"{self.folder}/{name}", self.marked(name)
        self._tables += 1
        if mark is None:
            df = result() if callable(result) else result
            df.write.mode("overwrite").parquet(path)
            mark = json.dumps(df.schema.jsonValue())
            self.mark(name, mark)
        return self.spark.read.schema(T.StructType.fromJson(json.loads(mark))).parquet(path)

    def release(self) -> None:
        """Give everything back; results built from the stages cannot be read after this."""
        for df in self._kept:
            df.unpersist()
        self._kept.clear()
        while self._dealt:
            self.spark.sql(f"DROP TABLE IF EXISTS {self._dealt.pop()}")
        if self.folder is not None and self._tables:
            jvm, jsc = self.spark._jvm, self.spark._jsc
            path = jvm.org.apache.hadoop.fs.Path(self.folder)
            path.getFileSystem(jsc.hadoopConfiguration()).delete(path, True)
            self._tables = 0


def run_together(
    needs: Mapping[str, Sequence[str]],
    do: Callable[[str], object],
    wanted: Iterable[str],
    together: int = TOGETHER,
) -> None:
    """Do what is wanted and all it needs, each after its needs; what is independent at the same time.

    ``needs`` maps names to the names that must be done before. The jobs of independent steps share
    the executors, so one step's tail does not leave them idle. If a step fails, those that already
    run are finished and its error is raised.
    """
    open_steps: set[str] = set()
    todo = list(wanted)
    while todo:
        name = todo.pop()
        if name not in open_steps:
            open_steps.add(name)
            todo += needs[name]
    done: set[str] = set()
    running = {}
    failed = None
    with ThreadPoolExecutor(together) as pool:
        while running or (open_steps and failed is None):
            ready = [n for n in needs if n in open_steps and done.issuperset(needs[n])] if failed is None else []
            if not ready and not running:
                raise ValueError(f"steps need each other: {sorted(open_steps)}")
            for name in ready:
                open_steps.remove(name)
                running[pool.submit(do, name)] = name
            for future in wait(running, return_when=FIRST_COMPLETED).done:
                name = running.pop(future)
                failed = failed or future.exception()
                done.add(name)
    if failed is not None:
        raise failed
