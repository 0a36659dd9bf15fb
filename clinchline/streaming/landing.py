"""Incremental ingest: rows of newly landed responses replace those of the same key."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from clinchline import schemas
from clinchline.sources import landed
from clinchline.sources.versions import VersionedTables

FLATTEN: dict[str, Callable[[DataFrame], DataFrame]] = {
    "events": landed.flatten_events,
    "event_teams": landed.flatten_event_teams,
    "matches": landed.flatten_matches,
    "alliances": landed.flatten_alliances,
    "awards": landed.flatten_awards,
    "event_points": landed.flatten_event_points,
    "district_rankings": landed.flatten_rankings,
}

#: The mark of a response: its key's rows are replaced by a response of a greater mark only.
_MARKS = {"day": "string", "landed": "timestamp", "file": "string"}


def raw_tables(spark: SparkSession, target: str, table: str) -> VersionedTables:
    """The ingested versions of one raw table; a manifest keeps each key's response."""
    return VersionedTables(spark, f"{target}/{table}", {"response_key": "string"}, _MARKS)


def read_ingested(spark: SparkSession, target: str, table: str) -> DataFrame:
    """The rows of the newest response of every key, of whole batches only."""
    return raw_tables(spark, target, table).read(table, schemas.RAW_TABLES[table])


def _parsed(table: str, key: str):
    """The elements of a response; a single object is one element.

    Null for text that is not JSON; JSON ``null`` is a response without elements.
    """
    fields = T.StructType.fromDDL(landed.landed_schema(table))
    element = T.StructType([f for f in fields.fields if f.name != key])
    elements = F.from_json("_text", T.ArrayType(element))
    return F.when(F.trim("_text") == "null", F.array().cast(T.ArrayType(element))).otherwise(elements)


def ingest(spark: SparkSession, files: DataFrame, table: str, target: str, run: str) -> None:
    """Take in response files (``_file``, ``_landed``, ``_text``) as one version.

    Per key the newest response of all taken in so far counts: by ``fetched_on``, then the time it
    landed, then its path. One that is older than what its key has changes nothing, whenever it lands. A
    newer response without elements leaves the key without rows. Text that is not JSON is passed over.
    """
    tables = raw_tables(spark, target, table)
    key = landed.landed_schema(table).rsplit(", ", 1)[1].split()[0]
    whole = files.withColumn("_elements", _parsed(table, key)).where(F.col("_elements").isNotNull())
    stamped = landed.responses(whole.select("_file", "_landed"), table)
    best = stamped.groupBy("_key").agg(F.max(F.struct("_day", "_landed", "_file")).alias("b"))
    mark = lambda prefix: F.struct(*[F.col(f"{prefix}{c}") for c in ("day", "landed", "file")])
    arrived = best.select(
        F.col("_key").alias("response_key"),
        F.col("b._day").alias("day"),
        F.col("b._landed").alias("landed"),
        F.col("b._file").alias("file"),
    )
    known = tables.manifest().select("response_key", *[F.col(c).alias(f"known_{c}") for c in _MARKS])
    newer = arrived.join(known, "response_key", "left").where(
        F.col("known_file").isNull() | (mark("") > mark("known_"))
    )
    held = newer.select("response_key", *_MARKS).persist()
    try:
        if held.isEmpty():
            return
        rows = (
            whole.join(held.select(F.col("file").alias("_file"), "response_key"), "_file")
            .select("response_key", F.col("response_key").alias(key), F.explode("_elements").alias("e"))
            .select("response_key", key, "e.*")
        )
        tables.write(table, FLATTEN[table](rows), run)
        tables.publish([table], held, run)
    finally:
        held.unpersist()


def refresh_landed(
    spark: SparkSession, landing: str, table: str, target: str, progress: str, batch_files: int = 10_000
) -> StreamingQuery:
    """Process every response that has not been seen yet, then stop; see ``ingest``.

    Each batch becomes one version of the table, so readers never see half of one, and a repeated batch
    changes nothing. ``progress`` is a folder on shared storage that remembers which files are done; with
    it a restarted run neither repeats nor loses a response. Paged rankings are read as a batch.
    """
    files = (
        spark.readStream.format("binaryFile")
        .schema("path string, modificationTime timestamp, length long, content binary")
        .option("recursiveFileLookup", True)
        .option("maxFilesPerTrigger", batch_files)
        .load(f"{landing}/{table}")
        .select(
            F.col("path").alias("_file"),
            F.col("modificationTime").alias("_landed"),
            F.col("content").cast("string").alias("_text"),
        )
    )
    return (
        files.writeStream.foreachBatch(lambda batch, n: ingest(spark, batch, table, target, f"batch-{n}"))
        .option("checkpointLocation", f"{progress}/{table}")
        .trigger(availableNow=True)
        .start()
    )
