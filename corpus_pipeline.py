"""A corpus made ready for training: five stages, each on all its predecessor kept.

Low-quality documents go, one document of every group of near-duplicates stays, documents that
hold benchmark items go, secrets are masked in what is left, and the rest is packed.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from clinchline.llm import packing, quality, secrets
from clinchline.llm.common import sent, staged
from clinchline.llm.decontamination import contaminated
from clinchline.llm.near_duplicates import near_duplicates
from clinchline.llm.queries import benchmark_items, table


def free_name(docs: DataFrame, name: str) -> str:
    """``name``, or the first of it with underscores behind that no column has."""
    taken = {c.lower() for c in docs.columns}
    while name in taken:
        name += "_"
    return name


def numbered(docs: DataFrame) -> tuple[DataFrame, str]:
    """``docs`` with one whole number for each different (doc_id, text), and the name of that column.

    Ids that are whole, never null and never repeated are the numbers. Otherwise the different pairs are
    sorted, texts by their digests, and numbered; a null id or text equals a null one. The rows are joined
    to these numbers, which is one more shuffle of them.
    """
    name, digest = free_name(docs, "number"), free_name(docs, "digest")
    if docs.schema["doc_id"].dataType.simpleString() in ("tinyint", "smallint", "int", "bigint"):
        if docs.groupBy("doc_id").count().where("count > 1 or doc_id is null").isEmpty():
            return docs.withColumn(name, F.col("doc_id").cast("long")), name
    rows = docs.withColumn(digest, F.sha2("text", 256))
    pairs = rows.select(F.col("doc_id").alias("id"), F.col(digest).alias("hash")).distinct().orderBy("id", "hash")
    pairs = staged(pairs.withColumn("n", F.monotonically_increasing_id()), "numbers")
    same = rows["doc_id"].eqNullSafe(pairs["id"]) & rows[digest].eqNullSafe(pairs["hash"])
    return rows.join(pairs, same).select(*[rows[c] for c in docs.columns], pairs["n"].alias(name)), name


def reject_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose calibrated score is 0.5 or more, whatever their id."""
    rows, number = numbered(docs)
    scores = quality.quality_scores(rows, table(spark, sf_dir, "labels"), carried=(number,))
    rejected = staged(scores.where("predicted = 0").select(number).distinct(), "rejected")
    return rows.join(sent(rejected), number, "left_anti").select(docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by five-word shingles at a similarity of 0.8 or more.

    Rows that repeat id and text are one document, of which the first row by the other columns stays. Rows
    with a null id, and those that repeat an id with another text, are documents of their own.
    """
    rows, number = numbered(docs)
    groups = staged(near_duplicates(rows, number), "groups")
    dropped = groups.where("not kept").select(number).distinct()
    kept = rows.join(sent(dropped), number, "left_anti")
    if groups.groupBy(number).count().where("count > 1").isEmpty():
        return kept.select(docs.columns)
    place = free_name(rows, "place")
    others = [f.name for f in docs.schema if f.name not in ("doc_id", "text") and f.dataType.typeName() != "map"]
    first = F.row_number().over(Window.partitionBy(number).orderBy(*(others or [number])))
    return kept.withColumn(place, first).where(F.col(place) == 1).select(docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows without a verified benchmark item, whatever their id."""
    rows, number = numbered(docs)
    found = contaminated(rows, benchmark_items(spark, sf_dir), number)
    leaks = staged(found.select(number).distinct(), "leaks")
    return rows.join(sent(leaks), number, "left_anti").select(docs.columns)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets in their texts replaced by a mask."""
    return secrets.redact_secrets(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of full sequences, sources mixed in proportion to their tokens."""
    return packing.pack_documents(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", reject_low_quality),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("secrets", mask_secrets),
    ("packing", pack),
]

#: Learned scores, hashing and tokenizers are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's rows are written before the next one reads them."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name)
    return docs


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"pipeline": run}


def oracle_sql() -> dict[str, str]:
    return {"pipeline": ORACLE_SQL} if ORACLE_SQL else {}
