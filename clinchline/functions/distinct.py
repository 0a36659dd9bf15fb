"""Distinct counts that add up: exact bitmaps of whole numbers, merged instead of recounted."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def distinct_bitmaps(df: DataFrame, keys: list[str], number: str | Column) -> DataFrame:
    """(keys, ``bucket``, ``bitmap``): which numbers each key holds, a bitmap for every 32,768 numbers in a row.

    Bitmaps are built before the shuffle, so a key that holds most rows sends 4 KB per bucket and task, and
    its buckets lie in different tasks. Meant for dense numbers, such as surrogate keys: a number far from
    all others costs a bitmap of its own. Null numbers are not counted; a key with no other has no row.
    """
    value = F.col(number) if isinstance(number, str) else number
    return (
        df.where(value.isNotNull())
        .groupBy(*keys, F.bitmap_bucket_number(value).alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position(value)).alias("bitmap"))
    )


def merged_bitmaps(bitmaps: DataFrame, keys: list[str]) -> DataFrame:
    """Bitmaps of fewer keys, or of the union of several frames of bitmaps: nothing is counted twice."""
    return bitmaps.groupBy(*keys, "bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))


def distinct_counts(bitmaps: DataFrame, keys: list[str], name: str) -> DataFrame:
    """(keys, ``name``): the number of different numbers of each key; one row without keys."""
    total = F.coalesce(F.sum(F.bitmap_count("bitmap")), F.lit(0)).alias(name)
    merged = merged_bitmaps(bitmaps, keys)
    return merged.groupBy(*keys).agg(total)
