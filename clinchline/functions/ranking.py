"""Row numbers over groups of any size, and first-k per key.

``row_number`` over a window sends a whole group to one task. One district (or one
snapshot of it) may hold a large part of all rows, so the rank is built in two steps:
count the rows per (group, block), where blocks are consecutive pieces of the sort order,
and number the rows inside each block. The counts are a partial aggregate and small; only
they are ordered per group.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

# rows of one block of consecutive ranks
BLOCK_ROWS = 1 << 14


@dataclass(frozen=True)
class Piece:
    """A leading part of the sort order; ties in it are split by the next parts."""

    column: Column
    descending: bool = False


def rank_block(rank: str | Column) -> Column:
    """Number of the block a dense 1-based rank falls into."""
    rank = F.col(rank) if isinstance(rank, str) else rank
    return F.floor((rank - 1) / F.lit(BLOCK_ROWS)).cast("long")


def with_large(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Mark rows of groups that are too large for one task: ``_large`` is true for them, else null.

    At most one group in ``BLOCK_ROWS`` rows is large, so the list of them is small at any size and is broadcast.
    """
    large = (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("_size"))
        .where(F.col("_size") > BLOCK_ROWS)
        .select(*keys, F.lit(True).alias("_large"))
    )
    return df.join(F.broadcast(large), keys, "left")


def spread_row_number(
    df: DataFrame,
    keys: Sequence[str],
    pieces: Sequence[Piece],
    inside: Sequence[Column],
    name: str,
) -> DataFrame:
    """Number the rows of each group by ``pieces`` and then ``inside``.

    Equals ``row_number() over (partition by keys order by pieces, inside)``. Only large groups are cut into pieces and
    counted; any other is one piece. ``df`` is read several times: stage it first when it is costly, or give it the
    column of ``with_large`` before costly steps. Keys and pieces must not be null.
    """
    if "_large" not in df.columns:
        df = with_large(df, keys)
    labels = [f"_piece_{i}" for i in range(len(pieces))]
    cut = df.withColumns({n: F.when(F.col("_large"), p.column) for n, p in zip(labels, pieces)})
    ordered = [
        F.col(n).desc() if p.descending else F.col(n).asc() for n, p in zip(labels, pieces)
    ]
    earlier = (
        Window.partitionBy(*keys)
        .orderBy(*ordered)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    starts = (
        cut.where(F.col("_large"))
        .groupBy(*keys, *labels)
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select(*keys, *labels, F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_start"))
    )
    by_pieces = [p.column.desc() if p.descending else p.column.asc() for p in pieces]
    local = Window.partitionBy(*keys, *labels).orderBy(*by_pieces, *inside)
    return (
        cut.join(starts, [*keys, *labels], "left")
        .withColumn(name, (F.coalesce("_start", F.lit(0)) + F.row_number().over(local)).cast("int"))
        .drop("_start", "_large", *labels)
    )


def spread_running_sum(
    df: DataFrame,
    keys: Sequence[str],
    pieces: Sequence[Piece],
    inside: Sequence[Column],
    value: str,
    name: str,
) -> DataFrame:
    """Running sums of ``value`` in each group by ``pieces`` and then ``inside``.

    Equals ``sum(value) over (partition by keys order by pieces, inside rows unbounded preceding)`` for groups
    of any size: sums are taken per range of the order, only these are added up per group, and rows are added up
    inside their range. ``df`` is read twice. Keys and pieces must not be null, null values count 0.
    """
    labels = [f"_piece_{i}" for i in range(len(pieces))]
    cut = df.withColumns({n: p.column for n, p in zip(labels, pieces)})
    ordered = [F.col(n).desc() if p.descending else F.col(n).asc() for n, p in zip(labels, pieces)]
    earlier = Window.partitionBy(*keys).orderBy(*ordered).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        cut.groupBy(*keys, *labels)
        .agg(F.sum(value).alias("_sum"))
        .select(*keys, *labels, F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_offset"))
    )
    local = Window.partitionBy(*keys, *labels).orderBy(*inside).rowsBetween(Window.unboundedPreceding, 0)
    return (
        cut.join(offsets, [*keys, *labels])
        .withColumn(name, F.col("_offset") + F.coalesce(F.sum(value).over(local), F.lit(0)))
        .drop("_offset", *labels)
    )


def first_per_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int
) -> DataFrame:
    """First ``k`` rows of each key. Spark limits the rows of a key before the shuffle."""
    window = Window.partitionBy(*keys).orderBy(*order)
    return (
        df.withColumn("_row", F.row_number().over(window))
        .where(F.col("_row") <= k)
        .drop("_row")
    )
