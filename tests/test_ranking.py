import random

import pytest
from pyspark.sql import Window, functions as F

from clinchline.functions import ranking
from clinchline.functions.ranking import Piece, first_per_key, rank_block, spread_row_number


@pytest.mark.parametrize("block", [3, 1 << 14])
def test_spread_row_number_equals_the_plain_window(spark, monkeypatch, block):
    monkeypatch.setattr(ranking, "BLOCK_ROWS", block)
    rng = random.Random(5)
    # one group holds most rows, and one score most of the group
    rows = [("hot" if i % 10 else f"g{i % 7}", rng.choice([0, 0, 0, 5, 9]), i + 1) for i in range(400)]
    df = spark.createDataFrame(rows, "g string, score int, official int")
    spread = spread_row_number(
        df,
        ["g"],
        [Piece(F.col("score"), descending=True), Piece(rank_block("official"))],
        [F.col("official").asc()],
        "place",
    )
    plain = F.row_number().over(Window.partitionBy("g").orderBy(F.desc("score"), "official"))
    expected = df.withColumn("place", plain)
    assert sorted(map(tuple, spread.collect())) == sorted(map(tuple, expected.collect()))


def test_rank_windows_never_span_a_whole_group(spark):
    df = spark.range(100).selectExpr("'hot' AS g", "id AS official", "0 AS score")
    spread = spread_row_number(
        df, ["g"], [Piece(F.col("score")), Piece(rank_block("official"))], [F.col("official")], "place"
    )
    plan = spread._jdf.queryExecution().executedPlan().toString()
    numbering = [line for line in plan.splitlines() if "Window [row_number()" in line]
    assert numbering and all("_piece_1" in line for line in numbering)


def test_only_large_groups_are_cut_into_pieces(spark, monkeypatch):
    monkeypatch.setattr(ranking, "BLOCK_ROWS", 8)
    df = spark.range(60).selectExpr("IF(id < 20, 'hot', 'g' || id % 6) AS g", "id AS official", "id % 4 AS score")
    marked = ranking.with_large(df, ["g"])
    assert {(r.g, r._large) for r in marked.where("_large").collect()} == {("hot", True)}
    assert marked.count() == 60
    spread = spread_row_number(
        marked, ["g"], [Piece(F.col("score")), Piece(rank_block("official"))], [F.col("official")], "place"
    )
    plain = F.row_number().over(Window.partitionBy("g").orderBy("score", "official"))
    assert sorted(map(tuple, spread.collect())) == sorted(map(tuple, df.withColumn("place", plain).collect()))


def test_first_per_key_limits_before_the_shuffle(spark):
    df = spark.range(50).selectExpr("id % 3 AS k", "id AS v")
    first = first_per_key(df, ["k"], [F.col("v").asc()], 2)
    assert sorted(map(tuple, first.collect())) == [(0, 0), (0, 3), (1, 1), (1, 4), (2, 2), (2, 5)]
    plan = first._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_running_sums_of_a_group_of_any_size(spark):
    rows = spark.range(5000).select(
        F.when(F.col("id") % 3 == 0, F.concat(F.lit("k"), (F.col("id") % 40).cast("string"))).otherwise("hot").alias("key"),
        (F.xxhash64("id") % 700).alias("at"),
        "id",
        F.when(F.col("id") % 11 != 0, F.col("id") % 17).alias("n"),
    )
    for pieces in ([ranking.Piece(F.floor(F.col("at") / 50))], [ranking.Piece(F.floor(F.col("at") / 50), descending=True)]):
        found = ranking.spread_running_sum(rows, ["key"], pieces, [F.col("at"), F.col("id")], "n", "through")
        first = pieces[0].column.desc() if pieces[0].descending else pieces[0].column.asc()
        window = Window.partitionBy("key").orderBy(first, "at", "id").rowsBetween(Window.unboundedPreceding, 0)
        plain = rows.withColumn("through", F.coalesce(F.sum("n").over(window), F.lit(0)))
        assert sorted(map(tuple, found.collect()), key=str) == sorted(map(tuple, plain.collect()), key=str)
