"""Distinct counts by bitmaps against sets, with hot keys, negative numbers, nulls and merges."""

import random

from clinchline.functions.distinct import distinct_bitmaps, distinct_counts, merged_bitmaps


def rows(seed, n):
    rng = random.Random(seed)
    pick = lambda: rng.choice([None, rng.randrange(-70_000, 70_000), rng.randrange(50), 32_768, -32_768, 1 << 40])
    return [("hot" if rng.random() < 0.6 else rng.choice(["a", "b", None]), rng.randrange(3), pick()) for _ in range(n)]


def sets(data, key):
    out = {}
    for row in data:
        if row[2] is not None:
            out.setdefault(key(row), set()).add(row[2])
    return {k: len(v) for k, v in out.items()}


SCHEMA = "key string, day int, number long"


def test_counts_and_merges_equal_sets(spark):
    first, second = rows(1, 4000), rows(2, 3000)
    one, two = (distinct_bitmaps(spark.createDataFrame(d, SCHEMA), ["key", "day"], "number") for d in (first, second))
    both = merged_bitmaps(one.union(two), ["key", "day"])
    by_day = {(r.key, r.day): r.n for r in distinct_counts(both, ["key", "day"], "n").collect()}
    assert by_day == sets(first + second, lambda r: (r[0], r[1]))
    by_key = {r.key: r.n for r in distinct_counts(both, ["key"], "n").collect()}
    assert by_key == sets(first + second, lambda r: r[0])
    assert distinct_counts(both, [], "n").first().n == sets(first + second, lambda r: 0)[0]


def test_a_hot_key_is_split_before_its_shuffle(spark):
    df = spark.range(200_000).selectExpr("'hot' AS key", "id AS number")
    bitmaps = distinct_bitmaps(df, ["key"], "number")
    assert bitmaps.count() == 200_000 // 32_768 + 2 - (200_000 % 32_768 == 0)
    assert distinct_counts(bitmaps, ["key"], "n").first().n == 200_000
    plan = bitmaps._jdf.queryExecution().executedPlan().toString()
    assert "partial_bitmap_construct_agg" in plan


def test_no_rows(spark):
    none = distinct_bitmaps(spark.createDataFrame([], SCHEMA), ["key"], "number")
    assert none.count() == 0 and distinct_counts(none, ["key"], "n").count() == 0
    assert distinct_counts(none, [], "n").first().n == 0
