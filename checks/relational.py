"""Registered queries of the relational features, over the test tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from checks.adaptor import read
from clinchline.functions.columns import (
    column_from,
    any_of,
    none_of,
    one_of,
    percent_label,
    round_up,
    rule_value,
    total_if,
)
from clinchline.functions.distinct import distinct_bitmaps, distinct_counts
from clinchline.functions.ranking import Piece, first_per_key, rank_block, spread_row_number, spread_running_sum
from clinchline.plans.stages import Stages

C = F.col
Tables = Callable[[str], DataFrame]
_ENTRIES: dict[str, tuple[Callable[[Tables], DataFrame], str]] = {}


def _entry(name: str, sql: str):
    def register(query: Callable[[Tables], DataFrame]):
        _ENTRIES[name] = (query, sql)
        return query

    return register


def _n():
    return F.count(F.lit(1)).alias("n")


def _sum(column):
    return F.sum(column).cast("long")


def _qty():
    return C("l_quantity").cast("int")


def _stage(rows: DataFrame) -> DataFrame:
    """Rows that are read more than once, evaluated once."""
    return Stages(rows.sparkSession).keep(rows)


# ---- scalar functions ----------------------------------------------------------------------


@_entry(
    "f1_comparisons",
    """SELECT l_quantity = 25 AS eq, l_quantity <> 10 AS ne, l_quantity < 20 AS lt,
         l_linenumber <= 3 AS le, l_quantity > 40 AS gt, l_linenumber >= 5 AS ge, COUNT(*) AS n
       FROM lineitem GROUP BY ALL""",
)
def _f1(t):
    return t("lineitem").groupBy(
        (C("l_quantity") == 25).alias("eq"),
        (C("l_quantity") != 10).alias("ne"),
        (C("l_quantity") < 20).alias("lt"),
        (C("l_linenumber") <= 3).alias("le"),
        (C("l_quantity") > 40).alias("gt"),
        (C("l_linenumber") >= 5).alias("ge"),
    ).agg(_n())


@_entry(
    "f2_in_lists",
    """SELECT o_orderstatus, COUNT(*) AS n FROM orders
       WHERE o_orderpriority IN ('1-URGENT', '2-HIGH') AND o_orderstatus NOT IN ('P')
       GROUP BY o_orderstatus""",
)
def _f2(t):
    return (
        t("orders")
        .where(one_of("o_orderpriority", ["1-URGENT", "2-HIGH"]) & none_of("o_orderstatus", ["P"]))
        .groupBy("o_orderstatus")
        .agg(_n())
    )


@_entry(
    "f3_in_columns",
    """SELECT l_linenumber IN (l_partkey % 7, l_suppkey % 7, l_orderkey % 7,
         NULLIF(l_partkey % 5, 0)) AS member, COUNT(*) AS n FROM lineitem GROUP BY ALL""",
)
def _f3(t):
    seats = [C("l_partkey") % 7, C("l_suppkey") % 7, C("l_orderkey") % 7]
    seats.append(F.nullif(C("l_partkey") % 5, F.lit(0)))
    return t("lineitem").groupBy(C("l_linenumber").isin(*seats).alias("member")).agg(_n())


@_entry(
    "f4_between",
    "SELECT l_linenumber, COUNT(*) AS n FROM lineitem WHERE l_quantity BETWEEN 10 AND 20 GROUP BY 1",
)
def _f4(t):
    return t("lineitem").where(C("l_quantity").between(10, 20)).groupBy("l_linenumber").agg(_n())


@_entry(
    "f5_is_null",
    """SELECT o_orderkey IS NULL AS no_order, o_orderkey IS NOT NULL AS has_order,
         COUNT(*) AS n FROM customer LEFT JOIN orders ON c_custkey = o_custkey GROUP BY ALL""",
)
def _f5(t):
    joined = t("customer").join(t("orders"), C("c_custkey") == C("o_custkey"), "left")
    return joined.groupBy(
        C("o_orderkey").isNull().alias("no_order"), C("o_orderkey").isNotNull().alias("has_order")
    ).agg(_n())


@_entry(
    "f6_boolean_output",
    """SELECT c_custkey, c_acctbal >= 0 AS solvent, c_acctbal = 0 AS even FROM customer""",
)
def _f6(t):
    return t("customer").select(
        "c_custkey", (C("c_acctbal") >= 0).alias("solvent"), (C("c_acctbal") == 0).alias("even")
    )


@_entry(
    "f7_case",
    """SELECT CASE WHEN l_quantity < 10 THEN 'small' WHEN l_quantity < 30 THEN
           CASE WHEN l_returnflag = 'R' THEN 'returned' ELSE 'medium' END ELSE 'large' END AS size,
         CAST(SUM(CASE WHEN l_linestatus = 'F' THEN CAST(l_quantity AS INTEGER) ELSE 0 END * 3)
           AS BIGINT) AS total
       FROM lineitem GROUP BY 1""",
)
def _f7(t):
    size = (
        F.when(C("l_quantity") < 10, "small")
        .when(C("l_quantity") < 30, F.when(C("l_returnflag") == "R", "returned").otherwise("medium"))
        .otherwise("large")
    )
    return t("lineitem").groupBy(size.alias("size")).agg(
        _sum(F.when(C("l_linestatus") == "F", _qty()).otherwise(0) * 3).alias("total")
    )


@_entry(
    "f8_coalesce",
    """SELECT c_custkey, CAST(COALESCE(o.n, 0) AS BIGINT) AS orders,
         COALESCE(o.urgent, FALSE) AS urgent, COALESCE(o.first_key, c_custkey, -1) AS key
       FROM customer LEFT JOIN (SELECT o_custkey, COUNT(*) AS n, MIN(o_orderkey) AS first_key,
         BOOL_OR(o_orderpriority = '1-URGENT') AS urgent FROM orders GROUP BY 1) o
         ON o_custkey = c_custkey""",
)
def _f8(t):
    o = t("orders").groupBy("o_custkey").agg(
        _n(),
        F.min("o_orderkey").alias("first_key"),
        F.bool_or(C("o_orderpriority") == "1-URGENT").alias("urgent"),
    )
    return t("customer").join(o, C("o_custkey") == C("c_custkey"), "left").select(
        "c_custkey",
        F.coalesce("n", F.lit(0).cast("long")).alias("orders"),
        F.coalesce("urgent", F.lit(False)).alias("urgent"),
        F.coalesce("first_key", "c_custkey", F.lit(-1)).alias("key"),
    )


@_entry(
    "f9_nullif",
    """SELECT l_suppkey, NULLIF(COUNT(*) FILTER (l_returnflag = 'R' AND l_quantity > 49), 0) AS n,
         COUNT(NULLIF(l_linenumber, 7)) AS not_seven FROM lineitem GROUP BY 1""",
)
def _f9(t):
    hit = (C("l_returnflag") == "R") & (C("l_quantity") > 49)
    return t("lineitem").groupBy("l_suppkey").agg(
        F.nullif(F.count_if(hit), F.lit(0).cast("long")).alias("n"),
        F.count(F.nullif("l_linenumber", F.lit(7))).alias("not_seven"),
    )


@_entry(
    "f10_least",
    """SELECT l_linenumber, CAST(SUM(LEAST(CAST(l_quantity AS INTEGER), 30,
         NULLIF(l_linenumber, 3) * 8)) AS BIGINT) AS capped FROM lineitem GROUP BY 1""",
)
def _f10(t):
    capped = F.least(_qty(), F.lit(30), F.nullif("l_linenumber", F.lit(3)) * 8)
    return t("lineitem").groupBy("l_linenumber").agg(_sum(capped).alias("capped"))


@_entry(
    "f11_round_up",
    """SELECT CAST(l_quantity AS INTEGER) AS q, CAST(CEIL(l_quantity / 5.0) * 5 AS INTEGER) AS by5,
         CAST(CEIL(l_quantity / 3.0) * 3 AS INTEGER) AS by3,
         CAST(CEIL(l_quantity / 15.0) * 15 AS INTEGER) AS by15, COUNT(*) AS n
       FROM lineitem GROUP BY ALL""",
)
def _f11(t):
    return t("lineitem").groupBy(
        _qty().alias("q"),
        round_up(_qty(), 5).alias("by5"),
        round_up(_qty(), 3).alias("by3"),
        round_up(_qty(), 15).alias("by15"),
    ).agg(_n())


@_entry(
    "f12_round",
    """SELECT l_suppkey, CAST(LEAST(ROUND(SUM(CAST(l_linestatus = 'F' AS INTEGER)) * 100.0
         / COUNT(*), 1), 99.9) AS VARCHAR) || '%' AS share FROM lineitem GROUP BY 1""",
)
def _f12(t):
    sums = t("lineitem").groupBy("l_suppkey").agg(
        F.count_if(C("l_linestatus") == "F").alias("part"), F.count(F.lit(1)).alias("whole")
    )
    return sums.select("l_suppkey", percent_label(C("part"), C("whole")).alias("share"))


@_entry(
    "f13_cast",
    """SELECT l_linenumber, CAST(SUM(CAST(l_quantity AS INTEGER)) AS INTEGER) AS total,
         CAST(COUNT(*) AS VARCHAR) AS shown FROM lineitem GROUP BY 1""",
)
def _f13(t):
    return t("lineitem").groupBy("l_linenumber").agg(
        F.sum(_qty()).cast("int").alias("total"), F.count(F.lit(1)).cast("string").alias("shown")
    )


@_entry(
    "f14_concat",
    """SELECT n_nationkey, n_name || ' / ' || (n_regionkey + 1) AS label FROM nation""",
)
def _f14(t):
    label = F.concat("n_name", F.lit(" / "), (C("n_regionkey") + 1).cast("string"))
    return t("nation").select("n_nationkey", label.alias("label"))


@_entry(
    "f15_substring",
    "SELECT c_custkey, SUBSTRING(c_name, 10) AS number FROM customer",
)
def _f15(t):
    return t("customer").select("c_custkey", column_from("c_name", 10).alias("number"))


@_entry(
    "f16_split_part",
    """SELECT p_partkey, SPLIT_PART(SUBSTRING(o, POSITION('-' IN o) + 1), ' ', 1) AS word
       FROM (SELECT p_partkey, p_brand || '-' || p_type AS o FROM part)""",
)
def _f16(t):
    text = t("part").select("p_partkey", F.concat("p_brand", F.lit("-"), "p_type").alias("o"))
    after = F.expr("substring(o, position('-' in o) + 1)")
    return text.select("p_partkey", F.split_part(after, F.lit(" "), F.lit(1)).alias("word"))


@_entry(
    "f17_lower_like",
    """SELECT r_name, LOWER(r_name) LIKE '%east%' AS east, LOWER(r_name) LIKE 'a%' AS a_word
       FROM region""",
)
def _f17(t):
    low = F.lower("r_name")
    return t("region").select("r_name", low.like("%east%").alias("east"), low.like("a%").alias("a_word"))


@_entry(
    "f18_arithmetic",
    """SELECT l_suppkey, CAST(SUM(18 * l_linenumber + 4 * CAST(l_quantity AS INTEGER) - 7) AS BIGINT)
         AS score FROM lineitem GROUP BY 1""",
)
def _f18(t):
    return t("lineitem").groupBy("l_suppkey").agg(
        _sum(18 * C("l_linenumber") + 4 * _qty() - 7).alias("score")
    )


@_entry(
    "f19_safe_division",
    """SELECT l_suppkey, CAST(SUM(CAST(l_quantity AS INTEGER)) AS DOUBLE)
         / NULLIF(COUNT(*) FILTER (l_quantity > 49 AND l_returnflag = 'A'), 0) AS ratio
       FROM lineitem GROUP BY 1""",
)
def _f19(t):
    hits = F.count_if((C("l_quantity") > 49) & (C("l_returnflag") == "A"))
    return t("lineitem").groupBy("l_suppkey").agg(F.try_divide(F.sum(_qty()), hits).alias("ratio"))


@_entry(
    "f20_lateral_alias",
    """SELECT o_orderstatus, n, n * 2 AS twice, CASE WHEN n * 2 > 100 THEN 'many' ELSE 'few' END
         AS label FROM (SELECT o_orderstatus, COUNT(*) AS n FROM orders GROUP BY 1)""",
)
def _f20(t):
    counted = t("orders").groupBy("o_orderstatus").agg(_n())
    return counted.selectExpr(
        "o_orderstatus", "n", "n * 2 AS twice", "CASE WHEN twice > 100 THEN 'many' ELSE 'few' END AS label"
    )


@_entry(
    "f21_constants",
    "SELECT n_name, 1 AS kind, 'Finals' AS label, 0 AS points FROM nation",
)
def _f21(t):
    return t("nation").select(
        "n_name", F.lit(1).alias("kind"), F.lit("Finals").alias("label"), F.lit(0).alias("points")
    )


@_entry(
    "f22_star_plus",
    "SELECT s.*, s_acctbal < 0 AS in_debt FROM supplier s",
)
def _f22(t):
    return t("supplier").select("*", (C("s_acctbal") < 0).alias("in_debt"))


@_entry(
    "f23_dates",
    """SELECT o_orderpriority, CAST(MIN(o_orderdate) AS DATE) AS first_day,
         COUNT(*) FILTER (CAST(o_orderdate AS DATE) <= DATE '1998-06-30') AS early
       FROM orders GROUP BY 1""",
)
def _f23(t):
    day = C("o_orderdate").cast("date")
    return t("orders").groupBy("o_orderpriority").agg(
        F.min(day).alias("first_day"),
        F.count_if(day <= F.lit("1998-06-30").cast("date")).alias("early"),
    )


@_entry(
    "f24_exceptions",
    """SELECT r_name, CASE r_name WHEN 'ASIA' THEN 2 WHEN 'EUROPE' THEN 3 ELSE 4 END AS winners
       FROM region""",
)
def _f24(t):
    return t("region").select(
        "r_name", rule_value({"ASIA": 2, "EUROPE": 3}, C("r_name"), 4).alias("winners")
    )


# ---- joins -----------------------------------------------------------------------------------


@_entry(
    "j1_inner",
    """SELECT o_orderpriority, COUNT(*) AS n FROM lineitem JOIN orders ON l_orderkey = o_orderkey
       GROUP BY 1""",
)
def _j1(t):
    return (
        t("lineitem").join(t("orders"), C("l_orderkey") == C("o_orderkey"))
        .groupBy("o_orderpriority").agg(_n())
    )


@_entry(
    "j2_left",
    """SELECT c_custkey, COUNT(o_orderkey) AS n FROM customer
       LEFT JOIN orders ON c_custkey = o_custkey GROUP BY 1""",
)
def _j2(t):
    counts = t("orders").groupBy(C("o_custkey").alias("c_custkey")).agg(_n())
    return t("customer").join(counts, "c_custkey", "left").select(
        "c_custkey", F.coalesce("n", F.lit(0).cast("long")).alias("n")
    )


@_entry(
    "j3_anti",
    """SELECT c_custkey FROM customer LEFT JOIN orders ON c_custkey = o_custkey
         AND o_orderstatus = 'P' AND o_orderpriority = '1-URGENT' WHERE o_custkey IS NULL""",
)
def _j3(t):
    urgent = t("orders").where("o_orderstatus = 'P' AND o_orderpriority = '1-URGENT'")
    return t("customer").join(urgent, C("c_custkey") == C("o_custkey"), "left_anti").select("c_custkey")


@_entry(
    "j4_full_chain",
    """SELECT COALESCE(a.k, b.k, c.k) AS k, a.n AS a, b.n AS b, c.n AS c FROM
         (SELECT l_suppkey AS k, COUNT(*) AS n FROM lineitem WHERE l_quantity = 50 AND l_returnflag = 'A'
            AND l_linenumber = 1 GROUP BY 1) a
         FULL JOIN (SELECT l_suppkey AS k, COUNT(*) AS n FROM lineitem WHERE l_quantity = 1
            AND l_returnflag = 'N' AND l_linenumber = 2 GROUP BY 1) b ON a.k = b.k
         FULL JOIN (SELECT s_suppkey AS k, COUNT(*) AS n FROM supplier WHERE s_acctbal < 0
            GROUP BY 1) c ON COALESCE(a.k, b.k) = c.k""",
)
def _j4(t):
    def part(condition, name):
        return (
            t("lineitem").where(condition).groupBy(C("l_suppkey").alias("k"))
            .agg(F.count(F.lit(1)).alias(name))
        )

    a = part("l_quantity = 50 AND l_returnflag = 'A' AND l_linenumber = 1", "a")
    b = part("l_quantity = 1 AND l_returnflag = 'N' AND l_linenumber = 2", "b")
    c = t("supplier").where("s_acctbal < 0").groupBy(C("s_suppkey").alias("k")).agg(
        F.count(F.lit(1)).alias("c")
    )
    return a.join(b, "k", "full").join(c, "k", "full")


@_entry(
    "j5_disjunctive",
    """SELECT n_name, COUNT(*) AS n FROM lineitem
       JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
       JOIN supplier ON l_suppkey = s_suppkey
       JOIN nation ON (l_linestatus = 'F' AND n_nationkey = s_nationkey)
         OR (l_linestatus = 'O' AND n_nationkey = c_nationkey) GROUP BY 1""",
)
def _j5(t):
    lines = (
        t("lineitem")
        .join(t("orders"), C("l_orderkey") == C("o_orderkey"))
        .join(t("customer"), C("o_custkey") == C("c_custkey"))
        .join(t("supplier"), C("l_suppkey") == C("s_suppkey"))
    )
    side = F.when(C("l_linestatus") == "F", C("s_nationkey")).when(
        C("l_linestatus") == "O", C("c_nationkey")
    )
    counts = lines.groupBy(side.alias("n_nationkey")).agg(_n())
    return counts.join(t("nation"), "n_nationkey").select("n_name", "n")


@_entry(
    "j6_membership",
    """SELECT s_suppkey, COUNT(*) AS n FROM supplier JOIN (
         SELECT l_partkey % 100 AS a, l_partkey % 97 AS b, l_orderkey % 89 AS c FROM lineitem) r
         ON s_suppkey IN (a, b, c) GROUP BY 1""",
)
def _j6(t):
    seats = F.array(C("l_partkey") % 100, C("l_partkey") % 97, C("l_orderkey") % 89)
    members = t("lineitem").select(F.explode(F.array_distinct(seats)).alias("s_suppkey"))
    counts = members.groupBy("s_suppkey").agg(_n())
    return t("supplier").join(counts, "s_suppkey").select("s_suppkey", "n")


@_entry(
    "j7_lower_ranked",
    """WITH r AS (SELECT s_nationkey, s_suppkey, ROW_NUMBER() OVER (PARTITION BY s_nationkey
           ORDER BY s_acctbal DESC, s_suppkey) AS place FROM supplier)
       SELECT a.s_suppkey, COUNT(*) AS below, CAST(SUM(b.place) AS BIGINT) AS places FROM r a
       JOIN r b ON a.s_nationkey = b.s_nationkey AND b.place > a.place
       WHERE a.place <= 3 GROUP BY 1""",
)
def _j7(t):
    # leaders meet their followers by blocks of places, so a large nation is many join keys
    ranked = _stage(
        spread_row_number(
            t("supplier").select("s_nationkey", "s_suppkey", "s_acctbal"),
            ["s_nationkey"],
            [Piece(F.floor(C("s_acctbal") / 100), descending=True)],
            [C("s_acctbal").desc(), C("s_suppkey").asc()],
            "place",
        )
    )
    leaders = ranked.where(C("place") <= 3).select("s_nationkey", "s_suppkey", "place")
    sizes = ranked.groupBy("s_nationkey").agg(F.max("place").alias("last"))
    blocks = F.explode(F.sequence(F.lit(0).cast("long"), rank_block("last"))).alias("block")
    spread = leaders.join(sizes, "s_nationkey").select("s_nationkey", "s_suppkey", "place", blocks)
    below = ranked.select("s_nationkey", C("place").alias("lower"), rank_block("place").alias("block"))
    return (
        spread.join(below, ["s_nationkey", "block"])
        .where(C("lower") > C("place"))
        .groupBy("s_suppkey")
        .agg(F.count(F.lit(1)).alias("below"), F.sum("lower").alias("places"))
    )


@_entry(
    "j8_first_and_second",
    """WITH r AS (SELECT o_custkey, CAST(o_totalprice AS BIGINT) AS price, ROW_NUMBER() OVER (
           PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS i
         FROM (SELECT o_custkey, FLOOR(o_totalprice) AS o_totalprice, o_orderdate, o_orderkey FROM orders))
       SELECT c_custkey, a.price AS first_price, b.price AS second_price FROM customer
       LEFT JOIN r a ON a.o_custkey = c_custkey AND a.i = 1
       LEFT JOIN r b ON b.o_custkey = c_custkey AND b.i = 2""",
)
def _j8(t):
    price = F.floor("o_totalprice").cast("long")
    firsts = first_per_key(
        t("orders").select("o_custkey", price.alias("price"), "o_orderdate", "o_orderkey"),
        ["o_custkey"],
        [C("o_orderdate").asc(), C("o_orderkey").asc()],
        2,
    )
    order = Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey")
    wide = (
        firsts.withColumn("i", F.row_number().over(order))
        .groupBy(C("o_custkey").alias("c_custkey")).pivot("i", [1, 2]).agg(F.max("price"))
    )
    return t("customer").select("c_custkey").join(wide, "c_custkey", "left").select(
        "c_custkey", C("1").alias("first_price"), C("2").alias("second_price")
    )


@_entry(
    "j9_small_dimension",
    """SELECT r_name, COUNT(*) AS n FROM customer JOIN nation ON c_nationkey = n_nationkey
       JOIN region ON n_regionkey = r_regionkey GROUP BY 1""",
)
def _j9(t):
    by_nation = t("customer").groupBy(C("c_nationkey").alias("n_nationkey")).agg(
        F.count(F.lit(1)).alias("c")
    )
    places = t("nation").join(t("region"), C("n_regionkey") == C("r_regionkey"))
    return by_nation.join(places, "n_nationkey").groupBy("r_name").agg(F.sum("c").alias("n"))


@_entry(
    "j10_lookup_by_size_and_rank",
    """WITH p AS (SELECT * FROM (VALUES (1, 50), (2, 40), (3, 35), (4, 20), (5, 10)) v(place, pts)),
         c AS (SELECT a.place, SUM(b.pts) AS through FROM p a JOIN p b ON b.place <= a.place GROUP BY 1)
       SELECT l_suppkey, l_linenumber, COUNT(*) AS n, CAST(MAX(through) AS BIGINT) AS through
       FROM lineitem JOIN c ON place = l_linenumber GROUP BY 1, 2""",
)
def _j10(t):
    counts = t("lineitem").groupBy("l_suppkey", "l_linenumber").agg(_n())
    spark = counts.sparkSession
    points = spark.createDataFrame([(1, 50), (2, 40), (3, 35), (4, 20), (5, 10)], "l_linenumber int, pts int")
    # five constant rows
    curve = points.withColumn(
        "through", F.sum("pts").over(Window.partitionBy(F.lit(0)).orderBy("l_linenumber"))
    ).drop("pts")
    return counts.join(curve, "l_linenumber")


@_entry(
    "j11_filtered_left_is_inner",
    """SELECT c_mktsegment, COUNT(*) AS n FROM customer LEFT JOIN orders ON c_custkey = o_custkey
       WHERE o_orderstatus = 'F' GROUP BY 1""",
)
def _j11(t):
    done = t("orders").where(C("o_orderstatus") == "F")
    return (
        t("customer").join(done, C("c_custkey") == C("o_custkey"))
        .groupBy("c_mktsegment").agg(_n())
    )


@_entry(
    "j12_aggregate_before_join",
    """SELECT c_custkey, ANY_VALUE(c_name) AS name, COUNT(o_orderkey) AS orders
       FROM customer JOIN orders ON c_custkey = o_custkey GROUP BY 1""",
)
def _j12(t):
    counts = t("orders").groupBy(C("o_custkey").alias("c_custkey")).agg(
        F.count("o_orderkey").alias("orders")
    )
    return t("customer").join(counts, "c_custkey").select("c_custkey", C("c_name").alias("name"), "orders")


@_entry(
    "j13_attribute_join",
    """SELECT n_name, COUNT(DISTINCT c_custkey) AS customers, COUNT(DISTINCT s_suppkey) AS suppliers
       FROM nation LEFT JOIN customer ON c_nationkey = n_nationkey
       LEFT JOIN supplier ON s_nationkey = n_nationkey GROUP BY 1""",
)
def _j13(t):
    zero = F.lit(0).cast("long")
    customers = t("customer").groupBy(C("c_nationkey").alias("n_nationkey")).agg(
        F.count(F.lit(1)).alias("customers")
    )
    suppliers = t("supplier").groupBy(C("s_nationkey").alias("n_nationkey")).agg(
        F.count(F.lit(1)).alias("suppliers")
    )
    return (
        t("nation").join(customers, "n_nationkey", "left").join(suppliers, "n_nationkey", "left")
        .select(
            "n_name",
            F.coalesce("customers", zero).alias("customers"),
            F.coalesce("suppliers", zero).alias("suppliers"),
        )
    )


# ---- aggregates ------------------------------------------------------------------------------


@_entry(
    "a1_basic",
    """SELECT l_returnflag, l_linestatus, CAST(SUM(CAST(l_quantity AS INTEGER)) AS BIGINT) AS qty,
         COUNT(*) AS n, COUNT(l_tax) AS taxed, MAX(l_quantity) AS most, MIN(l_shipdate) AS first_ship
       FROM lineitem GROUP BY 1, 2""",
)
def _a1(t):
    return t("lineitem").groupBy("l_returnflag", "l_linestatus").agg(
        _sum(_qty()).alias("qty"), _n(), F.count("l_tax").alias("taxed"),
        F.max("l_quantity").alias("most"), F.min("l_shipdate").alias("first_ship"),
    )


@_entry(
    "a2_count_distinct",
    """SELECT l_suppkey, COUNT(DISTINCT l_partkey) AS parts FROM lineitem GROUP BY 1
       HAVING COUNT(DISTINCT l_partkey) >= 2""",
)
def _a2(t):
    counted = t("lineitem").groupBy("l_suppkey").agg(F.count_distinct("l_partkey").alias("parts"))
    return counted.where(C("parts") >= 2)


@_entry(
    "a2_count_distinct_merged",
    """SELECT o_orderstatus, CAST(EXTRACT(YEAR FROM o_orderdate) AS INTEGER) AS order_year,
         COUNT(DISTINCT o_custkey) AS customers FROM orders GROUP BY 1, 2""",
)
def _a2_merged(t):
    # few keys over dense numbers: months are counted once, and merged to years
    orders = t("orders").select("o_orderstatus", F.date_trunc("month", "o_orderdate").alias("month"), "o_custkey")
    months = distinct_bitmaps(orders, ["o_orderstatus", "month"], "o_custkey")
    years = months.withColumn("order_year", F.year("month")).drop("month")
    return distinct_counts(years, ["o_orderstatus", "order_year"], "customers")


@_entry(
    "a3_count_expression",
    """SELECT l_suppkey, COUNT(*) AS listed, COUNT(COALESCE(NULLIF(l_quantity, 1), NULLIF(l_discount, 0)))
         AS played FROM lineitem GROUP BY 1""",
)
def _a3(t):
    played = F.coalesce(F.nullif("l_quantity", F.lit(1.0)), F.nullif("l_discount", F.lit(0.0)))
    return t("lineitem").groupBy("l_suppkey").agg(
        F.count(F.lit(1)).alias("listed"), F.count(played).alias("played")
    )


@_entry(
    "a4_conditional_sum",
    """SELECT l_suppkey, CAST(SUM(CASE WHEN l_returnflag IN ('A', 'R') THEN 1 ELSE 0 END) AS BIGINT)
         AS back FROM lineitem GROUP BY 1""",
)
def _a4(t):
    return t("lineitem").groupBy("l_suppkey").agg(
        total_if(one_of("l_returnflag", ["A", "R"])).alias("back")
    )


@_entry(
    "a5_any_value",
    """SELECT o_custkey, ANY_VALUE(c_name) AS name, COUNT(*) AS n FROM orders
       JOIN customer ON o_custkey = c_custkey GROUP BY 1""",
)
def _a5(t):
    joined = t("orders").join(t("customer"), C("o_custkey") == C("c_custkey"))
    return joined.groupBy("o_custkey").agg(any_of("c_name").alias("name"), _n())


@_entry(
    "a6_bool_or",
    """SELECT o_custkey, BOOL_OR(o_orderstatus = 'P') AS pending FROM orders GROUP BY 1""",
)
def _a6(t):
    return t("orders").groupBy("o_custkey").agg(F.bool_or(C("o_orderstatus") == "P").alias("pending"))


@_entry(
    "a7_having",
    "SELECT o_custkey, COUNT(*) AS n FROM orders GROUP BY 1 HAVING COUNT(*) >= 12",
)
def _a7(t):
    return t("orders").groupBy("o_custkey").agg(_n()).where(C("n") >= 12)


@_entry(
    "a8_group_by_positions",
    "SELECT c_mktsegment, c_nationkey, COUNT(*) AS n FROM customer GROUP BY 1, 2",
)
def _a8(t):
    return t("customer").groupBy("c_mktsegment", "c_nationkey").agg(_n())


@_entry(
    "a9_compared_aggregate",
    "SELECT l_suppkey, MAX(l_quantity) = 50 AS full_box FROM lineitem GROUP BY 1",
)
def _a9(t):
    return t("lineitem").groupBy("l_suppkey").agg((F.max("l_quantity") == 50).alias("full_box"))


@_entry(
    "a10_all_equal",
    """SELECT l_orderkey, MAX(l_linestatus) = 'F' AND MIN(l_linestatus) = 'F' AS all_done
       FROM lineitem GROUP BY 1""",
)
def _a10(t):
    return t("lineitem").groupBy("l_orderkey").agg(F.bool_and(C("l_linestatus") == "F").alias("all_done"))


@_entry(
    "a11_priority_pick",
    """SELECT o_custkey, CASE WHEN MAX(CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 0 END) = 1 THEN 'P'
         WHEN MAX(CASE WHEN o_orderstatus = 'O' THEN 1 ELSE 0 END) = 1 THEN 'O' ELSE 'F' END AS best
       FROM orders GROUP BY 1""",
)
def _a11(t):
    order = F.array_position(F.array(F.lit("P"), F.lit("O"), F.lit("F")), C("o_orderstatus"))
    return t("orders").groupBy("o_custkey").agg(F.min_by("o_orderstatus", order).alias("best"))


@_entry("a12_distinct", "SELECT DISTINCT l_suppkey, l_returnflag FROM lineitem")
def _a12(t):
    return t("lineitem").select("l_suppkey", "l_returnflag").distinct()


@_entry(
    "a13_ratio_of_aggregates",
    """SELECT o_orderpriority, CASE WHEN COUNT(*) FILTER (o_orderstatus = 'P') = 0 THEN '-' ELSE
         CAST(LEAST(ROUND(COUNT(*) FILTER (o_orderstatus = 'P') * 100.0 / COUNT(*), 1), 99.9)
           AS VARCHAR) || '%' END AS pending FROM orders GROUP BY 1""",
)
def _a13(t):
    sums = t("orders").groupBy("o_orderpriority").agg(
        F.count_if(C("o_orderstatus") == "P").alias("part"), F.count(F.lit(1)).alias("whole")
    )
    label = F.when(C("part") == 0, "-").otherwise(percent_label(C("part"), C("whole")))
    return sums.select("o_orderpriority", label.alias("pending"))


@_entry(
    "a14_sums_per_key",
    """SELECT l_suppkey, CAST(SUM(CASE WHEN l_linenumber <= 2 THEN CAST(l_quantity AS INTEGER) END)
         AS BIGINT) AS quals, CAST(SUM(CASE WHEN l_linenumber > 6 THEN CAST(l_quantity AS INTEGER)
         END) AS BIGINT) AS awards FROM lineitem GROUP BY 1""",
)
def _a14(t):
    return t("lineitem").groupBy("l_suppkey").agg(
        _sum(F.when(C("l_linenumber") <= 2, _qty())).alias("quals"),
        _sum(F.when(C("l_linenumber") > 6, _qty())).alias("awards"),
    )


# ---- windows ---------------------------------------------------------------------------------


@_entry(
    "w1_first_k_per_key",
    """SELECT o_custkey, o_orderkey FROM orders QUALIFY ROW_NUMBER() OVER (PARTITION BY o_custkey
         ORDER BY o_orderdate, o_orderkey) <= 2""",
)
def _w1(t):
    order = [C("o_orderdate").asc(), C("o_orderkey").asc()]
    return first_per_key(
        t("orders").select("o_custkey", "o_orderkey", "o_orderdate"), ["o_custkey"], order, 2
    ).select("o_custkey", "o_orderkey")


@_entry(
    "w2_rank_by_total",
    """SELECT c_nationkey, c_custkey, CAST(total AS BIGINT) AS total, CAST(ROW_NUMBER() OVER (
         PARTITION BY c_nationkey ORDER BY total DESC, c_custkey) AS INTEGER) AS place
       FROM (SELECT c_nationkey, c_custkey, COALESCE(SUM(CAST(FLOOR(o_totalprice) AS BIGINT)), 0)
           AS total FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY 1, 2)""",
)
def _w2(t):
    totals = t("orders").groupBy(C("o_custkey").alias("c_custkey")).agg(
        F.sum(F.floor("o_totalprice")).alias("total")
    )
    rows = t("customer").join(totals, "c_custkey", "left").select(
        "c_nationkey", "c_custkey", F.coalesce("total", F.lit(0).cast("long")).alias("total")
    )
    # coarse steps of the total split a large nation into many small windows
    step = F.floor(C("total") / 100000)
    return spread_row_number(
        _stage(rows),
        ["c_nationkey"],
        [Piece(step, descending=True)],
        [C("total").desc(), C("c_custkey").asc()],
        "place",
    )


@_entry(
    "w3_rank_after_anti_join",
    """SELECT s_nationkey, s_suppkey, CAST(ROW_NUMBER() OVER (PARTITION BY s_nationkey
         ORDER BY s_suppkey) AS INTEGER) AS place FROM supplier
       WHERE s_suppkey NOT IN (SELECT l_suppkey FROM lineitem WHERE l_quantity = 50
         AND l_discount = 0 AND l_linenumber = 7)""",
)
def _w3(t):
    out = t("lineitem").where("l_quantity = 50 AND l_discount = 0 AND l_linenumber = 7")
    left = t("supplier").join(out, C("s_suppkey") == C("l_suppkey"), "left_anti")
    return spread_row_number(
        _stage(left.select("s_nationkey", "s_suppkey")),
        ["s_nationkey"],
        [Piece(rank_block("s_suppkey"))],
        [C("s_suppkey").asc()],
        "place",
    )


@_entry(
    "w4_rank_within_flag",
    """SELECT o_custkey, o_orderkey, CASE WHEN o_orderstatus = 'F' THEN CAST(ROW_NUMBER() OVER (
         PARTITION BY o_custkey, o_orderstatus = 'F' ORDER BY o_orderkey) AS INTEGER) END AS place
       FROM orders""",
)
def _w4(t):
    flagged = t("orders").withColumn("done", C("o_orderstatus") == "F")
    order = Window.partitionBy("o_custkey", "done").orderBy("o_orderkey")
    return flagged.select(
        "o_custkey", "o_orderkey", F.when(C("done"), F.row_number().over(order)).alias("place")
    )


_BY_SIZE = """(SELECT l_suppkey, l_linenumber, CAST(SUM(CAST(l_quantity AS INTEGER)) AS BIGINT) AS q
    FROM lineitem GROUP BY 1, 2)"""


def _by_size(t):
    return t("lineitem").groupBy("l_suppkey", "l_linenumber").agg(F.sum(_qty()).alias("q"))


@_entry(
    "w5_running_sum",
    f"""SELECT l_suppkey, l_linenumber, CAST(SUM(q) OVER (PARTITION BY l_suppkey
         ORDER BY l_linenumber) AS BIGINT) AS through FROM {_BY_SIZE}""",
)
def _w5(t):
    order = Window.partitionBy("l_suppkey").orderBy("l_linenumber")
    return _by_size(t).select("l_suppkey", "l_linenumber", F.sum("q").over(order).alias("through"))


@_entry(
    "w5_running_sum_of_any_size",
    """SELECT l_linestatus, l_orderkey, l_linenumber, CAST(SUM(q) OVER (
         PARTITION BY l_linestatus ORDER BY l_orderkey, l_linenumber) AS BIGINT) AS through FROM (
         SELECT l_linestatus, l_orderkey, l_linenumber, SUM(CAST(l_quantity AS INTEGER)) AS q
         FROM lineitem GROUP BY ALL) r""",
)
def _w5_any_size(t):
    # two values of the key: each holds half of all lines
    keys = ["l_linestatus", "l_orderkey", "l_linenumber"]
    lines = _stage(t("lineitem").groupBy(*keys).agg(_sum(_qty()).alias("q")))
    ranges = [Piece(F.floor(C("l_orderkey") / 1000))]
    order = [C("l_orderkey").asc(), C("l_linenumber").asc()]
    return spread_running_sum(lines, ["l_linestatus"], ranges, order, "q", "through").drop("q")


@_entry(
    "w6_partition_min",
    f"""SELECT l_suppkey, l_linenumber, MIN(q) OVER (PARTITION BY l_suppkey) AS least
        FROM {_BY_SIZE}""",
)
def _w6(t):
    whole = Window.partitionBy("l_suppkey")
    return _by_size(t).select("l_suppkey", "l_linenumber", F.min("q").over(whole).alias("least"))


@_entry(
    "w7_position_pivot",
    """SELECT o_custkey, MAX(CASE WHEN i = 1 THEN o_orderkey END) AS one,
         MAX(CASE WHEN i = 2 THEN o_orderkey END) AS two FROM (
         SELECT o_custkey, o_orderkey, ROW_NUMBER() OVER (PARTITION BY o_custkey
           ORDER BY o_orderdate, o_orderkey) AS i FROM orders) GROUP BY 1""",
)
def _w7(t):
    order = Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey")
    numbered = t("orders").withColumn("i", F.row_number().over(order)).where(C("i") <= 2)
    return numbered.groupBy("o_custkey").agg(
        F.max(F.when(C("i") == 1, C("o_orderkey"))).alias("one"),
        F.max(F.when(C("i") == 2, C("o_orderkey"))).alias("two"),
    )


# ---- sorts and set operations ----------------------------------------------------------------


@_entry(
    "o1_order_by",
    "SELECT o_orderdate, o_orderkey FROM orders ORDER BY o_orderdate, o_orderkey",
)
def _o1(t):
    return t("orders").select("o_orderdate", "o_orderkey").orderBy("o_orderdate", "o_orderkey")


@_entry(
    "o2_order_by_over_union",
    """SELECT 0 AS kind, c_name AS name FROM customer UNION ALL SELECT 1, s_name FROM supplier
       ORDER BY kind, name""",
)
def _o2(t):
    first = t("customer").select(F.lit(0).alias("kind"), C("c_name").alias("name"))
    last = t("supplier").select(F.lit(1).alias("kind"), C("s_name").alias("name"))
    return first.unionByName(last).orderBy("kind", "name")


@_entry(
    "o3_keyed_row",
    """SELECT r_regionkey, r_name, COUNT(*) OVER (PARTITION BY r_regionkey) = 1 AS is_unique
       FROM region""",
)
def _o3(t):
    sizes = t("region").groupBy("r_regionkey").agg(
        (F.count(F.lit(1)) == 1).alias("is_unique"), F.max("r_name").alias("r_name")
    )
    return sizes.select("r_regionkey", "r_name", "is_unique")


@_entry(
    "o4_unpivot",
    """SELECT k, COUNT(*) AS n FROM (SELECT l_orderkey AS k FROM lineitem UNION ALL
         SELECT l_partkey FROM lineitem UNION ALL SELECT NULLIF(l_suppkey, 7) FROM lineitem
         WHERE NULLIF(l_suppkey, 7) IS NOT NULL) GROUP BY 1""",
)
def _o4(t):
    seats = F.array("l_orderkey", "l_partkey", F.nullif("l_suppkey", F.lit(7).cast("long")))
    rows = t("lineitem").select(F.explode(seats).alias("k")).where(C("k").isNotNull())
    return rows.groupBy("k").agg(_n())


@_entry(
    "o5_union_of_sources",
    """SELECT c_nationkey AS nation, 'customer' AS source, COUNT(*) AS n FROM customer GROUP BY 1
       UNION ALL SELECT s_nationkey, 'supplier', COUNT(*) FROM supplier GROUP BY 1""",
)
def _o5(t):
    def part(table, key, label):
        return (
            t(table).groupBy(C(key).alias("nation")).agg(_n())
            .select("nation", F.lit(label).alias("source"), "n")
        )

    return part("customer", "c_nationkey", "customer").unionByName(
        part("supplier", "s_nationkey", "supplier")
    )


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(query):
        return lambda spark, sf_dir: query(lambda table: read(spark, sf_dir, table))

    return {name: bind(query) for name, (query, _) in _ENTRIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for name, (_, sql) in _ENTRIES.items()}
