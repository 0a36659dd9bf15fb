"""Competition tables derived from the TPC-H-like test tables.

The mapping is plain SQL that Spark and the checking engine both run, so that both start
from the same rows: a supplier is a district, its lines are spread over a few events by
ship date, and parts stand for teams (60 per district; the same team keys occur in every
district, so a key that forgets the district shows). All lines are used and the work grows
with them. A district is at a point of its season that depends on its key; matches, points
and awards exist as far as that point.
"""

from __future__ import annotations

import math
import re
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from clinchline.plans.stages import Stages
from clinchline.sources import lookups
from clinchline.sources.inputs import SeasonInputs

TEAMS = 60

# event code, kind (D district event, C championship, V division, F finals of divisions)
_CODES = {
    "season": """CASE WHEN yr <= 1996 THEN 'a' WHEN yr <= 1998 THEN 'b'
        WHEN yr = 1999 THEN 'c' ELSE 'd' END""",
    "dcmp": """CASE WHEN yr <= 1996 THEN 'a' WHEN yr <= 1998 THEN 'b'
        WHEN yr = 1999 THEN 'c' ELSE 'cmp' END""",
    "dcmp_regions": """CASE WHEN yr <= 1996 THEN 'a' WHEN yr <= 1998 THEN 'b'
        WHEN yr = 1999 THEN 'c' WHEN yr = 2000 THEN 'cn' ELSE 'cs' END""",
    "dcmp_divisions": """CASE WHEN yr <= 1996 THEN 'a' WHEN yr <= 1998 THEN 'b'
        WHEN yr = 1999 THEN 'c' WHEN yr >= 2001 THEN 'fin'
        WHEN l_suppkey % 2 = 0 THEN CASE number % 4 WHEN 0 THEN 'v1' WHEN 1 THEN 'v2'
          WHEN 2 THEN 'v3' ELSE 'v4' END
        WHEN number % 2 = 0 THEN 'v1' ELSE 'v2' END""",
}

# how far an event has come: 0 not started ... 12 completed; the finals of divisions have
# their own scale (-1 not started, 0..3)
_PROGRESS = {
    "season": """LEAST(GREATEST((l_suppkey * 7) % 40 - CASE code WHEN 'a' THEN 0 WHEN 'b' THEN 7
        WHEN 'c' THEN 14 ELSE 21 END, 0), 12)""",
    "dcmp": "CASE WHEN code = 'cmp' THEN (l_suppkey * 5) % 13 ELSE 12 END",
    "dcmp_regions": """CASE code WHEN 'cn' THEN (l_suppkey * 5) % 13
        WHEN 'cs' THEN (l_suppkey * 5 + 3) % 13 ELSE 12 END""",
    "dcmp_divisions": """CASE WHEN code = 'fin' THEN GREATEST((l_suppkey * 5) % 16 - 12, -1)
        WHEN code IN ('v1', 'v3') THEN LEAST((l_suppkey * 5) % 16, 12)
        WHEN code IN ('v2', 'v4') THEN LEAST(GREATEST((l_suppkey * 5) % 16 - 1, 0), 12)
        ELSE 12 END""",
}

# columns of a line that the mapping reads
_LINE_COLUMNS = [
    "l_suppkey",
    "l_orderkey",
    "l_partkey",
    "l_linenumber",
    "l_quantity",
    "l_shipdate",
]
# common multiples of what the mapping takes remainders by
_PART_REMAINDERS = math.lcm(TEAMS, 20, 13, 8)
_ORDER_REMAINDERS = math.lcm(13, 3)

# formats that share their tables
TABLES_OF = {
    "district": "season",
    "district_regions": "season",
    "dcmp": "dcmp",
    "dcmp_regions": "dcmp_regions",
    "dcmp_divisions": "dcmp_divisions",
}


def _number(expression: str) -> str:
    return f"(({expression}) % {TEAMS} + 1)"


def _team(expression: str) -> str:
    return f"'frc' || CAST({_number(expression)} AS STRING)"


def lines_sql(mode: str) -> str:
    key = TABLES_OF[mode]
    return f"""
      SELECT t.*,
        '2020s' || CAST(l_suppkey AS STRING) AS district_key,
        '2020s' || CAST(l_suppkey AS STRING) || code AS event_key,
        CASE WHEN code IN ('cmp', 'cn', 'cs') THEN 'C' WHEN code = 'fin' THEN 'F'
             WHEN code LIKE 'v%' THEN 'V' ELSE 'D' END AS kind,
        CAST({_PROGRESS[key]} AS INTEGER) AS progress,
        CASE WHEN code IN ('cmp', 'cn', 'cs', 'fin', 'v1', 'v2', 'v3', 'v4') THEN 3 ELSE 1 END
          AS times
      FROM (
        SELECT s.*, {_CODES[key]} AS code FROM (
          SELECT l_suppkey, l_orderkey, l_partkey, l_linenumber,
            CAST(l_quantity AS INTEGER) AS qty, CAST(l_shipdate AS DATE) AS ship,
            year(l_shipdate) AS yr,
            CAST(l_partkey % {TEAMS} + 1 AS INTEGER) AS number
          FROM lineitem
        ) s
      ) t"""


_SHIFT = """CASE code WHEN 'a' THEN 0 WHEN 'b' THEN 13 WHEN 'c' THEN 26 ELSE 39 END"""
IMPACT_NUMBER = _number(f"l_suppkey * 3 + {_SHIFT}")

TABLES = {
    "events": """
      SELECT district_key, event_key,
        CASE WHEN code = 'cn' THEN 'State Champs - North City'
             WHEN code = 'cs' THEN 'State Champs - south City'
             WHEN kind = 'V' THEN 'District Champs - ' || CASE code WHEN 'v1' THEN 'Ada'
                 WHEN 'v2' THEN 'Bell' WHEN 'v3' THEN 'Curie' ELSE 'Darwin' END || ' pool'
             ELSE 'Event ' || code END AS name,
        CASE kind WHEN 'D' THEN 'District' WHEN 'V' THEN 'District Championship Division'
             ELSE 'District Championship' END AS event_type,
        MIN(ship) AS start_date, MAX(ship) AS end_date
      FROM lines GROUP BY district_key, event_key, code, kind""",
    "event_teams": """
      SELECT event_key, 'frc' || CAST(number AS STRING) AS team_key
      FROM lines GROUP BY event_key, number""",
    "matches": f"""
      SELECT event_key || '_' || level || CAST(slot AS STRING) AS match_key, event_key,
        level AS comp_level, CAST(slot AS INTEGER) AS match_number,
        CASE WHEN played THEN CASE
          WHEN level = 'sf' THEN CASE WHEN (slot + l_suppkey) % 3 = 0 THEN 'red' ELSE 'blue' END
          WHEN level = 'f' THEN CASE WHEN (slot = 2) = (l_suppkey % 2 = 0) THEN 'blue' ELSE 'red' END
          WHEN slot % 2 = 0 THEN 'red' ELSE 'blue' END END AS winning_alliance,
        CAST(CASE WHEN played THEN total ELSE -1 END AS INTEGER) AS red_score,
        CAST(CASE WHEN played THEN total + 3 ELSE -1 END AS INTEGER) AS blue_score,
        CASE WHEN level = 'sf' THEN {_team('(slot - 1) % 8 + l_suppkey')}
             WHEN level = 'f' THEN {_team('l_suppkey')} ELSE {_team('slot')} END AS red_1_key,
        {_team('slot + 1')} AS red_2_key, {_team('slot + 2')} AS red_3_key,
        CASE WHEN level = 'sf' THEN {_team('(slot + 2) % 8 + 8 + l_suppkey')}
             WHEN level = 'f' THEN {_team('l_suppkey + 1')} ELSE {_team('slot + 3')} END
          AS blue_1_key,
        {_team('slot + 4')} AS blue_2_key, {_team('slot + 5')} AS blue_3_key
      FROM (
        SELECT g.*, CASE
          WHEN level = 'qm' THEN progress >= 2 OR slot % 2 = 0
          WHEN kind = 'F' AND level = 'sf' THEN slot <= CASE progress WHEN 0 THEN 0 WHEN 1 THEN 2
            ELSE 5 END
          WHEN kind = 'F' THEN slot <= CASE progress WHEN 2 THEN 1 WHEN 3 THEN 3 ELSE 0 END
          WHEN level = 'sf' THEN slot <= CASE WHEN progress < 3 THEN 0 WHEN progress = 3 THEN 3
            WHEN progress <= 9 THEN progress + 3 ELSE 13 END
          ELSE slot <= CASE WHEN progress < 10 THEN 0 WHEN progress = 10 THEN 1 ELSE 3 END
          END AS played
        FROM (
          SELECT event_key, l_suppkey, kind, progress, level, slot, SUM(qty) AS total
          FROM (
            SELECT lines.*,
              CASE WHEN l_linenumber <= 2 THEN 'qm' WHEN l_linenumber <= 6 THEN 'sf' ELSE 'f' END
                AS level,
              CASE WHEN l_linenumber <= 2 THEN l_partkey % 20
                   WHEN l_linenumber <= 6 THEN l_orderkey % 13 + 1 ELSE l_orderkey % 3 + 1 END
                AS slot
            FROM lines
          ) m
          WHERE (kind <> 'F' AND progress >= 1) OR (kind = 'F' AND progress >= 0 AND level <> 'qm')
          GROUP BY event_key, l_suppkey, kind, progress, level, slot
        ) g
      ) p""",
    "alliances": f"""
      SELECT event_key, 'Alliance ' || CAST(a + 1 AS STRING) AS alliance_name,
        {_team('a + l_suppkey')} AS captain_key,
        {_team('a + 8 + l_suppkey')} AS first_selection_key,
        {_team('a + 16 + l_suppkey')} AS second_selection_key,
        CASE WHEN a < 4 THEN {_team('a + 24 + l_suppkey')} END AS backup_key
      FROM (
        SELECT event_key, l_suppkey, l_partkey % 8 AS a FROM lines
        WHERE (kind <> 'F' AND progress >= 3) OR (kind = 'F' AND progress >= 0)
        GROUP BY event_key, l_suppkey, l_partkey % 8
      ) r""",
    "awards": f"""
      SELECT event_key, CAST(n AS INTEGER) AS award_type,
        CASE WHEN n = 0 THEN 'frc' || CAST({IMPACT_NUMBER} AS STRING)
             ELSE {_team(f'l_suppkey + n * 5 + {_SHIFT}')} END AS team_key
      FROM (
        SELECT event_key, l_suppkey, code, kind, progress, l_partkey % 13 AS n FROM lines
        WHERE (kind <> 'F' AND progress >= 11) OR (kind = 'F' AND progress = 3)
        GROUP BY event_key, l_suppkey, code, kind, progress, l_partkey % 13
      ) r
      WHERE CASE kind WHEN 'F' THEN n IN (0, 9, 10)
              WHEN 'C' THEN (progress = 12 OR n >= 8) AND NOT (n = 10 AND l_suppkey % 4 = 1)
              ELSE progress = 12 OR n >= 4 END""",
    "event_points": f"""
      SELECT event_key, team_key, qual_points + selection_points + elim_points + award_points
          AS points,
        qual_points, selection_points, elim_points, award_points
      FROM (
        SELECT event_key, 'frc' || CAST(number AS STRING) AS team_key,
          CAST(CASE WHEN kind <> 'F' AND progress >= 2
            THEN (4 + SUM(CASE WHEN l_linenumber <= 2 THEN qty ELSE 0 END) % 19) * times
            ELSE 0 END AS INTEGER) AS qual_points,
          CAST(CASE WHEN kind <> 'F' AND progress >= 3
            THEN (SUM(CASE WHEN l_linenumber IN (3, 4) THEN qty ELSE 0 END) % 17) * times
            ELSE 0 END AS INTEGER) AS selection_points,
          CAST(CASE WHEN kind = 'F' OR progress >= 4
            THEN (SUM(CASE WHEN l_linenumber IN (5, 6) THEN qty ELSE 0 END) % 31) * times
            ELSE 0 END AS INTEGER) AS elim_points,
          CAST(CASE
            WHEN kind = 'F' OR progress < 11 THEN 0
            WHEN progress = 12 AND number = {IMPACT_NUMBER} THEN 10
            WHEN kind = 'V' AND progress = 12
              THEN CASE WHEN SUM(CASE WHEN l_linenumber = 7 THEN qty ELSE 0 END) > 0 THEN 8 ELSE 0 END
            WHEN SUM(CASE WHEN l_linenumber = 7 THEN qty ELSE 0 END) BETWEEN 1 AND 9 THEN 5
            WHEN SUM(CASE WHEN l_linenumber = 7 THEN qty ELSE 0 END) BETWEEN 10 AND 14 THEN 8
            ELSE 0 END * times AS INTEGER) AS award_points
        FROM lines
        WHERE (kind <> 'F' AND progress >= 1) OR (kind = 'F' AND progress >= 1)
        GROUP BY event_key, number, l_suppkey, code, kind, progress, times
      ) r""",
    "district_rankings": f"""
      SELECT district_key, 'frc' || CAST(number AS STRING) AS team_key,
        CAST((number * 7) % {TEAMS + 1} AS INTEGER) AS rank,
        CAST(SUM(qty) AS INTEGER) AS points,
        CASE number % 10 WHEN 0 THEN 10 WHEN 5 THEN 5 ELSE 0 END AS rookie_bonus
      FROM lines GROUP BY district_key, number""",
    "district_lookup": """
      SELECT '2020s' || CAST(s_suppkey AS STRING) AS district_key, r_name AS display_name,
        CASE WHEN s_suppkey % 2 = 0 THEN 'State Championship' ELSE 'District Championship' END
          AS dcmp_name,
        CAST(CASE WHEN s_suppkey % 25 = 7 THEN 60 ELSE 16 + s_suppkey % 20 END AS INTEGER)
          AS dcmp_capacity,
        CAST(14 + s_suppkey % 10 AS INTEGER) AS wcmp_capacity,
        CAST(1 + s_suppkey % 2 AS INTEGER) AS dcmp_impact_awards,
        1 AS dcmp_ei_awards, 1 AS dcmp_ras_awards,
        s_suppkey % 3 = 0 AS dcmp_directional_labels
      FROM supplier JOIN nation ON s_nationkey = n_nationkey
        JOIN region ON n_regionkey = r_regionkey""",
    "points_adjustments": f"""
      SELECT '2020s' || CAST(s_suppkey AS STRING) AS district_key,
        {_team('s_suppkey * 11')} AS team_key,
        CAST(s_suppkey % 9 - 3 AS INTEGER) AS points_adjustment
      FROM supplier""",
    "prequalified_teams": f"""
      SELECT district_key, team_key FROM (
        SELECT district_key, CASE WHEN l_suppkey % 4 = 2 THEN {_team('l_partkey % 8 + l_suppkey')}
          ELSE {_team('l_suppkey * 5 + 9')} END AS team_key
        FROM lines
      ) r GROUP BY district_key, team_key""",
    "region_lookup": """
      SELECT 'frc' || CAST(number AS STRING) AS team_key,
        CASE WHEN number <= 30 THEN 'north' ELSE 'south' END AS region
      FROM lines GROUP BY number""",
    "short_brackets": """
      SELECT event_key FROM lines
      WHERE l_suppkey % 6 = 1 AND code = 'a' GROUP BY event_key""",
    "championship_rules": """
      SELECT '2020s' || CAST(s_suppkey AS STRING) AS district_key, 2 AS picks_sent,
        FALSE AS sends_ras, 2 AS assumed_winners
      FROM supplier WHERE s_suppkey % 11 = 5""",
}


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def narrow_lines(lineitem: DataFrame) -> DataFrame:
    """The columns that the mapping reads, no wider than it reads them.

    Part and order keys occur only in remainders, which their remainder by a common multiple keeps; quantity and
    date are cast by the mapping anyway. A line then takes fewer bytes where it is moved and kept.
    """
    return lineitem.select(
        "l_suppkey",
        (F.col("l_orderkey") % _ORDER_REMAINDERS).alias("l_orderkey"),
        (F.col("l_partkey") % _PART_REMAINDERS).alias("l_partkey"),
        "l_linenumber",
        F.col("l_quantity").cast("int").alias("l_quantity"),
        F.col("l_shipdate").cast("date").alias("l_shipdate"),
    )


def event_of_line(mode: str) -> Column:
    """The key of a line's event, from the columns of lineitem."""
    code = _CODES[TABLES_OF[mode]].replace("number", f"(l_partkey % {TEAMS} + 1)")
    code = re.sub(r"\byr\b", "year(l_shipdate)", code)
    return F.expr(f"'2020s' || CAST(l_suppkey AS STRING) || {code}")


def dealt_lines(lineitem: DataFrame, by: str | Column = "l_suppkey", parts: int | None = None) -> DataFrame:
    """The lines, dealt once, by supplier or by what follows from a line."""
    lines = lineitem.select(*_LINE_COLUMNS)
    return lines.repartition(by) if parts is None else lines.repartition(parts, by)


def season_inputs(
    spark: SparkSession, sf_dir: str, mode: str, stages: Stages
) -> SeasonInputs:
    """The competition tables of a format, staged: a real run reads them from storage.

    The mapped lines are staged first, in buckets by event, so that tables of events are made
    and kept in the same buckets without moving a row; the tables made from them do not
    depend on each other, so their jobs are submitted together.
    """
    base = {t: read(spark, sf_dir, t) for t in ("lineitem", "supplier", "nation", "region")}
    dealt = dealt_lines(narrow_lines(base["lineitem"]), event_of_line(mode), stages.deals())
    lines = stages.keep_dealt(
        spark.sql(lines_sql(mode).replace("FROM lineitem", "FROM {lineitem}"), **{**base, "lineitem": dealt}),
        "event_key",
        ["ship"],
    )

    def table(name: str) -> DataFrame:
        text = TABLES[name].replace("lines.*", "src.*").replace("FROM lines", "FROM {lines} src")
        for t in ("supplier", "nation", "region"):
            text = re.sub(rf"(FROM|JOIN) {t}\b", rf"\1 {{{t}}}", text)
        df = spark.sql(text, lines=lines, **base)
        if "event_key" not in df.columns:
            return stages.keep(df)
        return stages.keep_dealt(stages.deal(df, "event_key"), "event_key")

    with ThreadPoolExecutor(len(TABLES)) as pool:
        tables = dict(zip(TABLES, pool.map(table, TABLES)))
    return SeasonInputs(qual_points=lookups.qual_points_table(spark), dealt=stages.folder is not None, **tables)


def oracle_ctes(mode: str) -> list[tuple[str, str]]:
    """The same tables as common table expressions."""
    values = ", ".join(str(row) for row in lookups.fv.qual_points_rows())
    return [
        ("lines", lines_sql(mode)),
        *TABLES.items(),
        (
            "qual_points_lookup",
            f"SELECT * FROM (VALUES {values}) v(event_size, team_rank, qual_points)",
        ),
    ]
