"""Registered queries of the ingest: API-shaped rows made from the test tables, flattened."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from checks.domain import open_run
from checks.domain_oracle import oracle
from clinchline import schemas
from clinchline.functions.columns import column_from
from clinchline.plans.publish import publish_season, published_tables
from clinchline.plans.stages import new_folder
from clinchline.sources import landed, lookups, tables

C = F.col
_ENTRIES: dict[str, tuple[Callable, str]] = {}


def _entry(name: str, sql: str):
    def register(query):
        _ENTRIES[name] = (query, sql)
        return query

    return register


def _as_landed(rows: DataFrame, payload: list, key: str, table: str) -> DataFrame:
    """Turn rows into JSON text and parse it as a landed response would be."""
    text = rows.select(key, F.to_json(F.struct(*payload)).alias("body"))
    schema = landed.landed_schema(table).rsplit(",", 1)[0]
    return text.select(key, F.from_json("body", schema).alias("landed_row")).select(key, "landed_row.*")


@_entry(
    "s1_events",
    """SELECT district_key, event_key, name, event_type, start_date, end_date FROM events
       WHERE event_key NOT IN ('2020s1a', '2020s2b')""",
)
def _s1(run):
    rows = run.inputs.events
    payload = [
        C("event_key").alias("key"),
        C("name").alias("short_name"),
        C("event_type").alias("event_type_string"),
        C("start_date").cast("string").alias("start_date"),
        C("end_date").cast("string").alias("end_date"),
    ]
    raw = _as_landed(rows, payload, "district_key", "events")
    return landed.flatten_events(raw, ["2020s1a", "2020s2b"])


@_entry("s2_event_teams", "SELECT event_key, team_key FROM event_teams")
def _s2(run):
    raw = _as_landed(run.inputs.event_teams, [C("team_key").alias("key")], "event_key", "event_teams")
    return landed.flatten_event_teams(raw)


@_entry(
    "s3_matches",
    """SELECT * REPLACE (CASE WHEN red_score = -1 THEN NULL ELSE red_3_key END AS red_3_key)
       FROM matches""",
)
def _s3(run):
    def side(color):
        robots = [C(f"{color}_{i}_key") for i in (1, 2, 3)]
        keys = F.array(*robots)
        if color == "red":  # unplayed matches list one robot less, as a short array
            keys = F.when(C("red_score") == -1, F.array(*robots[:2])).otherwise(keys)
        return F.struct(C(f"{color}_score").alias("score"), keys.alias("team_keys"))

    payload = [
        C("match_key").alias("key"),
        "comp_level",
        "match_number",
        "winning_alliance",
        F.struct(side("red").alias("red"), side("blue").alias("blue")).alias("alliances"),
    ]
    return landed.flatten_matches(_as_landed(run.inputs.matches, payload, "event_key", "matches"))


@_entry("s4_alliances", "SELECT * FROM alliances")
def _s4(run):
    three = [C("captain_key"), C("first_selection_key"), C("second_selection_key")]
    picks = F.when(C("backup_key").isNull(), F.array(*three)).otherwise(
        F.array(*three, C("backup_key"))
    )
    payload = [C("alliance_name").alias("name"), picks.alias("picks")]
    raw = _as_landed(run.inputs.alliances, payload, "event_key", "alliances")
    return landed.flatten_alliances(raw)


@_entry("s5_awards", "SELECT event_key, award_type, team_key FROM awards WHERE award_type <> 7")
def _s5(run):
    # type 7 is landed without recipients
    recipients = F.when(C("award_type") == 7, F.array()).otherwise(
        F.array(F.struct("team_key"))
    )
    payload = ["event_key", "award_type", recipients.alias("recipient_list")]
    rows = run.inputs.awards.withColumn("landed_event_key", C("event_key"))
    return landed.flatten_awards(_as_landed(rows, payload, "landed_event_key", "awards"))


@_entry("s6_event_points", "SELECT * FROM event_points")
def _s6(run):
    points = F.struct(
        C("points").alias("total"),
        "qual_points",
        C("selection_points").alias("alliance_points"),
        "elim_points",
        "award_points",
    )
    payload = [F.create_map(C("team_key"), points).alias("points")]
    raw = _as_landed(run.inputs.event_points, payload, "event_key", "event_points")
    return landed.flatten_event_points(raw)


def _rankings(run) -> DataFrame:
    payload = ["team_key", "rank", C("points").alias("point_total"), "rookie_bonus"]
    raw = _as_landed(run.inputs.district_rankings, payload, "district_key", "district_rankings")
    return landed.flatten_rankings(raw)


def _pages(run) -> DataFrame:
    row = F.struct(
        column_from("team_key", 4).cast("int").alias("teamNumber"),
        "rank",
        C("points").alias("totalPoints"),
        F.nullif("rookie_bonus", F.lit(0)).alias("teamAgePoints"),
    )
    payload = [F.array(row).alias("districtRanks"), F.lit(1).alias("pageTotal")]
    raw = _as_landed(run.inputs.district_rankings, payload, "district_key", "ranking_pages")
    return landed.flatten_ranking_pages(raw)


@_entry("s7_district_rankings", "SELECT * FROM district_rankings")
def _s7(run):
    return _rankings(run)


@_entry("s8_ranking_pages", "SELECT * FROM district_rankings")
def _s8(run):
    return _pages(run)


@_entry(
    "s9_first_source",
    """SELECT district_key, team_key, rank,
         CASE WHEN CAST(SUBSTRING(district_key, 6) AS INTEGER) % 3 = 0 THEN points ELSE points + 1 END
           AS points, rookie_bonus FROM district_rankings""",
)
def _s9(run):
    has_pages = column_from("district_key", 6).cast("int") % 3 == 0
    later = _rankings(run).withColumn("points", C("points") + 1)
    return landed.first_source([_pages(run).where(has_pages), later])


@_entry(
    "s10_started_events",
    """SELECT m.event_key, COUNT(*) AS n FROM matches m JOIN events e ON e.event_key = m.event_key
       WHERE e.start_date <= DATE '1997-06-30' GROUP BY 1""",
)
def _s10(run):
    day = F.lit("1997-06-30").cast("date")
    begun = landed.started_only(run.inputs.matches, run.inputs.events, day)
    return begun.groupBy("event_key").agg(F.count(F.lit(1)).alias("n"))


@_entry("s13_district_lookup", "SELECT * FROM district_lookup")
def _s13(run):
    text = run.inputs.district_lookup.withColumn(
        "dcmp_directional_labels",
        F.when(C("dcmp_directional_labels"), "1").otherwise(F.lit(None).cast("string")),
    )
    return lookups.typed_district_lookup(_from_csv_lines(text, schemas.DISTRICT_LOOKUP_CSV))


def _from_csv_lines(rows: DataFrame, schema: str) -> DataFrame:
    """Turn rows into CSV lines and parse them as the lookup files are parsed."""
    fields = [f.split()[0] for f in schema.split(", ")]
    lines = rows.select(F.to_csv(F.struct(*[C(f).cast("string").alias(f) for f in fields])).alias("line"))
    return lines.select(F.from_csv("line", schema, {"mode": "FAILFAST"}).alias("landed_row")).select("landed_row.*")


@_entry(
    "s12_qual_points",
    """SELECT q.event_size, q.team_rank, q.qual_points FROM qual_points_lookup q JOIN (
         SELECT event_key, COUNT(*) AS teams FROM event_teams GROUP BY 1) e ON e.teams = q.event_size""",
)
def _s12(run):
    sizes = run.inputs.event_teams.groupBy("event_key").agg(F.count(F.lit(1)).cast("int").alias("event_size"))
    return _from_csv_lines(run.inputs.qual_points, schemas.QUAL_POINTS).join(sizes, "event_size").drop("event_key")


@_entry("s14_points_adjustments", "SELECT * FROM points_adjustments")
def _s14(run):
    return _from_csv_lines(run.inputs.points_adjustments, schemas.POINTS_ADJUSTMENTS)


@_entry("s15_prequalified_teams", "SELECT * FROM prequalified_teams")
def _s15(run):
    return _from_csv_lines(run.inputs.prequalified_teams, schemas.PREQUALIFIED_TEAMS)


@_entry("s16_region_lookup", "SELECT * FROM region_lookup")
def _s16(run):
    return _from_csv_lines(run.inputs.region_lookup, schemas.REGION_LOOKUP)


#: name, tables of ``SeasonInputs`` and of the check SQL, layout of the file
_LOOKUPS = [
    ("qual_points", "qual_points_lookup", schemas.QUAL_POINTS),
    ("district_lookup", "district_lookup", schemas.DISTRICT_LOOKUP_CSV),
    ("points_adjustments", "points_adjustments", schemas.POINTS_ADJUSTMENTS),
    ("prequalified_teams", "prequalified_teams", schemas.PREQUALIFIED_TEAMS),
    ("region_lookup", "region_lookup", schemas.REGION_LOOKUP),
]


@_entry(
    "s17_lookups",
    " UNION ALL ".join(
        f"SELECT '{name}' AS lookup, COUNT(*) AS n, COUNT(DISTINCT {schema.split()[0]}) AS first_keys FROM {table}"
        for name, table, schema in _LOOKUPS
    ),
)
def _s17(run):
    counts = [
        _from_csv_lines(getattr(run.inputs, name), schema).agg(
            F.lit(name).alias("lookup"),
            F.count(F.lit(1)).alias("n"),
            F.count_distinct(schema.split()[0]).alias("first_keys"),
        )
        for name, _, schema in _LOOKUPS
    ]
    return reduce(DataFrame.unionByName, counts)


@_entry(
    "s11_replace_districts",
    """SELECT e.district_key, p.event_key, p.team_key, p.points
       FROM event_points p JOIN events e ON e.event_key = p.event_key""",
)
def _s11(run):
    # two runs into one folder, the second repeated: each replaces only the districts it holds
    spark, folder = run.spark, new_folder(run.spark)
    owners = run.inputs.events.select("district_key", "event_key").distinct()
    odd = column_from("district_key", 6).cast("int") % 2 == 1
    points = run.inputs.event_points.select("event_key", "team_key", "points").join(owners, "event_key")
    for part in (points.where(odd), points.where(~odd), points.where(~odd)):
        tables.write_tables({"event_points": part}, folder, run.fmt)
    return spark.read.parquet(f"{folder}/event_points")


@_entry(
    "s18_published_runs",
    "SELECT district_key, team_key, rank, teams_to_pass, total_teams_that_can_pass, lock_status FROM lock_status",
)
def _s18(run):
    # a run without the last points of every second district, then one that sees all: it recomputes those
    folder, inputs = new_folder(run.spark), run.inputs
    late = inputs.events.where(column_from("district_key", 6).cast("int") % 2 == 1).select("event_key")
    early = inputs.replace(event_points=inputs.event_points.join(late, "event_key", "left_anti"))
    for known in (early, inputs):
        publish_season(run.spark, known, run.fmt, folder)
    columns = ["district_key", "team_key", "rank", "teams_to_pass", "total_teams_that_can_pass", "lock_status"]
    return published_tables(run.spark, folder, run.fmt).read("lock_status").select(*columns)


@_entry(
    "s19_report_sink",
    """SELECT district_key, team_key, rank, points FROM district_rankings""",
)
def _s19(run):
    folder = new_folder(run.spark)
    report = run.inputs.district_rankings.select("district_key", "team_key", "rank", "points")
    tables.write_reports({"rankings": report}, folder, run.fmt)
    return run.spark.read.parquet(f"{folder}/rankings")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(query):
        return lambda spark, sf_dir: query(open_run(spark, sf_dir, "district"))

    return {name: bind(query) for name, (query, _) in _ENTRIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: oracle("district", sql) for name, (_, sql) in _ENTRIES.items()}
