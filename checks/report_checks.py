"""Registered queries of the quality rules and the report tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from checks.domain import ALL, CHAMPIONSHIP, SEASON, open_run
from checks.domain_oracle import oracle
from clinchline.functions.columns import column_from
from clinchline.operators import quality, reports

_ENTRIES: dict[str, tuple[str, Callable, str]] = {}


def _entry(name: str, mode: str, query: Callable, sql: str) -> None:
    _ENTRIES[f"{name}_{mode}"] = (mode, query, sql)


FLOORS = """(VALUES ('Elims 8', 39), ('Elims 9', 78), ('Elims 10', 99), ('Elims 11', 120),
  ('Elims 12', 141), ('Elims 13', 159), ('Finals', 180), ('Awards', 210))"""


def _event_checks_sql(mode: str) -> str:
    times = 1 if mode in SEASON else 3
    regional = mode == "district_regions"
    floor = "CAST(NULL AS INTEGER)" if regional else f"f.n * {times}"
    later = (
        "CASE WHEN qual_sum = 0 OR selection_sum = 0 THEN FALSE ELSE TRUE END"
        if regional
        else f"""CASE WHEN f.n IS NULL THEN TRUE WHEN elim_sum IS NULL THEN FALSE
             ELSE elim_sum >= f.n * {times} AND qual_sum <> 0 AND selection_sum <> 0 END"""
    )
    later_rule = "'points'" if regional else "CASE WHEN f.n IS NULL THEN 'none' ELSE 'floor' END"
    return f"""SELECT *, CASE WHEN is_valid THEN NULL WHEN elim_sum IS NULL THEN 'no points'
          ELSE 'points do not fit ' || event_state END AS reason
        FROM (SELECT s.district_key, s.event_key, s.event_state, qual_sum, selection_sum, elim_sum,
            {floor} AS elim_floor,
            CASE WHEN s.ord IN (0, 1) THEN 'none' WHEN s.ord = 2 THEN 'quals only'
              WHEN s.ord = 3 THEN 'no playoff points' ELSE {later_rule} END AS rule,
            CASE WHEN s.ord IN (0, 1) THEN TRUE
              WHEN s.ord = 2 THEN COALESCE(qual_sum <> 0 AND elim_sum = 0, FALSE)
              WHEN s.ord = 3 THEN COALESCE(qual_sum <> 0 AND selection_sum <> 0 AND elim_sum = 0, FALSE)
              ELSE {later} END AS is_valid
          FROM st s LEFT JOIN (SELECT event_key, CAST(SUM(qual_points) AS BIGINT) AS qual_sum,
              CAST(SUM(selection_points) AS BIGINT) AS selection_sum,
              CAST(SUM(elim_points) AS BIGINT) AS elim_sum
            FROM event_points GROUP BY 1) p ON p.event_key = s.event_key
          LEFT JOIN {FLOORS} f(phase, n) ON f.phase = s.event_state)"""


def _expected(run) -> DataFrame:
    """Expected sizes of the test districts: some known, some with slack, some not."""
    number = column_from("district_key", 6).cast("int")
    return run.inputs.district_lookup.where(number % 5 != 0).select(
        "district_key",
        (F.lit(60) + (number % 3).cast("int")).alias("expected"),
        (number % 2).cast("int").alias("may_miss"),
    )


_EXPECTED_SQL = """(SELECT district_key, 60 + n % 3 AS expected, n % 2 AS may_miss FROM (
    SELECT district_key, CAST(SUBSTRING(district_key, 6) AS INTEGER) AS n FROM district_lookup)
  WHERE n % 5 <> 0)"""


def _team_counts_sql(mode: str) -> str:
    fits = "TRUE" if mode in CHAMPIONSHIP else "x.teams BETWEEN e.expected - e.may_miss AND e.expected"
    return f"""SELECT x.district_key, x.teams, e.expected, e.may_miss,
          COALESCE({fits}, TRUE) AS is_valid
        FROM (SELECT district_key, COUNT(*) AS teams FROM district_rankings GROUP BY 1) x
        LEFT JOIN {_EXPECTED_SQL} e USING (district_key)"""


def _team_counts(run) -> DataFrame:
    return quality.team_count_checks(run.inputs, run.fmt, _expected(run))


for _mode in ALL:
    _entry("q1_q6_event_checks", _mode, lambda run: run.event_checks, _event_checks_sql(_mode))
    _entry(
        "q8_gate",
        _mode,
        lambda run: quality.gate(run.event_checks, _team_counts(run), run.fmt),
        f"""SELECT t.district_key, COALESCE(v.failed, 0) AS failed_events, t.is_valid AS teams_valid,
              t.is_valid AND COALESCE(v.failed, 0) = 0 AS publish
            FROM ({_team_counts_sql(_mode)}) t LEFT JOIN (SELECT district_key,
                COUNT(*) FILTER (NOT is_valid) AS failed
              FROM ({_event_checks_sql(_mode)}) GROUP BY 1) v USING (district_key)""",
    )
_entry("q7_team_counts", "district", _team_counts, _team_counts_sql("district"))
_entry("q7_team_counts", "dcmp", _team_counts, _team_counts_sql("dcmp"))

_OPEN = "lock_status NOT IN ('-', '0%', 'Impact', 'EI', 'RAS', 'Prequalified', 'Winner')"


def _season(mode: str) -> None:
    region = ", region" if mode == "district_regions" else ""
    ranks, events, stats, page = ("r1", "r2", "r3", "r8")
    if region:
        ranks = events = stats = "r4"
        page = "r8"
    _entry(
        f"{ranks}_rankings",
        mode,
        lambda run: reports.rankings(run.ready("lock_status"), run.fmt),
        f"""SELECT district_key{region}, rank, SUBSTRING(team_key, 4) AS team_number, team_key,
              event1_points, event2_points, rookie_bonus, total_points, lock_status, color,
              {_OPEN} AS has_team_page FROM lock_status""",
    )
    join = "AND b.region = r.region" if region else ""
    _entry(
        f"{events}_events",
        mode,
        lambda run: reports.season_events(run.event_states, run.event_points_remaining, run.fmt),
        f"""SELECT s.district_key{region.replace(' ', ' b.')}, s.event_key AS key, s.name,
              s.event_state AS status, b.team_count, b.points_remaining, s.color, s.start_date
            FROM event_states s JOIN event_points_remaining b ON b.event_key = s.event_key""",
    )
    _entry(
        f"{stats}_district_stats",
        mode,
        lambda run: reports.district_stats(run.inputs, run.district_points_remaining, run.fmt),
        f"""SELECT district_key{region}, points_remaining, events_remaining, dcmp_capacity, display_name
            FROM district_points_remaining JOIN district_lookup USING (district_key)""",
    )
    _entry(
        f"{page}_event_page",
        mode,
        lambda run: reports.event_page(run.event_states, run.event_points_remaining, run.fmt),
        f"""SELECT event_key{region}, name, event_state AS status, color,
              quals_adjusted_points_remaining, alliance_selection_points_remaining,
              elimination_points_remaining, award_points_remaining, points_remaining
            FROM event_states JOIN event_points_remaining USING (event_key)""",
    )
    _entry(
        "r10_team_header",
        mode,
        lambda run: reports.team_header(run.ready("lock_status"), run.fmt),
        f"""SELECT district_key{region}, team_key, total_inflated_points, teams_to_pass,
              total_teams_that_can_pass, total_points_to_pass, total_points_remaining, lock_status,
              COALESCE(total_teams_that_can_pass < teams_to_pass, FALSE) AS shows_passers
            FROM lock_status""",
    )
    _entry(
        "r11_followers",
        mode,
        lambda run: reports.team_followers(run.ready("following_teams"), run.fmt),
        f"""SELECT district_key{region}, team_key, following_team_key,
              SUBSTRING(following_team_key, 4) AS following_team_number, following_team_rank,
              following_team_inflated_points AS inflated_points_total,
              following_team_max_possible_points AS max_points,
              following_team_points_needed_to_pass_status AS points_to_pass,
              following_team_color AS color FROM following_teams""",
    )


def _championship(mode: str) -> None:
    _entry(
        "r5_rankings",
        mode,
        lambda run: reports.rankings(run.ready("lock_status_v2"), run.fmt),
        f"""SELECT district_key, rank, SUBSTRING(team_key, 4) AS team_number, team_key,
              COALESCE(district_event_points, 0) AS district_event_points, rookie_bonus,
              COALESCE(dcmp_points, 0) AS dcmp_points, total_points, lock_status, color,
              {_OPEN} AS has_team_page FROM lock_status_v2""",
    )
    if mode == "dcmp_divisions":
        _entry(
            "r12_division_events",
            mode,
            lambda run: reports.division_events(
                run.inputs,
                run.event_states,
                run.dcmp_finals_state,
                run.event_points_remaining,
                run.fmt,
            ),
            """SELECT s.district_key, 0 AS event_type,
                 SPLIT_PART(SPLIT_PART(s.name, '- ', 2), ' ', 1) || ' Division' AS name,
                 s.event_key AS key, s.event_state AS status, b.team_count, b.points_remaining, s.color
               FROM event_states s JOIN event_points_remaining b ON b.event_key = s.event_key
               UNION ALL
               SELECT s.district_key, 1, l.dcmp_name || ' Finals', s.event_key, s.event_state,
                 b.team_count, b.points_remaining, s.color
               FROM dcmp_finals_state s JOIN event_points_remaining b ON b.event_key = s.event_key
               JOIN district_lookup l ON l.district_key = s.district_key""",
        )
    else:
        _entry(
            "r6_events",
            mode,
            lambda run: reports.championship_events(
                run.inputs, run.event_states, run.event_points_remaining, run.fmt
            ),
            """SELECT s.district_key, s.event_key AS key, CASE
                 WHEN l.dcmp_directional_labels AND s.name ILIKE '%north%' THEN 'Northern '
                 WHEN l.dcmp_directional_labels AND s.name ILIKE '%south%' THEN 'Southern '
                 ELSE '' END || l.dcmp_name AS name, s.event_state AS status, b.team_count,
                 b.points_remaining, s.color, s.start_date
               FROM event_states s JOIN event_points_remaining b ON b.event_key = s.event_key
               JOIN district_lookup l ON l.district_key = s.district_key""",
        )
    _entry(
        "r7_district_stats",
        mode,
        lambda run: reports.district_stats(run.inputs, run.district_points_remaining, run.fmt),
        """SELECT district_key, points_remaining, wcmp_capacity, display_name
           FROM district_points_remaining JOIN district_lookup USING (district_key)""",
    )
    _entry(
        "r9_event_page",
        mode,
        lambda run: reports.event_page(run.event_states, run.event_points_remaining, run.fmt),
        """SELECT event_key, name, event_state AS status, color, quals_points_remaining,
             alliance_selection_points_remaining, elimination_points_remaining,
             award_points_remaining, points_remaining FROM event_points_remaining""",
    )
    _entry(
        "r10_team_header",
        mode,
        lambda run: reports.team_header(run.ready("lock_status_v2"), run.fmt),
        """SELECT district_key, team_key, total_points, teams_to_pass, total_teams_that_can_pass,
             total_points_to_pass, total_points_remaining, lock_status,
             COALESCE(total_teams_that_can_pass < teams_to_pass, FALSE) AS shows_passers
           FROM lock_status_v2""",
    )
    _entry(
        "r11_followers",
        mode,
        lambda run: reports.team_followers(run.ready("following_teams_v2"), run.fmt),
        """SELECT district_key, team_key, following_team_key,
             SUBSTRING(following_team_key, 4) AS following_team_number, following_team_rank,
             following_team_points AS points_total,
             following_team_max_possible_points AS max_points,
             COALESCE(CAST(following_team_points_needed_to_pass AS VARCHAR), '-') AS points_to_pass,
             following_team_color AS color FROM following_teams_v2""",
    )


for _mode in SEASON:
    _season(_mode)
for _mode in CHAMPIONSHIP:
    _championship(_mode)


def _pages_sql(mode: str) -> str:
    status = "lock_status" if mode in SEASON else "lock_status_v2"
    if mode == "district_regions":
        districts = """SELECT DISTINCT k.district_key, 'district' AS kind, k.district_key AS key,
            'districts/' || SUBSTRING(k.district_key, 5) || '_' || g.region AS path
          FROM district_rankings k JOIN region_lookup g USING (team_key)"""
        events = """SELECT district_key, 'event', event_key, 'events/' || event_key || '_' || region
          FROM event_regions"""
    else:
        districts = """SELECT DISTINCT district_key, 'district' AS kind, district_key AS key,
            'districts/' || SUBSTRING(district_key, 5) AS path FROM district_rankings"""
        kinds = {
            "district": "= 'District'",
            "dcmp_divisions": "LIKE 'District Championship%'",
        }.get(mode, "= 'District Championship'")
        events = f"""SELECT district_key, 'event', event_key, 'events/' || event_key
          FROM events WHERE event_type {kinds}"""
    return f"""{districts} UNION ALL {events} UNION ALL
        SELECT district_key, 'team', team_key, 'teams/' || team_key FROM {status} WHERE {_OPEN}"""


for _mode in ALL:
    _status = "lock_status" if _mode in SEASON else "lock_status_v2"
    _columns = "district_key, region, team_key" if _mode == "district_regions" else "district_key, team_key"
    _entry(
        "r13_team_pages",
        _mode,
        lambda run: reports.team_pages(
            reports.team_header(run.ready_status(), run.fmt), run.fmt
        ).select(*run.fmt.team, "lock_status"),
        f"SELECT {_columns}, lock_status FROM {_status} WHERE {_OPEN}",
    )
    _entry(
        "r14_page_index",
        _mode,
        lambda run: reports.page_index(
            run.inputs,
            run.fmt,
            reports.team_header(run.ready_status(), run.fmt),
            run.event_regions,
        ),
        _pages_sql(_mode),
    )


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(mode, query):
        return lambda spark, sf_dir: query(open_run(spark, sf_dir, mode))

    return {name: bind(mode, query) for name, (mode, query, _) in _ENTRIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: oracle(mode, sql) for name, (mode, _, sql) in _ENTRIES.items()}
