"""The domain operators once more, as plain SQL for the checking engine.

Written for checking only: direct and unoptimised (all pairs, correlated counts). Each
format is a list of named queries over the adaptor's tables; a check selects from one of
them.
"""

from __future__ import annotations

import re

from checks.adaptor import oracle_ctes

PHASE_ORD = """(VALUES ('Pre-Event', 0), ('Qualifications', 1), ('Selections', 2),
  ('Elims 1 to 7', 3), ('Elims 8', 4), ('Elims 9', 5), ('Elims 10', 6), ('Elims 11', 7),
  ('Elims 12', 8), ('Elims 13', 9), ('Finals', 10), ('Awards', 11), ('Completed', 12),
  ('ERROR', -1))"""

# phase number -> elimination points to come
LADDER = """(VALUES (0, 213), (1, 213), (2, 213), (3, 213), (4, 174), (5, 135), (6, 114),
  (7, 93), (8, 72), (9, 53), (10, 31))"""


def _roster() -> tuple[str, str]:
    return (
        "roster",
        """SELECT event_key, alliance_name, UNNEST([captain_key, first_selection_key,
             second_selection_key, backup_key]) AS team_key, UNNEST([1, 2, 3, 4]) AS seat
           FROM alliances""",
    )


def _match_facts() -> tuple[str, str]:
    return (
        "mf",
        """SELECT event_key,
             COUNT(DISTINCT match_key) FILTER (comp_level = 'qm') AS quals,
             COUNT(*) FILTER (comp_level = 'qm' AND (red_score <> -1 OR blue_score <> -1)) AS played,
             COUNT(*) AS listed,
             COUNT(winning_alliance) FILTER (comp_level = 'sf') AS semis,
             COUNT(winning_alliance) FILTER (comp_level = 'f') AS finals,
             COUNT(*) FILTER (comp_level = 'f' AND winning_alliance = 'red') AS red,
             COUNT(*) FILTER (comp_level = 'f' AND winning_alliance = 'blue') AS blue
           FROM matches GROUP BY event_key""",
    )


def _states(mode: str) -> list[tuple[str, str]]:
    kind = {
        "dcmp": "District Championship",
        "dcmp_regions": "District Championship",
        "dcmp_divisions": "District Championship Division",
    }.get(mode, "District")
    short = "e.event_key IN (SELECT event_key FROM short_brackets)" if mode == "district" else "FALSE"
    copies = "1"
    extra = ""
    if mode == "district_regions":
        copies = "(SELECT COUNT(*) FROM event_regions r WHERE r.event_key = e.event_key)"
        extra = "AND EXISTS (SELECT 1 FROM event_regions r WHERE r.event_key = e.event_key)"
    full = 30 if mode in ("dcmp", "dcmp_regions") else 10
    if mode == "dcmp_divisions":
        closing = """CASE WHEN n_types <= 10 AND given < 180 THEN 'Awards'
                          WHEN n_types > 10 AND given >= 165 THEN 'Completed' ELSE 'ERROR' END"""
    else:
        closing = f"""CASE WHEN n_types <= 10 OR best < {full} THEN 'Awards'
                           WHEN best = {full} THEN 'Completed' ELSE 'ERROR' END"""
    return [
        _match_facts(),
        (
            "state_facts",
            f"""SELECT e.*, COALESCE(m.quals, 0) AS quals, m.played,
                  COALESCE(m.semis, 0) * {copies} AS semis, COALESCE(m.red, 0) * {copies} AS red,
                  COALESCE(m.blue, 0) * {copies} AS blue, {short} AS short,
                  (SELECT COUNT(DISTINCT alliance_name) FROM alliances a
                    WHERE a.event_key = e.event_key) AS n_alliances,
                  (SELECT COUNT(DISTINCT award_type) FROM awards w
                    WHERE w.event_key = e.event_key) AS n_types,
                  (SELECT MAX(award_points) FROM event_points p
                    WHERE p.event_key = e.event_key) AS best,
                  (SELECT SUM(award_points) FROM event_points p
                    WHERE p.event_key = e.event_key) AS given
                FROM events e LEFT JOIN mf m ON m.event_key = e.event_key
                WHERE e.event_type = '{kind}' {extra}""",
        ),
        (
            "event_states",
            f"""SELECT event_key, district_key, name, event_type, start_date, end_date, event_state,
                  CASE event_state WHEN 'Completed' THEN '93C47D' WHEN 'Pre-Event' THEN 'FFD966'
                    ELSE 'B6D7A8' END AS color
                FROM (SELECT *, CASE
                    WHEN quals = 0 THEN 'Pre-Event'
                    WHEN played < quals THEN 'Qualifications'
                    WHEN n_alliances = 0 THEN 'Selections'
                    WHEN semis < 7 THEN 'Elims 1 to 7'
                    WHEN semis <= 12 AND NOT short THEN 'Elims ' || CAST(semis + 1 AS VARCHAR)
                    WHEN GREATEST(red, blue) < 2 THEN 'Finals'
                    ELSE {closing} END AS event_state
                  FROM state_facts)""",
        ),
        (
            "st",
            f"""SELECT s.*, o.n AS ord FROM event_states s
                JOIN {PHASE_ORD} o(phase, n) ON o.phase = s.event_state""",
        ),
    ]


def _team_states(mode: str) -> list[tuple[str, str]]:
    loser = "CASE winning_alliance WHEN 'blue' THEN red_1_key WHEN 'red' THEN blue_1_key END"
    losses = (
        "losses",
        f"""SELECT m.event_key, m.comp_level, r.alliance_name, COUNT(DISTINCT m.match_key) AS n
            FROM (SELECT *, {loser} AS loser FROM matches) m
            JOIN roster r ON r.event_key = m.event_key AND r.team_key = m.loser
            WHERE m.comp_level IN ('sf', 'f') GROUP BY ALL""",
    )
    if mode != "dcmp_divisions":
        district = ", s.district_key" if mode.startswith("dcmp") else ""
        return [
            losses,
            (
                "team_event_states",
                f"""SELECT p.event_key, p.team_key{district}, p.award_points = 0 AS award_eligible,
                      NOT EXISTS (
                        SELECT 1 FROM losses l JOIN roster r
                          ON r.event_key = l.event_key AND r.alliance_name = l.alliance_name
                        WHERE l.n >= 2 AND l.comp_level = 'sf' AND l.event_key = p.event_key
                          AND r.team_key = p.team_key AND s.ord NOT IN (0, 1, 2, 11, 12)
                      ) AS elim_eligible
                    FROM event_points p JOIN st s ON s.event_key = p.event_key
                    WHERE s.ord NOT IN (0, 1, 2, 12)""",
            ),
        ]
    return [
        losses,
        (
            "out_teams",
            """SELECT s.district_key, r.team_key FROM losses l JOIN roster r
                 ON r.event_key = l.event_key AND r.alliance_name = l.alliance_name
               JOIN st s ON s.event_key = l.event_key WHERE l.n >= 2 AND s.ord NOT IN (0, 1, 2)
               UNION
               SELECT f.district_key, r.team_key FROM losses l JOIN roster r
                 ON r.event_key = l.event_key AND r.alliance_name = l.alliance_name
               JOIN dcmp_finals_state f ON f.event_key = l.event_key
               WHERE l.n >= 2 AND l.comp_level = 'sf'
                 AND f.event_state NOT IN ('Pre-Event', 'Awards', 'Completed')""",
        ),
        (
            "team_event_states",
            """SELECT e.district_key, p.team_key, MAX(p.award_points) = 0 AS award_eligible,
                 NOT EXISTS (SELECT 1 FROM out_teams o WHERE o.district_key = e.district_key
                   AND o.team_key = p.team_key) AS elim_eligible
               FROM event_points p JOIN events e ON e.event_key = p.event_key
               WHERE e.event_type = 'District Championship Division'
               GROUP BY e.district_key, p.team_key""",
        ),
    ]


def _counted(alias: str, source: str, columns: str) -> tuple[str, str]:
    return (
        alias,
        f"""SELECT e.district_key, t.team_key, t.event_key{columns} FROM {source} t
            JOIN events e ON e.event_key = t.event_key WHERE e.event_type = 'District'
            QUALIFY ROW_NUMBER() OVER (PARTITION BY e.district_key, t.team_key
              ORDER BY e.start_date, t.event_key) <= 2""",
    )


_CHANCES = """SUM(CAST(ord IN (0, 1) AS INT)) AS q, SUM(CAST(ord IN (0, 1, 2) AS INT)) AS s,
  SUM(CAST(ord < 10 AND playing AS INT)) AS d, SUM(CAST(ord < 11 AND playing AS INT)) AS f,
  SUM(CAST(ord < 12 AND awardable AS INT)) AS a"""

_CHANCE_NAMES = """CAST(COALESCE(n, 0) AS INTEGER) AS events_remaining,
  CAST(COALESCE(q, 0) AS INTEGER) AS quals_remaining,
  CAST(COALESCE(s, 0) AS INTEGER) AS selections_remaining,
  CAST(COALESCE(d, 0) AS INTEGER) AS double_elims_remaining,
  CAST(COALESCE(f, 0) AS INTEGER) AS finals_remaining,
  CAST(COALESCE(a, 0) AS INTEGER) AS awards_remaining"""


def _season_standings(regional: bool) -> list[tuple[str, str]]:
    race = "district_key, region" if regional else "district_key"
    region = "region, " if regional else ""
    joined = "JOIN region_lookup g ON g.team_key = k.team_key" if regional else ""
    return [
        (
            "chances",
            f"""SELECT district_key, team_key, SUM(pts) AS pts,
                  SUM(CAST(ord <> 12 AS INT)) AS n, {_CHANCES}
                FROM (SELECT c.district_key, c.team_key, s.ord,
                    CASE WHEN s.ord NOT IN (0, 1) THEN p.points END AS pts,
                    COALESCE(t.elim_eligible, TRUE) AS playing,
                    COALESCE(t.award_eligible, TRUE) AS awardable
                  FROM counted c JOIN st s ON s.event_key = c.event_key
                  LEFT JOIN event_points p ON p.event_key = c.event_key AND p.team_key = c.team_key
                  LEFT JOIN team_event_states t
                    ON t.event_key = c.event_key AND t.team_key = c.team_key)
                GROUP BY district_key, team_key""",
        ),
        (
            "totals",
            f"""SELECT k.district_key, {region} k.team_key, k.rank AS official,
                  CAST(COALESCE(c.pts, 0) + k.rookie_bonus + COALESCE(j.points_adjustment, 0)
                    AS INTEGER) AS points,
                  k.rookie_bonus + COALESCE(j.points_adjustment, 0) AS rookie_bonus,
                  {_CHANCE_NAMES}
                FROM district_rankings k {joined}
                LEFT JOIN chances c ON c.district_key = k.district_key AND c.team_key = k.team_key
                LEFT JOIN points_adjustments j
                  ON j.district_key = k.district_key AND j.team_key = k.team_key""",
        ),
        (
            "adjusted_district_rankings",
            f"""SELECT district_key, {region} team_key,
                  CAST(ROW_NUMBER() OVER (PARTITION BY {race} ORDER BY points DESC, official)
                    AS INTEGER) AS rank, points, rookie_bonus,
                  points + 4 * quals_remaining AS inflated_points,
                  events_remaining, quals_remaining, selections_remaining,
                  double_elims_remaining, finals_remaining, awards_remaining
                FROM totals""",
        ),
        (
            "open_rankings",
            f"""SELECT *, CAST(ROW_NUMBER() OVER (PARTITION BY {race}
                  ORDER BY inflated_points DESC, rank) AS INTEGER) AS active_team_rank
                FROM adjusted_district_rankings a
                WHERE NOT EXISTS (SELECT 1 FROM impact_award_winners i
                  WHERE i.district_key = a.district_key AND i.team_key = a.team_key)""",
        ),
    ]


def _impact(regional: bool) -> tuple[str, str]:
    region = ", g.region" if regional else ""
    joined = "JOIN region_lookup g ON g.team_key = w.team_key" if regional else ""
    return (
        "impact_award_winners",
        f"""SELECT e.district_key{region}, w.team_key FROM awards w
            JOIN events e ON e.event_key = w.event_key {joined}
            WHERE w.award_type = 0 AND e.event_type = 'District'""",
    )


_SIZES = ("sizes", "SELECT event_key, COUNT(*) AS n FROM event_teams GROUP BY event_key")
_CURVE = (
    "curve",
    """SELECT a.event_size, a.team_rank, SUM(b.qual_points) AS through,
         SUM(b.qual_points) - a.team_rank * (SELECT MIN(qual_points) FROM qual_points_lookup z
           WHERE z.event_size = a.event_size) AS above
       FROM qual_points_lookup a JOIN qual_points_lookup b
         ON b.event_size = a.event_size AND b.team_rank <= a.team_rank
       GROUP BY a.event_size, a.team_rank""",
)


def _season_budget(regional: bool) -> list[tuple[str, str]]:
    rookie = """EXISTS (SELECT 1 FROM event_teams t JOIN district_rankings k
        ON k.team_key = t.team_key AND k.district_key = s.district_key
        WHERE t.event_key = s.event_key AND k.rookie_bonus = 10)"""
    given = """COALESCE((SELECT SUM(award_points) FROM event_points p
        WHERE p.event_key = s.event_key AND p.award_points <> 10), 0)"""
    base = (
        "event_base",
        f"""SELECT s.event_key, s.district_key, s.ord, z.n AS size,
              CASE WHEN s.ord = 12 THEN 0 ELSE 68 + CASE WHEN {rookie} THEN 8 ELSE 0 END - {given}
                END AS awards,
              COALESCE(l.pts, 0) AS elims
            FROM st s JOIN sizes z ON z.event_key = s.event_key
            LEFT JOIN {LADDER} l(ord, pts) ON l.ord = s.ord""",
    )
    parts = """CAST(award AS INTEGER) AS award_points_remaining,
        CAST(elim AS INTEGER) AS elimination_points_remaining,
        CAST(pick AS INTEGER) AS alliance_selection_points_remaining,
        CAST(qual AS INTEGER) AS quals_adjusted_points_remaining,
        CAST(award + elim + pick + qual AS INTEGER) AS points_remaining"""
    if not regional:
        return [
            _SIZES,
            _CURVE,
            base,
            (
                "event_points_remaining",
                f"""SELECT event_key, CAST(size AS INTEGER) AS team_count, {parts} FROM (
                      SELECT b.event_key, b.size, awards AS award, elims AS elim,
                        CASE WHEN ord IN (0, 1, 2) THEN 236 ELSE 0 END AS pick,
                        CASE WHEN ord IN (0, 1) THEN c.above ELSE 0 END AS qual
                      FROM event_base b JOIN curve c
                        ON c.event_size = b.size AND c.team_rank = b.size)""",
            ),
            (
                "district_points_remaining",
                """SELECT s.district_key, CAST(COUNT(*) AS INTEGER) AS total_district_events,
                     CAST(SUM(CAST(s.ord <> 12 AS INT)) AS INTEGER) AS events_remaining,
                     CAST(SUM(b.points_remaining) AS INTEGER) AS points_remaining
                   FROM st s JOIN event_points_remaining b ON b.event_key = s.event_key
                   GROUP BY s.district_key""",
            ),
        ]
    return [
        _SIZES,
        _CURVE,
        base,
        (
            "attendance",
            """SELECT s.event_key, g.region,
                 SUM(CAST(COALESCE(t.elim_eligible, TRUE) AS INT)) AS players,
                 COUNT(k.team_key) AS ranked,
                 SUM(CAST(k.team_key IS NOT NULL AND COALESCE(t.award_eligible, TRUE) AS INT))
                   AS winners,
                 SUM(CAST(COALESCE(k.rookie_bonus, 0) = 10 AS INT)) AS rookies
               FROM event_teams x JOIN st s ON s.event_key = x.event_key
               JOIN region_lookup g ON g.team_key = x.team_key
               LEFT JOIN district_rankings k
                 ON k.district_key = s.district_key AND k.team_key = x.team_key
               LEFT JOIN team_event_states t
                 ON t.event_key = x.event_key AND t.team_key = x.team_key
               GROUP BY s.event_key, g.region""",
        ),
        (
            "event_points_remaining",
            f"""SELECT region, event_key, CAST(team_count AS INTEGER) AS team_count, {parts} FROM (
                  SELECT r.region, b.event_key, r.team_count,
                    LEAST(awards, CASE WHEN a.winners = 1 THEN 8
                      WHEN a.rookies > 0 THEN 6 + 5 * a.winners ELSE 3 + 5 * a.winners END) AS award,
                    LEAST(elims, CASE WHEN a.players <= 3 THEN 30 * a.players
                      WHEN a.players <= 6 THEN 30 + 20 * a.players
                      WHEN a.players <= 9 THEN 72 + 13 * a.players
                      WHEN a.players <= 12 THEN 87 + 7 * a.players ELSE 213 END) AS elim,
                    CASE WHEN ord IN (0, 1, 2) THEN (
                      SELECT COALESCE(SUM(v), 0) FROM (SELECT v, ROW_NUMBER() OVER (ORDER BY v DESC) AS i
                        FROM (SELECT UNNEST([16, 16, 15, 15, 14, 14, 13, 13, 12, 12, 11, 11, 10, 10,
                          9, 9, 8, 7, 6, 5, 4, 3, 2, 1]) AS v)) WHERE i <= r.team_count)
                      ELSE 0 END AS pick,
                    CASE WHEN ord IN (0, 1) THEN c.above ELSE 0 END AS qual
                  FROM event_base b JOIN event_regions r ON r.event_key = b.event_key
                  JOIN attendance a ON a.event_key = b.event_key AND a.region = r.region
                  JOIN curve c ON c.event_size = b.size AND c.team_rank = r.team_count
                  WHERE a.ranked > 0)""",
        ),
        (
            "district_points_remaining",
            """SELECT r.district_key, r.region, CAST(COUNT(*) AS INTEGER) AS total_district_events,
                 CAST(SUM(CAST(s.ord <> 12 AS INT)) AS INTEGER) AS events_remaining,
                 CAST(SUM(b.points_remaining) AS INTEGER) AS points_remaining
               FROM event_regions r JOIN st s ON s.event_key = r.event_key
               JOIN event_points_remaining b ON b.event_key = r.event_key AND b.region = r.region
               GROUP BY r.district_key, r.region""",
        ),
    ]


def _season_race(regional: bool) -> list[tuple[str, str]]:
    race = "district_key, region" if regional else "district_key"
    region = "region, " if regional else ""
    using = f"USING ({race})"
    if regional:
        places = """SELECT b.district_key, b.region, l.dcmp_capacity - b.events_remaining
              - (SELECT COUNT(*) FROM impact_award_winners i
                 WHERE i.district_key = b.district_key AND i.region = b.region) AS places
            FROM district_points_remaining b JOIN district_lookup l USING (district_key)"""
        teams = "SELECT region, COUNT(*) AS teams FROM region_lookup GROUP BY region"
        team_key = "region"
    else:
        places = """SELECT district_key, dcmp_capacity - (SELECT COUNT(*) FROM events e
              WHERE e.district_key = l.district_key AND e.event_type = 'District') AS places
            FROM district_lookup l"""
        teams = "SELECT district_key, COUNT(*) AS teams FROM district_rankings GROUP BY 1"
        team_key = "district_key"
    return [
        ("places", places),
        (
            "teams_to_pass",
            f"""SELECT district_key, {region} team_key, points, inflated_points, rank,
                  active_team_rank, CAST(places - active_team_rank + 1 AS INTEGER) AS teams_to_pass
                FROM open_rankings JOIN places {using} WHERE active_team_rank <= places""",
        ),
        _pairs("pairs", "teams_to_pass", race, "inflated_points", 1, (18, 16, 20, 10, 8, 0), False),
        _following(
            "following_teams",
            "pairs",
            race,
            """follower_race AS following_team_inflated_points,""",
            """CASE WHEN late THEN LEAST(CAST(CEIL(gap / 5.0) * 5 AS INTEGER),
                 CASE WHEN gap <= 8 THEN 8 ELSE CAST(CEIL((gap - 8) / 5.0) * 5 + 8 AS INTEGER) END)
               ELSE gap END""",
            True,
        ),
        (
            "scored",
            """SELECT e.district_key, p.team_key, p.points,
                 ROW_NUMBER() OVER (PARTITION BY e.district_key, p.team_key
                   ORDER BY e.start_date, e.event_key) AS i
               FROM event_points p JOIN events e ON e.event_key = p.event_key
               JOIN st s ON s.event_key = e.event_key
               JOIN district_rankings k
                 ON k.district_key = e.district_key AND k.team_key = p.team_key
               WHERE e.event_type = 'District' AND s.ord NOT IN (0, 1)""",
        ),
        ("race_teams", teams),
        _follower_sums("sums", "following_teams", race),
        (
            "lock_status",
            f"""SELECT district_key, {region} team_key, rank, points AS total_points,
                  total_inflated_points, event1_points, event2_points, rookie_bonus, teams_to_pass,
                  CAST(passers AS INTEGER) AS total_teams_that_can_pass,
                  needed AS total_points_to_pass, budget AS total_points_remaining, lock_status,
                  CASE WHEN lock_status = '100%' THEN '6AA84F' WHEN lock_status = '-' THEN 'E06666'
                    WHEN lock_status = 'Impact' THEN '6D9EEB' WHEN followed THEN 'B6D7A8'
                    ELSE 'FFD966' END AS color
                FROM (SELECT *, CASE WHEN impact THEN 'Impact'
                    WHEN budget = 0 AND active_team_rank <= capacity - events THEN '100%'
                    WHEN passers < teams_to_pass OR needed > budget OR teams = capacity THEN '100%'
                    WHEN open_events = 0 AND NOT followed AND rank > capacity THEN '-'
                    WHEN NOT followed THEN '0%'
                    ELSE LEAST(ROUND(needed * 100.0 / budget, 1), 99.9) || '%' END AS lock_status
                  FROM (SELECT a.*, o.inflated_points AS total_inflated_points, o.active_team_rank,
                      o.events_remaining AS open_events, t.teams_to_pass,
                      COALESCE(f.passers, 0) AS passers, f.needed, f.passers IS NOT NULL AS followed,
                      b.points_remaining AS budget, b.total_district_events AS events,
                      l.dcmp_capacity AS capacity, n.teams,
                      EXISTS (SELECT 1 FROM impact_award_winners i WHERE i.district_key = a.district_key
                        AND i.team_key = a.team_key) AS impact,
                      COALESCE((SELECT points FROM scored c WHERE c.district_key = a.district_key
                        AND c.team_key = a.team_key AND i = 1), 0) AS event1_points,
                      COALESCE((SELECT points FROM scored c WHERE c.district_key = a.district_key
                        AND c.team_key = a.team_key AND i = 2), 0) AS event2_points
                    FROM adjusted_district_rankings a
                    JOIN district_points_remaining b {using}
                    JOIN district_lookup l USING (district_key)
                    JOIN race_teams n USING ({team_key})
                    LEFT JOIN open_rankings o USING ({race}, team_key)
                    LEFT JOIN teams_to_pass t USING ({race}, team_key)
                    LEFT JOIN sums f USING ({race}, team_key)))""",
        ),
    ]


def _pairs(
    name: str, leaders: str, race: str, points: str, times: int, reach: tuple, semis: bool
) -> tuple[str, str]:
    q, s, d, f, a, m = reach
    last = f"+ {m} * o.dcmp_semi_finals_remaining" if semis else ""
    same = " AND ".join(f"o.{c.strip()} = t.{c.strip()}" for c in race.split(","))
    return (
        name,
        f"""SELECT t.*, o.team_key AS follower, o.rank AS follower_rank,
              o.points AS follower_points, o.{points} AS follower_race,
              CAST(t.{points} - o.{points} AS INTEGER) AS gap, o.double_elims_remaining = 0 AS late,
              CAST(o.{points} + {times} * ({q} * o.quals_remaining + {s} * o.selections_remaining
                + {d} * o.double_elims_remaining + {f} * o.finals_remaining
                + {a} * o.awards_remaining {last}) AS INTEGER) AS best,
              best >= t.{points} AS can_pass
            FROM {leaders} t JOIN open_rankings o ON {same}
              AND o.active_team_rank > t.active_team_rank AND o.events_remaining > 0""",
    )


def _following(
    name: str, pairs: str, race: str, inflated: str, needed: str, season: bool
) -> tuple[str, str]:
    status = (
        """CASE WHEN can_pass THEN CAST(needed AS VARCHAR) ELSE '-' END
             AS following_team_points_needed_to_pass_status,"""
        if season
        else ""
    )
    return (
        name,
        f"""SELECT {race}, team_key, points, teams_to_pass, follower AS following_team_key,
              follower_rank AS following_team_rank, follower_points AS following_team_points,
              {inflated} best AS following_team_max_possible_points,
              can_pass AS following_team_can_pass,
              CASE WHEN can_pass THEN CAST(passed AS INTEGER) END AS following_team_order,
              CASE WHEN can_pass THEN needed END AS following_team_points_needed_to_pass, {status}
              CASE WHEN can_pass THEN 'FFD966' ELSE 'E06666' END AS following_team_color
            FROM (SELECT *, {needed} AS needed,
                SUM(CAST(can_pass AS INT)) OVER (PARTITION BY {race}, team_key
                  ORDER BY follower_rank) AS passed,
                SUM(CAST(can_pass AS INT)) OVER (PARTITION BY {race}, team_key) AS all_passers
              FROM {pairs})
            WHERE all_passers < teams_to_pass OR passed - CAST(can_pass AS INT) < teams_to_pass""",
    )


def _follower_sums(name: str, following: str, race: str) -> tuple[str, str]:
    return (
        name,
        f"""SELECT {race}, team_key, SUM(CAST(following_team_can_pass AS INT)) AS passers,
              CAST(SUM(following_team_points_needed_to_pass) AS INTEGER) AS needed
            FROM {following} GROUP BY {race}, team_key""",
    )


# ---- championships -----------------------------------------------------------------------


def _qualifiers(mode: str) -> list[tuple[str, str]]:
    winner = "CASE winning_alliance WHEN 'red' THEN red_1_key WHEN 'blue' THEN blue_1_key END"
    by_event = mode == "dcmp_regions"
    where = "e.event_type = 'District Championship'"
    if mode != "dcmp_divisions":
        where += " AND EXISTS (SELECT 1 FROM st s WHERE s.event_key = e.event_key AND s.ord >= 11)"
    event = ", e.event_key" if by_event else ""
    special = "district_key IN (SELECT district_key FROM championship_rules)"
    seats = f"AND NOT (seat > 2 AND w.{special})" if mode == "dcmp" else ""
    ras = f"AND NOT (w.award_type = 10 AND e.{special})" if mode == "dcmp" else ""
    return [
        (
            "won",
            f"""SELECT w.* EXCLUDE (seat) FROM (
                  SELECT e.district_key{event}, r.team_key, r.seat FROM (
                      SELECT event_key, winning_alliance, MIN({winner}) AS robot FROM matches
                      WHERE comp_level = 'f' AND winning_alliance IS NOT NULL
                      GROUP BY ALL HAVING COUNT(*) >= 2) m
                  JOIN events e ON e.event_key = m.event_key
                  JOIN roster h ON h.event_key = m.event_key AND h.team_key = m.robot
                  JOIN roster r ON r.event_key = h.event_key AND r.alliance_name = h.alliance_name
                  WHERE {where} AND r.team_key IS NOT NULL) w
                WHERE TRUE {seats}""",
        ),
        (
            "given",
            f"""SELECT e.district_key{event}, w.team_key,
                  CASE w.award_type WHEN 0 THEN 'Impact' WHEN 9 THEN 'EI' ELSE 'RAS' END AS award_type
                FROM awards w JOIN events e ON e.event_key = w.event_key
                WHERE w.award_type IN (0, 9, 10) AND e.event_type = 'District Championship' {ras}""",
        ),
        (
            "everyone",
            """SELECT district_key, team_key FROM won UNION SELECT district_key, team_key FROM given
               UNION SELECT district_key, team_key FROM prequalified_teams""",
        ),
        (
            "qualifying_award_winners",
            """SELECT x.district_key, x.team_key, g.award_type,
                 EXISTS (SELECT 1 FROM won w WHERE w.district_key = x.district_key
                   AND w.team_key = x.team_key) AS is_winner,
                 EXISTS (SELECT 1 FROM prequalified_teams p WHERE p.district_key = x.district_key
                   AND p.team_key = x.team_key) AS is_prequalified
               FROM everyone x LEFT JOIN given g
                 ON g.district_key = x.district_key AND g.team_key = x.team_key"""
            if not by_event
            else """SELECT x.district_key, x.team_key,
                 (SELECT ARG_MIN(award_type, CASE award_type WHEN 'Impact' THEN 1 WHEN 'EI' THEN 2
                    ELSE 3 END) FROM given g WHERE g.district_key = x.district_key
                    AND g.team_key = x.team_key) AS award_type,
                 EXISTS (SELECT 1 FROM won w WHERE w.district_key = x.district_key
                   AND w.team_key = x.team_key) AS is_winner,
                 EXISTS (SELECT 1 FROM prequalified_teams p WHERE p.district_key = x.district_key
                   AND p.team_key = x.team_key) AS is_prequalified,
                 COALESCE((SELECT MIN(event_key) FROM won w WHERE w.district_key = x.district_key
                   AND w.team_key = x.team_key), (SELECT MIN(event_key) FROM given g
                   WHERE g.district_key = x.district_key AND g.team_key = x.team_key)) AS event_key
               FROM everyone x""",
        ),
        (
            "qualifier_ways",
            """SELECT *, CAST(award_type IS NOT NULL AS INT) + CAST(is_winner AS INT)
                 + CAST(is_prequalified AS INT) AS ways FROM qualifying_award_winners""",
        ),
    ]


def _spots(mode: str) -> tuple[str, str]:
    start = """l.wcmp_capacity - l.dcmp_impact_awards - l.dcmp_ei_awards - l.dcmp_ras_awards"""
    counts = """SUM(CAST(q.is_winner AS INT)) AS winners, SUM(CAST(q.ways = 2 AS INT)) AS doubles,
        SUM(CAST(q.ways = 3 AS INT)) AS triples,
        SUM(CAST(COALESCE(q.award_type = 'RAS', FALSE) AS INT)) AS ras"""
    if mode == "dcmp_regions":
        return (
            "wcmp_spots",
            f"""SELECT l.district_key, CAST({start} - COALESCE(SUM(COALESCE(NULLIF(winners, 0), 4)), 4)
                  + COALESCE(SUM(doubles + 2 * triples), 0) + COALESCE(SUM(CASE WHEN ord = 12
                    THEN l.dcmp_ras_awards - ras ELSE 0 END), 0) AS INTEGER) AS wcmp_spots
                FROM district_lookup l LEFT JOIN (
                  SELECT s.district_key, s.event_key, s.ord, COALESCE(SUM(CAST(q.is_winner AS INT)), 0)
                      AS winners, COALESCE(SUM(CAST(q.ways = 2 AS INT)), 0) AS doubles,
                    COALESCE(SUM(CAST(q.ways = 3 AS INT)), 0) AS triples,
                    COUNT(*) FILTER (q.award_type = 'RAS') AS ras
                  FROM st s LEFT JOIN qualifier_ways q
                    ON q.district_key = s.district_key AND q.event_key = s.event_key
                  GROUP BY s.district_key, s.event_key, s.ord) x USING (district_key)
                GROUP BY ALL""".replace(
                "GROUP BY ALL",
                """GROUP BY l.district_key, l.wcmp_capacity, l.dcmp_impact_awards,
                  l.dcmp_ei_awards, l.dcmp_ras_awards""",
            ),
        )
    deciding = "dcmp_finals_state" if mode == "dcmp_divisions" else "event_states"
    assumed = "4"
    if mode == "dcmp":
        assumed = """CASE WHEN l.district_key IN (SELECT district_key FROM championship_rules)
            THEN 2 ELSE 4 END"""
    return (
        "wcmp_spots",
        f"""SELECT l.district_key, CAST({start} - COALESCE(x.winners, {assumed})
              + COALESCE(x.doubles, 0) + 2 * COALESCE(x.triples, 0)
              + CASE WHEN x.done THEN l.dcmp_ras_awards - x.ras ELSE 0 END AS INTEGER) AS wcmp_spots
            FROM district_lookup l LEFT JOIN (
              SELECT s.district_key, s.event_state = 'Completed' AS done, {counts}
              FROM {deciding} s JOIN qualifier_ways q USING (district_key)
              WHERE s.event_state IN ('Awards', 'Completed')
              GROUP BY s.district_key, s.event_state) x USING (district_key)""",
    )


def _finals() -> tuple[str, str]:
    return (
        "dcmp_finals_state",
        """SELECT district_key, event_key, name, event_type, num_dcmp_divisions, event_state,
             CASE event_state WHEN 'Completed' THEN '93C47D' ELSE 'FFD966' END AS color
           FROM (SELECT e.district_key, e.event_key, e.event_type, num_dcmp_divisions,
               l.display_name || ' ' || l.dcmp_name || ' Finals' AS name,
               CASE WHEN m.listed IS NULL THEN 'Pre-Event'
                 WHEN m.semis + m.finals = 0 THEN 'Elims 1'
                 WHEN m.semis IN (1, 2, 3, 4) THEN 'Elims ' || CAST(m.semis + 1 AS VARCHAR)
                 WHEN GREATEST(m.red, m.blue) < 2 THEN 'Finals'
                 WHEN (SELECT COUNT(*) FROM qualifying_award_winners q WHERE q.award_type = 'Impact'
                   AND q.district_key = e.district_key) < l.dcmp_impact_awards THEN 'Awards'
                 ELSE 'Completed' END AS event_state
             FROM events e JOIN district_lookup l ON l.district_key = e.district_key
             JOIN (SELECT district_key, COUNT(*) AS num_dcmp_divisions FROM event_states
               GROUP BY district_key) d ON d.district_key = e.district_key
             LEFT JOIN mf m ON m.event_key = e.event_key
             WHERE e.event_type = 'District Championship')""",
    )


def _championship_standings(divisions: bool) -> list[tuple[str, str]]:
    if divisions:
        elig = "t.district_key = s.district_key AND t.team_key = x.team_key"
        finals = "JOIN dcmp_finals_state f ON f.district_key = s.district_key"
        running = """SUM(CAST(finals <> 'Completed' AS INT)) AS n,
            SUM(CAST(divisions = 4 AND finals NOT IN ('Finals', 'Awards', 'Completed')
              AND playing AS INT)) AS m,"""
        fields = ", f.event_state AS finals, f.num_dcmp_divisions AS divisions"
        semis = ", CAST(COALESCE(m, 0) AS INTEGER) AS dcmp_semi_finals_remaining"
        dcmp = """COALESCE(c.pts, 0) + COALESCE((SELECT SUM(p.points) FROM event_points p
            JOIN event_teams x ON x.event_key = p.event_key AND x.team_key = p.team_key
            JOIN dcmp_finals_state f ON f.event_key = p.event_key
            WHERE f.district_key = k.district_key AND p.team_key = k.team_key), 0)"""
        names = ", dcmp_semi_finals_remaining"
    else:
        elig = "t.event_key = x.event_key AND t.team_key = x.team_key"
        finals, fields, semis, names = "", "", "", ""
        running = "SUM(CAST(ord <> 12 AS INT)) AS n,"
        dcmp = "c.pts"
    return [
        _counted("counted_scores", "event_points", ", t.points"),
        (
            "chances",
            f"""SELECT district_key, team_key, SUM(pts) AS pts, {running} {_CHANCES}
                FROM (SELECT s.district_key, x.team_key, s.ord,
                    CASE WHEN s.ord IN (0, 1) THEN 0 ELSE p.points END AS pts,
                    COALESCE(t.elim_eligible, TRUE) AS playing,
                    COALESCE(t.award_eligible, TRUE) AS awardable {fields}
                  FROM event_teams x JOIN st s ON s.event_key = x.event_key {finals}
                  LEFT JOIN event_points p ON p.event_key = x.event_key AND p.team_key = x.team_key
                  LEFT JOIN team_event_states t ON {elig})
                GROUP BY district_key, team_key""",
        ),
        (
            "totals",
            f"""SELECT *, COALESCE(district_event_points, 0) + rookie_bonus
                  + COALESCE(dcmp_points, 0) AS points FROM (
                SELECT k.district_key, k.team_key, k.rank AS official,
                  CAST((SELECT SUM(points) FROM counted_scores z WHERE z.district_key = k.district_key
                    AND z.team_key = k.team_key) AS INTEGER) AS district_event_points,
                  k.rookie_bonus + COALESCE(j.points_adjustment, 0) AS rookie_bonus,
                  CAST({dcmp} AS INTEGER) AS dcmp_points, {_CHANCE_NAMES}{semis}
                FROM district_rankings k
                LEFT JOIN chances c ON c.district_key = k.district_key AND c.team_key = k.team_key
                LEFT JOIN points_adjustments j
                  ON j.district_key = k.district_key AND j.team_key = k.team_key)""",
        ),
        (
            "adjusted_district_rankings",
            f"""SELECT district_key, team_key,
                  CAST(ROW_NUMBER() OVER (PARTITION BY district_key ORDER BY points DESC, official)
                    AS INTEGER) AS rank, district_event_points, rookie_bonus, dcmp_points, points,
                  events_remaining, quals_remaining, selections_remaining,
                  double_elims_remaining, finals_remaining, awards_remaining{names}
                FROM totals""",
        ),
        (
            "open_rankings",
            """SELECT * EXCLUDE (district_event_points, dcmp_points),
                 CAST(ROW_NUMBER() OVER (PARTITION BY district_key ORDER BY points DESC, rank)
                   AS INTEGER) AS active_team_rank
               FROM adjusted_district_rankings a
               WHERE NOT EXISTS (SELECT 1 FROM qualifying_award_winners q
                 WHERE q.district_key = a.district_key AND q.team_key = a.team_key)""",
        ),
    ]


def _championship_budget(divisions: bool) -> list[tuple[str, str]]:
    base = 0 if divisions else 31
    name = "s.name" if divisions else "l.display_name || ' ' || l.dcmp_name"
    finals = ""
    if divisions:
        finals = """UNION ALL
            SELECT f.event_key, f.name, f.event_state, f.color, CAST(COALESCE(z.n, 0) AS INTEGER), 0,
              CASE WHEN x.open THEN 90 ELSE 0 END, 0, 0, CASE WHEN x.open THEN 90 ELSE 0 END
            FROM dcmp_finals_state f LEFT JOIN sizes z ON z.event_key = f.event_key
            JOIN (SELECT event_key, num_dcmp_divisions = 4
                AND event_state NOT IN ('Finals', 'Awards', 'Completed') AS open
              FROM dcmp_finals_state) x ON x.event_key = f.event_key"""
    return [
        _SIZES,
        (
            "event_points_remaining",
            f"""SELECT event_key, name, event_state, color, team_count,
                  CAST(award AS INTEGER) AS award_points_remaining,
                  CAST(elim AS INTEGER) AS elimination_points_remaining,
                  CAST(pick AS INTEGER) AS alliance_selection_points_remaining,
                  CAST(qual AS INTEGER) AS quals_points_remaining,
                  CAST(award + elim + pick + qual AS INTEGER) AS points_remaining
                FROM (SELECT s.event_key, {name} AS name, s.event_state, s.color,
                    CAST(z.n AS INTEGER) AS team_count,
                    CASE WHEN s.ord = 12 THEN 0 ELSE 180 - COALESCE((SELECT SUM(award_points)
                      FROM event_points p WHERE p.event_key = s.event_key
                      AND p.award_points NOT IN (30, 24)), 0) END AS award,
                    3 * COALESCE(d.pts - {base}, 0) AS elim,
                    CASE WHEN s.ord IN (0, 1, 2) THEN 708 ELSE 0 END AS pick,
                    CASE WHEN s.ord IN (0, 1) THEN 3 * q.total ELSE 0 END AS qual
                  FROM st s JOIN sizes z ON z.event_key = s.event_key
                  JOIN district_lookup l ON l.district_key = s.district_key
                  JOIN (SELECT event_size, SUM(qual_points) AS total FROM qual_points_lookup
                    GROUP BY event_size) q ON q.event_size = z.n
                  LEFT JOIN {LADDER} d(ord, pts) ON d.ord = s.ord)
                {finals}""",
        ),
        (
            "district_points_remaining",
            """SELECT e.district_key, CAST(SUM(b.points_remaining) AS INTEGER) AS points_remaining
               FROM event_points_remaining b JOIN events e ON e.event_key = b.event_key
               GROUP BY e.district_key""",
        ),
    ]


def _championship_race(mode: str, second: bool) -> list[tuple[str, str]]:
    v = "_v2" if second else ""
    divisions = mode == "dcmp_divisions"
    reach = (18, 16, 20, 10, 5, 10) if divisions or second else (22, 16, 20, 0, 5, 0)
    return [
        (
            f"teams_to_pass{v}",
            f"""SELECT district_key, team_key, points, rank, active_team_rank,
                  wcmp_spots - active_team_rank + 1 AS teams_to_pass
                FROM open_rankings JOIN wcmp_spots{v} USING (district_key)
                WHERE active_team_rank <= wcmp_spots""",
        ),
        _pairs(f"pairs{v}", f"teams_to_pass{v}", "district_key", "points", 3, reach, divisions),
        _following(
            f"following_teams{v}",
            f"pairs{v}",
            "district_key",
            "",
            """CASE WHEN late THEN CAST(CEIL(gap / 15.0) * 15 AS INTEGER)
               ELSE CAST(CEIL(gap / 3.0) * 3 AS INTEGER) END""",
            False,
        ),
        _follower_sums(f"sums{v}", f"following_teams{v}", "district_key"),
        (
            f"lock_status{v}",
            f"""SELECT district_key, team_key, rank, district_event_points, dcmp_points, rookie_bonus,
                  points AS total_points, teams_to_pass,
                  CAST(COALESCE(passers, 0) AS INTEGER) AS total_teams_that_can_pass,
                  needed AS total_points_to_pass, budget AS total_points_remaining, lock_status,
                  CASE WHEN lock_status = '100%' THEN '6AA84F' WHEN lock_status = '-' THEN 'E06666'
                    WHEN lock_status = 'Prequalified' THEN '8E7CC3'
                    WHEN lock_status IN ('Impact', 'EI', 'RAS', 'Winner') THEN '6D9EEB'
                    WHEN passers IS NOT NULL THEN 'B6D7A8' ELSE 'FFD966' END AS color
                FROM (SELECT *, CASE WHEN pre THEN 'Prequalified' WHEN award IS NOT NULL THEN award
                    WHEN won THEN 'Winner' WHEN budget = 0 AND active_team_rank <= wcmp_spots THEN '100%'
                    WHEN passers < teams_to_pass OR needed > budget THEN '100%'
                    WHEN passers IS NULL AND open_events = 0 THEN '-' WHEN passers IS NULL THEN '0%'
                    ELSE LEAST(ROUND(needed * 100.0 / budget, 1), 99.9) || '%' END AS lock_status
                  FROM (SELECT a.*, o.active_team_rank, o.events_remaining AS open_events,
                      t.teams_to_pass, f.passers, f.needed, b.points_remaining AS budget, w.wcmp_spots,
                      q.pre, q.won, q.award
                    FROM adjusted_district_rankings a
                    JOIN district_points_remaining b USING (district_key)
                    JOIN wcmp_spots{v} w USING (district_key)
                    LEFT JOIN open_rankings o USING (district_key, team_key)
                    LEFT JOIN teams_to_pass{v} t USING (district_key, team_key)
                    LEFT JOIN sums{v} f USING (district_key, team_key)
                    LEFT JOIN (SELECT district_key, team_key, BOOL_OR(is_prequalified) AS pre,
                        BOOL_OR(is_winner) AS won, ARG_MIN(award_type, CASE award_type
                          WHEN 'Impact' THEN 1 WHEN 'EI' THEN 2 ELSE 3 END) AS award
                      FROM qualifying_award_winners GROUP BY 1, 2) q
                      USING (district_key, team_key)))""",
        ),
    ]


def _second_spots(mode: str) -> list[tuple[str, str]]:
    if mode == "dcmp_divisions":
        alive = """SELECT DISTINCT e.district_key, r.event_key, r.alliance_name FROM roster r
            JOIN events e ON e.event_key = r.event_key
            JOIN dcmp_finals_state f ON f.district_key = e.district_key
            JOIN team_event_states t ON t.district_key = e.district_key AND t.team_key = r.team_key
            WHERE e.event_type = 'District Championship Division' AND t.elim_eligible
              AND f.event_state NOT IN ('Awards', 'Completed')"""
    else:
        alive = """SELECT DISTINCT s.district_key, r.event_key, r.alliance_name FROM roster r
            JOIN st s ON s.event_key = r.event_key
            JOIN team_event_states t ON t.event_key = r.event_key AND t.team_key = r.team_key
            WHERE t.elim_eligible AND s.ord NOT IN (0, 1, 2, 11, 12)"""
    per_event = "event_key" if mode == "dcmp_regions" else "''"
    return [
        (
            "alive_locked",
            f"""SELECT district_key, event_key, alliance_name, (
                  SELECT COUNT(*) FROM roster r JOIN lock_status k
                    ON k.team_key = r.team_key AND k.district_key = a.district_key
                  WHERE r.event_key = a.event_key AND r.alliance_name = a.alliance_name
                    AND k.lock_status IN ('100%', 'Prequalified', 'Impact', 'EI', 'RAS')) AS locked
                FROM ({alive}) a""",
        ),
        (
            "wcmp_spots_v2",
            f"""SELECT district_key, CAST(wcmp_spots + COALESCE((SELECT SUM(least_locked) FROM (
                  SELECT MIN(locked) AS least_locked FROM alive_locked a
                  WHERE a.district_key = w.district_key GROUP BY {per_event})), 0) AS INTEGER)
                  AS wcmp_spots
                FROM wcmp_spots w""",
        ),
    ]


def ctes(mode: str) -> list[tuple[str, str]]:
    parts = [*oracle_ctes(mode), _roster()]
    if mode in ("district", "district_regions"):
        regional = mode == "district_regions"
        parts.append(_counted("counted", "event_teams", ""))
        if regional:
            parts.append(
                (
                    "event_regions",
                    """SELECT c.district_key, c.event_key, g.region, COUNT(*) AS team_count
                       FROM counted c JOIN region_lookup g ON g.team_key = c.team_key
                       GROUP BY ALL""",
                )
            )
        parts += _states(mode)
        parts += _team_states(mode)
        parts.append(_impact(regional))
        parts += _season_standings(regional)
        parts += _season_budget(regional)
        parts += _season_race(regional)
        return parts
    divisions = mode == "dcmp_divisions"
    if divisions:
        parts += _qualifiers(mode)
    parts += _states(mode)
    if divisions:
        parts.append(_finals())
    parts += _team_states(mode)
    if not divisions:
        parts += _qualifiers(mode)
    parts.append(_spots(mode))
    parts += _championship_standings(divisions)
    parts += _championship_budget(divisions)
    parts += _championship_race(mode, False)
    parts += _second_spots(mode)
    parts += _championship_race(mode, True)
    return parts


def oracle(mode: str, query: str) -> str:
    """A check query over the named results of a format: those it needs, each computed once."""
    wanted, needed = {*_names(query)}, []
    for name, sql in reversed(ctes(mode)):  # a query only reads earlier ones
        if name in wanted:
            wanted.update(_names(sql))
            needed.append(f"{name} AS MATERIALIZED ({sql})")
    return "WITH " + ",\n".join(reversed(needed)) + f"\n{query}"


def _names(sql: str) -> list[str]:
    return re.findall(r"[A-Za-z_][A-Za-z_0-9]*", sql)
