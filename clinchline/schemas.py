"""Schemas, as DDL text, of the raw tables, the lookups and the landed JSON.

DDL text is accepted by every reader and by ``createDataFrame``; nothing is inferred.
"""

# ---- raw tables -----------------------------------------------------------------

EVENTS = (
    "district_key string, event_key string, name string, event_type string, "
    "start_date date, end_date date"
)
EVENT_TEAMS = "event_key string, team_key string"
MATCHES = (
    "match_key string, event_key string, comp_level string, match_number int, "
    "winning_alliance string, red_score int, blue_score int, "
    "red_1_key string, red_2_key string, red_3_key string, "
    "blue_1_key string, blue_2_key string, blue_3_key string"
)
ALLIANCES = (
    "event_key string, alliance_name string, captain_key string, "
    "first_selection_key string, second_selection_key string, backup_key string"
)
AWARDS = "event_key string, award_type int, team_key string"
EVENT_POINTS = (
    "event_key string, team_key string, points int, qual_points int, "
    "selection_points int, elim_points int, award_points int"
)
DISTRICT_RANKINGS = (
    "district_key string, team_key string, rank int, points int, rookie_bonus int"
)

RAW_TABLES = {
    "events": EVENTS,
    "event_teams": EVENT_TEAMS,
    "matches": MATCHES,
    "alliances": ALLIANCES,
    "awards": AWARDS,
    "event_points": EVENT_POINTS,
    "district_rankings": DISTRICT_RANKINGS,
}

# ---- lookups --------------------------------------------------------------------

QUAL_POINTS = "event_size int, team_rank int, qual_points int"
DISTRICT_LOOKUP_CSV = (
    "district_key string, display_name string, dcmp_name string, dcmp_capacity string, "
    "wcmp_capacity string, dcmp_impact_awards string, dcmp_ei_awards string, "
    "dcmp_ras_awards string, dcmp_directional_labels string"
)
DISTRICT_LOOKUP = (
    "district_key string, display_name string, dcmp_name string, dcmp_capacity int, "
    "wcmp_capacity int, dcmp_impact_awards int, dcmp_ei_awards int, "
    "dcmp_ras_awards int, dcmp_directional_labels boolean"
)
POINTS_ADJUSTMENTS = "district_key string, team_key string, points_adjustment int"
PREQUALIFIED_TEAMS = "district_key string, team_key string"
REGION_LOOKUP = "team_key string, region string"
SHORT_BRACKETS = "event_key string"
CHAMPIONSHIP_RULES = (
    "district_key string, picks_sent int, sends_ras boolean, assumed_winners int"
)

# ---- landed JSON (one row per array element after the read) -----------------------

EVENTS_JSON = (
    "key string, short_name string, event_type_string string, start_date string, "
    "end_date string"
)
EVENT_TEAMS_JSON = "key string"
MATCHES_JSON = (
    "key string, comp_level string, match_number int, winning_alliance string, "
    "alliances struct<red: struct<score: int, team_keys: array<string>>, "
    "blue: struct<score: int, team_keys: array<string>>>"
)
ALLIANCES_JSON = "name string, picks array<string>"
AWARDS_JSON = (
    "event_key string, award_type int, recipient_list array<struct<team_key: string>>"
)
EVENT_POINTS_JSON = (
    "points map<string, struct<total: int, qual_points: int, alliance_points: int, "
    "elim_points: int, award_points: int>>"
)
RANKINGS_JSON = "team_key string, rank int, point_total int, rookie_bonus int"
RANKING_PAGES_JSON = (
    "districtRanks array<struct<teamNumber: int, rank: int, totalPoints: int, "
    "teamAgePoints: int>>, pageTotal int"
)
