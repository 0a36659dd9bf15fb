"""Fixed values of the competition rules.

Every list and table here is a given constant: results depend on these exact values.
"""

import math
from statistics import NormalDist

# ---- event phases, in order -------------------------------------------------------
PHASES = [
    "Pre-Event",
    "Qualifications",
    "Selections",
    "Elims 1 to 7",
    "Elims 8",
    "Elims 9",
    "Elims 10",
    "Elims 11",
    "Elims 12",
    "Elims 13",
    "Finals",
    "Awards",
    "Completed",
]
UNKNOWN_PHASE = "ERROR"

# ---- event types --------------------------------------------------------------------
DISTRICT_EVENT = "District"
CHAMPIONSHIP = "District Championship"
DIVISION = "District Championship Division"

# ---- award types ----------------------------------------------------------------------
IMPACT_AWARD_TYPE = 0
QUALIFYING_AWARDS = {0: "Impact", 9: "EI", 10: "RAS"}
AWARD_PRIORITY = ["Impact", "EI", "RAS"]
# more distinct award types than this means that all awards were handed out
AWARD_TYPES_WHEN_OPEN = 10
# award points of a division: still open below, all handed out from
DIVISION_AWARDS_OPEN_BELOW = 180
DIVISION_AWARDS_DONE_FROM = 165

# ---- points an event still has to give, by phase --------------------------------------
# elimination points a district event still has to give
ELIMINATION_POINTS = {
    "Pre-Event": 213,
    "Qualifications": 213,
    "Selections": 213,
    "Elims 1 to 7": 213,
    "Elims 8": 174,
    "Elims 9": 135,
    "Elims 10": 114,
    "Elims 11": 93,
    "Elims 12": 72,
    "Elims 13": 53,
    "Finals": 31,
}
# part of the above that only goes to the event winner
WINNER_POINTS = 31
SELECTION_POINTS = 236
# what the single alliance-selection slots are worth, best first (they sum to 236)
SELECTION_SLOTS = [16, 16, 15, 15, 14, 14, 13, 13, 12, 12, 11, 11, 10, 10, 9, 9]
SELECTION_SLOTS += [8, 7, 6, 5, 4, 3, 2, 1]
# elimination points within reach of 0, 1, 2 ... 12 live regional teams
REGIONAL_ELIMINATION_CAP = [0, 30, 60, 90, 110, 130, 150, 163, 176, 189, 157, 164, 171]
REGIONAL_ELIMINATION_FULL = 213
SEASON_AWARD_POINTS = 68
ROOKIE_AWARD_POINTS = 8
ROOKIE_BONUS = 10
CHAMPIONSHIP_AWARD_POINTS = 60
IMPACT_POINTS = 10
QUALIFYING_AWARD_POINTS = 8
FINALS_SEMI_POINTS = 30
DIVISIONS_WITH_SEMIS = 4
# inflation of season points for every event whose qualification round is open
QUALS_FLOOR_POINTS = 4

# ---- colours ---------------------------------------------------------------------------
GREEN = "93C47D"
YELLOW = "FFD966"
PALE_GREEN = "B6D7A8"
RED = "E06666"
DARK_GREEN = "6AA84F"
BLUE = "6D9EEB"
PURPLE = "8E7CC3"

# ---- quality gate ----------------------------------------------------------------------
# least elimination points that must have been given out in a phase
ELIMINATION_FLOOR = {
    "Elims 8": 39,
    "Elims 9": 78,
    "Elims 10": 99,
    "Elims 11": 120,
    "Elims 12": 141,
    "Elims 13": 159,
    "Finals": 180,
    "Awards": 210,
}
# expected number of ranked teams: district, teams, teams that may be missing
EXPECTED_TEAM_COUNTS = [
    ("2026ca", 296, 0),
    ("2026fch", 118, 1),
    ("2026fim", 531, 0),
    ("2026fin", 69, 0),
    ("2026fit", 181, 0),
    ("2026fma", 143, 0),
    ("2026fnc", 90, 1),
    ("2026fsc", 40, 0),
    ("2026isr", 70, 0),
    ("2026ne", 200, 0),
    ("2026ont", 120, 1),
    ("2026pch", 75, 0),
    ("2026pnw", 126, 0),
    ("2026win", 71, 0),
]

# ---- exceptions --------------------------------------------------------------------------
EXCLUDED_EVENTS = ["2025tempclone-356125237", "2026txabi"]
SHORT_BRACKET_EVENTS = ["2026txmca", "2026schop"]
# district, roster places whose members qualify by winning, RAS qualifies, winners assumed
CHAMPIONSHIP_EXCEPTIONS = [("2025fsc", 2, False, 2)]
ASSUMED_WINNERS = 4

# ---- lookups -------------------------------------------------------------------------------
# district_key, display_name, dcmp_name, dcmp_capacity, wcmp_capacity, dcmp_impact_awards,
# dcmp_ei_awards, dcmp_ras_awards, dcmp_directional_labels
DISTRICTS = [
    ("2024fma", "Mid-Atlantic", "District Championship", 60, 22, 2, 2, 1, False),
    ("2024fin", "Indiana", "State Championship", 38, 11, 1, 1, 1, False),
    ("2024fim", "Michigan", "State Championship", 160, 86, 5, 1, 2, False),
    ("2024ne", "New England", "District Championship", 96, 31, 3, 2, 1, False),
    ("2024ont", "Ontario", "Provincial Championship", 100, 23, 3, 1, 1, False),
    ("2025chs", "Chesapeake", "District Championship", 54, 17, 2, 2, 1, False),
    ("2025isr", "Israel", "National Championship", 45, 10, 1, 1, 1, False),
    ("2025fin", "Indiana", "State Championship", 38, 12, 1, 1, 1, False),
    ("2025fim", "Michigan", "State Championship", 160, 80, 4, 1, 2, False),
    ("2025fma", "Mid-Atlantic", "District Championship", 60, 23, 2, 2, 1, False),
    ("2025ne", "New England", "District Championship", 96, 31, 3, 2, 1, False),
    ("2025fnc", "North Carolina", "State Championship", 40, 14, 1, 2, 2, False),
    ("2025ont", "Ontario", "Provincial Championship", 100, 22, 2, 1, 1, False),
    ("2025pnw", "Pacific Northwest", "District Championship", 50, 22, 2, 2, 1, False),
    ("2025pch", "Peachtree", "State Championship", 45, 12, 1, 2, 1, False),
    ("2025fsc", "South Carolina", "State Championship", 28, 5, 1, 1, 0, False),
    ("2025fit", "Texas", "State Championship", 90, 28, 2, 2, 2, False),
    ("2026fch", "Chesapeake", "District Championship", 54, 19, 2, 1, 1, False),
    ("2026isr", "Israel", "National Championship", 42, 12, 1, 1, 1, False),
    ("2026fin", "Indiana", "State Championship", 38, 12, 1, 2, 0, False),
    ("2026fim", "Michigan", "State Championship", 160, 83, 5, 1, 2, False),
    ("2026fma", "Mid-Atlantic", "District Championship", 66, 23, 2, 2, 1, False),
    ("2026ne", "New England", "District Championship", 100, 32, 4, 2, 1, False),
    ("2026fnc", "North Carolina", "State Championship", 50, 15, 1, 2, 2, False),
    ("2026ont", "Ontario", "Provincial Championship", 100, 21, 2, 1, 1, False),
    ("2026pnw", "Pacific Northwest", "District Championship", 50, 21, 2, 2, 1, False),
    ("2026pch", "Peachtree", "State Championship", 45, 13, 2, 2, 1, False),
    ("2026fsc", "South Carolina", "State Championship", 32, 7, 1, 1, 1, False),
    ("2026fit", "Texas", "State Championship", 90, 28, 2, 2, 2, False),
    ("2026win", "Wisconsin", "District Championship", 36, 12, 1, 1, 1, False),
    ("2026ca", "California", "State Championship", 60, 46, 4, 2, 2, True),
]
# district_key, team_key, points_adjustment
POINTS_ADJUSTMENTS = [
    ("2025fit", "frc6672", 7),
    ("2025fit", "frc2689", 7),
    ("2025fit", "frc2158", 7),
    ("2025fit", "frc7691", 3),
    ("2025fit", "frc4597", 2),
    ("2025fit", "frc9658", 1),
    ("2025fit", "frc5261", 1),
    ("2025fit", "frc10014", 1),
    ("2025fit", "frc9517", 1),
    ("2025fnc", "frc2642", 2),
    ("2025fnc", "frc8746", 1),
    ("2025fnc", "frc4828", 1),
    ("2025fnc", "frc4829", 1),
    ("2025fnc", "frc2059", 1),
    ("2025fnc", "frc9789", 1),
    ("2025fnc", "frc6240", 1),
    ("2025pnw", "frc9567", -3),
    ("2025pnw", "frc1425", 1),
    ("2025pnw", "frc9430", 1),
    ("2025pnw", "frc9600", 1),
    ("2025pnw", "frc4043", 1),
]
# district_key, team_key
PREQUALIFIED_TEAMS = [
    ("2024fin", "frc45"),
    ("2024fma", "frc341"),
    ("2025chs", "frc1629"),
    ("2025isr", "frc5614"),
    ("2025isr", "frc1690"),
    ("2025isr", "frc9739"),
    ("2025fim", "frc2834"),
    ("2025fim", "frc27"),
    ("2025fim", "frc503"),
    ("2025fma", "frc321"),
    ("2025fnc", "frc9008"),
    ("2025fnc", "frc2642"),
    ("2025ont", "frc1114"),
    ("2026fma", "frc321"),
    ("2026fim", "frc503"),
    ("2026fch", "frc1629"),
    ("2026fim", "frc2834"),
]
TEAM_KEY_PREFIX = "frc"

# ---- qualification points --------------------------------------------------------------------
# Sizes of event for which qualification points are defined, and the shape constant of the
# published ranking-points formula (inverse error function of the relative rank).
EVENT_SIZES = range(10, 80)
QUAL_POINTS_ALPHA = 1.07


def qual_points(size: int, rank: int) -> int:
    """Qualification points of the team at ``rank`` in an event of ``size`` teams."""

    def inverse_erf(x: float) -> float:
        return NormalDist().inv_cdf((x + 1) / 2) / math.sqrt(2)

    spread = inverse_erf((size - 2 * rank + 2) / (QUAL_POINTS_ALPHA * size))
    return math.ceil(spread * 10 / inverse_erf(1 / QUAL_POINTS_ALPHA) + 12)


def qual_points_rows() -> list[tuple[int, int, int]]:
    """All (event_size, team_rank, qual_points) rows; 3,115 of them."""
    return [
        (size, rank, qual_points(size, rank))
        for size in EVENT_SIZES
        for rank in range(1, size + 1)
    ]
