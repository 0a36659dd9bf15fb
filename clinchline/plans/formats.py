"""The five competition formats, as data.

All operators are shared; a ``Format`` holds what differs between formats. ``scope`` names
extra key columns (for example a snapshot date) that are carried through every key, so
that many snapshots of all districts run as one job.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from clinchline.fixed_values import CHAMPIONSHIP, DISTRICT_EVENT, DIVISION


@dataclass(frozen=True)
class Reach:
    """Most points a team can win per open chance; the counters are those of standings."""

    quals: int
    selections: int
    double_elims: int
    finals: int
    awards: int
    semis: int = 0


@dataclass(frozen=True)
class Format:
    name: str
    tracked_type: str  # type of the events whose phase is classified
    championship: bool = False
    regional: bool = False  # standings are split by region
    several_championships: bool = False  # spots are counted event by event
    divisions: bool = False
    multiplier: int = 1
    full_award_points: int | None = 10  # best award score once all awards are in
    reach: Reach = Reach(18, 16, 20, 10, 8)
    second_reach: Reach | None = None
    winner_keeps_points: bool = True  # the event winner's points count in the budget
    short_brackets: bool = False
    scope: tuple[str, ...] = ()

    @property
    def district(self) -> list[str]:
        """Key of one race for spots."""
        return [*self.scope, "district_key", *(["region"] if self.regional else [])]

    @property
    def team(self) -> list[str]:
        return [*self.district, "team_key"]

    @property
    def event(self) -> list[str]:
        return [*self.scope, "event_key"]

    @property
    def event_team(self) -> list[str]:
        return [*self.event, "team_key"]

    @property
    def home(self) -> list[str]:
        """Key of a district, without the region split."""
        return [*self.scope, "district_key"]

    @property
    def home_team(self) -> list[str]:
        return [*self.home, "team_key"]

    @property
    def race_points(self) -> str:
        """The points column in which contenders are compared."""
        return "points" if self.championship else "inflated_points"

    def with_scope(self, *columns: str) -> Format:
        return replace(self, scope=tuple(columns))


_SEASON = Format("district", DISTRICT_EVENT, short_brackets=True)
_CHAMPIONSHIP = Format(
    "dcmp",
    CHAMPIONSHIP,
    championship=True,
    multiplier=3,
    full_award_points=30,
    # nobody races for the winner's points: the winner qualifies anyway
    reach=Reach(22, 16, 20, 0, 5),
    second_reach=Reach(18, 16, 20, 10, 5),
    winner_keeps_points=False,
)

FORMATS: dict[str, Format] = {
    f.name: f
    for f in (
        _SEASON,
        replace(_SEASON, name="district_regions", regional=True, short_brackets=False),
        _CHAMPIONSHIP,
        replace(_CHAMPIONSHIP, name="dcmp_regions", several_championships=True),
        replace(
            _CHAMPIONSHIP,
            name="dcmp_divisions",
            tracked_type=DIVISION,
            divisions=True,
            full_award_points=None,
            reach=Reach(18, 16, 20, 10, 5, semis=10),
            second_reach=Reach(18, 16, 20, 10, 5, semis=10),
            winner_keeps_points=True,
        ),
    )
}


def format_for(mode: str) -> Format:
    """Format of a mode name; unknown names fall back to the plain season format."""
    return FORMATS.get(mode, FORMATS["district"])
