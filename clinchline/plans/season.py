"""One run: the operators composed for a format.

``SeasonRun`` names every result table of a run and builds each at most once, on first
use. Only the few results with several readers are staged; with a shared folder that writes
them at once, all else waits for an action.
"""

from __future__ import annotations

from collections.abc import Callable
from contextlib import nullcontext
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from clinchline.operators import budget, clinch, phases, qualifiers, quality, reports, standings
from clinchline.plans.formats import Format
from clinchline.plans.stages import TOGETHER, Stages, joined_where_kept, planned_by_rows, run_together
from clinchline.sources.inputs import SeasonInputs


#: Results with several readers, staged on first use.
ALWAYS_STAGED = {
    "event_states",
    "dcmp_finals_state",
    "qualifying_award_winners",
    "wcmp_spots_v2",
    "totals",
    "adjusted_district_rankings",
    "open_rankings",
    "district_points_remaining",
}


class SeasonRun:
    def __init__(
        self,
        spark: SparkSession,
        inputs: SeasonInputs,
        fmt: Format,
        stages: Stages | None = None,
        fix_region_fanout: bool = False,
    ):
        self.spark = spark
        self.inputs = inputs
        self.fmt = fmt
        self.stages = stages or Stages(spark)
        self.fix_region_fanout = fix_region_fanout
        self._ready: dict[str, DataFrame] = {}

    def _keep_of_events(self, result: Callable[[], DataFrame], name: str) -> DataFrame:
        """Keep a result of tables of events, joined where their events are kept.

        Only for short chains of joins: each sorts in the same task, and every sort holds a page of its memory.
        """
        with joined_where_kept(self.spark) if self.inputs.dealt else nullcontext():
            return self.stages.keep(result, name)

    # ---- phases ------------------------------------------------------------------------

    @cached_property
    def event_regions(self) -> DataFrame | None:
        if not self.fmt.regional:
            return None
        if self.inputs.region_lookup is None:
            raise ValueError("a format with regions needs region_lookup: team_key, region")
        return phases.event_regions(self.inputs, self.fmt)

    @cached_property
    def event_states(self) -> DataFrame:
        return self.stages.keep(
            lambda: phases.event_states(
                self.inputs, self.fmt, self.event_regions, self.fix_region_fanout
            ),
            "event_states",
        )

    @cached_property
    def dcmp_finals_state(self) -> DataFrame | None:
        if not self.fmt.divisions:
            return None
        return self.stages.keep(
            lambda: phases.finals_states(
                self.inputs, self.fmt, self.event_states, self.qualifying_award_winners
            ),
            "dcmp_finals_state",
        )

    @cached_property
    def team_event_states(self) -> DataFrame:
        if self.fmt.divisions:
            return phases.division_team_states(
                self.inputs, self.fmt, self.event_states, self.dcmp_finals_state
            )
        return phases.team_event_states(self.inputs, self.fmt, self.event_states)

    # ---- qualified teams and spots -------------------------------------------------------

    @cached_property
    def impact_award_winners(self) -> DataFrame:
        return qualifiers.impact_award_winners(self.inputs, self.fmt)

    @cached_property
    def qualifying_award_winners(self) -> DataFrame:
        return self.stages.keep(
            lambda: qualifiers.qualifying_award_winners(
                self.inputs, self.fmt, None if self.fmt.divisions else self.event_states
            ),
            "qualifying_award_winners",
        )

    @property
    def _deciding_states(self) -> DataFrame:
        return self.dcmp_finals_state if self.fmt.divisions else self.event_states

    @cached_property
    def wcmp_spots(self) -> DataFrame:
        return qualifiers.championship_spots(
            self.inputs, self.fmt, self._deciding_states, self.qualifying_award_winners
        )

    @cached_property
    def wcmp_spots_v2(self) -> DataFrame:
        return self.stages.keep(
            lambda: qualifiers.guaranteed_spots(
                self.inputs,
                self.fmt,
                self.wcmp_spots,
                self.team_event_states,
                self._deciding_states,
                self.lock_status,
            ),
            "wcmp_spots_v2",
        )

    # ---- standings -----------------------------------------------------------------------

    @cached_property
    def totals(self) -> DataFrame:
        needed = self.event_states, self.team_event_states, self.dcmp_finals_state
        return self._keep_of_events(lambda: self._totals(*needed), "totals")

    def _totals(
        self, states: DataFrame, team_states: DataFrame, finals: DataFrame | None
    ) -> DataFrame:
        if self.fmt.championship:
            return standings.championship_totals(self.inputs, self.fmt, states, team_states, finals)
        return standings.season_totals(self.inputs, self.fmt, states, team_states)

    @cached_property
    def adjusted_district_rankings(self) -> DataFrame:
        return self.stages.keep(
            lambda: standings.adjusted_rankings(self.totals, self.fmt),
            "adjusted_district_rankings",
        )

    @cached_property
    def open_rankings(self) -> DataFrame:
        """Rankings without teams that are qualified by an award or a win."""
        return self.stages.keep(
            lambda: standings.open_rankings(
                self.adjusted_district_rankings,
                self.qualifying_award_winners if self.fmt.championship else self.impact_award_winners,
                self.fmt,
            ),
            "open_rankings",
        )

    # ---- budget --------------------------------------------------------------------------

    @cached_property
    def event_points_remaining(self) -> DataFrame:
        i, f, s = self.inputs, self.fmt, self.event_states
        if f.championship:
            return budget.championship_event_budget(i, f, s, self.dcmp_finals_state)
        if f.regional:
            return budget.regional_event_budget(
                i, f, s, self.event_regions, self.team_event_states
            )
        return budget.season_event_budget(i, f, s)

    @cached_property
    def district_points_remaining(self) -> DataFrame:
        return self.stages.keep(
            lambda: budget.district_budget(
                self.inputs,
                self.fmt,
                self.event_points_remaining,
                self.event_states,
                self.event_regions,
            ),
            "district_points_remaining",
        )

    # ---- race ----------------------------------------------------------------------------

    @cached_property
    def _places(self) -> DataFrame:
        if self.fmt.championship:
            return clinch.championship_places(self.wcmp_spots, self.fmt)
        return clinch.season_places(
            self.inputs, self.fmt, self.impact_award_winners, self.district_points_remaining
        )

    @cached_property
    def _second_places(self) -> DataFrame:
        return clinch.championship_places(self.wcmp_spots_v2, self.fmt)

    @cached_property
    def teams_to_pass(self) -> DataFrame:
        return clinch.teams_to_pass(self.open_rankings, self._places, self.fmt)

    @cached_property
    def teams_to_pass_v2(self) -> DataFrame:
        return clinch.teams_to_pass(self.open_rankings, self._second_places, self.fmt)

    @cached_property
    def pass_summary(self) -> DataFrame:
        return clinch.pass_summary(
            self.open_rankings, self.teams_to_pass, self.fmt, self.fmt.reach
        )

    @cached_property
    def pass_summary_v2(self) -> DataFrame:
        return clinch.pass_summary(
            self.open_rankings, self.teams_to_pass_v2, self.fmt, self.fmt.second_reach
        )

    @cached_property
    def following_teams(self) -> DataFrame:
        return clinch.following_teams(
            self.open_rankings, self.teams_to_pass, self.fmt, self.fmt.reach, self.pass_summary
        )

    @cached_property
    def following_teams_v2(self) -> DataFrame:
        return clinch.following_teams(
            self.open_rankings,
            self.teams_to_pass_v2,
            self.fmt,
            self.fmt.second_reach,
            self.pass_summary_v2,
        )

    @cached_property
    def lock_status(self) -> DataFrame:
        if self.fmt.championship:
            return self.stages.keep(
                lambda: self._championship_status(self.teams_to_pass, self.pass_summary, self._places),
                "lock_status",
            )
        return clinch.season_lock_status(
            self.inputs,
            self.fmt,
            self.event_states,
            self.adjusted_district_rankings,
            self.open_rankings,
            self.teams_to_pass,
            self.pass_summary,
            self.impact_award_winners,
            self.district_points_remaining,
        )

    @cached_property
    def lock_status_v2(self) -> DataFrame:
        return self._championship_status(
            self.teams_to_pass_v2, self.pass_summary_v2, self._second_places
        )

    def _championship_status(
        self, to_pass: DataFrame, summary: DataFrame, places: DataFrame
    ) -> DataFrame:
        return clinch.championship_lock_status(
            self.fmt,
            self.adjusted_district_rankings,
            self.open_rankings,
            to_pass,
            summary,
            self.qualifying_award_winners,
            places,
            self.district_points_remaining,
        )

    @property
    def published_status(self) -> DataFrame:
        """The status that is published: the second look where the format has one."""
        return self.lock_status_v2 if self.fmt.second_reach else self.lock_status

    @property
    def published_followers(self) -> DataFrame:
        return self.following_teams_v2 if self.fmt.second_reach else self.following_teams

    # ---- quality and reports ---------------------------------------------------------------

    @cached_property
    def event_checks(self) -> DataFrame:
        return quality.event_checks(self.inputs, self.fmt, self.event_states)

    @cached_property
    def team_count_checks(self) -> DataFrame:
        return quality.team_count_checks(
            self.inputs, self.fmt, quality.expected_team_counts(self.spark)
        )

    @cached_property
    def gate(self) -> DataFrame:
        gate = quality.gate(self.event_checks, self.team_count_checks, self.fmt)
        return quality.hold_back_unranked(gate, self.inputs, self.fmt)

    def result_tables(self) -> dict[str, DataFrame]:
        """Every result table of the format, by name, in dependency order."""
        f = self.fmt
        tables = {"event_regions": self.event_regions} if f.regional else {}
        if f.championship:
            tables["qualifying_award_winners"] = self.qualifying_award_winners
        tables["event_states"] = self.event_states
        if f.divisions:
            tables["dcmp_finals_state"] = self.dcmp_finals_state
        tables["team_event_states"] = self.team_event_states
        if f.championship:
            tables["wcmp_spots"] = self.wcmp_spots
        else:
            tables["impact_award_winners"] = self.impact_award_winners
        tables["adjusted_district_rankings"] = self.adjusted_district_rankings
        open_name = "qualify_awards" if f.championship else "impact"
        tables[f"district_rankings_without_{open_name}"] = self.open_rankings
        tables["event_points_remaining"] = self.event_points_remaining
        tables["district_points_remaining"] = self.district_points_remaining
        tables["teams_to_pass"] = self.teams_to_pass
        tables["following_teams"] = self.following_teams
        tables["lock_status"] = self.lock_status
        if f.second_reach:
            tables["wcmp_spots_v2"] = self.wcmp_spots_v2
            tables["teams_to_pass_v2"] = self.teams_to_pass_v2
            tables["following_teams_v2"] = self.following_teams_v2
            tables["lock_status_v2"] = self.lock_status_v2
        return tables

    def report_tables(self) -> dict[str, DataFrame]:
        """The report tables of the format, of districts that pass the gate."""
        i, f = self.inputs, self.fmt
        states, amounts = self.event_states, self.event_points_remaining
        header = reports.team_header(self.published_status, f)
        if f.divisions:
            events = reports.division_events(i, states, self.dcmp_finals_state, amounts, f)
        elif f.championship:
            events = reports.championship_events(i, states, amounts, f)
        else:
            events = reports.season_events(states, amounts, f)
        owners = i.events.select(*f.home, "event_key")
        open_teams = reports.team_pages(header, f)
        tables = {
            "rankings": reports.rankings(self.published_status, f),
            "events": events,
            "district_stats": reports.district_stats(i, self.district_points_remaining, f),
            "event_pages": reports.event_page(states, amounts, f).join(owners, f.event),
            "team_pages": open_teams,
            "team_followers": reports.team_followers(self.published_followers, f).join(
                open_teams.select(*f.home_team), f.home_team, "left_semi"
            ),
            "pages": reports.page_index(i, f, header, self.event_regions),
        }
        passed = self.gate.where("publish").select(*f.home)
        return {n: t.join(passed, f.home, "left_semi") for n, t in tables.items()}

    # ---- order of the stages -----------------------------------------------------------------

    def needs(self) -> dict[str, tuple[str, ...]]:
        """The results that each result is built from, as far as they hold up others."""
        f = self.fmt
        states = ("event_states", *(["dcmp_finals_state"] if f.divisions else []))
        winners = ("qualifying_award_winners",) if f.championship else ()
        needs = {
            "event_states": (),
            "team_event_states": states,
            "totals": ("team_event_states",),
            "adjusted_district_rankings": ("totals",),
            "open_rankings": ("adjusted_district_rankings", *winners),
            "event_points_remaining": states,
            "district_points_remaining": ("event_points_remaining",),
            "teams_to_pass": ("open_rankings", "district_points_remaining"),
        }
        if f.championship:
            needs["qualifying_award_winners"] = () if f.divisions else ("event_states",)
            needs["wcmp_spots"] = (*states, *winners)
            needs["teams_to_pass"] = ("open_rankings", "wcmp_spots")
        if f.divisions:
            needs["dcmp_finals_state"] = ("event_states", "qualifying_award_winners")
        needs["pass_summary"] = ("teams_to_pass",)
        needs["following_teams"] = ("pass_summary",)
        needs["lock_status"] = ("pass_summary", "district_points_remaining")
        if f.second_reach:
            needs["wcmp_spots_v2"] = ("lock_status", "wcmp_spots", "team_event_states")
            needs["teams_to_pass_v2"] = ("wcmp_spots_v2",)
            needs["pass_summary_v2"] = ("teams_to_pass_v2",)
            needs["following_teams_v2"] = ("pass_summary_v2",)
            needs["lock_status_v2"] = ("pass_summary_v2",)
        return needs

    def prepare(self, *names: str) -> None:
        """Stage what these results need; stages that do not need each other run together."""
        needs = self.needs()
        ahead = [k for name in names for k in needs.get(name, ())]
        run_together(needs, lambda name: getattr(self, name), ahead)

    def ready(self, name: str) -> DataFrame:
        """A result, what it needs staged first.

        Where stages are written, it is staged too, so that its own joins are planned here: left to the action that reads
        it, they would be planned by the sizes of staged files, and the driver would make broadcasts that its memory does
        not hold. Persisted stages know the size of their rows.
        """
        if self.stages.folder is None:
            self.prepare(name)
            return getattr(self, name)
        if name not in self._ready:
            with planned_by_rows(self.spark):
                self.prepare(name)
                made = getattr(self, name)
                self._ready[name] = made if self._always_staged(name) else self.stages.keep(made, name)
        return self._ready[name]

    def ready_status(self) -> DataFrame:
        """The published status, what it needs staged first."""
        return self.ready("lock_status_v2" if self.fmt.second_reach else "lock_status")

    def stage_results(self, together: bool = True) -> None:
        """Stage the results that tables and reports both read."""
        needs = self.needs()
        run_together(needs, self.stage, needs, TOGETHER if together else 1)

    def _always_staged(self, name: str) -> bool:
        return name in ALWAYS_STAGED or (name == "lock_status" and self.fmt.championship)

    def stage(self, name: str) -> None:
        """Stage a result, whether or not it holds up others."""
        if not self._always_staged(name):
            self.__dict__[name] = self.stages.keep(
                lambda: getattr(type(self), name).func(self), name
            )
        else:
            getattr(self, name)

    def release(self) -> None:
        self.stages.release()


def run_season(
    spark: SparkSession, inputs: SeasonInputs, fmt: Format, folder: str
) -> SeasonRun:
    """Build all tables of a run and write them and the reports below ``folder``."""
    run = SeasonRun(spark, inputs, fmt)
    try:
        with planned_by_rows(spark):
            _write_season(run, folder)
    finally:
        run.release()
    return run


def _write_season(run: SeasonRun, folder: str) -> None:
    from clinchline.sources.landed import short_sides
    from clinchline.sources.tables import write_reports, write_tables

    inputs, fmt = run.inputs, run.fmt
    run.stage_results()
    owners = inputs.events.select(*fmt.home, "event_key").distinct()
    write_tables(run.result_tables(), f"{folder}/tables", fmt, owners)
    checks = {
        "gate": run.gate,
        "event_checks": run.event_checks,
        "open_questions": quality.open_questions(inputs, fmt, run.event_states),
        "short_sides": short_sides(inputs.matches, fmt.event),
    }
    write_tables(checks, f"{folder}/quality", fmt, owners)
    write_reports(run.report_tables(), f"{folder}/reports", fmt)
