"""Phase of every event, regional attendance, and what each team can still win."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from clinchline import fixed_values as fv
from clinchline.functions.columns import none_of, phases_before, total_if
from clinchline.functions.ranking import first_per_key
from clinchline.operators import rosters
from clinchline.plans.formats import Format
from clinchline.sources.inputs import SeasonInputs

COUNTED_EVENTS = 2


def counted_registrations(inputs: SeasonInputs, fmt: Format) -> DataFrame:
    """The first two district events each team is registered for, by date."""
    events = inputs.events.where(F.col("event_type") == fv.DISTRICT_EVENT)
    entries = inputs.event_teams.join(
        events.select(*fmt.home, "event_key", "start_date"), fmt.event
    )
    return first_per_key(
        entries,
        fmt.home_team,
        [F.col("start_date").asc(), F.col("event_key").asc()],
        COUNTED_EVENTS,
    ).select(*fmt.home_team, "event_key")


def event_regions(inputs: SeasonInputs, fmt: Format) -> DataFrame:
    """Which regions an event counts for, and how many of their teams it counts for."""
    return (
        counted_registrations(inputs, fmt)
        .join(inputs.region_lookup, "team_key")
        .groupBy(*fmt.home, "event_key", "region")
        .agg(F.count(F.lit(1)).alias("team_count"))
    )


def match_facts(matches: DataFrame, fmt: Format) -> DataFrame:
    """All match counts of an event in one pass over the matches."""
    level, winner = F.col("comp_level"), F.col("winning_alliance")
    score = F.coalesce(
        F.nullif(F.col("red_score"), F.lit(-1)), F.nullif(F.col("blue_score"), F.lit(-1))
    )
    return matches.groupBy(*fmt.event).agg(
        F.count_distinct(F.when(level == "qm", F.col("match_key"))).alias("quals"),
        F.count(F.when(level == "qm", score)).alias("quals_played"),
        F.count("match_key").alias("matches_listed"),
        total_if((level == "sf") & rosters.decided()).alias("semis_decided"),
        total_if(level.isin("sf", "f") & rosters.decided()).alias("playoffs_decided"),
        total_if((level == "f") & (winner == "red")).alias("red_finals"),
        total_if((level == "f") & (winner == "blue")).alias("blue_finals"),
    )


def _first_match(steps: list[tuple[Column, Column | str]], default: str) -> Column:
    chain = F
    for condition, value in steps:
        chain = chain.when(condition, value)
    return chain.otherwise(default)


def _awards_closing(fmt: Format) -> tuple[Column, Column]:
    """Conditions for: awards still being given, all awards given."""
    types, best, given = F.col("award_types"), F.col("best_award"), F.col("award_sum")
    few = types <= fv.AWARD_TYPES_WHEN_OPEN
    if fmt.full_award_points is None:
        return (
            few & (given < fv.DIVISION_AWARDS_OPEN_BELOW),
            ~few & (given >= fv.DIVISION_AWARDS_DONE_FROM),
        )
    return few | (best < fmt.full_award_points), ~few & (best == fmt.full_award_points)


def event_states(
    inputs: SeasonInputs,
    fmt: Format,
    regions: DataFrame | None = None,
    fix_region_fanout: bool = False,
) -> DataFrame:
    """Phase and colour of every tracked event.

    With regions, an event that counts for two regions has its decided playoff matches
    counted once per region unless ``fix_region_fanout`` is set.
    """
    events = inputs.events.where(F.col("event_type") == fmt.tracked_type)
    facts = (
        events.join(match_facts(inputs.matches, fmt), fmt.event, "left")
        .join(
            inputs.alliances.groupBy(*fmt.event).agg(
                F.count_distinct("alliance_name").alias("alliances")
            ),
            fmt.event,
            "left",
        )
        .join(
            inputs.awards.groupBy(*fmt.event).agg(
                F.count_distinct("award_type").alias("award_types")
            ),
            fmt.event,
            "left",
        )
        .join(
            inputs.event_points.groupBy(*fmt.event).agg(
                F.max("award_points").alias("best_award"),
                F.sum("award_points").alias("award_sum"),
            ),
            fmt.event,
            "left",
        )
    )
    times: Column = F.lit(1)
    if fmt.regional:
        copies = regions.groupBy(*fmt.home, "event_key").agg(
            F.count(F.lit(1)).alias("region_copies")
        )
        facts = facts.join(copies, [*fmt.home, "event_key"])
        times = F.lit(1) if fix_region_fanout else F.col("region_copies")
    full_bracket: Column = F.lit(True)
    if fmt.short_brackets and inputs.short_brackets is not None:
        short = inputs.short_brackets.select("event_key").distinct()
        facts = facts.join(
            short.withColumn("_short", F.lit(True)), "event_key", "left"
        )
        full_bracket = F.col("_short").isNull()
    facts = facts.fillna(0, ["quals", "alliances", "award_types"]).withColumns(
        {c: F.col(c) * times for c in ("semis_decided", "red_finals", "blue_finals")}
    )

    quals, played = F.col("quals"), F.col("quals_played")
    alliances, semis = F.col("alliances"), F.col("semis_decided")
    giving, given = _awards_closing(fmt)
    state = _first_match(
        [
            (quals == 0, "Pre-Event"),
            (played < quals, "Qualifications"),
            ((played == quals) & (alliances == 0), "Selections"),
            ((alliances > 0) & (semis < 7), "Elims 1 to 7"),
            (
                full_bracket & semis.between(1, 12),
                F.concat(F.lit("Elims "), (semis + 1).cast("string")),
            ),
            ((F.col("red_finals") < 2) & (F.col("blue_finals") < 2), "Finals"),
            (giving, "Awards"),
            (given, "Completed"),
        ],
        fv.UNKNOWN_PHASE,
    )
    return facts.withColumn("event_state", state).select(
        *fmt.event,
        "district_key",
        "name",
        "event_type",
        "start_date",
        "end_date",
        "event_state",
        _phase_color(F.col("event_state")).alias("color"),
    )


def _phase_color(state: Column) -> Column:
    return (
        F.when(state == "Completed", fv.GREEN)
        .when(state == "Pre-Event", fv.YELLOW)
        .otherwise(fv.PALE_GREEN)
    )


def finals_states(
    inputs: SeasonInputs, fmt: Format, states: DataFrame, qualifiers: DataFrame
) -> DataFrame:
    """Phase of the event in which the division winners meet."""
    finals = inputs.events.where(F.col("event_type") == fv.CHAMPIONSHIP)
    impact = (
        qualifiers.where(F.col("award_type") == "Impact")
        .groupBy(*fmt.home)
        .agg(F.count(F.lit(1)).alias("impact_winners"))
    )
    divisions = states.groupBy(*fmt.home).agg(
        F.count_distinct("event_key").alias("num_dcmp_divisions")
    )
    facts = (
        finals.join(match_facts(inputs.matches, fmt), fmt.event, "left")
        .join(inputs.district_lookup, "district_key")
        .join(divisions, fmt.home)
        .join(impact, fmt.home, "left")
        .fillna(0, ["matches_listed", "impact_winners"])
    )
    semis = F.col("semis_decided")
    winners, expected = F.col("impact_winners"), F.col("dcmp_impact_awards")
    state = _first_match(
        [
            (F.col("matches_listed") == 0, "Pre-Event"),
            (F.col("playoffs_decided") == 0, "Elims 1"),
            (semis.between(1, 4), F.concat(F.lit("Elims "), (semis + 1).cast("string"))),
            ((F.col("red_finals") < 2) & (F.col("blue_finals") < 2), "Finals"),
            (winners < expected, "Awards"),
            (winners >= expected, "Completed"),
        ],
        fv.UNKNOWN_PHASE,
    )
    return facts.withColumn("event_state", state).select(
        *fmt.home,
        "event_key",
        F.concat("display_name", F.lit(" "), "dcmp_name", F.lit(" Finals")).alias("name"),
        "event_type",
        "num_dcmp_divisions",
        "event_state",
        F.when(F.col("event_state") == "Completed", fv.GREEN)
        .otherwise(fv.YELLOW)
        .alias("color"),
    )


def team_event_states(inputs: SeasonInputs, fmt: Format, states: DataFrame) -> DataFrame:
    """Per team of a running event: can it still win an award, is it still in the playoffs."""
    before_playoffs = phases_before("Elims 1 to 7")
    in_playoffs = states.where(
        none_of("event_state", [*before_playoffs, "Awards", "Completed"])
    ).select(*fmt.event)
    roster = rosters.members(inputs.alliances.join(in_playoffs, fmt.event), fmt)
    semis = inputs.matches.where(F.col("comp_level") == "sf").join(in_playoffs, fmt.event, "left_semi")
    out = (
        rosters.twice_beaten(semis, roster, fmt, fmt.event)
        .select(*fmt.event_team)
        .distinct()
        .withColumn("_out", F.lit(True))
    )
    running = states.where(none_of("event_state", [*before_playoffs, "Completed"]))
    return (
        inputs.event_points.join(running.select(*fmt.event, "district_key"), fmt.event)
        .join(out, fmt.event_team, "left")
        .select(
            *fmt.event_team,
            *(["district_key"] if fmt.championship else []),
            (F.col("award_points") == 0).alias("award_eligible"),
            F.col("_out").isNull().alias("elim_eligible"),
        )
    )


def division_team_states(
    inputs: SeasonInputs, fmt: Format, states: DataFrame, finals: DataFrame
) -> DataFrame:
    """Eligibility per (district, team) over the divisions and the finals event."""
    def members_in(events: DataFrame) -> DataFrame:
        chosen = inputs.alliances.join(events.select(*fmt.home, "event_key"), fmt.event)
        return rosters.members(chosen, fmt, carried=("district_key",))

    def matches_in(events: DataFrame, *levels: str) -> DataFrame:
        played = inputs.matches.where(F.col("comp_level").isin(*levels))
        return played.join(events.select(*fmt.event), fmt.event, "left_semi")

    division_events = states.where(none_of("event_state", phases_before("Elims 1 to 7")))
    finals_events = finals.where(none_of("event_state", ["Pre-Event", "Awards", "Completed"]))
    in_divisions, in_finals = members_in(division_events), members_in(finals_events)
    playoffs = matches_in(division_events, "sf", "f")
    semis = matches_in(finals_events, "sf")
    division_group = [*fmt.home, "event_key", "comp_level"]
    out = (
        rosters.twice_beaten(playoffs, in_divisions, fmt, division_group)
        .select(*fmt.home_team)
        .unionByName(
            rosters.twice_beaten(semis, in_finals, fmt, fmt.home).select(*fmt.home_team)
        )
        .distinct()
        .withColumn("_out", F.lit(True))
    )
    divisions = inputs.events.where(F.col("event_type") == fv.DIVISION)
    return (
        inputs.event_points.join(divisions.select(*fmt.home, "event_key"), fmt.event)
        .groupBy(*fmt.home_team)
        .agg((F.max("award_points") == 0).alias("award_eligible"))
        .join(out, fmt.home_team, "left")
        .select(*fmt.home_team, "award_eligible", F.col("_out").isNull().alias("elim_eligible"))
    )
