"""Points that events still have to give, per event and per district."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from clinchline import fixed_values as fv
from clinchline.functions.columns import none_of, one_of, phases_from, rule_value, total_if
from clinchline.operators.standings import QUALS_OPEN, SELECTION_OPEN
from clinchline.plans.formats import Format
from clinchline.sources.inputs import SeasonInputs

PARTS = [
    "award_points_remaining",
    "elimination_points_remaining",
    "alliance_selection_points_remaining",
]


def qual_points_by_size(inputs: SeasonInputs) -> DataFrame:
    """All qualification points of an event, and the part above everyone's minimum."""
    return inputs.qual_points.groupBy("event_size").agg(
        F.sum("qual_points").cast("int").alias("total_qual_points"),
        (F.sum("qual_points") - F.min("qual_points") * F.col("event_size"))
        .cast("int")
        .alias("total_adjusted_qual_points"),
    )


def qual_points_through_rank(inputs: SeasonInputs) -> DataFrame:
    """The same for the best ``rank`` teams only. One window partition per event size."""
    from pyspark.sql import Window

    by_size = Window.partitionBy("event_size")
    running = F.sum("qual_points").over(by_size.orderBy("team_rank"))
    lowest = F.min("qual_points").over(by_size)
    return inputs.qual_points.select(
        "event_size",
        F.col("team_rank").alias("rank"),
        running.cast("int").alias("qual_points_through_rank"),
        (running - lowest * F.col("team_rank"))
        .cast("int")
        .alias("adjusted_qual_points_through_rank"),
    )


def _event_sizes(inputs: SeasonInputs, fmt: Format) -> DataFrame:
    return inputs.event_teams.groupBy(*fmt.event).agg(
        F.count("team_key").cast("int").alias("event_size")
    )


def _awarded(inputs: SeasonInputs, fmt: Format) -> DataFrame:
    """Award points given out, without those that nobody races for."""
    uncounted = [fv.IMPACT_POINTS * fmt.multiplier]
    if fmt.championship:
        uncounted.append(fv.QUALIFYING_AWARD_POINTS * fmt.multiplier)
    return (
        inputs.event_points.where(~F.col("award_points").isin(*uncounted))
        .groupBy(*fmt.event)
        .agg(F.sum("award_points").alias("awarded"))
    )


def _entries(inputs: SeasonInputs, fmt: Format, states: DataFrame) -> DataFrame:
    """Entries of the tracked events with the rookie bonus of teams of the same district."""
    ranked = inputs.district_rankings.select(*fmt.home_team, "rookie_bonus")
    return inputs.event_teams.join(
        states.select(*fmt.home, "event_key"), fmt.event
    ).join(ranked, fmt.home_team, "left")


def _rookie_events(entries: DataFrame, fmt: Format) -> DataFrame:
    return (
        entries.where(F.col("rookie_bonus") == fv.ROOKIE_BONUS)
        .select(*fmt.event)
        .distinct()
        .withColumn("rookie_award", F.lit(fv.ROOKIE_AWARD_POINTS))
    )


def _elimination_rule(fmt: Format) -> dict[str, int]:
    spared = 0 if fmt.winner_keeps_points else fv.WINNER_POINTS
    return {
        phase: (points - spared) * fmt.multiplier
        for phase, points in fv.ELIMINATION_POINTS.items()
    }


def _season_award_budget() -> Column:
    return F.when(
        F.col("event_state") != "Completed",
        F.lit(fv.SEASON_AWARD_POINTS)
        + F.coalesce("rookie_award", F.lit(0))
        - F.coalesce("awarded", F.lit(0)),
    ).otherwise(0)


def _with_total(df: DataFrame, head: list[str], quals: str) -> DataFrame:
    parts = [*PARTS, quals]
    total = sum((F.col(p) for p in parts[1:]), F.col(parts[0]))
    return df.withColumns({p: F.col(p).cast("int") for p in parts}).select(
        *head, *parts, total.cast("int").alias("points_remaining")
    )


def season_event_budget(inputs: SeasonInputs, fmt: Format, states: DataFrame) -> DataFrame:
    """Points remaining per district event."""
    sizes = qual_points_by_size(inputs)  # one row per event size
    rookies = _rookie_events(_entries(inputs, fmt, states), fmt)
    state = F.col("event_state")
    events = (
        states.select(*fmt.event, "event_state")
        .join(_event_sizes(inputs, fmt), fmt.event)
        .join(sizes, "event_size")
        .join(rookies, fmt.event, "left")
        .join(_awarded(inputs, fmt), fmt.event, "left")
    )
    budget = events.withColumns(
        {
            "team_count": F.col("event_size"),
            "award_points_remaining": _season_award_budget(),
            "elimination_points_remaining": rule_value(_elimination_rule(fmt), state),
            "alliance_selection_points_remaining": F.when(
                one_of(state, SELECTION_OPEN), fv.SELECTION_POINTS
            ).otherwise(0),
            "quals_adjusted_points_remaining": F.when(
                one_of(state, QUALS_OPEN), F.col("total_adjusted_qual_points")
            ).otherwise(0),
        }
    )
    return _with_total(
        budget, [*fmt.event, "team_count"], "quals_adjusted_points_remaining"
    )


def regional_event_budget(
    inputs: SeasonInputs,
    fmt: Format,
    states: DataFrame,
    regions: DataFrame,
    team_states: DataFrame,
) -> DataFrame:
    """Points remaining per event and region, capped by what the region's teams can take."""
    state = F.col("event_state")
    entries = _entries(inputs, fmt, states)
    can_play = F.coalesce(F.col("elim_eligible"), F.lit(True))
    can_win_award = F.coalesce(F.col("award_eligible"), F.lit(True))
    ranked = F.col("rookie_bonus").isNotNull()
    attendance = (
        entries.join(inputs.region_lookup, "team_key")
        .join(
            team_states.select(*fmt.event_team, "award_eligible", "elim_eligible"),
            fmt.event_team,
            "left",
        )
        .groupBy(*fmt.event, "region")
        .agg(
            total_if(can_play).alias("players"),
            total_if(ranked).alias("ranked"),
            total_if(ranked & can_win_award).alias("award_teams"),
            total_if(F.col("rookie_bonus") == fv.ROOKIE_BONUS).alias("rookies"),
        )
        .where(F.col("ranked") > 0)
    )
    players, award_teams = F.col("players"), F.col("award_teams")
    elimination_cap = rule_value(
        dict(enumerate(fv.REGIONAL_ELIMINATION_CAP)),
        players.cast("int"),
        fv.REGIONAL_ELIMINATION_FULL,
    )
    award_cap = (
        F.when(award_teams == 1, 8)
        .when(F.col("rookies") >= 1, 16 + 5 * (award_teams - 2))
        .otherwise(8 + 5 * (award_teams - 1))
    )
    slots = fv.SELECTION_SLOTS
    selection_rule = {n: sum(slots[:n]) for n in range(1, len(slots))}
    selection_cap = F.when(
        F.col("team_count") >= len(slots), fv.SELECTION_POINTS
    ).otherwise(rule_value(selection_rule, F.col("team_count")))
    curve = qual_points_through_rank(inputs)  # 3,115 rows
    events = (
        states.select(*fmt.event, "event_state")
        .join(
            regions.select(
                *fmt.event, "region", F.col("team_count").cast("int").alias("team_count")
            ),
            fmt.event,
        )
        .join(attendance, [*fmt.event, "region"])
        .join(_event_sizes(inputs, fmt), fmt.event)
        .withColumn("rank", F.col("team_count"))
        .join(curve, ["event_size", "rank"])
        .join(_rookie_events(entries, fmt), fmt.event, "left")
        .join(_awarded(inputs, fmt), fmt.event, "left")
    )
    budget = events.withColumns(
        {
            "award_points_remaining": F.least(award_cap, _season_award_budget()),
            "elimination_points_remaining": F.least(
                elimination_cap, rule_value(_elimination_rule(fmt), state)
            ),
            "alliance_selection_points_remaining": F.when(
                one_of(state, SELECTION_OPEN), selection_cap
            ).otherwise(0),
            "quals_adjusted_points_remaining": F.when(
                one_of(state, QUALS_OPEN), F.col("adjusted_qual_points_through_rank")
            ).otherwise(0),
        }
    )
    return _with_total(
        budget, ["region", *fmt.event, "team_count"], "quals_adjusted_points_remaining"
    )


def championship_event_budget(
    inputs: SeasonInputs, fmt: Format, states: DataFrame, finals: DataFrame | None = None
) -> DataFrame:
    """Points remaining per championship event, or per division and finals event."""
    times = fmt.multiplier
    state = F.col("event_state")
    sizes = qual_points_by_size(inputs)  # one row per event size
    entered = _event_sizes(inputs, fmt)
    events = (
        states.join(entered, fmt.event)
        .join(sizes, "event_size")
        .join(_awarded(inputs, fmt), fmt.event, "left")
    )
    if not fmt.divisions:
        names = inputs.district_lookup.select(
            "district_key",
            F.concat("display_name", F.lit(" "), "dcmp_name").alias("shown_name"),
        )
        events = events.join(names, "district_key").withColumn("name", F.col("shown_name"))
    budget = events.withColumns(
        {
            "team_count": F.col("event_size"),
            "award_points_remaining": F.when(
                state != "Completed",
                F.lit(fv.CHAMPIONSHIP_AWARD_POINTS * times) - F.coalesce("awarded", F.lit(0)),
            ).otherwise(0),
            "elimination_points_remaining": rule_value(_elimination_rule(fmt), state),
            "alliance_selection_points_remaining": F.when(
                one_of(state, SELECTION_OPEN), fv.SELECTION_POINTS * times
            ).otherwise(0),
            "quals_points_remaining": F.when(
                one_of(state, QUALS_OPEN), F.col("total_qual_points") * times
            ).otherwise(0),
        }
    )
    head = [*fmt.event, "name", "event_state", "color", "team_count"]
    result = _with_total(budget, head, "quals_points_remaining")
    if not fmt.divisions:
        return result
    semis_open = (F.col("num_dcmp_divisions") == fv.DIVISIONS_WITH_SEMIS) & none_of(
        state, phases_from("Finals")
    )
    final_rows = (
        finals.join(entered, fmt.event, "left")
        .withColumns(
            {
                "team_count": F.coalesce("event_size", F.lit(0)),
                "award_points_remaining": F.lit(0),
                "elimination_points_remaining": F.when(
                    semis_open, fv.FINALS_SEMI_POINTS * times
                ).otherwise(0),
                "alliance_selection_points_remaining": F.lit(0),
                "quals_points_remaining": F.lit(0),
            }
        )
    )
    return result.unionByName(_with_total(final_rows, head, "quals_points_remaining"))


def district_budget(
    inputs: SeasonInputs,
    fmt: Format,
    event_budget: DataFrame,
    states: DataFrame,
    regions: DataFrame | None = None,
) -> DataFrame:
    """Points remaining per district (and region), with event counts during the season."""
    total = F.sum("points_remaining").cast("int").alias("points_remaining")
    if fmt.championship:
        owners = inputs.events.where(
            F.col("event_type").isin(fv.CHAMPIONSHIP, *([fv.DIVISION] if fmt.divisions else []))
        )
        return (
            owners.select(*fmt.home, "event_key")
            .join(event_budget, fmt.event)
            .groupBy(*fmt.home)
            .agg(total)
        )
    amounts = event_budget.select(
        *fmt.event, *(["region"] if fmt.regional else []), "points_remaining"
    )
    owners = states.select(*fmt.home, "event_key", "event_state")
    if fmt.regional:
        owners = owners.join(regions.select(*fmt.event, "region"), fmt.event)
    return (
        owners.join(amounts, [c for c in amounts.columns if c in owners.columns])
        .groupBy(*fmt.district)
        .agg(
            F.count(F.lit(1)).cast("int").alias("total_district_events"),
            total_if(F.col("event_state") != "Completed").cast("int").alias("events_remaining"),
            total,
        )
    )
