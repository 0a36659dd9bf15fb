"""Standings: the points that count, the chances that remain, and the ranks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from clinchline import fixed_values as fv
from clinchline.functions.columns import none_of, one_of, phases_from, total_if
from clinchline.functions.ranking import Piece, first_per_key, rank_block, spread_row_number, with_large
from clinchline.operators.phases import COUNTED_EVENTS, counted_registrations
from clinchline.plans.formats import Format
from clinchline.sources.inputs import SeasonInputs

QUALS_OPEN = ["Pre-Event", "Qualifications"]
SELECTION_OPEN = [*QUALS_OPEN, "Selections"]
CHANCES = [
    "events_remaining",
    "quals_remaining",
    "selections_remaining",
    "double_elims_remaining",
    "finals_remaining",
    "awards_remaining",
]
SEMIS = "dcmp_semi_finals_remaining"


def chance_columns(fmt: Format) -> list[str]:
    return [*CHANCES, *([SEMIS] if fmt.divisions else [])]


def _chances(state: str) -> list[Column]:
    """Counters of the chances that the phases of a team's events leave open."""
    playing = F.coalesce(F.col("elim_eligible"), F.lit(True))
    awardable = F.coalesce(F.col("award_eligible"), F.lit(True))
    return [
        total_if(one_of(state, QUALS_OPEN)).alias("quals_remaining"),
        total_if(one_of(state, SELECTION_OPEN)).alias("selections_remaining"),
        total_if(none_of(state, phases_from("Finals")) & playing).alias(
            "double_elims_remaining"
        ),
        total_if(none_of(state, phases_from("Awards")) & playing).alias("finals_remaining"),
        total_if(none_of(state, phases_from("Completed")) & awardable).alias(
            "awards_remaining"
        ),
    ]


def _bonuses(inputs: SeasonInputs, fmt: Format) -> DataFrame:
    """Official rankings with the manual point adjustments."""
    changes = inputs.points_adjustments
    keys = [k for k in fmt.home_team if k in changes.columns]
    return inputs.district_rankings.join(changes, keys, "left").select(
        *fmt.home_team,
        F.col("rank").alias("official_rank"),
        (F.col("rookie_bonus") + F.coalesce("points_adjustment", F.lit(0))).alias(
            "rookie_bonus"
        ),
    )


def season_totals(
    inputs: SeasonInputs, fmt: Format, states: DataFrame, team_states: DataFrame
) -> DataFrame:
    """Points of the two events that count and the chances left in them, per team."""
    counted = counted_registrations(inputs, fmt).join(
        states.select(*fmt.home, "event_key", "event_state"), [*fmt.home, "event_key"]
    )
    scored = inputs.event_points.select(*fmt.event_team, "points")
    open_event = F.col("event_state") != "Completed"
    sums = (
        counted.join(scored, fmt.event_team, "left")
        .join(
            team_states.select(*fmt.event_team, "award_eligible", "elim_eligible"),
            fmt.event_team,
            "left",
        )
        .groupBy(*fmt.home_team)
        .agg(
            F.sum(F.when(none_of("event_state", QUALS_OPEN), F.col("points"))).alias("event_sum"),
            total_if(open_event).alias("events_remaining"),
            *_chances("event_state"),
        )
    )
    totals = _bonuses(inputs, fmt).join(sums, fmt.home_team, "left")
    if fmt.regional:
        totals = totals.join(inputs.region_lookup, "team_key")
    totals = totals.fillna(0, ["event_sum", *CHANCES])
    points = F.col("event_sum") + F.col("rookie_bonus")
    return totals.select(
        *fmt.team,
        "official_rank",
        points.cast("int").alias("points"),
        "rookie_bonus",
        (points + fv.QUALS_FLOOR_POINTS * F.col("quals_remaining"))
        .cast("int")
        .alias("inflated_points"),
        *[F.col(c).cast("int").alias(c) for c in CHANCES],
    )


def counted_scores(inputs: SeasonInputs, fmt: Format) -> DataFrame:
    """The first two district events a team has points for, by date."""
    events = inputs.events.where(F.col("event_type") == fv.DISTRICT_EVENT)
    by_date = Window.partitionBy(*fmt.home).orderBy("start_date", "event_key")
    # numbered per district before the join, so that scores carry a number and not their event's key and date
    numbered = events.select(*fmt.home, "event_key", F.row_number().over(by_date).alias("event_order"))
    scores = inputs.event_points.select(*fmt.event_team, "points").join(numbered, fmt.event)
    return first_per_key(
        scores.select(*fmt.home_team, "event_order", "points"),
        fmt.home_team,
        [F.col("event_order").asc()],
        COUNTED_EVENTS,
    )


def _points_at(inputs: SeasonInputs, fmt: Format, events: DataFrame) -> DataFrame:
    """Points of the teams at these events; chosen before a join by team, which then moves only these."""
    points = inputs.event_points.select(*fmt.event_team, "points")
    return points.join(events.select(*fmt.event), fmt.event, "left_semi")


def championship_totals(
    inputs: SeasonInputs,
    fmt: Format,
    states: DataFrame,
    team_states: DataFrame,
    finals: DataFrame | None = None,
) -> DataFrame:
    """District and championship points, and the chances left at the championship."""
    season = (
        counted_scores(inputs, fmt)
        .groupBy(*fmt.home_team)
        .agg(F.sum("points").cast("int").alias("district_event_points"))
    )
    entered = inputs.event_teams.join(
        states.select(*fmt.home, "event_key", "event_state"), fmt.event
    ).join(_points_at(inputs, fmt, states), fmt.event_team, "left")
    eligible = team_states.select(
        *[k for k in [*fmt.home, "event_key", "team_key"] if k in team_states.columns],
        "award_eligible",
        "elim_eligible",
    )
    entered = entered.join(
        eligible, [k for k in entered.columns if k in eligible.columns], "left"
    )
    score = total_if(none_of("event_state", QUALS_OPEN), F.col("points")).alias("dcmp_points")
    running = [total_if(F.col("event_state") != "Completed").alias("events_remaining")]
    if fmt.divisions:
        entered = entered.join(
            finals.select(
                *fmt.home, F.col("event_state").alias("finals_state"), "num_dcmp_divisions"
            ),
            fmt.home,
        )
        semis_open = (
            (F.col("num_dcmp_divisions") == fv.DIVISIONS_WITH_SEMIS)
            & none_of("finals_state", phases_from("Finals"))
            & F.coalesce(F.col("elim_eligible"), F.lit(True))
        )
        running = [
            total_if(F.col("finals_state") != "Completed").alias("events_remaining"),
            total_if(semis_open).alias(SEMIS),
        ]
    at_championship = (
        entered.groupBy(*fmt.home_team).agg(score, *running, *_chances("event_state"))
    )
    totals = (
        _bonuses(inputs, fmt)
        .join(season, fmt.home_team, "left")
        .join(at_championship, fmt.home_team, "left")
    )
    dcmp_points: Column = F.col("dcmp_points")
    if fmt.divisions:
        finals_points = (
            inputs.event_teams.join(finals.select(*fmt.home, "event_key"), fmt.event)
            .join(_points_at(inputs, fmt, finals), fmt.event_team)
            .groupBy(*fmt.home_team)
            .agg(F.sum("points").alias("finals_points"))
        )
        totals = totals.join(finals_points, fmt.home_team, "left")
        dcmp_points = F.coalesce("dcmp_points", F.lit(0)) + F.coalesce(
            "finals_points", F.lit(0)
        )
    totals = totals.withColumn("dcmp_points", dcmp_points.cast("int")).fillna(
        0, chance_columns(fmt)
    )
    return totals.select(
        *fmt.home_team,
        "official_rank",
        "district_event_points",
        "rookie_bonus",
        "dcmp_points",
        (
            F.coalesce("district_event_points", F.lit(0))
            + F.col("rookie_bonus")
            + F.coalesce("dcmp_points", F.lit(0))
        )
        .cast("int")
        .alias("points"),
        *[F.col(c).cast("int").alias(c) for c in chance_columns(fmt)],
    )


def adjusted_rankings(totals: DataFrame, fmt: Format) -> DataFrame:
    """Rank the totals: most points first, ties by the official rank."""
    ranked = spread_row_number(
        totals,
        fmt.district,
        [
            Piece(F.col("points"), descending=True),
            Piece(rank_block("official_rank")),
        ],
        [F.col("official_rank").asc(), F.col("team_key").asc()],
        "rank",
    )
    fields = [c for c in totals.columns if c not in {*fmt.team, "official_rank"}]
    return ranked.select(*fmt.team, "rank", *fields)


def open_rankings(adjusted: DataFrame, qualified: DataFrame, fmt: Format) -> DataFrame:
    """Rank the teams that still race for a spot, after those qualified otherwise left."""
    # marked before the join, as teams are staged and those that are left are not
    racing = with_large(adjusted, fmt.district).join(
        qualified.select(*fmt.home_team).where(F.col("team_key").isNotNull()).distinct(),
        fmt.home_team,
        "left_anti",
    )
    ranked = spread_row_number(
        racing,
        fmt.district,
        [Piece(F.col(fmt.race_points), descending=True), Piece(rank_block("rank"))],
        [F.col("rank").asc()],
        "active_team_rank",
    )
    dropped = ["district_event_points", "dcmp_points"] if fmt.championship else []
    return ranked.drop(*dropped).select(
        *[c for c in adjusted.columns if c not in dropped], "active_team_rank"
    )
