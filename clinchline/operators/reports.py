"""Report tables: what the pages of a district, an event and a team show.

Order is applied where a report is written, not here.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from clinchline.functions.columns import column_from, points_short
from clinchline.plans.formats import Format
from clinchline.sources.inputs import SeasonInputs

FINAL_STATUSES = ["-", "0%", "Impact"]
CHAMPIONSHIP_FINAL_STATUSES = [*FINAL_STATUSES, "EI", "RAS", "Prequalified", "Winner"]


def final_statuses(fmt: Format) -> list[str]:
    return CHAMPIONSHIP_FINAL_STATUSES if fmt.championship else FINAL_STATUSES


def team_number(column: str) -> Column:
    """Numeric part of a team key."""
    return column_from(column, 4)


def rankings(status: DataFrame, fmt: Format) -> DataFrame:
    scores = (
        ["district_event_points", "rookie_bonus", "dcmp_points"]
        if fmt.championship
        else ["event1_points", "event2_points", "rookie_bonus"]
    )
    return status.select(
        *fmt.district,
        "rank",
        team_number("team_key").alias("team_number"),
        "team_key",
        *[points_short(c).alias(c) for c in scores],
        "total_points",
        "lock_status",
        "color",
        (~F.col("lock_status").isin(*final_statuses(fmt))).alias("has_team_page"),
    )


def _event_rows(states: DataFrame, budget: DataFrame, fmt: Format) -> DataFrame:
    """Events with their budget; one row per region where the budget is regional."""
    amounts = budget.select(
        *fmt.event,
        *(["region"] if fmt.regional else []),
        "team_count",
        "points_remaining",
    )
    return states.join(amounts, fmt.event)


def season_events(states: DataFrame, budget: DataFrame, fmt: Format) -> DataFrame:
    return _event_rows(states, budget, fmt).select(
        *fmt.district,
        F.col("event_key").alias("key"),
        "name",
        F.col("event_state").alias("status"),
        "team_count",
        "points_remaining",
        "color",
        "start_date",
    )


def championship_events(
    inputs: SeasonInputs, states: DataFrame, budget: DataFrame, fmt: Format
) -> DataFrame:
    """Championship events; a district with several names them by direction."""
    place = F.lower(F.col("name"))
    plain = F.col("dcmp_name")
    label = (
        F.when(~F.col("dcmp_directional_labels"), plain)
        .when(place.like("%north%"), F.concat(F.lit("Northern "), plain))
        .when(place.like("%south%"), F.concat(F.lit("Southern "), plain))
        .otherwise(plain)
    )
    names = inputs.district_lookup.select(
        "district_key", "dcmp_name", "dcmp_directional_labels"
    )
    return (
        _event_rows(states, budget, fmt)
        .join(names, "district_key")
        .select(
            *fmt.district,
            F.col("event_key").alias("key"),
            label.alias("name"),
            F.col("event_state").alias("status"),
            "team_count",
            "points_remaining",
            "color",
            "start_date",
        )
    )


def division_events(
    inputs: SeasonInputs,
    states: DataFrame,
    finals: DataFrame,
    budget: DataFrame,
    fmt: Format,
) -> DataFrame:
    """Divisions, named by the first word after the dash, and then the finals."""
    after_dash = F.expr("substring(name, position('-' in name) + 2)")
    division = F.concat(F.split_part(after_dash, F.lit(" "), F.lit(1)), F.lit(" Division"))
    shown = [
        F.col("event_key").alias("key"),
        F.col("event_state").alias("status"),
        "team_count",
        "points_remaining",
        "color",
    ]
    first = _event_rows(states, budget, fmt).select(
        *fmt.home, F.lit(0).alias("event_type"), division.alias("name"), *shown
    )
    names = inputs.district_lookup.select("district_key", "dcmp_name")
    last = (
        _event_rows(finals, budget, fmt)
        .join(names, "district_key")
        .select(
            *fmt.home,
            F.lit(1).alias("event_type"),
            F.concat("dcmp_name", F.lit(" Finals")).alias("name"),
            *shown,
        )
    )
    return first.unionByName(last)


def district_stats(inputs: SeasonInputs, budget: DataFrame, fmt: Format) -> DataFrame:
    season = ["events_remaining"] if not fmt.championship else []
    capacity = "wcmp_capacity" if fmt.championship else "dcmp_capacity"
    return budget.join(
        inputs.district_lookup.select("district_key", capacity, "display_name"),
        "district_key",
    ).select(*fmt.district, "points_remaining", *season, capacity, "display_name")


def event_page(states: DataFrame, budget: DataFrame, fmt: Format) -> DataFrame:
    """Phase and budget parts of an event."""
    quals = "quals_points_remaining" if fmt.championship else "quals_adjusted_points_remaining"
    parts = [
        quals,
        "alliance_selection_points_remaining",
        "elimination_points_remaining",
        "award_points_remaining",
        "points_remaining",
    ]
    if fmt.championship:  # names differ from those of the events there
        page = budget
    else:
        page = states.select(*fmt.event, "name", "event_state", "color").join(
            budget, fmt.event
        )
    return page.select(
        *fmt.event,
        *(["region"] if fmt.regional else []),
        "name",
        F.col("event_state").alias("status"),
        "color",
        *parts,
    )


def team_header(status: DataFrame, fmt: Format) -> DataFrame:
    total = "total_points" if fmt.championship else "total_inflated_points"
    return status.select(
        *fmt.team,
        total,
        "teams_to_pass",
        "total_teams_that_can_pass",
        "total_points_to_pass",
        "total_points_remaining",
        "lock_status",
        F.coalesce(
            F.col("total_teams_that_can_pass") < F.col("teams_to_pass"), F.lit(False)
        ).alias("shows_passers"),
    )


def team_followers(following: DataFrame, fmt: Format) -> DataFrame:
    points = (
        F.col("following_team_points").alias("points_total")
        if fmt.championship
        else F.col("following_team_inflated_points").alias("inflated_points_total")
    )
    return following.select(
        *fmt.team,
        "following_team_key",
        team_number("following_team_key").alias("following_team_number"),
        "following_team_rank",
        points,
        F.col("following_team_max_possible_points").alias("max_points"),
        F.coalesce(
            F.col("following_team_points_needed_to_pass").cast("string"), F.lit("-")
        ).alias("points_to_pass"),
        F.col("following_team_color").alias("color"),
    )


def team_pages(header: DataFrame, fmt: Format) -> DataFrame:
    """Only teams whose status is still open get a page."""
    return header.where(~F.col("lock_status").isin(*final_statuses(fmt)))


def page_index(
    inputs: SeasonInputs,
    fmt: Format,
    header: DataFrame,
    regions: DataFrame | None = None,
) -> DataFrame:
    """Every page of a run: its kind, its key and its path."""
    events = inputs.events.where(
        F.col("event_type").isin(
            fmt.tracked_type, *(["District Championship"] if fmt.divisions else [])
        )
    ).select(*fmt.home, "event_key")
    ranked = inputs.district_rankings.select(*fmt.home).distinct()
    if fmt.regional:
        ranked = inputs.district_rankings.join(inputs.region_lookup, "team_key").select(
            *fmt.home, "region"
        ).distinct()
        events = regions.select(*fmt.home, "event_key", "region")
    suffix = F.concat(F.lit("_"), F.col("region")) if fmt.regional else F.lit("")
    code = column_from("district_key", 5)

    def page(df: DataFrame, kind: str, key: str, path: Column) -> DataFrame:
        return df.select(
            *fmt.home,
            F.lit(kind).alias("kind"),
            F.col(key).alias("key"),
            F.concat(F.lit(f"{kind}s/"), path).alias("path"),
        )

    return (
        page(ranked, "district", "district_key", F.concat(code, suffix))
        .unionByName(page(events, "event", "event_key", F.concat("event_key", suffix)))
        .unionByName(page(team_pages(header, fmt), "team", "team_key", F.col("team_key")))
    )
