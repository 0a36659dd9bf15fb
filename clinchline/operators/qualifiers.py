"""Teams that qualify by an award or by winning, and the spots left for points."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from clinchline import fixed_values as fv
from clinchline.functions.columns import total_if
from clinchline.operators import rosters
from clinchline.plans.formats import Format
from clinchline.sources.inputs import SeasonInputs


def impact_award_winners(inputs: SeasonInputs, fmt: Format) -> DataFrame:
    """Impact winners at district events; they leave the race for points."""
    events = inputs.events.where(F.col("event_type") == fv.DISTRICT_EVENT)
    winners = inputs.awards.where(F.col("award_type") == fv.IMPACT_AWARD_TYPE).join(
        events.select(*fmt.home, "event_key"), fmt.event
    )
    if fmt.regional:
        winners = winners.join(inputs.region_lookup, "team_key")
    return winners.select(*fmt.team)


def _championship_rules(inputs: SeasonInputs, fmt: Format, df: DataFrame) -> DataFrame:
    """Attach the per-district exceptions; only the single-event championship has any."""
    if fmt.several_championships or fmt.divisions or inputs.championship_rules is None:
        return df.withColumns(
            {
                "picks_sent": F.lit(len(rosters.SEATS)),
                "sends_ras": F.lit(True),
                "assumed_winners": F.lit(fv.ASSUMED_WINNERS),
            }
        )
    return (
        df.join(inputs.championship_rules, "district_key", "left")
        .fillna({"picks_sent": len(rosters.SEATS), "assumed_winners": fv.ASSUMED_WINNERS})
        .withColumn("sends_ras", F.coalesce("sends_ras", F.lit(True)))
    )


def _winning_teams(inputs: SeasonInputs, fmt: Format, states: DataFrame | None) -> DataFrame:
    """Seats of the alliance whose colour won the final twice.

    A winning colour whose robot is in no roster keeps its first three seats, empty: the
    district then still counts as decided.
    """
    if fmt.divisions:
        decided_events = inputs.events.where(F.col("event_type") == fv.CHAMPIONSHIP)
    else:
        decided_events = states.where(F.col("event_state").isin("Completed", "Awards"))
    group = [*fmt.home, *(["event_key"] if fmt.several_championships else [])]
    finals = (
        inputs.matches.where(
            (F.col("comp_level") == "f") & F.col("winning_alliance").isNotNull()
        )
        .select(*fmt.event, "winning_alliance", rosters.winning_robot().alias("team_key"))
        .join(decided_events.select(*fmt.home, "event_key"), fmt.event)
    )
    alliances = inputs.alliances.join(decided_events.select(*fmt.event), fmt.event, "left_semi")
    wins = (
        finals.join(rosters.members(alliances, fmt, "roster"), fmt.event_team, "left")
        .groupBy(*group, "winning_alliance")
        .agg(
            F.count(F.lit(1)).alias("_wins"),
            F.min_by("roster", "alliance_name").alias("roster"),
        )
        .where(F.col("_wins") >= 2)
    )
    no_one = F.array(*[F.lit(None).cast("string")] * len(rosters.SEATS))
    seated = _championship_rules(inputs, fmt, wins).select(
        *group,
        "picks_sent",
        F.posexplode(F.coalesce("roster", no_one)).alias("seat", "team_key"),
    )
    backup = len(rosters.SEATS) - 1
    return seated.where(
        (F.col("seat") < F.col("picks_sent"))
        & ((F.col("seat") < backup) | F.col("team_key").isNotNull())
    ).select(*group, "team_key")


def _award_teams(inputs: SeasonInputs, fmt: Format) -> DataFrame:
    events = inputs.events.where(F.col("event_type") == fv.CHAMPIONSHIP)
    kind: Column = F.lit(None).cast("string")
    for code, label in fv.QUALIFYING_AWARDS.items():
        kind = F.when(F.col("award_type") == code, label).otherwise(kind)
    given = inputs.awards.where(F.col("award_type").isin(*fv.QUALIFYING_AWARDS)).join(
        events.select(*fmt.home, "event_key"), fmt.event
    )
    return (
        _championship_rules(inputs, fmt, given.withColumn("award_label", kind))
        .where(F.col("sends_ras") | (F.col("award_label") != "RAS"))
        .select(
            *fmt.home,
            *(["event_key"] if fmt.several_championships else []),
            "team_key",
            F.col("award_label").alias("award_type"),
        )
    )


def _prequalified(inputs: SeasonInputs, fmt: Format) -> DataFrame:
    known = inputs.prequalified_teams
    if fmt.scope and not set(fmt.scope) <= set(known.columns):
        known = known.join(inputs.events.select(*fmt.home).distinct(), "district_key")
    return known.select(*fmt.home_team)


def qualifying_award_winners(
    inputs: SeasonInputs, fmt: Format, states: DataFrame | None = None
) -> DataFrame:
    """Winners, award winners and prequalified teams, merged by team.

    With several championships there is one row per team, with its best award; otherwise
    one row per team and award.
    """
    keys = fmt.home_team
    won = _winning_teams(inputs, fmt, states).withColumn("_won", F.lit(True))
    awarded = _award_teams(inputs, fmt)
    if fmt.several_championships:
        won = won.withColumnRenamed("event_key", "_won_event")
        awarded = awarded.withColumnRenamed("event_key", "_award_event")
    pre = _prequalified(inputs, fmt).withColumn("_pre", F.lit(True))
    # a full join on named keys merges them; rows without a team never match
    merged = awarded.join(won, keys, "full").join(pre, keys, "full")
    has_team = F.col("team_key").isNotNull()
    flags = [
        (has_team & F.col("_won").isNotNull()).alias("is_winner"),
        (has_team & F.col("_pre").isNotNull()).alias("is_prequalified"),
    ]
    if not fmt.several_championships:
        return merged.select(*keys, "award_type", *flags)
    return (
        merged.select(
            *keys,
            "award_type",
            *flags,
            F.coalesce("_won_event", "_award_event").alias("event_key"),
        )
        .groupBy(*keys)
        .agg(
            F.min_by("award_type", award_order()).alias("award_type"),
            F.bool_or("is_winner").alias("is_winner"),
            F.bool_or("is_prequalified").alias("is_prequalified"),
            F.min("event_key").alias("event_key"),
        )
    )


def award_order() -> Column:
    """Position of an award in the order of importance; null for no award."""
    labels = F.array(*map(F.lit, fv.AWARD_PRIORITY))
    return F.array_position(labels, F.col("award_type"))


def _entitlements() -> Column:
    """How many ways a team qualified."""
    return (
        F.col("award_type").isNotNull().cast("int")
        + F.col("is_prequalified").cast("int")
        + F.col("is_winner").cast("int")
    )


def _qualifier_counts(qualifiers: DataFrame, keys: list[str]) -> DataFrame:
    return qualifiers.groupBy(*keys).agg(
        total_if(F.col("is_winner")).alias("winners"),
        total_if(_entitlements() == 2).alias("doubles"),
        total_if(_entitlements() == 3).alias("triples"),
        total_if(F.col("award_type") == "RAS").alias("ras"),
    )


def _spots(winners: Column, doubles: Column, triples: Column, unawarded: Column) -> Column:
    """Capacity less award spots and winners; every double use of a spot frees one."""
    return (
        F.col("wcmp_capacity")
        - F.col("dcmp_impact_awards")
        - F.col("dcmp_ei_awards")
        - F.col("dcmp_ras_awards")
        - winners
        + doubles
        + 2 * triples
        + unawarded
    ).cast("int")


def championship_spots(
    inputs: SeasonInputs, fmt: Format, states: DataFrame, qualifiers: DataFrame
) -> DataFrame:
    """Points-based spots of each district. ``states`` are those of the deciding events."""
    zero = F.lit(0)
    districts = inputs.district_lookup
    if fmt.scope:
        districts = districts.join(inputs.events.select(*fmt.home).distinct(), "district_key")
    if fmt.several_championships:
        return _spots_by_event(fmt, districts, states, qualifiers)
    # qualifiers are counted before the join, once per decided event
    ended = (
        states.where(F.col("event_state").isin("Completed", "Awards"))
        .groupBy(*fmt.home)
        .agg(
            F.count(F.lit(1)).alias("events"),
            F.bool_and(F.col("event_state") == "Completed").alias("completed"),
        )
    )
    counts = ended.join(_qualifier_counts(qualifiers, fmt.home), fmt.home)
    times = F.col("events")
    missing = F.when(
        F.col("completed"), F.col("dcmp_ras_awards") - times * F.col("ras")
    ).otherwise(0)
    return _championship_rules(
        inputs, fmt, districts.join(counts, fmt.home, "left")
    ).select(
        *fmt.home,
        _spots(
            F.coalesce(times * F.col("winners"), F.col("assumed_winners")),
            F.coalesce(times * F.col("doubles"), zero),
            F.coalesce(times * F.col("triples"), zero),
            F.coalesce(missing, zero),
        ).alias("wcmp_spots"),
    )


def _spots_by_event(
    fmt: Format, districts: DataFrame, states: DataFrame, qualifiers: DataFrame
) -> DataFrame:
    """Spots where several championships share a district: 0 winners means not known yet."""
    keys = [*fmt.home, "event_key"]
    by_event = (
        states.select(*keys, "event_state")
        .join(_qualifier_counts(qualifiers.where(F.col("event_key").isNotNull()), keys), keys, "left")
        .join(districts.select(*fmt.home, "dcmp_ras_awards"), fmt.home)
    )
    known = F.nullif(F.col("winners"), F.lit(0))
    per_district = by_event.groupBy(*fmt.home).agg(
        F.sum(F.coalesce(known, F.lit(fv.ASSUMED_WINNERS))).alias("winners"),
        F.sum(F.coalesce("doubles", F.lit(0))).alias("doubles"),
        F.sum(F.coalesce("triples", F.lit(0))).alias("triples"),
        total_if(
            F.col("event_state") == "Completed",
            F.col("dcmp_ras_awards") - F.coalesce("ras", F.lit(0)),
        ).alias("unawarded"),
    )
    zero = F.lit(0)
    return districts.join(per_district, fmt.home, "left").select(
        *fmt.home,
        _spots(
            F.coalesce("winners", F.lit(fv.ASSUMED_WINNERS)),
            F.coalesce("doubles", zero),
            F.coalesce("triples", zero),
            F.coalesce("unawarded", zero),
        ).alias("wcmp_spots"),
    )


LOCKED_STATUSES = ["100%", "Prequalified", "Impact", "EI", "RAS"]


def guaranteed_spots(
    inputs: SeasonInputs,
    fmt: Format,
    spots: DataFrame,
    team_states: DataFrame,
    states: DataFrame,
    status: DataFrame,
) -> DataFrame:
    """Spots after the second look.

    Whichever live alliance wins, its members that are locked already free their spots, so
    the smallest number of locked members is certain. ``states`` are the deciding events.
    """
    alive_teams = team_states.where(F.col("elim_eligible"))
    if fmt.divisions:
        open_districts = states.where(none_ended("event_state")).select(*fmt.home)
        divisions = inputs.events.where(F.col("event_type") == fv.DIVISION)
        running = divisions.select(*fmt.home, "event_key").join(open_districts, fmt.home)
        alive_keys = fmt.home_team
    else:
        running = states.where(
            ~F.col("event_state").isin(
                "Pre-Event", "Qualifications", "Selections", "Awards", "Completed"
            )
        )
        alive_keys = [*fmt.home, "event_key", "team_key"]
    chosen = inputs.alliances.join(running.select(*fmt.home, "event_key"), fmt.event)
    members = rosters.members(chosen, fmt, carried=("district_key",))
    alliance = [*fmt.home, "event_key", "alliance_name"]
    marked = members.join(
        alive_teams.select(*alive_keys).distinct().withColumn("_alive", F.lit(True)),
        alive_keys,
        "left",
    ).join(
        status.where(F.col("lock_status").isin(*LOCKED_STATUSES))
        .select(*fmt.home_team)
        .withColumn("_locked", F.lit(1)),
        fmt.home_team,
        "left",
    )
    per_alliance = (
        marked.groupBy(*alliance)
        .agg(F.max("_alive").alias("alive"), F.count("_locked").alias("locked"))
        .where(F.col("alive"))
    )
    if fmt.several_championships:
        certain = (
            per_alliance.groupBy(*fmt.home, "event_key")
            .agg(F.min("locked").alias("locked"))
            .groupBy(*fmt.home)
            .agg(F.sum("locked").alias("certain"))
        )
    else:
        certain = per_alliance.groupBy(*fmt.home).agg(F.min("locked").alias("certain"))
    return spots.join(certain, fmt.home, "left").select(
        *fmt.home,
        (F.col("wcmp_spots") + F.coalesce("certain", F.lit(0))).cast("int").alias("wcmp_spots"),
    )


def none_ended(column: str) -> Column:
    return ~F.col(column).isin("Awards", "Completed")
