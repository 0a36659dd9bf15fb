"""Quality gate: are the landed points consistent with the phase of each event?"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from clinchline import fixed_values as fv
from clinchline.functions.columns import one_of, rule_value
from clinchline.plans.formats import Format
from clinchline.sources.inputs import SeasonInputs


def event_checks(inputs: SeasonInputs, fmt: Format, states: DataFrame) -> DataFrame:
    """One verdict per event, from one grouped pass over the points.

    A sum that is missing (no rows at all) is neither zero nor above a floor; it only
    passes where the rule asks for "not zero".
    """
    sums = inputs.event_points.groupBy(*fmt.event).agg(
        *[F.sum(f"{p}_points").alias(f"{p}_sum") for p in ("qual", "selection", "elim")]
    )
    state = F.col("event_state")
    quals = F.coalesce(F.col("qual_sum") != 0, F.lit(True))
    selection = F.coalesce(F.col("selection_sum") != 0, F.lit(True))
    no_elims = F.coalesce(F.col("elim_sum") == 0, F.lit(False))
    floors = {p: n * fmt.multiplier for p, n in fv.ELIMINATION_FLOOR.items()}
    floor = F.nullif(rule_value(floors, state, -1), F.lit(-1))
    enough = F.coalesce(F.col("elim_sum") >= floor, F.lit(False))
    always = one_of(state, ["Pre-Event", "Qualifications"])
    if fmt.regional:
        later_rule, later_valid = F.lit("points"), quals & selection
    else:
        later_rule = F.when(floor.isNotNull(), "floor").otherwise("none")
        later_valid = F.when(floor.isNotNull(), quals & selection & enough).otherwise(True)
    checked = states.join(sums, fmt.event, "left").withColumns(
        {
            "rule": F.when(always, "none")
            .when(state == "Selections", "quals only")
            .when(state == "Elims 1 to 7", "no playoff points")
            .otherwise(later_rule),
            "is_valid": F.when(always, True)
            .when(state == "Selections", quals & no_elims)
            .when(state == "Elims 1 to 7", quals & selection & no_elims)
            .otherwise(later_valid),
        }
    )
    return checked.select(
        *fmt.home,
        "event_key",
        "event_state",
        "qual_sum",
        "selection_sum",
        "elim_sum",
        (F.lit(None).cast("int") if fmt.regional else floor).alias("elim_floor"),
        "rule",
        "is_valid",
        F.when(F.col("is_valid"), F.lit(None).cast("string"))
        .when(F.col("elim_sum").isNull(), "no points")
        .otherwise(F.concat(F.lit("points do not fit "), state))
        .alias("reason"),
    )


def expected_team_counts(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        fv.EXPECTED_TEAM_COUNTS, "district_key string, expected int, may_miss int"
    )


def team_count_checks(inputs: SeasonInputs, fmt: Format, expected: DataFrame) -> DataFrame:
    """Number of ranked teams against the known size; unknown districts pass."""
    counted = inputs.district_rankings.groupBy(*fmt.home).agg(
        F.count(F.lit(1)).alias("teams")
    )
    fits = F.col("teams").between(F.col("expected") - F.col("may_miss"), F.col("expected"))
    if fmt.championship:
        fits = F.lit(True)
    return counted.join(expected, "district_key", "left").select(
        *fmt.home,
        "teams",
        "expected",
        "may_miss",
        F.coalesce(fits, F.lit(True)).alias("is_valid"),
    )


def gate(event_verdicts: DataFrame, team_verdicts: DataFrame, fmt: Format) -> DataFrame:
    """Per district: publish only when every event and the team count pass."""
    events = event_verdicts.groupBy(*fmt.home).agg(
        F.count_if(~F.col("is_valid")).alias("failed_events"),
        F.bool_and("is_valid").alias("events_valid"),
    )
    teams = team_verdicts.select(*fmt.home, F.col("is_valid").alias("teams_valid"))
    return events.join(teams, fmt.home, "full").select(
        *fmt.home,
        F.coalesce("failed_events", F.lit(0)).alias("failed_events"),
        F.coalesce("teams_valid", F.lit(True)).alias("teams_valid"),
        (
            F.coalesce("events_valid", F.lit(True)) & F.coalesce("teams_valid", F.lit(True))
        ).alias("publish"),
    )


def hold_back_unranked(gate: DataFrame, inputs: SeasonInputs, fmt: Format) -> DataFrame:
    """A district without any rankings is not published; the others are not affected."""
    ranked = inputs.district_rankings.select(*fmt.home).distinct().withColumn("_ranked", F.lit(True))
    return (
        gate.join(ranked, fmt.home, "left")
        .withColumn("publish", F.col("publish") & F.col("_ranked").isNotNull())
        .drop("_ranked")
    )


def open_questions(inputs: SeasonInputs, fmt: Format, states: DataFrame) -> DataFrame:
    """Counts of rows the rules silently leave out, per district."""
    unknown = states.groupBy(*fmt.home).agg(
        F.count_if(F.col("event_state") == fv.UNKNOWN_PHASE).alias("events_in_unknown_phase")
    )
    sizes = inputs.event_teams.groupBy(*fmt.event).agg(
        F.count("team_key").alias("event_size")
    )
    odd = (
        states.select(*fmt.home, "event_key")
        .join(sizes, fmt.event, "left")
        .groupBy(*fmt.home)
        .agg(
            F.count_if(
                ~F.coalesce("event_size", F.lit(0)).between(
                    fv.EVENT_SIZES.start, fv.EVENT_SIZES.stop - 1
                )
            ).alias("events_without_size_rule")
        )
    )
    result = unknown.join(odd, fmt.home, "full")
    if fmt.regional:
        lost = (
            inputs.district_rankings.join(inputs.region_lookup, "team_key", "left_anti")
            .groupBy(*fmt.home)
            .agg(F.count(F.lit(1)).alias("teams_without_region"))
        )
        result = result.join(lost, fmt.home, "full").fillna(0, ["teams_without_region"])
    return result
