"""Alliance rosters as rows, and the matches an alliance won or lost."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from clinchline.plans.formats import Format

SEATS = ["captain_key", "first_selection_key", "second_selection_key", "backup_key"]


def members(
    alliances: DataFrame, fmt: Format, roster_name: str | None = None, carried: tuple[str, ...] = ()
) -> DataFrame:
    """Distinct members of each alliance: (event, alliance_name, team_key, carried).

    ``roster_name`` adds the whole roster, in seat order, as an array column. Choose the events of ``alliances``
    before, so that a join shuffles alliances and not their members.
    """
    roster = F.array(*SEATS)
    return alliances.select(
        *fmt.event,
        "alliance_name",
        *([roster.alias(roster_name)] if roster_name else []),
        F.explode(F.array_distinct(roster)).alias("team_key"),
        *carried,
    ).where(F.col("team_key").isNotNull())


def decided() -> Column:
    return F.col("winning_alliance").isin("red", "blue")


def losing_robot() -> Column:
    """First robot of the losing side; it tells which alliance lost."""
    return F.when(F.col("winning_alliance") == "blue", F.col("red_1_key")).when(
        F.col("winning_alliance") == "red", F.col("blue_1_key")
    )


def winning_robot() -> Column:
    return F.when(F.col("winning_alliance") == "red", F.col("red_1_key")).when(
        F.col("winning_alliance") == "blue", F.col("blue_1_key")
    )


def twice_beaten(
    matches: DataFrame, roster: DataFrame, fmt: Format, group: list[str]
) -> DataFrame:
    """Members of the alliances that lost two or more different matches.

    ``roster`` holds the members of the alliances that can still be eliminated. The join is
    on (event, team), so one large event is spread over many tasks, and the distinct count
    is pre-aggregated by match.
    """
    losses = matches.where(decided()).select(
        *fmt.event, "comp_level", "match_key", losing_robot().alias("team_key")
    )
    beaten = (
        losses.join(roster, fmt.event_team)
        .groupBy(*group, "alliance_name")
        .agg(F.count_distinct("match_key").alias("_losses"))
        .where(F.col("_losses") >= 2)
    )
    held = [k for k in [*group, "alliance_name"] if k in roster.columns]
    return roster.join(beaten.select(*held).distinct(), held, "left_semi")
