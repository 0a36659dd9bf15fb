"""Registered queries of the domain operators, one per operator and format."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from checks.adaptor import TABLES_OF, season_inputs
from checks.domain_oracle import oracle
from clinchline.plans.formats import FORMATS
from clinchline.plans.season import SeasonRun
from clinchline.plans.stages import Stages
from clinchline.sources.inputs import SeasonInputs

_inputs: dict[tuple[str, str, str], SeasonInputs] = {}
_runs: dict[tuple[str, str, str], SeasonRun] = {}


def open_inputs(spark: SparkSession, sf_dir: str, mode: str) -> SeasonInputs:
    """The raw tables of a format over the test tables, made once per session and scale."""
    key = (spark.sparkContext.applicationId, sf_dir, TABLES_OF[mode])
    if any(k[:2] != key[:2] for k in _inputs):
        forget()
        _inputs.clear()
    if key not in _inputs:
        _inputs[key] = season_inputs(spark, sf_dir, mode, Stages(spark))
    return _inputs[key]


def open_run(spark: SparkSession, sf_dir: str, mode: str) -> SeasonRun:
    """The run of a format over the test tables; its queries share its staged results."""
    inputs = open_inputs(spark, sf_dir, mode)
    key = (spark.sparkContext.applicationId, sf_dir, mode)
    if key not in _runs:
        _runs[key] = SeasonRun(spark, inputs, FORMATS[mode])
    return _runs[key]


def forget() -> None:
    """Drop all runs, so that the next query starts from the raw tables.

    Written stages stay: results that were handed out may still read them.
    """
    _runs.clear()


SEASON = ["district", "district_regions"]
CHAMPIONSHIP = ["dcmp", "dcmp_regions", "dcmp_divisions"]
ALL = [*SEASON, *CHAMPIONSHIP]

# key, result table (attribute of SeasonRun and name in the check SQL), formats
OPERATORS = [
    ("m1", "event_regions", ["district_regions"]),
    ("m2", "event_states", ALL),
    ("m3", "dcmp_finals_state", ["dcmp_divisions"]),
    ("m4", "team_event_states", [*SEASON, "dcmp", "dcmp_regions"]),
    ("m4d", "team_event_states", ["dcmp_divisions"]),
    ("m5", "impact_award_winners", SEASON),
    ("m6", "qualifying_award_winners", CHAMPIONSHIP),
    ("m7", "adjusted_district_rankings", SEASON),
    ("m8", "adjusted_district_rankings", CHAMPIONSHIP),
    ("m9", "open_rankings", ALL),
    ("m10", "event_points_remaining", ["district"]),
    ("m11", "event_points_remaining", ["district_regions"]),
    ("m12", "event_points_remaining", CHAMPIONSHIP),
    ("m13", "district_points_remaining", ALL),
    ("m14", "wcmp_spots", CHAMPIONSHIP),
    ("m15", "teams_to_pass", ALL),
    ("m16", "following_teams", SEASON),
    ("m17", "following_teams", CHAMPIONSHIP),
    ("m18", "lock_status", SEASON),
    ("m19", "lock_status", CHAMPIONSHIP),
    ("m20", "wcmp_spots_v2", CHAMPIONSHIP),
    ("m21", "teams_to_pass_v2", CHAMPIONSHIP),
    ("m22", "following_teams_v2", CHAMPIONSHIP),
    ("m23", "lock_status_v2", CHAMPIONSHIP),
]


def _query(mode: str, table: str) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: open_run(spark, sf_dir, mode).ready(table)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        f"{key}_{table}_{mode}": _query(mode, table)
        for key, table, modes in OPERATORS
        for mode in modes
    }


def oracle_sql() -> dict[str, str]:
    return {
        f"{key}_{table}_{mode}": oracle(mode, f"SELECT * FROM {table}")
        for key, table, modes in OPERATORS
        for mode in modes
    }
