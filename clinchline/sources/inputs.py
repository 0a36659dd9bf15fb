"""The input tables of one run."""

from __future__ import annotations

from dataclasses import dataclass, fields, replace

from pyspark.sql import DataFrame, SparkSession

from clinchline.sources import lookups


@dataclass(frozen=True)
class SeasonInputs:
    """Raw tables and lookups; see ``clinchline.schemas`` for their columns."""

    events: DataFrame
    event_teams: DataFrame
    matches: DataFrame
    alliances: DataFrame
    awards: DataFrame
    event_points: DataFrame
    district_rankings: DataFrame
    district_lookup: DataFrame
    points_adjustments: DataFrame
    prequalified_teams: DataFrame
    qual_points: DataFrame
    region_lookup: DataFrame | None = None
    short_brackets: DataFrame | None = None
    championship_rules: DataFrame | None = None
    #: whether tables of events are kept in buckets by event (``Stages.keep_dealt``)
    dealt: bool = False

    @classmethod
    def build(cls, spark: SparkSession, **tables: DataFrame) -> SeasonInputs:
        """Inputs from the raw tables; lookups that are not given take their fixed values."""
        known = {f.name for f in fields(cls)}
        return cls(**{**lookups.fixed_lookups(spark), **{k: v for k, v in tables.items() if k in known}})

    def replace(self, **tables: DataFrame) -> SeasonInputs:
        return replace(self, **tables)
