"""Standings and qualification-race analytics as Spark jobs."""

from clinchline.plans.formats import FORMATS, Format
from clinchline.plans.season import SeasonInputs, run_season

__all__ = ["FORMATS", "Format", "SeasonInputs", "run_season"]
