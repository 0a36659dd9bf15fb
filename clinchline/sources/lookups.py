"""Lookup tables: read from CSV, or built from the fixed values."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from clinchline import fixed_values as fv, schemas

_INT_COLUMNS = [
    "dcmp_capacity",
    "wcmp_capacity",
    "dcmp_impact_awards",
    "dcmp_ei_awards",
    "dcmp_ras_awards",
]


def _csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("mode", "FAILFAST")
        .csv(path)
    )


def read_qual_points(spark: SparkSession, path: str) -> DataFrame:
    return _csv(spark, path, schemas.QUAL_POINTS)


def typed_district_lookup(raw: DataFrame) -> DataFrame:
    """Cast the text columns of the district lookup; a missing flag means no labels."""
    return raw.select(
        "district_key",
        "display_name",
        "dcmp_name",
        *[F.col(c).cast("int").alias(c) for c in _INT_COLUMNS],
        (F.coalesce(F.col("dcmp_directional_labels").cast("int"), F.lit(0)) == 1).alias(
            "dcmp_directional_labels"
        ),
    )


def read_district_lookup(spark: SparkSession, path: str) -> DataFrame:
    return typed_district_lookup(_csv(spark, path, schemas.DISTRICT_LOOKUP_CSV))


def read_points_adjustments(spark: SparkSession, path: str) -> DataFrame:
    return _csv(spark, path, schemas.POINTS_ADJUSTMENTS)


def read_prequalified_teams(spark: SparkSession, path: str) -> DataFrame:
    return _csv(spark, path, schemas.PREQUALIFIED_TEAMS)


def read_region_lookup(spark: SparkSession, path: str) -> DataFrame:
    return _csv(spark, path, schemas.REGION_LOOKUP)


def read_lookups(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """All lookups of a folder on shared storage, as arguments of ``SeasonInputs``."""
    return {
        "qual_points": read_qual_points(spark, f"{folder}/qual_points_lookup.csv"),
        "district_lookup": read_district_lookup(spark, f"{folder}/district_lookup.csv"),
        "points_adjustments": read_points_adjustments(spark, f"{folder}/points_adjustments.csv"),
        "prequalified_teams": read_prequalified_teams(spark, f"{folder}/prequalified_teams.csv"),
        "region_lookup": read_region_lookup(spark, f"{folder}/region_lookup.csv"),
    }


def qual_points_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(fv.qual_points_rows(), schemas.QUAL_POINTS)


def fixed_lookups(spark: SparkSession) -> dict[str, DataFrame]:
    """The built-in lookups. Region membership is not among them: give it as a table."""
    make = spark.createDataFrame
    return {
        "qual_points": qual_points_table(spark),
        "district_lookup": make(fv.DISTRICTS, schemas.DISTRICT_LOOKUP),
        "points_adjustments": make(fv.POINTS_ADJUSTMENTS, schemas.POINTS_ADJUSTMENTS),
        "prequalified_teams": make(fv.PREQUALIFIED_TEAMS, schemas.PREQUALIFIED_TEAMS),
        "short_brackets": make([(e,) for e in fv.SHORT_BRACKET_EVENTS], schemas.SHORT_BRACKETS),
        "championship_rules": make(fv.CHAMPIONSHIP_EXCEPTIONS, schemas.CHAMPIONSHIP_RULES),
    }
