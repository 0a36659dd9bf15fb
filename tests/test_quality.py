import pytest

from clinchline import fixed_values as fv
from clinchline.operators import quality
from clinchline.plans.formats import FORMATS

from tests.conftest import as_dict


def checks(world, spark, mode, phase, *sums):
    """Verdict of one event with the given (qual, selection, elim) points; none without."""
    if sums:
        world.points("e", "t", *sums)
    states = spark.createDataFrame(
        [("2026aa", "e", phase)], "district_key string, event_key string, event_state string"
    )
    row = quality.event_checks(world.inputs(), FORMATS[mode], states).collect()[0]
    return row.is_valid, row.reason


@pytest.mark.parametrize(
    "mode, phase, sums, valid",
    [
        ("district", "Pre-Event", (), True),
        ("district", "Qualifications", (), True),
        ("district", "Selections", (5, 0, 0), True),
        ("district", "Selections", (0, 0, 0), False),
        ("district", "Selections", (5, 0, 1), False),
        ("district", "Elims 1 to 7", (5, 5, 0), True),
        ("district", "Elims 1 to 7", (5, 0, 0), False),
        ("district", "Elims 8", (5, 5, 39), True),
        ("district", "Elims 8", (5, 5, 38), False),
        ("district", "Awards", (5, 5, 210), True),
        ("district", "Awards", (5, 0, 210), False),
        ("dcmp", "Elims 8", (5, 5, 116), False),
        ("dcmp", "Elims 8", (5, 5, 117), True),
        ("district", "Completed", (0, 0, 0), True),
        ("district", "ERROR", (), True),
        ("district_regions", "Finals", (5, 5, 0), True),
        ("district_regions", "Completed", (5, 0, 0), False),
        ("district_regions", "Completed", (), True),
    ],
)
def test_sums_must_fit_the_phase(world, spark, mode, phase, sums, valid):
    assert checks(world, spark, mode, phase, *sums)[0] is valid


@pytest.mark.parametrize("phase", ["Selections", "Elims 1 to 7", "Finals"])
def test_an_event_without_rows_is_named(world, spark, phase):
    assert checks(world, spark, "district", phase) == (False, "no points")


def test_team_counts_and_gate(world, spark):
    expected = spark.createDataFrame(
        [("2026aa", 3, 1), ("2026bb", 3, 0)], "district_key string, expected int, may_miss int"
    )
    for d in ("2026aa", "2026bb", "2026cc"):
        world.ranking("t", 1, district=d)
        world.ranking("u", 2, district=d)
    inputs, fmt = world.inputs(), FORMATS["district"]
    teams = quality.team_count_checks(inputs, fmt, expected)
    assert as_dict(teams, "district_key", "is_valid") == {"2026aa": True, "2026bb": False, "2026cc": True}
    events = spark.createDataFrame(
        [("2026aa", True), ("2026cc", True), ("2026cc", False)], "district_key string, is_valid boolean"
    )
    gate = quality.gate(events, teams, fmt)
    assert as_dict(gate, "district_key", "failed_events", "publish") == {
        "2026aa": (0, True),
        "2026bb": (0, False),
        "2026cc": (1, False),
    }
    always = quality.team_count_checks(inputs, FORMATS["dcmp"], expected)
    assert set(as_dict(always, "district_key", "is_valid").values()) == {True}


def test_left_out_rows_are_counted(world, spark):
    world.event("tiny")
    world.enter("tiny", "t")
    world.ranking("t", 1)
    states = spark.createDataFrame(
        [("2026aa", "tiny", fv.UNKNOWN_PHASE)],
        "district_key string, event_key string, event_state string",
    )
    row = quality.open_questions(world.inputs(), FORMATS["district_regions"], states).collect()[0]
    assert (row.events_in_unknown_phase, row.events_without_size_rule, row.teams_without_region) == (1, 1, 1)
