import pytest

from clinchline import fixed_values as fv
from clinchline.operators import budget
from clinchline.plans.formats import FORMATS

from tests.conftest import as_dict


def states(spark, rows):
    return spark.createDataFrame(
        [(e, "2026aa", "n", "k", s, "c") for e, s in rows],
        "event_key string, district_key string, name string, event_type string, "
        "event_state string, color string",
    )


def test_qualification_points_table():
    rows = fv.qual_points_rows()
    assert len(rows) == 3115
    assert [p for size, _, p in rows if size == 10] == [22, 19, 17, 15, 14, 12, 11, 10, 8, 6]
    assert [p for size, rank, p in rows if size == 12][:8] == [22, 19, 17, 16, 15, 14, 12, 11]


def test_season_budget_by_phase(world, spark):
    quals = sum(p for size, _, p in fv.qual_points_rows() if size == 12)
    lowest = min(p for size, _, p in fv.qual_points_rows() if size == 12)
    for phase in [*fv.PHASES, "ERROR"]:
        world.event(phase)
        world.enter(phase, *[f"t{i}" for i in range(12)])
    world.event("tiny")
    world.enter("tiny", "t0")
    fmt, inputs = FORMATS["district"], world.inputs()
    found = as_dict(
        budget.season_event_budget(
            inputs, fmt, states(spark, [(p, p) for p in [*fv.PHASES, "ERROR"]] + [("tiny", "Finals")])
        ),
        "event_key",
        "quals_adjusted_points_remaining",
        "alliance_selection_points_remaining",
        "elimination_points_remaining",
        "award_points_remaining",
        "points_remaining",
    )
    assert "tiny" not in found  # no size rule
    assert found["Pre-Event"][:4] == (quals - 12 * lowest, 236, 213, 68)
    assert found["Selections"] == (0, 236, 213, 68, 517)
    assert found["Elims 8"] == (0, 0, 174, 68, 242)
    assert found["Finals"] == (0, 0, 31, 68, 99)
    assert found["Awards"] == (0, 0, 0, 68, 68)
    assert found["Completed"] == (0, 0, 0, 0, 0)
    assert found["ERROR"] == (0, 0, 0, 68, 68)
    order = [found[p] for p in fv.PHASES]
    for part in range(5):
        values = [row[part] for row in order]
        assert values == sorted(values, reverse=True)


def test_rookies_add_and_given_awards_reduce_the_award_budget(world, spark):
    world.event("e")
    world.enter("e", *[f"t{i}" for i in range(10)])
    world.ranking("t0", 1, bonus=10)
    world.ranking("elsewhere", 1, bonus=10, district="2026bb")
    for team, award in (("t0", 10), ("t1", 8), ("t2", 5)):
        world.points("e", team, award=award)
    found = budget.season_event_budget(world.inputs(), FORMATS["district"], states(spark, [("e", "Awards")]))
    assert as_dict(found, "event_key", "award_points_remaining") == {"e": 68 + 8 - 13}


@pytest.mark.parametrize(
    "present, selection, elimination, award",
    [(1, 16, 30, 8), (9, 128, 189, 48), (10, 140, 157, 53), (12, 162, 171, 63), (13, 172, 213, 68), (24, 236, 213, 68)],
)
def test_regional_budget_is_capped_by_attendance(world, spark, present, selection, elimination, award):
    teams = [f"t{i}" for i in range(30)]
    world.event("e")
    world.enter("e", *teams)
    world.lookups["region_lookup"] = [(t, "north") for t in teams[:present]]
    for i, t in enumerate(teams):
        world.ranking(t, i + 1)
    fmt, inputs = FORMATS["district_regions"], world.inputs()
    regions = spark.createDataFrame(
        [("2026aa", "e", "north", present)],
        "district_key string, event_key string, region string, team_count long",
    )
    none = spark.createDataFrame(
        [], "event_key string, team_key string, award_eligible boolean, elim_eligible boolean"
    )
    found = budget.regional_event_budget(
        inputs, fmt, states(spark, [("e", "Pre-Event")]), regions, none
    )
    curve = [p for size, _, p in fv.qual_points_rows() if size == 30]
    quals = sum(curve[:present]) - present * curve[-1]
    row = found.collect()[0]
    assert row.alliance_selection_points_remaining == selection
    assert row.elimination_points_remaining == elimination
    assert row.award_points_remaining == award
    assert row.quals_adjusted_points_remaining == quals
    assert row.points_remaining == quals + selection + elimination + award


def test_championship_budget_is_threefold(world, spark):
    world.district()
    world.event("c", kind="District Championship")
    world.enter("c", *[f"t{i}" for i in range(12)])
    for team, award in (("t0", 30), ("t1", 24), ("t2", 15)):
        world.points("c", team, award=award)
    quals = sum(p for size, _, p in fv.qual_points_rows() if size == 12)
    first = states(spark, [("c", "Qualifications")])
    row = budget.championship_event_budget(world.inputs(), FORMATS["dcmp"], first).collect()[0]
    assert row.name == "Alpha State Championship"
    assert row.quals_points_remaining == 3 * quals
    assert row.elimination_points_remaining == 3 * (213 - 31)
    assert row.award_points_remaining == 180 - 15


def test_finals_of_four_divisions_have_their_own_budget(world, spark):
    world.event("fin", kind="District Championship")
    world.event("v", kind="District Championship Division")
    world.enter("v", *[f"t{i}" for i in range(10)])
    finals = spark.createDataFrame(
        [("2026aa", "fin", "F", "k", 4, "Elims 2", "c")],
        "district_key string, event_key string, name string, event_type string, "
        "num_dcmp_divisions long, event_state string, color string",
    )
    fmt, inputs = FORMATS["dcmp_divisions"], world.inputs()
    rows = budget.championship_event_budget(inputs, fmt, states(spark, [("v", "Finals")]), finals)
    assert as_dict(rows, "event_key", "elimination_points_remaining", "team_count") == {
        "v": (93, 10),
        "fin": (90, 0),
    }
    total = budget.district_budget(inputs, fmt, rows, None)
    assert as_dict(total, "district_key", "points_remaining") == {"2026aa": 93 + 180 + 90}
