from clinchline.operators import phases, standings
from clinchline.plans.formats import FORMATS
from clinchline.plans.season import SeasonRun

from tests.conftest import as_dict


def test_first_two_events_count_by_date_then_key(world):
    for key, day in (("e3", 9), ("e1", 1), ("e2b", 5), ("e2a", 5)):
        world.event(key, day=day)
        world.enter(key, "t")
    world.event("other", "2026bb", day=0)
    world.enter("other", "t")  # the same key in another district has its own two
    counted = phases.counted_registrations(world.inputs(), FORMATS["district"])
    assert {tuple(r) for r in counted.select("district_key", "event_key").collect()} == {
        ("2026aa", "e1"),
        ("2026aa", "e2a"),
        ("2026bb", "other"),
    }


def test_season_points_ranks_and_chances(world, spark):
    world.district()
    world.lookups["points_adjustments"] = [("2026aa", "b", -3)]
    world.event("done", day=1)
    world.quals("done")  # all played, no alliances: Selections
    world.event("open", day=2)
    world.quals("open", played=0)
    world.event("third", day=3)
    world.quals("third")
    for e in ("done", "open", "third"):
        world.enter(e, "a", "b", "c")
    for team, score in (("a", 20), ("b", 20), ("c", 30)):
        world.points("done", team, qual=score)
        world.points("open", team, qual=50)  # qualification still running: not counted
        world.points("third", team, qual=70)  # third event: not counted
    world.ranking("a", 2, bonus=10)
    world.ranking("b", 1)
    world.ranking("c", 3)
    world.ranking("idle", 4)
    run = SeasonRun(spark, world.inputs(), FORMATS["district"])
    fields = ["rank", "points", "inflated_points", "rookie_bonus", *standings.CHANCES]
    assert as_dict(run.adjusted_district_rankings, "team_key", *fields) == {
        # ties go to the better official rank
        "a": (1, 30, 34, 10, 2, 1, 2, 2, 2, 2),
        "c": (2, 30, 34, 0, 2, 1, 2, 2, 2, 2),
        "b": (3, 17, 21, -3, 2, 1, 2, 2, 2, 2),
        "idle": (4, 0, 0, 0, 0, 0, 0, 0, 0, 0),
    }


def test_impact_winners_leave_the_race_only_in_their_district(world, spark):
    for d in ("2026aa", "2026bb"):
        world.district(d)
        world.event(f"e{d}", d)
        world.enter(f"e{d}", "t", "u")
        world.ranking("t", 1, district=d)
        world.ranking("u", 2, district=d)
    world.awards("e2026aa", [0], "t")
    run = SeasonRun(spark, world.inputs(), FORMATS["district"])
    assert as_dict(run.open_rankings, ["district_key", "team_key"], "active_team_rank") == {
        ("2026aa", "u"): 1,
        ("2026bb", "t"): 1,
        ("2026bb", "u"): 2,
    }


def test_championship_points_count_after_qualification(world, spark):
    world.district()
    world.event("d1", day=1)
    world.event("d2", day=2)
    world.event("d3", day=3)
    world.event("c", kind="District Championship", day=9)
    world.quals("c")
    for e, score in (("d1", 5), ("d3", 11)):  # no points row at d2
        world.points(e, "t", qual=score)
    world.enter("c", "t", "u")
    world.points("c", "t", qual=60)
    world.ranking("t", 1, bonus=5)
    world.ranking("u", 2)
    world.ranking("home", 3)
    run = SeasonRun(spark, world.inputs(), FORMATS["dcmp"])
    fields = ["district_event_points", "dcmp_points", "points", "events_remaining"]
    assert as_dict(run.adjusted_district_rankings, "team_key", *fields) == {
        "t": (16, 60, 81, 1),
        "u": (None, None, 0, 1),
        "home": (None, None, 0, 0),
    }


def test_semis_remain_only_with_four_divisions(world, spark):
    for n, d in ((4, "2026aa"), (2, "2026bb")):
        world.district(d)
        world.event(f"f{d}", d, "District Championship")
        for i in range(n):
            world.event(f"v{i}{d}", d, "District Championship Division")
            world.enter(f"v{i}{d}", f"t{i}")
            world.ranking(f"t{i}", i + 1, district=d)
    run = SeasonRun(spark, world.inputs(), FORMATS["dcmp_divisions"])
    chances = as_dict(
        run.adjusted_district_rankings, ["district_key", "team_key"], standings.SEMIS
    )
    assert chances[("2026aa", "t0")] == 1 and chances[("2026bb", "t0")] == 0


def test_scores_carry_the_number_of_their_event_in_the_district(world):
    for key, day, points in (("e3", 9, 9), ("e1", 1, 1), ("e2b", 5, 6), ("e2a", 5, 5)):
        world.event(key, day=day)
        world.points(key, "t", qual=points)
    world.event("other", "2026bb", day=0)
    world.points("other", "t", qual=7)
    counted = standings.counted_scores(world.inputs(), FORMATS["dcmp"])
    assert set(counted.columns) == {"district_key", "team_key", "event_order", "points"}
    assert {(r.district_key, r.event_order, r.points) for r in counted.collect()} == {
        ("2026aa", 1, 1),
        ("2026aa", 2, 5),
        ("2026bb", 1, 7),
    }
