import pytest

from clinchline.operators import phases, qualifiers
from clinchline.plans.formats import FORMATS

from tests.conftest import as_dict

C = "District Championship"


def championship(world, district="2026aa", key="c", red_wins=2, types=range(11), best=30):
    world.district(district, wcmp=20, impact=1, ei=1, ras=1)
    world.event(key, district, C)
    world.quals(key)
    world.alliance(key, "A1", "a", "b", "c", "d")
    world.alliance(key, "A2", "e", "f", "g")
    world.semis(key, 13, "a", "e")
    world.finals(key, red_wins, 1, "a", "e")
    world.awards(key, [t for t in types if t not in (0, 9, 10)], "z")
    world.points(key, "z", award=best)


def test_winners_awards_and_prequalified_teams_merge(world):
    championship(world)
    world.awards("c", [0], "a")
    world.awards("c", [9, 10], "m")
    world.lookups["prequalified_teams"] = [("2026aa", "a"), ("2026aa", "p"), ("2026bb", "a")]
    inputs = world.inputs()
    for mode in ("dcmp", "dcmp_regions", "dcmp_divisions"):
        fmt = FORMATS[mode]
        states = None if fmt.divisions else phases.event_states(inputs, fmt)
        rows = qualifiers.qualifying_award_winners(inputs, fmt, states).where("district_key = '2026aa'")
        found = sorted(
            (r.team_key, r.award_type, r.is_winner, r.is_prequalified) for r in rows.collect()
        )
        expected = [("a", "Impact", True, True)]
        expected += [(t, None, True, False) for t in "bcd"]
        expected += [("m", "EI", False, False)]
        if mode != "dcmp_regions":  # one row per award; several championships keep the best
            expected += [("m", "RAS", False, False)]
        assert found == sorted(expected + [("p", None, False, True)], key=str)


def test_one_district_sends_fewer_winners_and_no_ras(world):
    championship(world, "2025fsc")
    world.awards("c", [9], "m")
    world.awards("c", [10], "r")
    inputs, fmt = world.inputs(), FORMATS["dcmp"]
    rows = qualifiers.qualifying_award_winners(inputs, fmt, phases.event_states(inputs, fmt))
    assert {r.team_key for r in rows.collect()} == {"a", "b", "m"}
    assert as_dict(
        qualifiers.championship_spots(inputs, fmt, phases.event_states(inputs, fmt), rows.limit(0)),
        "district_key",
        "wcmp_spots",
    ) == {"2025fsc": 20 - 3 - 2}


def test_spots_before_and_after_the_final(world):
    championship(world)
    championship(world, "2026bb", "open", red_wins=1)
    world.awards("c", [0], "a")
    world.awards("c", [9], "m")
    world.lookups["prequalified_teams"] = [("2026aa", "a"), ("2026aa", "b")]
    inputs, fmt = world.inputs(), FORMATS["dcmp"]
    states = phases.event_states(inputs, fmt)
    assert as_dict(states, "event_key", "event_state") == {"c": "Awards", "open": "Finals"}
    rows = qualifiers.qualifying_award_winners(inputs, fmt, states)
    spots = qualifiers.championship_spots(inputs, fmt, states, rows)
    # four winners; a qualified three ways (two spots free), b two ways (one spot free)
    assert as_dict(spots, "district_key", "wcmp_spots") == {
        "2026aa": 20 - 3 - 4 + 2 + 1,
        "2026bb": 20 - 3 - 4,
    }


def test_unawarded_ras_frees_a_spot_once_completed(world):
    championship(world, types=range(13))
    world.awards("c", [0], "x")
    world.awards("c", [9], "y")
    inputs = world.inputs()
    for mode in ("dcmp", "dcmp_regions"):
        fmt = FORMATS[mode]
        states = phases.event_states(inputs, fmt)
        assert as_dict(states, "event_key", "event_state") == {"c": "Completed"}
        rows = qualifiers.qualifying_award_winners(inputs, fmt, states)
        spots = qualifiers.championship_spots(inputs, fmt, states, rows)
        assert as_dict(spots, "district_key", "wcmp_spots") == {"2026aa": 20 - 3 - 4 + 1}


def test_a_winner_in_no_roster_still_decides_the_event(world):
    championship(world)
    world.rows["alliances"] = [r for r in world.rows["alliances"] if r[1] != "A1"]
    inputs, fmt = world.inputs(), FORMATS["dcmp"]
    states = phases.event_states(inputs, fmt)
    rows = qualifiers.qualifying_award_winners(inputs, fmt, states)
    assert [(r.team_key, r.is_winner) for r in rows.collect()] == [(None, False)] * 3
    spots = qualifiers.championship_spots(inputs, fmt, states, rows)
    assert as_dict(spots, "district_key", "wcmp_spots") == {"2026aa": 20 - 3}


def test_second_look_counts_members_that_are_locked(world, spark):
    world.district()
    world.event("c", kind=C)
    world.quals("c")
    world.alliance("c", "A1", "a", "b", "c")
    world.alliance("c", "A2", "d", "e", "f", "g")
    world.alliance("c", "A3", "x", "y", "z")
    for team in "abcdefgxyz":
        world.points("c", team)
    world.match("c", "sf", 1, "red", "q", "x")
    world.match("c", "sf", 2, "red", "q", "x")  # A3 is out
    inputs, fmt = world.inputs(), FORMATS["dcmp"]
    states = phases.event_states(inputs, fmt)
    team_states = phases.team_event_states(inputs, fmt, states)
    labels = dict(a="100%", b="EI", d="Prequalified", e="50.0%", x="0%")
    status = spark.createDataFrame(
        [("2026aa", t, label) for t, label in labels.items()],
        "district_key string, team_key string, lock_status string",
    )
    spots = spark.createDataFrame([("2026aa", 7), ("2026bb", 3)], "district_key string, wcmp_spots int")
    for mode in ("dcmp", "dcmp_regions"):
        second = qualifiers.guaranteed_spots(inputs, FORMATS[mode], spots, team_states, states, status)
        assert as_dict(second, "district_key", "wcmp_spots") == {"2026aa": 8, "2026bb": 3}


@pytest.mark.parametrize("mode", ["dcmp_regions", "dcmp_divisions"])
def test_members_are_listed_only_at_running_events(spark, mode):
    from checks import domain

    run = domain.open_run(spark, "/root/testdata/sf0.001", mode)
    run.prepare("wcmp_spots_v2")
    made = qualifiers.guaranteed_spots(
        run.inputs,
        run.fmt,
        run.wcmp_spots,
        run.team_event_states.limit(0),
        run._deciding_states,
        run.lock_status,
    )
    lines = made._jdf.queryExecution().optimizedPlan().toString().splitlines()
    depths = [len(line) - len(line.lstrip(" :+-")) for line in lines]
    listed = [i for i, line in enumerate(lines) if "Generate explode" in line]
    assert listed
    for i in listed:
        end = next((j for j in range(i + 1, len(lines)) if depths[j] <= depths[i]), len(lines))
        assert any("Join" in line for line in lines[i + 1 : end])
