from clinchline.operators import phases, qualifiers
from clinchline.plans.formats import FORMATS

from tests.conftest import as_dict

DISTRICT = FORMATS["district"]


def at_playoffs(world, key, semis, red=0, blue=0, types=0, best=None, kind="District"):
    world.event(key, kind=kind)
    world.quals(key)
    world.alliance(key, "A1", "r", "r2", "r3")
    world.semis(key, semis)
    world.finals(key, red, blue)
    world.awards(key, range(types))
    if best is not None:
        world.points(key, "t", award=best)


def test_every_phase_and_boundary(world):
    world.event("pre")
    world.event("only_playoffs")
    world.match("only_playoffs", "sf", 1, "red")
    world.event("quals")
    world.quals("quals", played=1, total=2)
    world.event("selection")
    world.quals("selection")
    for n in (0, 6, 7, 12, 13):
        at_playoffs(world, f"sf{n}", n)
    at_playoffs(world, "one_each", 13, red=1, blue=1)
    at_playoffs(world, "decided", 13, red=2, blue=1, types=10, best=10)
    at_playoffs(world, "no_points", 13, blue=2, types=11)
    at_playoffs(world, "points_late", 13, blue=2, types=11, best=8)
    at_playoffs(world, "done", 13, blue=2, types=11, best=10)
    at_playoffs(world, "odd", 13, blue=2, types=11, best=30)
    at_playoffs(world, "2026txmca", 8)  # short bracket: no numbered phases
    states = phases.event_states(world.inputs(), DISTRICT)
    assert as_dict(states, "event_key", "event_state") == {
        "pre": "Pre-Event",
        "only_playoffs": "Pre-Event",
        "quals": "Qualifications",
        "selection": "Selections",
        "sf0": "Elims 1 to 7",
        "sf6": "Elims 1 to 7",
        "sf7": "Elims 8",
        "sf12": "Elims 13",
        "sf13": "Finals",
        "one_each": "Finals",
        "decided": "Awards",
        "no_points": "ERROR",
        "points_late": "Awards",
        "done": "Completed",
        "odd": "ERROR",
        "2026txmca": "Finals",
    }
    colors = as_dict(states, "event_key", "color")
    assert (colors["done"], colors["pre"], colors["odd"]) == ("93C47D", "FFD966", "B6D7A8")


def test_a_match_without_scores_on_one_side_counts_as_played(world):
    world.event("e")
    world.match("e", "qm", 1, "red", score=0)
    assert as_dict(phases.event_states(world.inputs(), DISTRICT), "event_key", "event_state") == {
        "e": "Selections"
    }


def test_championship_and_division_award_rules(world):
    kind = "District Championship"
    at_playoffs(world, "c", 13, red=2, types=11, best=30, kind=kind)
    at_playoffs(world, "c_open", 13, red=2, types=11, best=24, kind=kind)
    dcmp = phases.event_states(world.inputs(), FORMATS["dcmp"])
    assert as_dict(dcmp, "event_key", "event_state") == {"c": "Completed", "c_open": "Awards"}


def test_division_award_sums_leave_gaps(world):
    kind = "District Championship Division"
    at_playoffs(world, "open", 13, red=2, types=10, best=179, kind=kind)
    at_playoffs(world, "gap_few", 13, red=2, types=10, best=180, kind=kind)
    at_playoffs(world, "gap_many", 13, red=2, types=11, best=164, kind=kind)
    at_playoffs(world, "done", 13, red=2, types=11, best=165, kind=kind)
    states = phases.event_states(world.inputs(), FORMATS["dcmp_divisions"])
    assert as_dict(states, "event_key", "event_state") == {
        "open": "Awards",
        "gap_few": "ERROR",
        "gap_many": "ERROR",
        "done": "Completed",
    }


def test_regional_fanout_multiplies_decided_matches_unless_fixed(world):
    world.lookups["region_lookup"] = [("n", "north"), ("s", "south")]
    at_playoffs(world, "both", 4)
    at_playoffs(world, "one", 4)
    world.event("none")
    world.enter("both", "n", "s")
    world.enter("one", "n")
    inputs, fmt = world.inputs(), FORMATS["district_regions"]
    regions = phases.event_regions(inputs, fmt)
    assert as_dict(regions, ["event_key", "region"], "team_count") == {
        ("both", "north"): 1,
        ("both", "south"): 1,
        ("one", "north"): 1,
    }
    states = phases.event_states(inputs, fmt, regions)
    assert as_dict(states, "event_key", "event_state") == {"both": "Elims 9", "one": "Elims 1 to 7"}
    fixed = phases.event_states(inputs, fmt, regions, fix_region_fanout=True)
    assert as_dict(fixed, "event_key", "event_state")["both"] == "Elims 1 to 7"


def test_finals_of_divisions(world, spark):
    fmt = FORMATS["dcmp_divisions"]
    for i, district in enumerate(["pre", "e1", "e3", "fin", "aw", "done"]):
        world.district(f"2026{district}", impact=1)
        world.event(f"{district}_v", f"2026{district}", "District Championship Division")
        world.event(district, f"2026{district}", "District Championship")
    world.match("e1", "sf", 1)
    world.semis("e3", 2)
    world.semis("fin", 5)
    world.finals("fin", 1, 1)
    for done in ("aw", "done"):
        world.semis(done, 5)
        world.finals(done, 2)
    inputs = world.inputs()
    qualifiers = spark.createDataFrame(
        [("2026done", "t", "Impact")], "district_key string, team_key string, award_type string"
    )
    states = phases.event_states(inputs, fmt)
    result = phases.finals_states(inputs, fmt, states, qualifiers)
    assert as_dict(result, "event_key", "event_state", "num_dcmp_divisions") == {
        "pre": ("Pre-Event", 1),
        "e1": ("Elims 1", 1),
        "e3": ("Elims 3", 1),
        "fin": ("Finals", 1),
        "aw": ("Awards", 1),
        "done": ("Completed", 1),
    }
    assert as_dict(result, "event_key", "name")["done"] == "Alpha State Championship Finals"


def test_two_lost_matches_eliminate_an_alliance(world):
    world.event("e")
    world.quals("e")
    world.alliance("e", "A1", "a", "b", "c")  # no backup
    world.alliance("e", "A2", "d", "f", "g", "h")
    world.alliance("e", "A3", "i", "j", "k")
    world.match("e", "sf", 1, "red", "a", "d")
    world.match("e", "sf", 2, "blue", "d", "a")
    world.match("e", "sf", 3, "red", "d", "i")
    world.match("e", "sf", 4, "red", "unknown", "also unknown")
    for team in "abcdfghijk":
        world.points("e", team, award=5 if team == "b" else 0)
    inputs = world.inputs()
    states = phases.event_states(inputs, DISTRICT)
    result = as_dict(
        phases.team_event_states(inputs, DISTRICT, states),
        "team_key",
        "award_eligible",
        "elim_eligible",
    )
    assert {t for t, (_, playing) in result.items() if not playing} == set("dfgh")
    assert [t for t, (award, _) in result.items() if not award] == ["b"]


def test_division_losses_count_by_level_and_at_the_finals(world):
    fmt = FORMATS["dcmp_divisions"]
    world.district()
    world.event("v", kind="District Championship Division")
    world.event("fin", kind="District Championship")
    world.quals("v")
    world.alliance("v", "A1", "a", "b", "c")
    world.alliance("v", "A2", "d", "e", "f")
    world.alliance("v", "A3", "g", "h", "i")
    world.match("v", "sf", 1, "red", "x", "a")
    world.match("v", "f", 1, "red", "x", "a")  # one loss per level: still in
    world.match("v", "f", 2, "red", "x", "d")
    world.match("v", "f", 3, "red", "x", "d")
    world.alliance("fin", "W", "g", "h", "i")
    world.match("fin", "sf", 1, "red", "y", "g")
    world.match("fin", "sf", 2, "red", "y", "g")
    for team in "abcdefghi":
        world.points("v", team)
    inputs = world.inputs()
    states = phases.event_states(inputs, fmt)
    from clinchline.operators.qualifiers import qualifying_award_winners

    finals = phases.finals_states(inputs, fmt, states, qualifying_award_winners(inputs, fmt))
    result = as_dict(
        phases.division_team_states(inputs, fmt, states, finals), "team_key", "elim_eligible"
    )
    assert {t for t, playing in result.items() if not playing} == set("defghi")


def test_alliances_are_chosen_before_their_members_are_listed(spark):
    from checks import domain

    def below(lines, i):
        depth = len(lines[i]) - len(lines[i].lstrip(" :+-"))
        for line in lines[i + 1 :]:
            if len(line) - len(line.lstrip(" :+-")) <= depth:
                return
            yield line

    for mode in ("dcmp_regions", "dcmp_divisions"):
        run = domain.open_run(spark, "/root/testdata/sf0.001", mode)
        for table in ("team_event_states", "qualifying_award_winners"):
            run.prepare(table)
            made = (
                run.team_event_states
                if table == "team_event_states"
                else qualifiers.qualifying_award_winners(
                    run.inputs, run.fmt, None if run.fmt.divisions else run.event_states
                )
            )
            lines = made._jdf.queryExecution().optimizedPlan().toString().splitlines()
            listed = [i for i, line in enumerate(lines) if "Generate explode" in line]
            assert listed and all(any("Join" in line for line in below(lines, i)) for i in listed)
