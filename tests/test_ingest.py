import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from clinchline.plans.formats import FORMATS
from clinchline import fixed_values as fv
from clinchline.sources import landed, lookups, tables
from clinchline.streaming.landing import read_ingested, refresh_landed

from tests.conftest import as_dict


def land(folder, table, key, name, body, page=""):
    path = folder / table / f"{key}={name}"
    path.mkdir(parents=True, exist_ok=True)
    (path / f"response{page}.json").write_text(json.dumps(body))


@pytest.fixture
def landing(tmp_path):
    folder = tmp_path / "landing"
    for d in ("2026aa", "2026bb"):
        events = [
            {"key": f"{d}1", "short_name": "One", "event_type_string": "District",
             "start_date": "2026-03-01", "end_date": "2026-03-03", "city": "ignored"},
            {"key": f"{d}2", "short_name": "Two", "event_type_string": "District",
             "start_date": "2026-04-01", "end_date": "2026-04-03"},
        ]
        if d == "2026aa":
            events.append({**events[0], "key": fv.EXCLUDED_EVENTS[1]})
        land(folder, "events", "district_key", d, events)
        rankings = [{"team_key": "frc1", "rank": 1, "point_total": 50, "rookie_bonus": 5}]
        land(folder, "district_rankings", "district_key", d, rankings)
        for e in (f"{d}1", f"{d}2"):
            land(folder, "event_teams", "event_key", e, [{"key": "frc1"}, {"key": "frc2"}])
            sides = {
                "red": {"score": 10, "team_keys": ["frc1", "frc2", "frc3"]},
                "blue": {"score": -1, "team_keys": ["frc4", "frc5"]},
            }
            match = {"key": f"{e}_qm1", "comp_level": "qm", "match_number": 1,
                     "winning_alliance": "red", "alliances": sides}
            land(folder, "matches", "event_key", e, [match])
            alliances = [
                {"name": "A1", "picks": ["frc1", "frc2", "frc3"]},
                {"name": "A2", "picks": ["frc4", "frc5", "frc6", "frc7"]},
            ]
            land(folder, "alliances", "event_key", e, alliances)
            awards = [
                {"event_key": e, "award_type": 0, "recipient_list": [{"team_key": "frc1"}, {"team_key": None}]},
                {"event_key": e, "award_type": 9, "recipient_list": []},
            ]
            land(folder, "awards", "landed_event_key", e, awards)
            body = {"points": {"frc1": {"total": 30, "qual_points": 20, "alliance_points": 5,
                                        "elim_points": 4, "award_points": 1}}}
            land(folder, "event_points", "event_key", e, body)
    land(folder, "alliances", "event_key", "2026cc1", None)
    land(folder, "event_points", "event_key", "2026cc1", None)
    return folder


def test_landed_responses_become_tables(spark, landing):
    found = landed.load_raw_tables(spark, str(landing), dt.date(2026, 3, 15))
    assert as_dict(found["events"], "event_key", "district_key", "name", "start_date") == {
        "2026aa1": ("2026aa", "One", dt.date(2026, 3, 1)),
        "2026aa2": ("2026aa", "Two", dt.date(2026, 4, 1)),
        "2026bb1": ("2026bb", "One", dt.date(2026, 3, 1)),
        "2026bb2": ("2026bb", "Two", dt.date(2026, 4, 1)),
    }
    # entries of all events, facts only of those that have started
    assert found["event_teams"].count() == 8
    assert {r.event_key for r in found["matches"].collect()} == {"2026aa1", "2026bb1"}
    match = found["matches"].where("event_key = '2026aa1'").collect()[0]
    assert (match.red_score, match.blue_score, match.red_3_key, match.blue_3_key) == (10, -1, "frc3", None)
    shorts = landed.short_sides(found["matches"])
    assert as_dict(shorts, "event_key", "short_matches") == {"2026aa1": 1, "2026bb1": 1}
    backups = as_dict(found["alliances"], ["event_key", "alliance_name"], "backup_key")
    assert backups[("2026aa1", "A1")] is None and backups[("2026aa1", "A2")] == "frc7"
    assert sorted((r.award_type, str(r.team_key)) for r in found["awards"].collect()) == [
        (0, "None"), (0, "None"), (0, "frc1"), (0, "frc1")
    ]
    assert as_dict(found["event_points"], "event_key", "points", "selection_points") == {
        "2026aa1": (30, 5),
        "2026bb1": (30, 5),
    }
    later = landed.load_raw_tables(spark, str(landing), dt.date(2026, 4, 1))
    assert later["event_points"].count() == 4


def test_pages_win_over_the_plain_rankings_where_they_exist(spark, landing):
    for page, team in ((1, 11), (2, 12)):
        row = {"teamNumber": team, "rank": page, "totalPoints": 70}
        if page == 1:
            row["teamAgePoints"] = 5
        body = {"districtRanks": [row], "pageTotal": 2}
        land(landing, "ranking_pages", "district_key", "2026aa", body, page)
    land(landing, "ranking_pages", "district_key", "2026bb", {"districtRanks": None, "pageTotal": 0})
    found = landed.load_raw_tables(spark, str(landing), dt.date(2026, 3, 15), paginated=True)
    rows = as_dict(found["district_rankings"], ["district_key", "team_key"], "points", "rookie_bonus")
    assert rows == {
        ("2026aa", "frc11"): (70, 5),
        ("2026aa", "frc12"): (70, 0),
        ("2026bb", "frc1"): (50, 5),
    }
    from pyspark.sql import functions as F

    request = found["events"].select(*landed.page_request(F.col("district_key"))).distinct()
    assert {tuple(r) for r in request.collect()} == {(2026, "AA"), (2026, "BB")}


def test_a_district_without_rankings_stays(spark, landing):
    events = [{"key": "2026cc1", "short_name": "One", "event_type_string": "District",
               "start_date": "2026-03-01", "end_date": "2026-03-03"}]
    land(landing, "events", "district_key", "2026cc", events)
    found = landed.load_raw_tables(spark, str(landing), dt.date(2026, 3, 15))
    assert {r.district_key for r in found["events"].collect()} == {"2026aa", "2026bb", "2026cc"}
    assert {r.district_key for r in found["district_rankings"].collect()} == {"2026aa", "2026bb"}


def points(**totals):
    rest = {"qual_points": 1, "alliance_points": 0, "elim_points": 0, "award_points": 0}
    return {"points": {team: {"total": n, **rest} for team, n in totals.items()}}


def test_the_newest_response_of_a_key_counts(spark, tmp_path):
    for day, n in (("2026-03-01", 5), ("2026-03-08", 9), ("2026-03-15", 12)):
        land(tmp_path / "event_points", "event_key=2026aa1", "fetched_on", day, points(frc1=n))
    land(tmp_path / "event_points", "event_key=2026aa2", "fetched_on", "2026-03-01", points(frc1=1))
    land(tmp_path / "event_points", "event_key=2026aa2", "fetched_on", "2026-03-02", {"points": None})

    def read(day):
        rows = landed.read_landed(spark, str(tmp_path), "event_points", day)
        return as_dict(landed.flatten_event_points(rows), ["event_key", "team_key"], "points")

    assert read(None) == {("2026aa1", "frc1"): 12}
    assert read(dt.date(2026, 3, 10)) == {("2026aa1", "frc1"): 9}
    assert read(dt.date(2026, 3, 1)) == {("2026aa1", "frc1"): 5, ("2026aa2", "frc1"): 1}
    land(tmp_path, "event_teams", "event_key", "2026aa1", [{"key": "frc1"}, {"key": "frc2"}])
    land(tmp_path, "event_teams", "event_key", "2026aa1", [{"key": "frc3"}], "2")
    again = landed.flatten_event_teams(landed.read_landed(spark, str(tmp_path), "event_teams"))
    assert [r.team_key for r in again.collect()] == ["frc3"]


def test_incremental_ingest_reads_each_response_once(spark, landing, tmp_path):
    target, progress = str(tmp_path / "raw"), str(tmp_path / "progress")

    def run():
        refresh_landed(spark, str(landing), "event_points", target, progress).awaitTermination(60)
        return read_ingested(spark, target, "event_points")

    assert run().count() == 4
    body = {"points": {"frc9": {"total": 1, "qual_points": 1, "alliance_points": 0,
                                "elim_points": 0, "award_points": 0}}}
    land(landing, "event_points", "event_key", "2026dd1", body)
    assert run().count() == 5
    assert run().count() == 5
    land(landing, "event_points", "event_key", "2026aa1", points(frc1=9), "2")
    assert as_dict(run().where("event_key = '2026aa1'"), "team_key", "points") == {"frc1": 9}
    assert run().count() == 5


def test_saving_again_replaces_only_the_same_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    make = lambda rows: spark.createDataFrame(rows, "district_key string, n int")
    tables.save_table(make([("a", 1), ("b", 1)]), path, ["district_key"])
    tables.save_table(make([("b", 2)]), path, ["district_key"])
    assert as_dict(spark.read.parquet(path), "district_key", "n") == {"a": 1, "b": 2}
    tables.save_table(make([("b", 3)]), path, ["district_key"], append=True)
    assert spark.read.parquet(path).count() == 3


def test_lookups_from_csv(spark, tmp_path):
    files = {
        "qual_points_lookup": "event_size,team_rank,qual_points\n10,1,22\n",
        "district_lookup": "district_key,display_name,dcmp_name,dcmp_capacity,wcmp_capacity,"
        "dcmp_impact_awards,dcmp_ei_awards,dcmp_ras_awards,dcmp_directional_labels\n"
        "2026aa,Alpha,State Championship,60,46,4,2,2,1\n2026bb,Beta,Cup,10,5,1,1,0,\n",
        "points_adjustments": "district_key,team_key,points_adjustment\n2026aa,frc1,-3\n",
        "prequalified_teams": "district_key,team_key\n2026aa,frc1\n",
        "region_lookup": "team_key,region\nfrc1,north\n",
    }
    for name, text in files.items():
        (tmp_path / f"{name}.csv").write_text(text)
    found = lookups.read_lookups(spark, str(tmp_path))
    fixed = lookups.fixed_lookups(spark)
    for name, table in found.items():
        assert table.count() == (2 if name == "district_lookup" else 1)
        if name in fixed:
            assert table.dtypes == fixed[name].dtypes
    flags = as_dict(found["district_lookup"], "district_key", "dcmp_directional_labels", "dcmp_capacity")
    assert flags == {"2026aa": (True, 60), "2026bb": (False, 10)}


def test_fixed_lookups(spark):
    fixed = lookups.fixed_lookups(spark)
    sizes = {n: t.count() for n, t in fixed.items()}
    assert sizes["qual_points"] == 3115 and sizes["district_lookup"] == 31
    assert sizes["points_adjustments"] == 21 and sizes["prequalified_teams"] == 17


def test_a_second_run_keeps_the_first_runs_districts(spark, tmp_path):
    fmt = FORMATS["district"]
    folder = str(tmp_path / "runs")
    for district in ("2026aa", "2026bb"):
        owners = spark.createDataFrame([(district, f"{district}e")], "district_key string, event_key string")
        budget = spark.createDataFrame([(f"{district}e", 5)], "event_key string, points int")
        status = spark.createDataFrame([(district, "frc1")], "district_key string, team_key string")
        tables.write_tables({"budget": budget, "status": status}, folder, fmt, owners)
    for name in ("budget", "status"):
        rows = spark.read.parquet(f"{folder}/{name}").collect()
        assert {r.district_key for r in rows} == {"2026aa", "2026bb"}
    with pytest.raises(ValueError, match="district_key"):
        tables.write_tables({"stray": spark.range(1)}, folder, fmt)


def test_keys_and_counts_are_not_cut(spark):
    from pyspark.sql import functions as F

    from clinchline.functions.columns import column_from, percent_label

    row = spark.range(1).select(
        column_from(F.lit("frc" + "1" * 80), 4).alias("key"),
        percent_label(F.lit(10**11), F.lit(4 * 10**11)).alias("share"),
    ).first()
    assert (row.key, row.share) == ("1" * 80, "25.0%")


def ingest_of(spark, landing, target, progress, table="event_points"):
    def run():
        refresh_landed(spark, str(landing), table, str(target), str(progress)).awaitTermination(90)
        return read_ingested(spark, str(target), table)

    return run


def test_an_older_response_that_lands_later_changes_nothing(spark, tmp_path):
    run = ingest_of(spark, tmp_path / "landing", tmp_path / "raw", tmp_path / "progress")
    key = tmp_path / "landing" / "event_points" / "event_key=2026aa1"
    land(key.parent, key.name, "fetched_on", "2026-03-10", points(frc1=50))
    assert as_dict(run(), "team_key", "points") == {"frc1": 50}
    land(key.parent, key.name, "fetched_on", "2026-03-05", points(frc1=10, frc2=3))
    assert as_dict(run(), "team_key", "points") == {"frc1": 50}
    batch = landed.read_landed(spark, str(tmp_path / "landing"), "event_points")
    assert as_dict(landed.flatten_event_points(batch), "team_key", "points") == {"frc1": 50}
    # the newest of one batch counts, whatever the order of its files
    land(key.parent, key.name, "fetched_on", "2026-03-12", points(frc1=60))
    land(key.parent, key.name, "fetched_on", "2026-03-11", points(frc1=55))
    land(key.parent, "event_key=2026aa2", "fetched_on", "2026-03-01", points(frc7=7))
    assert as_dict(run(), ["event_key", "team_key"], "points") == {("2026aa1", "frc1"): 60, ("2026aa2", "frc7"): 7}


def test_a_newer_empty_response_empties_its_key(spark, tmp_path):
    run = ingest_of(spark, tmp_path / "landing", tmp_path / "raw", tmp_path / "progress", "event_teams")
    key = tmp_path / "landing" / "event_teams"
    for event in ("2026aa1", "2026aa2", "2026aa3"):
        land(key, f"event_key={event}", "fetched_on", "2026-03-01", [{"key": "frc1"}, {"key": "frc2"}])
    assert run().count() == 6
    land(key, "event_key=2026aa1", "fetched_on", "2026-03-02", [])
    land(key, "event_key=2026aa2", "fetched_on", "2026-03-02", None)
    broken = key / "event_key=2026aa3" / "fetched_on=2026-03-02"
    broken.mkdir(parents=True)
    (broken / "response.json").write_text('[{"key": "frc')
    assert as_dict(run(), ["event_key", "team_key"], "event_key").keys() == {("2026aa3", "frc1"), ("2026aa3", "frc2")}
    land(key, "event_key=2026aa1", "fetched_on", "2026-03-01", [{"key": "frc3"}], "late")
    assert run().count() == 2


@pytest.mark.parametrize("table", ["events", "matches", "alliances", "awards", "event_points", "district_rankings"])
def test_ingested_tables_equal_the_batch(spark, landing, tmp_path, table):
    from clinchline.streaming.landing import FLATTEN

    found = ingest_of(spark, landing, tmp_path / "raw", tmp_path / "progress", table)()
    batch = FLATTEN[table](landed.read_landed(spark, str(landing), table))
    assert found.dtypes == batch.dtypes
    assert sorted(map(str, found.collect())) == sorted(map(str, batch.collect()))


def page(total, *teams):
    rows = [{"teamNumber": t, "rank": i + 1, "totalPoints": 70 - i} for i, t in enumerate(teams)]
    return {"districtRanks": rows, "pageTotal": total}


def test_only_a_complete_fetch_of_pages_counts(spark, tmp_path):
    folder = tmp_path / "ranking_pages"

    def put(district, day, name, body):
        path = folder / f"district_key={district}" / f"fetched_on={day}"
        path.mkdir(parents=True, exist_ok=True)
        (path / f"{name}.json").write_text(body if isinstance(body, str) else json.dumps(body))

    def read(day=None):
        rows = landed.flatten_ranking_pages(landed.read_landed(spark, str(tmp_path), "ranking_pages", day))
        return sorted((r.district_key, r.team_key) for r in rows.collect())

    put("2026aa", "2026-03-01", "page1", page(2, 1))
    put("2026aa", "2026-03-01", "page2", page(2, 2))
    # a later fetch lacks its second of three pages, another has one that does not parse
    put("2026aa", "2026-03-02", "page1", page(3, 1, 3))
    put("2026aa", "2026-03-02", "page3", page(3, 4))
    put("2026aa", "2026-03-03", "page1", page(2, 9))
    put("2026aa", "2026-03-03", "page2", '{"districtRanks": [')
    # two fetches on one day under other names: each team once
    for name in ("morning", "noon"):
        put("2026bb", "2026-03-01", f"{name}1", page(2, 5))
        put("2026bb", "2026-03-01", f"{name}2", page(2, 6))
    put("2026cc", "2026-03-01", "response", page(0))
    put("2026dd", "2026-03-01", "page1", page(3, 7))
    assert read() == [("2026aa", "frc1"), ("2026aa", "frc2"), ("2026bb", "frc5"), ("2026bb", "frc6")]
    put("2026aa", "2026-03-02", "page2", page(3, 8))
    assert read()[:4] == [("2026aa", f"frc{t}") for t in (1, 3, 4, 8)]
    assert read(dt.date(2026, 3, 1))[:2] == [("2026aa", "frc1"), ("2026aa", "frc2")]
    pages = spark.read.schema(landed.landed_schema("ranking_pages")).option("multiLine", True).json(str(folder))
    stamped = pages.select("*", *[F.col(f"_metadata.{a}").alias(b) for a, b in (("file_path", "_file"), ("file_modification_time", "_landed"))])
    fetches = landed.ranking_fetches(stamped).where("_key = '2026dd'").collect()
    assert [(f.pages, f.page_total, f.complete) for f in fetches] == [(1, 3, False)]


def test_a_hundred_days_in_one_scan(spark, tmp_path):
    day = lambda i: dt.date(2026, 1, 1) + dt.timedelta(days=i)
    fetched = {"2026aa1": [0, 7, 8, 40], "2026aa2": [30, 31, 99], "2026aa3": [120]}
    for event, days in fetched.items():
        for i in days:
            body = {"points": None} if (event, i) == ("2026aa1", 8) else points(frc1=i, frc2=1)
            land(tmp_path / "event_points", f"event_key={event}", "fetched_on", day(i).isoformat(), body)
    wanted = [day(i) for i in range(100)]
    together = landed.flatten_event_points(landed.read_landed(spark, str(tmp_path), "event_points", wanted))
    found = {}
    for r in together.collect():
        found.setdefault(r.as_of, []).append((r.event_key, r.team_key, r.points))
    for i, d in enumerate(wanted):
        expected = []
        for event, days in fetched.items():
            last = max((x for x in days if x <= i), default=None)
            if last is not None and (event, last) != ("2026aa1", 8):
                expected += [(event, "frc1", last), (event, "frc2", 1)]
        assert sorted(found.get(d, [])) == sorted(expected)
    for i in (0, 8, 39, 99):
        alone = landed.flatten_event_points(landed.read_landed(spark, str(tmp_path), "event_points", day(i)))
        assert sorted((r.event_key, r.team_key, r.points) for r in alone.collect()) == sorted(found.get(day(i), []))


def test_raw_tables_of_many_days(spark, landing):
    for n, team in ((1, 11), (2, 12)):
        land(landing, "ranking_pages", "district_key", "2026aa", page(2, team), n)
    days = [dt.date(2026, 2, 1), dt.date(2026, 3, 15), dt.date(2026, 4, 2)]
    together = landed.load_raw_tables(spark, str(landing), days, paginated=True)
    for day in days:
        alone = landed.load_raw_tables(spark, str(landing), day, paginated=True)
        for name, table in together.items():
            on_day = table.where(F.col("as_of") == F.lit(day)).drop("as_of")
            assert sorted(map(str, on_day.select(alone[name].columns).collect())) == sorted(map(str, alone[name].collect())), (name, day)


def test_readers_see_whole_versions(spark, tmp_path):
    from clinchline.sources.versions import VersionedTables

    store = VersionedTables(spark, str(tmp_path / "v"), {"district_key": "string"})
    schema = "district_key string, n int"
    make = lambda rows: spark.createDataFrame(rows, schema)
    read = lambda table, version=None: sorted(map(tuple, store.read(table, schema, version).collect()))
    assert read("a") == [] and store.version() == 0
    for table in ("a", "b"):
        store.write(table, make([("x", 1), ("y", 1)]), "one")
    assert read("a") == []  # written, not published
    store.publish(["a", "b"], make([("x", 0), ("y", 0)]), "one")
    assert read("a") == read("b") == [("x", 1), ("y", 1)]
    store.write("a", make([("y", 2)]), "two")
    assert read("a") == [("x", 1), ("y", 1)]  # half of a run
    store.write("b", make([]), "two")
    before = store.manifest()
    store.publish(["a", "b"], make([("y", 0)]), "two")
    assert read("a") == [("x", 1), ("y", 2)] and read("b") == [("x", 1)]
    assert read("a", 1) == [("x", 1), ("y", 1)] and before.count() == 4
    store.write("a", make([("z", 9)]), "abandoned")
    assert store.vacuum(keep=1) == ["abandoned"]
    assert read("a") == [("x", 1), ("y", 2)]
    store.write("a", make([("x", 3), ("y", 3)]), "three")
    store.write("b", make([("x", 3), ("y", 3)]), "three")
    store.publish(["a", "b"], make([("x", 0), ("y", 0)]), "three")
    assert store.vacuum(keep=1) == ["one", "two"] and read("b") == [("x", 3), ("y", 3)]


def test_a_page_reads_one_row_group_of_a_report(spark, tmp_path, monkeypatch):
    import glob

    import pyarrow.parquet as pq

    monkeypatch.setattr(tables, "REPORT_GROUP_BYTES", 1 << 14)
    team = F.concat(F.lit("frc"), F.lpad(F.col("id").cast("string"), 6, "0"))
    pages = spark.range(60_000).select(F.lit("2026aa").alias("district_key"), team.alias("team_key"), F.sha2(team, 256).alias("text"))
    tables.write_reports({"team_pages": pages}, str(tmp_path), FORMATS["district"])
    groups = []
    for file in glob.glob(f"{tmp_path}/team_pages/*/*.parquet"):
        meta = pq.ParquetFile(file).metadata
        place = meta.schema.names.index("team_key")
        for g in range(meta.num_row_groups):
            column = meta.row_group(g).column(place)
            groups.append((column.statistics.min, column.statistics.max))
    assert len(groups) > 10
    wanted = "frc031234"
    assert sum(low <= wanted <= high for low, high in groups) == 1
    row = spark.read.parquet(f"{tmp_path}/team_pages").where(F.col("team_key") == wanted).collect()
    assert [r.team_key for r in row] == [wanted]


def test_reports_of_many_small_districts_stay_small(spark, tmp_path):
    import glob
    import os

    import pyarrow.parquet as pq

    teams = spark.range(2400).select(
        F.concat(F.lit("2026d"), (F.col("id") % 40).cast("string")).alias("district_key"),
        F.concat(F.lit("frc"), F.col("id").cast("string")).alias("team_key"),
        F.col("id").cast("int").alias("rank"),
    )
    tables.write_reports({"rankings": teams}, str(tmp_path), FORMATS["district"])
    files = glob.glob(f"{tmp_path}/rankings/*/*.parquet")
    assert len(files) >= 40 and sum(map(os.path.getsize, files)) < 40 * 4096  # a full filter takes 1 MB a file
    assert sum(pq.ParquetFile(f).metadata.num_rows for f in files) == 2400
