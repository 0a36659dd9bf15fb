import datetime as dt

import pytest
from pyspark.sql import functions as F

from checks.domain import open_inputs
from clinchline import run_season
from clinchline.plans.formats import FORMATS, format_for
from clinchline.plans.season import SeasonRun
from clinchline.plans.stages import Stages, joined_where_kept, planned_by_rows

SMALL = "/root/testdata/sf0.001"
FACTS = ["matches", "alliances", "awards", "event_points", "event_teams"]


def inputs_of(spark, mode):
    return open_inputs(spark, SMALL, mode)


def rows(df):
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


def test_unknown_modes_fall_back_to_the_season():
    assert format_for("dcmp_regions").several_championships
    assert format_for("nonsense") is FORMATS["district"]


@pytest.mark.parametrize("mode", ["district_regions", "dcmp_divisions"])
def test_a_run_writes_its_tables_and_reports(spark, tmp_path, mode):
    run_season(spark, inputs_of(spark, mode), FORMATS[mode], str(tmp_path))
    names = {p.name for p in (tmp_path / "tables").iterdir()}
    expected = {"event_states", "adjusted_district_rankings", "following_teams", "lock_status"}
    assert expected <= names
    assert ("lock_status_v2" in names) == (mode == "dcmp_divisions")
    gate = spark.read.parquet(str(tmp_path / "quality" / "gate"))
    passed = {r.district_key for r in gate.where("publish").collect()}
    assert passed
    ranks = spark.read.parquet(str(tmp_path / "reports" / "rankings"))
    assert {r.district_key for r in ranks.select("district_key").distinct().collect()} <= passed
    followers = spark.read.parquet(str(tmp_path / "reports" / "team_followers"))
    pages = spark.read.parquet(str(tmp_path / "reports" / "team_pages"))
    assert followers.join(pages, ["district_key", "team_key"], "left_anti").count() == 0


@pytest.mark.parametrize("mode", ["district", "dcmp"])
def test_districts_together_equal_each_alone(spark, mode):
    everything = inputs_of(spark, mode)
    together = SeasonRun(spark, everything, FORMATS[mode]).published_status
    one = F.col("district_key") == "2020s7"
    events = everything.events.where(one)
    only = everything.replace(
        events=events,
        district_rankings=everything.district_rankings.where(one),
        district_lookup=everything.district_lookup.where(one),
        prequalified_teams=everything.prequalified_teams.where(one),
        **{n: getattr(everything, n).join(events.select("event_key"), "event_key", "left_semi") for n in FACTS},
    )
    alone = SeasonRun(spark, only, FORMATS[mode]).published_status
    assert rows(together.where(one)) == rows(alone)


@pytest.mark.parametrize("mode", ["district_regions", "dcmp_divisions"])
def test_many_snapshots_run_as_one(spark, mode):
    now = inputs_of(spark, mode)
    first, second = dt.date(2026, 3, 1), dt.date(2026, 3, 8)

    def stamped(name):
        table = getattr(now, name)
        early = table
        if name in ("matches", "event_points"):  # an earlier state has fewer rows
            early = table.where(F.xxhash64("event_key") % 2 == 0)
        return early.withColumn("as_of", F.lit(first)).unionByName(
            table.withColumn("as_of", F.lit(second))
        )

    scoped = now.replace(**{n: stamped(n) for n in ["events", "district_rankings", *FACTS]})
    both = SeasonRun(spark, scoped, FORMATS[mode].with_scope("as_of")).published_status
    later = both.where(F.col("as_of") == F.lit(second)).drop("as_of")
    assert rows(later) == rows(SeasonRun(spark, now, FORMATS[mode]).published_status)
    assert rows(both.where(F.col("as_of") == F.lit(first)).drop("as_of")) != rows(later)


def test_properties_of_the_standings(spark):
    run = SeasonRun(spark, inputs_of(spark, "district"), FORMATS["district"])
    ranks = run.adjusted_district_rankings.groupBy("district_key").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_distinct("rank").alias("different"),
        F.max("rank").alias("last"),
    )
    assert all(r.n == r.different == r.last for r in ranks.collect())
    labels = run.lock_status.where(F.col("lock_status").like("%.%"))
    values = [float(r.lock_status[:-1]) for r in labels.collect()]
    assert values and all(0 <= v <= 99.9 for v in values)
    second = SeasonRun(spark, inputs_of(spark, "dcmp"), FORMATS["dcmp"])
    spots = second.wcmp_spots.join(
        second.wcmp_spots_v2.withColumnRenamed("wcmp_spots", "later"), "district_key"
    )
    assert spots.where("later < wcmp_spots").count() == 0


def test_stages_persist_where_no_shared_folder_is_named(spark):
    stages = Stages(spark)
    stages.folder = None
    kept = stages.keep(spark.range(5))
    assert kept.storageLevel.useDisk and kept.count() == 5
    stages.release()
    assert not kept.storageLevel.useDisk


def test_stages_write_below_the_shared_folder(spark, tmp_path):
    stages = Stages(spark)
    stages.folder = str(tmp_path / "stages")
    kept = stages.keep(spark.range(5))
    assert kept.count() == 5 and str(tmp_path) in kept.inputFiles()[0]
    stages.release()
    assert not (tmp_path / "stages").exists()


def published(store, name):
    return rows(store.read(name))


def test_a_published_run_resumes_and_recomputes_only_what_changed(spark, tmp_path, monkeypatch):
    from clinchline.plans import publish
    from clinchline.plans.publish import published_tables, publish_season

    fmt = FORMATS["district"]
    inputs = inputs_of(spark, "district")
    folder = str(tmp_path / "published")
    store = published_tables(spark, folder, fmt)

    # a run that ends half-way shows nothing, and the next one goes on from its stages
    def cut_off(self, name):
        if name == "pass_summary":
            raise RuntimeError("the driver is gone")
        return whole(self, name)

    whole = SeasonRun.stage
    monkeypatch.setattr(SeasonRun, "stage", cut_off)
    with pytest.raises(RuntimeError, match="gone"):
        publish_season(spark, inputs, fmt, folder)
    monkeypatch.setattr(SeasonRun, "stage", whole)
    assert store.version() == 0
    (stage_folder,) = (tmp_path / "published" / "_stages").iterdir()
    done = {p.name for p in (stage_folder / "_done").iterdir() if not p.name.startswith(".")}
    assert {"event_states", "totals", "open_rankings"} <= done and "pass_summary" not in done
    monkeypatch.setattr(publish.SeasonRun, "_totals", None)  # a finished stage is not built again
    assert publish_season(spark, inputs, fmt, folder) == 1
    monkeypatch.undo()
    alone = SeasonRun(spark, inputs, fmt)
    for name in ("lock_status", "following_teams", "event_points_remaining"):
        expected = alone.result_tables()[name]
        assert rows(store.read(name).select(expected.columns)) == rows(expected)
    assert not list((tmp_path / "published" / "_stages").iterdir())
    assert publish_season(spark, inputs, fmt, folder) == 1  # nothing changed

    # one event of one district changes: its district is written anew, all others stay
    event = "2020s7a"
    more = F.when(F.col("event_key") == event, F.col("points") + 3).otherwise(F.col("points"))
    edited = inputs.replace(event_points=inputs.event_points.withColumn("points", more))
    assert edited.event_points.where(F.col("event_key") == event).count() > 0
    assert publish_season(spark, edited, fmt, folder) == 2
    runs = store.manifest().where("table = 'lock_status'").groupBy("run").agg(F.collect_set("district_key").alias("d"))
    sizes = sorted((len(r.d), r.d) for r in runs.collect())
    assert sizes[0] == (1, ["2020s7"]) and len(sizes) == 2
    full = SeasonRun(spark, edited, fmt).lock_status
    assert rows(store.read("lock_status").select(full.columns)) == rows(full)
    # who reads the first version still sees all of it
    before = alone.lock_status
    assert rows(store.read("lock_status", version=1).select(before.columns)) == rows(before)

    # a district that leaves the inputs is empty from then on
    fewer = edited.replace(
        events=edited.events.where("district_key <> '2020s3'"),
        district_rankings=edited.district_rankings.where("district_key <> '2020s3'"),
    )
    assert publish_season(spark, fewer, fmt, folder) == 3
    left = {r.district_key for r in store.read("lock_status").select("district_key").distinct().collect()}
    assert "2020s3" not in left and "2020s7" in left


def test_steps_run_after_what_they_need_and_together():
    import threading

    from clinchline.plans.stages import run_together

    needs = {"a": (), "b": ("a",), "c": ("a",), "d": ("b", "c"), "unused": ()}
    both, order = threading.Barrier(2, timeout=20), []

    def do(name):
        if name in "bc":
            both.wait()  # ends only if both run at once
        order.append(name)

    run_together(needs, do, ["d"])
    assert order[0] == "a" and order[-1] == "d" and sorted(order) == list("abcd")
    with pytest.raises(KeyError):
        run_together({"a": (), "b": ("a",)}, lambda name: {}[name], ["b"])
    with pytest.raises(ValueError, match="need each other"):
        run_together({"a": ("b",), "b": ("a",)}, print, ["a"])


def test_published_runs_do_not_broadcast_files_that_hold_many_rows(spark, tmp_path, monkeypatch):
    from clinchline.plans import publish

    factor, threshold = "spark.sql.sources.fileCompressionFactor", "spark.sql.autoBroadcastJoinThreshold"
    # 300,000 rows: 4.8 MB in memory, a tenth of it as a file
    spark.range(300_000).select((F.col("id") % 1000).alias("k")).coalesce(1).write.parquet(f"{tmp_path}/rows")
    before = spark.conf.get(threshold)

    def planned(*_):
        rows = spark.read.parquet(f"{tmp_path}/rows")
        other = spark.read.parquet(f"{tmp_path}/rows").groupBy("k").count()
        return rows.join(other, "k")._jdf.queryExecution().sparkPlan().toString()

    monkeypatch.setattr(publish, "_publish", planned, raising=False)
    try:
        spark.conf.set(threshold, "1MB")
        assert "BroadcastHashJoin" in planned()
        assert "BroadcastHashJoin" not in publish.publish_season(spark, None, None, str(tmp_path))
        assert spark.conf.get(factor) == "1.0"
    finally:
        spark.conf.set(threshold, before)


def test_ready_results_are_planned_by_rows(spark, tmp_path, monkeypatch):
    inputs = inputs_of(spark, "dcmp")
    factor, keep, seen = "spark.sql.sources.fileCompressionFactor", Stages.keep, {}

    def kept(self, result, name=None):
        seen[name] = spark.conf.get(factor)
        return keep(self, result, name)

    monkeypatch.setattr(Stages, "keep", kept)
    stages = Stages(spark)
    stages.folder = str(tmp_path / "stages")
    run = SeasonRun(spark, inputs, FORMATS["dcmp"], stages)
    followers = run.ready("following_teams")
    assert {"event_states", "totals", "open_rankings", "following_teams"} <= set(seen)
    assert set(seen.values()) == {"30.0"} and spark.conf.get(factor) == "1.0"
    # nothing is left to plan for the action that reads it; the run's own result stays as it is built
    assert "Join" not in followers._jdf.queryExecution().executedPlan().toString()
    assert "Join" in run.following_teams._jdf.queryExecution().executedPlan().toString()
    assert run.ready("following_teams") is followers and followers.count() > 0
    stages.release()


def test_settings_are_given_back_by_the_last_step(spark):
    factor = "spark.sql.sources.fileCompressionFactor"
    first, second = planned_by_rows(spark), planned_by_rows(spark)
    first.__enter__()
    second.__enter__()
    first.__exit__(None, None, None)  # not the order of a stack: steps may run in threads
    assert spark.conf.get(factor) == "30.0"
    second.__exit__(None, None, None)
    assert spark.conf.get(factor) == "1.0"


def test_lines_are_dealt_by_supplier(spark):
    from checks import adaptor

    conf = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(conf, "false")
    try:
        lines = adaptor.read(spark, "/root/testdata/sf0.01", "lineitem").repartition(4)
        dealt = adaptor.dealt_lines(lines)
        placed = dealt.withColumn("p", F.spark_partition_id()).select("l_suppkey", "p").distinct().collect()
        assert len({r.p for r in placed}) > 1 and len(placed) == lines.select("l_suppkey").distinct().count()
        assert dealt.count() == lines.count() and dealt.exceptAll(lines.select(*dealt.columns)).isEmpty()
    finally:
        spark.conf.unset(conf)


def test_dealt_stages_are_grouped_and_joined_without_moving_rows(spark, tmp_path):
    stages = Stages(spark)
    stages.folder = str(tmp_path / "stages")
    rows_of = spark.range(1000).select((F.col("id") % 50).cast("string").alias("k"), "id")
    kept = stages.keep_dealt(stages.deal(rows_of, "k"), "k", ["id"])
    other = stages.keep_dealt(stages.deal(rows_of.select("k").distinct(), "k"), "k")
    counts = kept.groupBy("k").agg(F.count("id").alias("n"))
    joined = other.hint("merge").join(counts, "k")
    assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
    assert {r.n for r in joined.collect()} == {20} and joined.count() == 50
    assert len(kept.inputFiles()) <= stages.deals()
    stages.release()
    assert not (tmp_path / "stages").exists()


def test_dealt_tables_are_joined_by_event_and_team_where_they_are(spark, tmp_path):
    setting = "spark.sql.requireAllClusterKeysForCoPartition"
    given = spark.conf.get(setting)
    stages = Stages(spark)
    stages.folder = str(tmp_path / "stages")
    entries = spark.range(1000).selectExpr("CAST(id % 50 AS STRING) AS event_key", "CAST(id AS STRING) AS team_key")
    kept = stages.keep_dealt(stages.deal(entries, "event_key"), "event_key")
    other = stages.keep_dealt(stages.deal(entries.where("team_key < '5'"), "event_key"), "event_key")

    def joined():
        both = kept.join(other.hint("merge"), ["event_key", "team_key"])
        return "Exchange" in both._jdf.queryExecution().executedPlan().toString(), both.count()

    moved, found = joined()
    assert moved
    with joined_where_kept(spark):
        with joined_where_kept(spark):
            assert joined() == (False, found)
        assert joined() == (False, found)
    assert spark.conf.get(setting) == given and joined() == (True, found)
    stages.release()


def test_totals_of_dealt_tables_equal_those_of_others(spark, tmp_path):
    from checks import adaptor

    stages = Stages(spark)
    stages.folder = str(tmp_path / "stages")
    kept = adaptor.season_inputs(spark, SMALL, "dcmp_divisions", stages)
    plain = inputs_of(spark, "dcmp_divisions")
    assert kept.dealt
    fmt = FORMATS["dcmp_divisions"]
    run = SeasonRun(spark, kept, fmt, stages)
    assert rows(run.ready("adjusted_district_rankings")) == rows(
        SeasonRun(spark, plain, fmt, Stages(spark)).ready("adjusted_district_rankings")
    )
    stages.release()


@pytest.mark.parametrize("mode", ["dcmp", "dcmp_divisions"])
def test_tables_of_events_are_made_where_their_lines_are(spark, tmp_path, mode):
    from checks import adaptor

    stages = Stages(spark)
    stages.folder = str(tmp_path / "stages")
    inputs = adaptor.season_inputs(spark, "/root/testdata/sf0.001", mode, stages)
    for table in (inputs.event_points, inputs.matches, inputs.event_teams, inputs.awards, inputs.alliances):
        assert len({r[0] for r in table.groupBy("event_key").count().select("event_key").collect()}) > 1
        grouped = table.groupBy("event_key").count()
        assert "Exchange" not in grouped._jdf.queryExecution().executedPlan().toString()
    plain = adaptor.season_inputs(spark, "/root/testdata/sf0.001", mode, Stages(spark))
    assert rows(inputs.event_points) == rows(plain.event_points)
    stages.release()


def test_narrow_lines_keep_all_remainders_of_any_key(spark):
    from checks import adaptor

    made = spark.range(-5000, 5000).select(
        (F.col("id") * 7).alias("l_suppkey"),
        F.when(F.col("id") != 3, F.col("id") * 31 + 5).alias("l_orderkey"),
        F.when(F.col("id") != 4, F.col("id") * 17 - 2).alias("l_partkey"),
        F.lit(1).alias("l_linenumber"),
        F.lit(7.9).alias("l_quantity"),
        F.lit("1995-12-31 23:59:59").cast("timestamp").alias("l_shipdate"),
    )

    def read(df):
        parts = [F.col("l_partkey") % m for m in (adaptor.TEAMS, 20, 13, 8)]
        orders = [F.col("l_orderkey") % m for m in (13, 3)]
        day, qty = F.col("l_shipdate").cast("date"), F.col("l_quantity").cast("int")
        return df.select("l_suppkey", *parts, *orders, day, F.year("l_shipdate"), qty)

    assert read(made).exceptAll(read(adaptor.narrow_lines(made))).isEmpty()
