"""Runs that publish: only changed districts, resumable, visible as a whole.

A run compares a fingerprint of each district's inputs with that of the version it follows. Districts that
changed are recomputed, in stages that survive a lost driver; their tables and reports become visible together
(``VersionedTables``), and the districts that did not change stay as they are.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from clinchline.operators import quality
from clinchline.plans.formats import Format
from clinchline.plans.season import SeasonRun
from clinchline.plans.stages import TOGETHER, Stages, planned_by_rows, run_together
from clinchline.sources.inputs import SeasonInputs
from clinchline.sources.landed import short_sides
from clinchline.sources.tables import DIVISION_EVENT_ORDER, REPORT_ORDER, with_home
from clinchline.sources.versions import VersionedTables

_FACTS = ["event_teams", "matches", "alliances", "awards", "event_points"]
_DISTRICT_LOOKUPS = ["district_lookup", "points_adjustments", "prequalified_teams", "championship_rules"]
_COMMON = ["region_lookup", "qual_points"]
_SUMS = ["rows", "first", "second"]


def _hash(df: DataFrame, name: str) -> Column:
    return F.xxhash64(F.lit(name), *[F.col(c) for c in sorted(df.columns)])


def _summed(df: DataFrame, name: str, keys: Sequence[str]) -> DataFrame:
    """Number of rows and two sums of their hashes: equal for equal rows in any order.

    Sums of whole numbers are added before the shuffle, and a key of any size stays a single row.
    """
    wide = lambda h: F.sum(h.cast("decimal(20,0)"))
    return (
        df.select(*keys, _hash(df, name).alias("_h"))
        .groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("rows"), wide(F.col("_h")).alias("first"), wide(F.xxhash64("_h", F.lit(7))).alias("second"))
    )


def _added(sums: DataFrame, keys: Sequence[str]) -> DataFrame:
    return sums.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in _SUMS])


def district_fingerprints(inputs: SeasonInputs, fmt: Format) -> DataFrame:
    """One row per district: a digest of all input rows that its results can depend on."""
    owners = inputs.events.select(*fmt.home, "event_key").distinct()
    sums = _summed(inputs.events, "events", fmt.home).unionByName(
        _summed(inputs.district_rankings, "district_rankings", fmt.home)
    )
    for name in _FACTS:
        per_event = _summed(getattr(inputs, name), name, fmt.event)
        sums = sums.unionByName(_added(per_event.join(owners, fmt.event), fmt.home))
    if inputs.short_brackets is not None:
        per_event = _summed(inputs.short_brackets, "short_brackets", ["event_key"])
        sums = sums.unionByName(_added(per_event.join(owners, "event_key"), fmt.home))
    homes = _added(sums, fmt.home)
    looked_up = None
    for name in _DISTRICT_LOOKUPS:
        table = getattr(inputs, name)
        if table is not None:
            one = _summed(table, name, ["district_key"])
            looked_up = one if looked_up is None else looked_up.unionByName(one)
    looked_up = _added(looked_up, ["district_key"]).select(
        "district_key", *[F.col(c).alias(f"lookup_{c}") for c in _SUMS]
    )
    common = [
        [str(v) for v in _summed(getattr(inputs, name), name, []).first()]
        for name in _COMMON
        if getattr(inputs, name) is not None
    ]
    said = F.concat_ws(
        "|",
        F.lit(f"{fmt.name} {common}"),
        *[F.coalesce(F.col(c).cast("string"), F.lit("-")) for c in [*_SUMS, *[f"lookup_{c}" for c in _SUMS]]],
    )
    return homes.join(looked_up, "district_key", "left").select(*fmt.home, F.sha2(said, 256).alias("fingerprint"))


def only_districts(inputs: SeasonInputs, fmt: Format, homes: DataFrame) -> SeasonInputs:
    """The inputs of some districts; lookups stay whole."""
    events = inputs.events.join(homes, fmt.home, "left_semi")
    keys = events.select(*fmt.event).distinct()
    return inputs.replace(
        events=events,
        district_rankings=inputs.district_rankings.join(homes, fmt.home, "left_semi"),
        **{name: getattr(inputs, name).join(keys, fmt.event, "left_semi") for name in _FACTS},
    )


def published_tables(spark: SparkSession, folder: str, fmt: Format, events: DataFrame | None = None) -> VersionedTables:
    """The published versions of a format's tables, reports (``report_*``) and checks (``check_*``)."""
    kinds = dict(events.dtypes) if events is not None else {}
    return VersionedTables(spark, folder, {k: kinds.get(k, "date" if k == "as_of" else "string") for k in fmt.home})


def publish_season(spark: SparkSession, inputs: SeasonInputs, fmt: Format, folder: str, together: int = TOGETHER) -> int:
    """Bring the published results up to date with the inputs; returns the version that counts now.

    If nothing changed that is the version there was. A run that was cut off leaves its finished stages
    and tables below ``<folder>/_stages``; the next call with the same inputs goes on from them. Districts
    that vanished from the inputs are published as empty. Keys must not be null.
    """
    with planned_by_rows(spark):
        return _publish(spark, inputs, fmt, folder, together)


def _publish(spark: SparkSession, inputs: SeasonInputs, fmt: Format, folder: str, together: int) -> int:
    store = published_tables(spark, folder, fmt, inputs.events)
    now = district_fingerprints(inputs, fmt)
    if store.version():
        then = store.read("fingerprints").withColumnRenamed("fingerprint", "_then")
        now = now.join(then, fmt.home, "full").where(~F.col("fingerprint").eqNullSafe(F.col("_then"))).drop("_then")
    changed = now.persist()
    try:
        digest = changed.agg(
            F.count(F.lit(1)).alias("n"),
            F.sum(F.xxhash64(*fmt.home, "fingerprint").cast("decimal(20,0)")).alias("sum"),
        ).first()
        if not digest["n"]:
            return store.version()
        run = f"{store.version() + 1}-{digest['n']}-{digest['sum']}"
        stages = Stages(spark, f"{folder.rstrip('/')}/_stages/{run}")
        dirty = stages.keep(lambda: changed, "changed")
    finally:
        changed.unpersist()
    homes = dirty.select(*fmt.home)
    season = SeasonRun(spark, only_districts(inputs, fmt, homes), fmt, stages)
    owners = season.inputs.events.select(*fmt.home, "event_key").distinct()
    stage_needs = season.needs()

    def tables() -> dict[str, tuple[DataFrame, Sequence[str]]]:
        out = {name: (df, ()) for name, df in season.result_tables().items()}
        checks = {
            "gate": season.gate,
            "event_checks": season.event_checks,
            "open_questions": quality.open_questions(season.inputs, fmt, season.event_states),
            "short_sides": short_sides(season.inputs.matches, fmt.event),
        }
        out |= {f"check_{name}": (df, ()) for name, df in checks.items()}
        for name, df in season.report_tables().items():
            order = REPORT_ORDER.get(name, [])
            out[f"report_{name}"] = (df, order if set(order) <= set(df.columns) else DIVISION_EVENT_ORDER)
        out["fingerprints"] = (dirty.where(F.col("fingerprint").isNotNull()), ())
        return {name: (with_home(name, df, fmt, owners), order) for name, (df, order) in out.items()}

    run_together(stage_needs, season.stage, stage_needs, together)
    written = tables()

    def write(name: str) -> None:
        mark = f"written_{name}"
        if stages.marked(mark) is None:
            df, order = written[name]
            store.write(name, df, run, order)
            stages.mark(mark)

    run_together({name: () for name in written}, write, written, together)
    version = store.publish(list(written), homes, run)
    stages.release()
    return version
