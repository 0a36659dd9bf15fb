"""Raw tables from landed JSON.

Each API response is landed unchanged as one JSON file, below folders that name the key it
was asked for: ``<landing>/<table>/district_key=.../...json`` for district responses and
``<landing>/<table>/event_key=.../...json`` for event responses. A key may be fetched again: a
folder ``fetched_on=<date>`` below the key (in all of a table or in none) dates the response,
and the newest response of each key counts. A paged response is a fetch of several files, one a
page, and counts once all its pages are there. All files of a table are read in one distributed
scan with an explicit schema. The ``flatten_*`` functions are plain DataFrame transformations, so
they serve batch and streaming reads alike; a column ``as_of`` is carried through.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from clinchline import fixed_values as fv, schemas
from clinchline.functions.columns import column_from

_LANDED = {
    "events": (schemas.EVENTS_JSON, "district_key string"),
    "event_teams": (schemas.EVENT_TEAMS_JSON, "event_key string"),
    "matches": (schemas.MATCHES_JSON, "event_key string"),
    "alliances": (schemas.ALLIANCES_JSON, "event_key string"),
    # award responses name their event themselves
    "awards": (schemas.AWARDS_JSON, "landed_event_key string"),
    "event_points": (schemas.EVENT_POINTS_JSON, "event_key string"),
    "district_rankings": (schemas.RANKINGS_JSON, "district_key string"),
    "ranking_pages": (schemas.RANKING_PAGES_JSON, "district_key string"),
}

#: Tables whose response is a set of files, one a page.
_PAGED = {"ranking_pages"}


def landed_schema(table: str) -> str:
    """Schema of the response elements and of the folder key."""
    return ", ".join(_LANDED[table])


def stamped_files(rows: DataFrame) -> DataFrame:
    """Path and time of the file each row was read from."""
    return rows.select(
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_modification_time").alias("_landed"),
    )


def responses(files: DataFrame, table: str) -> DataFrame:
    """Each file with its key and what orders the responses of a key: day, time, path.

    Undated files have an empty day, which is older than any.
    """
    part = lambda name: F.regexp_extract("_file", f"/{name}=([^/]+)/", 1)
    key = _LANDED[table][1].split()[0]
    return files.select("_file", "_landed", part(key).alias("_key"), part("fetched_on").alias("_day"))


def newest_files(files: DataFrame, table: str, as_of: dt.date | None = None) -> DataFrame:
    """The file of each key's newest response, of those fetched by ``as_of``.

    The newest has the latest ``fetched_on``, then the latest modification time, then the last path.
    """
    stamped = responses(files, table)
    if as_of is not None:
        stamped = stamped.where(F.substring("_day", 1, 10) <= as_of.isoformat())
    best = stamped.groupBy("_key").agg(F.max(F.struct("_day", "_landed", "_file")).alias("_best"))
    return best.select("_best._file")


def _valid_on(newest: DataFrame, days: Sequence[dt.date]) -> DataFrame:
    """The wanted days on which each response counts, from its day up to the key's next one.

    ``newest`` has one response per key and day. A response is repeated once per wanted day, which is
    what the result holds; only days are compared, not pairs of responses.
    """
    following = F.lead("_day").over(Window.partitionBy("_key").orderBy("_day"))
    wanted = F.array(*[F.lit(d) for d in sorted(set(days))])
    label = lambda d: F.date_format(d, "yyyy-MM-dd")
    counts = lambda d: (label(d) >= F.col("_day")) & (F.col("_next").isNull() | (label(d) < F.col("_next")))
    # a response fetched at a time of a day counts on that day as a whole
    dated = newest.withColumn("_day", F.substring("_day", 1, 10))
    last = dated.groupBy("_key", "_day").agg(F.max_by("_best", "_order").alias("_best"))
    return (
        last.withColumn("_next", following)
        .withColumn("as_of", F.explode(F.filter(wanted, counts)))
        .select("_best", "as_of")
    )


def files_on(files: DataFrame, table: str, days: Sequence[dt.date]) -> DataFrame:
    """(_file, as_of): the newest response of each key on each wanted day."""
    newest = (
        responses(files, table)
        .groupBy("_key", "_day")
        .agg(F.max(F.struct("_day", "_landed", "_file")).alias("_order"))
        .withColumn("_best", F.col("_order._file"))
    )
    return _valid_on(newest, days).select(F.col("_best").alias("_file"), "as_of")


def ranking_fetches(pages: DataFrame) -> DataFrame:
    """Fetches of paged rankings: how many pages they have, how many they should, and their files.

    ``pages``: rows of the paged table with ``_file`` and ``_landed``. Files belong to one fetch if they
    share the key, the day, the folder ``fetch=<id>`` where there is one, and their name up to its
    trailing number, which is the page (1 without a number). Of a page landed twice the newest file counts. A fetch
    is complete if it has all pages from 1 to the largest ``pageTotal`` that one of them names.
    """
    name = F.regexp_extract("_file", r"([^/]*?)(\d*)\.[^./]*$", 1)
    number = F.regexp_extract("_file", r"(\d*)\.[^./]*$", 1)
    fetch = F.regexp_extract("_file", "/fetch=([^/]+)/", 1)
    # a file that does not parse has neither field: its page has not landed
    landed_pages = pages.where(F.col("pageTotal").isNotNull() | F.col("districtRanks").isNotNull())
    files = (
        responses(pages.select("_file", "_landed"), "ranking_pages")
        .join(landed_pages.groupBy("_file").agg(F.max("pageTotal").alias("_total")), "_file")
        .withColumn("_fetch", F.concat_ws("/", fetch, name))
        .withColumn("_page", F.when(number == "", 1).otherwise(number.cast("int")))
    )
    of_fetch = ["_key", "_day", "_fetch"]
    single = files.groupBy(*of_fetch, "_page").agg(
        F.max(F.struct("_landed", "_file", "_total")).alias("_newest")
    )
    sets = single.groupBy(*of_fetch).agg(
        F.max("_newest._landed").alias("_landed"),
        F.greatest(F.max("_newest._total"), F.lit(1)).alias("page_total"),
        F.collect_set("_page").alias("_pages"),
        F.collect_list("_newest._file").alias("_files"),
    )
    present = F.size(F.filter("_pages", lambda p: (p >= 1) & (p <= F.col("page_total"))))
    return sets.withColumn("pages", present).withColumn("complete", present == F.col("page_total"))


def _complete_files(pages: DataFrame, as_of: dt.date | None, days: Sequence[dt.date] | None) -> DataFrame:
    """Files of the newest complete fetch of each key (on each wanted day)."""
    complete = ranking_fetches(pages).where("complete")
    if as_of is not None:
        complete = complete.where(F.substring("_day", 1, 10) <= as_of.isoformat())
    order = F.struct("_day", "_landed", "_fetch")
    if days is None:
        best = complete.groupBy("_key").agg(F.max_by("_files", order).alias("_best"))
        return best.select(F.explode("_best").alias("_file"))
    newest = complete.groupBy("_key", "_day").agg(F.max_by("_files", order).alias("_best"), F.max(order).alias("_order"))
    return _valid_on(newest, days).select(F.explode("_best").alias("_file"), "as_of")


def read_landed(
    spark: SparkSession, landing: str, table: str, as_of: dt.date | Sequence[dt.date] | None = None
) -> DataFrame:
    """The newest response of every key; a JSON array gives one row per element.

    Which files these are follows from their paths and times (and, of pages, from the number of
    pages they name), so older ones are listed, not counted. With several days the result has a
    column ``as_of``: the responses as they stood on each, in one scan.
    """
    path = f"{landing}/{table}"
    days = None if as_of is None or isinstance(as_of, dt.date) else list(as_of)
    day = as_of if days is None else None
    rows = (
        spark.read.schema(landed_schema(table))
        .option("multiLine", True)
        .json(path)
        .withColumn("_file", F.col("_metadata.file_path"))
    )
    if table in _PAGED:
        pages = rows.withColumn("_landed", F.col("_metadata.file_modification_time"))
        files = _complete_files(pages, day, days)
    else:
        listed = stamped_files(spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path))
        files = newest_files(listed, table, day) if days is None else files_on(listed, table, days)
    kept = rows.join(files, "_file", "left_semi" if days is None else "inner")
    return kept.drop("_file", "fetched_on", "fetch")


def _scope(raw: DataFrame) -> list[str]:
    """Key columns that are carried along with every row: the day, and in the ingest the response's key."""
    return [c for c in ("as_of", "response_key") if c in raw.columns]


def flatten_events(
    raw: DataFrame, excluded: Sequence[str] = tuple(fv.EXCLUDED_EVENTS)
) -> DataFrame:
    return raw.where(F.col("key").isNotNull() & ~F.col("key").isin(*excluded)).select(
        *_scope(raw),
        "district_key",
        F.col("key").alias("event_key"),
        F.col("short_name").alias("name"),
        F.col("event_type_string").alias("event_type"),
        F.col("start_date").cast("date").alias("start_date"),
        F.col("end_date").cast("date").alias("end_date"),
    )


def flatten_event_teams(raw: DataFrame) -> DataFrame:
    return raw.where(F.col("key").isNotNull()).select(
        *_scope(raw), "event_key", F.col("key").alias("team_key")
    )


def _robots(color: str) -> list[Column]:
    keys = F.col(f"alliances.{color}.team_keys")
    return [F.get(keys, F.lit(i)).alias(f"{color}_{i + 1}_key") for i in range(3)]


def flatten_matches(raw: DataFrame) -> DataFrame:
    """Matches with three robots a side; missing ones are null (see ``short_sides``)."""
    return raw.where(F.col("key").isNotNull()).select(
        *_scope(raw),
        F.col("key").alias("match_key"),
        "event_key",
        "comp_level",
        "match_number",
        "winning_alliance",
        F.col("alliances.red.score").alias("red_score"),
        F.col("alliances.blue.score").alias("blue_score"),
        *_robots("red"),
        *_robots("blue"),
    )


def short_sides(matches: DataFrame, keys: Sequence[str] = ("event_key",)) -> DataFrame:
    """Number of matches per event in which a side has fewer than three robots."""
    sides = [f"{c}_{i}_key" for c in ("red", "blue") for i in (1, 2, 3)]
    gap = F.array_contains(F.transform(F.array(*sides), lambda k: k.isNull()), True)
    return matches.groupBy(*keys).agg(F.count_if(gap).alias("short_matches"))


def flatten_alliances(raw: DataFrame) -> DataFrame:
    """Picks by position; there is a fourth only where a backup was called."""
    picks = F.col("picks")
    seats = ["captain_key", "first_selection_key", "second_selection_key", "backup_key"]
    return raw.where(picks.isNotNull()).select(
        *_scope(raw),
        "event_key",
        F.col("name").alias("alliance_name"),
        *[F.get(picks, F.lit(i)).alias(s) for i, s in enumerate(seats)],
    )


def flatten_awards(raw: DataFrame) -> DataFrame:
    """One row per recipient; awards without recipients disappear."""
    return raw.select(
        *_scope(raw), "event_key", "award_type", F.explode("recipient_list").alias("recipient")
    ).select(*_scope(raw), "event_key", "award_type", F.col("recipient.team_key").alias("team_key"))


def flatten_event_points(raw: DataFrame) -> DataFrame:
    """The response is one object keyed by team, or null."""
    rows = raw.select(*_scope(raw), "event_key", F.explode("points").alias("team_key", "p"))
    return rows.select(
        *_scope(raw),
        "event_key",
        "team_key",
        F.col("p.total").alias("points"),
        F.col("p.qual_points").alias("qual_points"),
        F.col("p.alliance_points").alias("selection_points"),
        F.col("p.elim_points").alias("elim_points"),
        F.col("p.award_points").alias("award_points"),
    )


def flatten_rankings(raw: DataFrame) -> DataFrame:
    return raw.where(F.col("team_key").isNotNull()).select(
        *_scope(raw),
        "district_key",
        "team_key",
        "rank",
        F.col("point_total").alias("points"),
        "rookie_bonus",
    )


def flatten_ranking_pages(raw: DataFrame) -> DataFrame:
    """The paginated form of the rankings: teams by number, missing age points are 0."""
    rows = raw.select(*_scope(raw), "district_key", F.explode("districtRanks").alias("r"))
    return rows.select(
        *_scope(raw),
        "district_key",
        F.concat(F.lit(fv.TEAM_KEY_PREFIX), F.col("r.teamNumber").cast("string")).alias(
            "team_key"
        ),
        F.col("r.rank").alias("rank"),
        F.col("r.totalPoints").alias("points"),
        F.coalesce("r.teamAgePoints", F.lit(0)).alias("rookie_bonus"),
    )


def page_request(district_key: Column) -> list[Column]:
    """Year and code under which the paginated source knows a district."""
    return [
        F.substring(district_key, 1, 4).cast("int").alias("year"),
        F.upper(column_from(district_key, 5)).alias("district_code"),
    ]


def first_source(sources: Sequence[DataFrame]) -> DataFrame:
    """Per district (and day), the rows of the first source that has any."""
    tagged = None
    for priority, source in enumerate(sources):
        rows = source.withColumn("_priority", F.lit(priority))
        tagged = rows if tagged is None else tagged.unionByName(rows)
    keys = [*_scope(tagged), "district_key"]
    best = tagged.groupBy(*keys).agg(F.min("_priority").alias("_priority"))
    return tagged.join(best, [*keys, "_priority"]).drop("_priority")


def started_only(facts: DataFrame, events: DataFrame, as_of: dt.date | Column | None = None) -> DataFrame:
    """Facts of events that have begun by ``as_of``, or else by the day in their own column ``as_of``."""
    keys = [*(_scope(facts) if as_of is None else []), "event_key"]
    day = F.col("as_of") if as_of is None else as_of if isinstance(as_of, Column) else F.lit(as_of)
    begun = events.where(F.col("start_date") <= day).select(*keys)
    return facts.join(begun, keys, "left_semi")


def load_raw_tables(
    spark: SparkSession, landing: str, as_of: dt.date | Sequence[dt.date], paginated: bool = False
) -> dict[str, DataFrame]:
    """All raw tables of a landing folder as they stood on ``as_of``.

    With several days every table has a column ``as_of``, and a format ``with_scope("as_of")`` runs all
    snapshots as one job. A district without rankings keeps its events; the quality gate holds it back.
    """
    read = lambda name: read_landed(spark, landing, name, as_of)
    day = as_of if isinstance(as_of, dt.date) else None
    events = flatten_events(read("events"))
    facts = {
        "matches": flatten_matches,
        "alliances": flatten_alliances,
        "awards": flatten_awards,
        "event_points": flatten_event_points,
    }
    rankings = [flatten_rankings(read("district_rankings"))]
    if paginated:
        rankings.insert(0, flatten_ranking_pages(read("ranking_pages")))
    tables = {
        name: started_only(flatten(read(name)), events, day)
        for name, flatten in facts.items()
    }
    entries = flatten_event_teams(read("event_teams"))
    known = [*_scope(events), "event_key"]
    tables["events"] = events
    tables["event_teams"] = entries.join(events.select(*known), known, "left_semi")
    tables["district_rankings"] = first_source(rankings)
    return tables
