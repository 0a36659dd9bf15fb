import datetime as dt

import pytest

from checks.session import local_session
from clinchline import schemas
from clinchline.sources import lookups
from clinchline.sources.inputs import SeasonInputs


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session("4", "4g")
    if session.conf.get("spark.checkpoint.dir", None) is None:
        folder = str(tmp_path_factory.mktemp("checkpoints"))
        session.sparkContext.setCheckpointDir(folder)
    return session


DAY = dt.date(2026, 3, 1)


class World:
    """Hand-made competition tables; what is not given is empty."""

    def __init__(self, spark):
        self.spark = spark
        self.rows = {name: [] for name in schemas.RAW_TABLES}
        self.lookups = {}

    def district(self, key="2026aa", capacity=10, wcmp=5, impact=1, ei=1, ras=1, labels=False):
        self.lookups.setdefault("district_lookup", []).append(
            (key, "Alpha", "State Championship", capacity, wcmp, impact, ei, ras, labels)
        )

    def event(self, key, district="2026aa", kind="District", day=0, name=None):
        date = DAY + dt.timedelta(days=day)
        self.rows["events"].append((district, key, name or key, kind, date, date))

    def match(self, event, level, number, winner=None, red="r", blue="b", score=None):
        points = score if score is not None else (10 if winner else -1)
        self.rows["matches"].append(
            (f"{event}_{level}{number}", event, level, number, winner, points, points)
            + (red, "r2", "r3", blue, "b2", "b3")
        )

    def quals(self, event, played=2, total=2):
        for i in range(total):
            self.match(event, "qm", i, "red" if i < played else None)

    def semis(self, event, decided, red="r", blue="b"):
        for i in range(decided):
            self.match(event, "sf", i, "red", red, blue)

    def finals(self, event, red_wins=0, blue_wins=0, red="r", blue="b"):
        for i in range(red_wins + blue_wins):
            self.match(event, "f", i, "red" if i < red_wins else "blue", red, blue)

    def alliance(self, event, name, *picks):
        self.rows["alliances"].append((event, name, *(list(picks) + [None] * 4)[:4]))

    def awards(self, event, types, team="x"):
        for t in types:
            self.rows["awards"].append((event, t, team))

    def points(self, event, team, qual=0, selection=0, elim=0, award=0):
        total = qual + selection + elim + award
        self.rows["event_points"].append((event, team, total, qual, selection, elim, award))

    def enter(self, event, *teams):
        self.rows["event_teams"] += [(event, t) for t in teams]

    def ranking(self, team, rank, bonus=0, district="2026aa"):
        self.rows["district_rankings"].append((district, team, rank, 0, bonus))

    def inputs(self) -> SeasonInputs:
        make = self.spark.createDataFrame
        tables = {n: make(self.rows[n], s) for n, s in schemas.RAW_TABLES.items()}
        given = {
            name: make(rows, getattr(schemas, name.upper()))
            for name, rows in self.lookups.items()
        }
        empty = {
            name: make([], getattr(schemas, name.upper()))
            for name in ("points_adjustments", "prequalified_teams", "region_lookup")
            if name not in given
        }
        base = lookups.fixed_lookups(self.spark)
        return SeasonInputs(**{**base, **empty, **given, **tables})


@pytest.fixture
def world(spark):
    return World(spark)


def as_dict(df, key, *columns):
    """Collect a small result into {key: value or tuple}."""
    keys = [key] if isinstance(key, str) else list(key)
    result = {}
    for row in df.select(*keys, *columns).collect():
        k = row[0] if len(keys) == 1 else tuple(row[: len(keys)])
        v = tuple(row[len(keys) :])
        assert k not in result, f"two rows for {k}"
        result[k] = v[0] if len(columns) == 1 else v
    return result
