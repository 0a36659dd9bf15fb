"""Registered queries against their SQL on the smallest test tables."""

import pytest

import __spark_entry__ as entry
from checks import domain, ingest_checks, relational, report_checks
from checks.compare import connect, differences

SF_DIR = "/root/testdata/sf0.001"
SAMPLE = [
    "m1_event_regions_district_regions",
    "m3_dcmp_finals_state_dcmp_divisions",
    "m4d_team_event_states_dcmp_divisions",
    "m11_event_points_remaining_district_regions",
    "m16_following_teams_district",
    "m18_lock_status_district",
    "m18_lock_status_district_regions",
    "m23_lock_status_v2_dcmp",
    "m23_lock_status_v2_dcmp_regions",
    "m23_lock_status_v2_dcmp_divisions",
    "q8_gate_district",
    "r12_division_events_dcmp_divisions",
    "r14_page_index_district",
    "s3_matches",
    "f12_round",
    "j4_full_chain",
    "a2_count_distinct",
    "a2_count_distinct_merged",
    "w2_rank_by_total",
    "o4_unpivot",
]


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", SAMPLE)
def test_query_equals_its_sql(spark, con, name):
    assert differences(entry.queries()[name](spark, SF_DIR), con, entry.oracle_sql()[name]) == []


def test_every_query_of_the_library_has_its_sql():
    groups = [relational, ingest_checks, domain, report_checks]
    names = {name for group in groups for name in group.queries()}
    assert names <= set(entry.queries())
    assert names == {name for group in groups for name in group.oracle_sql()}
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_has_rows(spark):
    result = entry.entry(spark)
    assert {"team_key", "lock_status", "color"} <= set(result.columns)
    assert result.limit(1).count() == 1
