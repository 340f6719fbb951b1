"""A spread of registered queries against DuckDB; ``python -m tests.compare`` runs them all."""

import pytest

import __spark_entry__ as entry
from tests.compare import compare, connect

NAMES = [
    "scan_trips_merged", "cleaning_report", "trip_flags", "borough_hour_features", "top_routes",
    "top_zones_by_hour", "zone_rank_change", "airport_trip_summary", "zone_balance_hour",
    "map_replay_sample", "zone_centroids", "route_profile_summary", "lag_features",
    "error_distribution", "stream_zone_demand", "stream_zone_demand_parts", "stream_hotspots", "lk_filters",
    "lk_routes_all", "lk_profiles_route", "lk_map_flows_hour", "lk_spatial", "busiest_zone_forecast",
]


@pytest.mark.parametrize("name", NAMES)
def test_matches_oracle(spark, small_dir, name):
    status, rows = compare(spark, connect(small_dir), entry.queries()[name], entry.oracle_sql()[name], small_dir)
    assert status == "ok" and rows > 0


def test_entry_runs(spark):
    assert entry.entry(spark).count() == 24


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
