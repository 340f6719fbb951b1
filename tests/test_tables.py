"""Temporal, business, route, flow and profile tables on hand-made trips."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from hourgrid.functions import exprs as X
from hourgrid.operators import business, clean, enrich, features, flows, profiles, rollup, routes, temporal
from tests.rows import trip, trips, values, zones


def at(year, month, day, hour, minutes=30, **more):
    start = datetime(year, month, day, hour)
    return trip(pick=start, drop=datetime(year, month, day, hour, minutes), **more)


@pytest.fixture(scope="module")
def data(spark):
    rows = [
        at(2021, 1, 4, 8, pu=2, do=3), at(2021, 1, 4, 9, pu=2, do=3), at(2021, 1, 4, 9, pu=2, do=4),
        at(2021, 1, 9, 8, pu=3, do=2), at(2021, 3, 9, 8, pu=4, do=1),
        at(2023, 1, 4, 8, pu=3, do=3), at(2023, 1, 4, 8, pu=3, do=2, pay=2), at(2023, 2, 4, 20, pu=2, do=3, total=75.0),
        at(2023, 2, 4, 20, pu=1, do=2), at(2023, 2, 5, 20, pu=3, do=2),
    ]
    rows = [tuple(v if i != 7 else v + n for i, v in enumerate(r)) for n, r in enumerate(rows)]  # totals differ
    z = zones(spark)
    full = enrich.trip_enriched(clean.clean_trips(trips(spark, *rows), z), z).persist()
    yield full, features.zone_hour_features(full).persist()
    full.unpersist()


def test_kpis_and_cube_total(data):
    full, cube = data
    k = temporal.kpi_summary(cube).first()
    assert k.total_trips == full.count() == 10
    assert (k.active_days, k.active_pickup_zones, k.active_boroughs) == (6, 4, 3)
    assert k.avg_trips_per_day == pytest.approx(10 / 6)


def test_demand_counts_distinct_days_and_zones(data):
    hourly = temporal.hourly_demand(data[1])
    assert values(hourly, "hour", "total_trips", "active_days", "active_pickup_zones") == [
        (8, 5, 4, 3), (9, 2, 1, 1), (20, 3, 2, 3),
    ]
    assert values(temporal.rush_hour_summary(data[1]), "time_period") == ["morning_peak_06_10", "night_20_23"]


def test_year_over_year_uses_previous_present_year(data):
    rows = temporal.yearly_summary(data[1]).collect()
    assert [(r.year, r.total_trips, r.prev_year_trips, r.yoy_trip_change) for r in rows] == [
        (2021, 5, None, None), (2023, 5, 5, 0.0),
    ]


def test_shares_sum_to_one(data):
    for table, share, keys in (
        (temporal.year_month_demand, "monthly_trip_share_in_year", ["year"]),
        (temporal.borough_year_hour, "hourly_trip_share_in_borough_year", ["pickup_borough", "year"]),
        (temporal.weekday_weekend_by_year, "hourly_trip_share_in_day_type_year", ["year", "day_type"]),
    ):
        sums = values(table(data[1]).groupBy(*keys).agg(F.sum(share).alias("s")), "s")
        assert sums and all(s == pytest.approx(1.0) for s in sums)


def test_month_pattern_counts_years(data):
    rows = temporal.month_of_year_pattern(data[1]).collect()
    assert [(r.month_name, r.active_years, r.avg_trips_per_active_year) for r in rows] == [
        ("Jan", 2, 3.0), ("Feb", 1, 3.0), ("Mar", 1, 1.0),
    ]


def test_rank_ties_stay(spark, data):
    cube = data[1].withColumn("total_revenue", F.lit(1.0))
    top = temporal.top_zones_by_hour(cube, 1).where("hour = 20")
    assert top.count() == 3  # three zones with one trip each share rank 1


def test_zone_rank_change_null_rules(data):
    rows = {r.PULocationID: r for r in temporal.zone_rank_change(data[1], 1).collect()}
    assert set(rows) == {1, 2, 3, 4}
    new, gone, up = rows[1], rows[4], rows[3]
    assert (new.first_rank, new.first_year, new.rank_improvement, new.trip_count_change) == (None, None, None, 1)
    assert (gone.last_rank, gone.trip_count_change, gone.trip_count_pct_change) == (None, -1, None)
    assert (up.first_rank, up.last_rank, up.rank_improvement, up.trip_count_pct_change) == (3, 1, 2, 2.0)  # zone 4 has the higher revenue in 2021


def test_one_year_only(data):
    one = data[1].where("year = 2021")
    rows = temporal.zone_rank_change(one, 50).collect()
    assert all(r.first_year == r.last_year == 2021 and r.rank_improvement == 0 for r in rows) and len(rows) == 3


def test_business_keeps_null_group(spark, data):
    flagged = X.add_trip_flags(data[0].withColumn("passenger_count", F.when(F.col("year") == 2021, F.col("passenger_count"))))
    rows = business.business_table(flagged, "passenger_count_summary").collect()
    assert [(r.passenger_count, r.trip_count) for r in rows] == [(None, 5), (1, 5)]
    matrix = business.business_table(flagged, "pickup_dropoff_borough_matrix")
    assert values(matrix.agg(F.sum("trip_count").alias("n")), "n") == [10]


def test_routes_and_concentration(data):
    table = features.top_routes(data[0])
    ranks = {r.route_key: (r.route_rank, r.trip_count) for r in table.collect()}
    assert ranks["2->3"][1] == ranks["3->2"][1] == 3
    assert sorted(r for r, _ in ranks.values()) == [1, 2, 3, 4, 5, 6]
    curve = routes.route_concentration(table).collect()
    assert curve[-1].cumulative_trip_share == 1.0 and curve[0].route_order == 1
    assert [c.cumulative_trips for c in curve] == [3, 6, 7, 8, 9, 10]
    airport = values(routes.top_airport_routes(table), "route_key")
    assert sorted(airport) == ["1->2", "2->4", "4->1"]
    assert "3->3" not in values(routes.top_inter_borough_routes(table), "route_key")
    assert routes.route_efficiency_ranking(table, 5, 2).count() == 2


def test_equal_routes_share_a_rank(spark):
    z = zones(spark)
    rows = trips(spark, at(2021, 1, 4, 8, pu=2, do=3), at(2021, 1, 4, 8, pu=3, do=2), at(2021, 1, 4, 8, pu=4, do=2, total=1.0))
    table = features.top_routes(enrich.trip_enriched(clean.clean_trips(rows, z), z))
    assert sorted(values(table, "route_rank")) == [1, 1, 2]


def test_balance_cancels_over_all_zones(data):
    full, cube = data
    table = flows.zone_balance_hour(cube, flows.dropoff_zone_hour_features(full))
    row = table.agg(F.sum("net_dropoffs_minus_pickups").alias("n"), F.sum("total_zone_activity").alias("a")).first()
    assert (row.n, row.a) == (0, 20)
    assert set(values(table, "balance_direction")) <= {"balanced", "pickup_heavy", "dropoff_heavy"}


def test_replay_sample_is_independent_of_partitioning(spark, data):
    spots = spark.createDataFrame([(i, float(i), -float(i)) for i in range(1, 6)], "LocationID int, centroid_lon double, centroid_lat double")
    a = flows.map_replay_sample(data[0], spots, 4, 1).collect()
    b = flows.map_replay_sample(data[0].repartition(7), spots, 4, 1).collect()
    assert sorted(a) == sorted(b) and [r.replay_trip_id for r in a] == [1, 2, 3, 4]
    assert all(r.pickup_lon == r.PULocationID and r.pickup_epoch_ms % 1000 == 0 for r in a)


def test_profiles_break_ties_by_smaller_value(data):
    full, cube = data
    peak = {r.PULocationID: (r.peak_hour, r.peak_hour_trip_count) for r in profiles.zone_peak_hour(cube).collect()}
    assert peak[2] == (9, 2) and peak[3] == (8, 3) and peak[4] == (8, 1)
    dest = {r.PULocationID: r.top_dropoff_location_id for r in profiles.zone_top_destination(full).collect()}
    assert dest == {1: 2, 2: 3, 3: 2, 4: 1}
    zone = {r.PULocationID: r for r in profiles.zone_profile_summary(cube, full).collect()}
    assert zone[3].active_zone_hours == 3 and zone[3].active_days == 3
    route = profiles.route_profile_summary(full, 1).collect()
    assert [(r.route_rank, r.trip_count) for r in route] == [(1, 3)]


def test_generic_rollup_handles_no_rows(data):
    empty = data[1].where("hour > 99")
    assert rollup.aggregate_demand(empty, ["hour"]).count() == 0
    assert temporal.kpi_summary(empty).first().avg_trips_per_day is None
