from datetime import datetime

import pytest
from pyspark.sql import functions as F

from hourgrid import schema as S
from hourgrid.functions import exprs as X
from hourgrid.operators import clean, enrich, features
from tests.rows import trip, trips, values, zones

GOOD = trip()


@pytest.fixture(scope="module")
def defects(spark):
    return trips(
        spark, GOOD, GOOD,
        trip(pick=None), trip(pu=None), trip(drop=datetime(2021, 5, 3, 8, 0)), trip(fare=-1.0),
        trip(passengers=-1.0), trip(pu=99), trip(distance=None), trip(total=None),
        trip(pick=datetime(2021, 1, 1), drop=datetime(2021, 1, 1, 0, 5)),
        trip(pick=datetime(2025, 1, 1), drop=datetime(2025, 1, 1, 0, 5)),
        trip(pick=datetime(2024, 12, 31, 23, 59), drop=datetime(2025, 1, 1, 0, 5)),
        trip(passengers=None),
    )


def test_clean_keeps_only_valid_rows(spark, defects):
    out = clean.clean_trips(defects, zones(spark))
    kept = sorted(values(out, "pickup_ts"))
    assert kept == [
        datetime(2021, 1, 1), datetime(2021, 5, 3, 8), datetime(2021, 5, 3, 8),
        datetime(2024, 12, 31, 23, 59),
    ]
    assert dict(out.dtypes)["passenger_count"] == "int"
    assert values(out.where("pickup_ts < '2021-02-01'"), "trip_duration_min") == [5.0]


def test_report_counts_each_step(spark, defects):
    report = clean.cleaning_report(defects, zones(spark)).collect()
    assert [(r.step, r.row_count, r.removed_rows) for r in report] == [
        ("raw", 14, 0), ("time_order", 11, 3), ("date_window", 10, 1), ("numeric", 6, 4),
        ("valid_zones", 5, 1), ("distinct", 4, 1),
    ]
    assert report[-1].removal_ratio == pytest.approx(10 / 14)


def test_project_renames_fee_and_tolerates_missing(spark, defects):
    raw = defects.withColumnRenamed("airport_fee", "Airport_fee").withColumn("other", F.lit(1))
    out = clean.project_needed(raw.drop("tolls_amount"))
    assert "airport_fee" in out.columns and "other" not in out.columns
    assert "tolls_amount" not in out.columns
    # the cube can still be built
    cleaned = clean.clean_trips(raw.drop("tolls_amount"), zones(spark))
    cube = features.zone_hour_features(enrich.trip_enriched(cleaned, zones(spark)))
    assert set(values(cube, "total_tolls_amount")) == {None}


def test_labels_default_to_unknown(spark):
    raw = trips(spark, GOOD, trip(vendor=3, rate=50.0, pay=9, flag=None), trip(vendor=None, rate=None, pay=None, flag="?"))
    out = X.add_business_labels(raw)
    names = ("vendor_name", "ratecode_desc", "payment_type_desc", "store_and_fwd_desc")
    rows = values(out, *names)
    assert rows[0] == ("Creative Mobile Technologies, LLC", "Standard rate", "Credit card", "Not a store and forward trip")
    assert rows[1] == rows[2] == ("Unknown",) * 4


def test_enriched_order_calendar_and_null_zone(spark):
    cleaned = clean.clean_trips(trips(spark, trip(do=5), trip(pick=datetime(2021, 5, 2, 23, 0))), zones(spark))
    out = enrich.trip_enriched(cleaned, zones(spark))
    assert out.columns[: len(S.TRIP_ORDER)] == S.TRIP_ORDER
    by_day = {r.weekday_name: r for r in out.collect()}
    assert (by_day["Mon"].day_of_week, by_day["Mon"].is_weekend) == (2, 0)
    assert (by_day["Sun"].day_of_week, by_day["Sun"].is_weekend) == (1, 1)
    assert by_day["Mon"].route_key == "2->5" and by_day["Mon"].route_name == "Jamaica"
    assert by_day["Sun"].year_month == "2021-05" and by_day["Sun"].hour == 23


def test_flags_follow_three_valued_logic(spark):
    rows = trips(
        spark, trip(pu=4, do=1), trip(pu=2, do=4), trip(pu=4, do=3), trip(pu=5, do=3),
        trip(distance=0.0, total=0.0, tip=None),
    )
    placed = enrich.join_zone_lookup(clean.standardize_columns(rows), zones(spark))
    out = X.add_trip_flags(placed).orderBy("PULocationID", "DOLocationID").collect()
    kinds = {(r.PULocationID, r.DOLocationID): r for r in out}
    assert kinds[4, 1].airport_trip_type == "airport_to_airport"
    assert kinds[2, 4].airport_trip_type == "airport_dropoff"
    assert kinds[4, 3].airport_trip_type == "airport_pickup"
    assert kinds[5, 3].airport_trip_type == "non_airport" and kinds[5, 3].is_inter_borough == 0
    zero = kinds[2, 3]
    assert zero.tip_share_of_total is None and zero.fare_per_mile is None
    assert (zero.distance_bucket, zero.fare_bucket, zero.duration_bucket) == ("00_<1_mile", "00_<10", "03_20_40_min")


def test_cube_averages_skip_nulls_but_rollups_do_not(spark):
    rows = trips(spark, trip(passengers=None), trip(passengers=4.0, distance=15.0))
    cube = features.zone_hour_features(enrich.trip_enriched(clean.clean_trips(rows, zones(spark)), zones(spark)))
    daily = features.zone_daily_features(cube)
    assert values(cube, "avg_passenger_count", "avg_speed_mph") == [(4.0, 20.0)]
    assert values(daily, "avg_passenger_count", "avg_speed_mph") == [(2.0, 20.0)]
    assert cube.columns == S.CUBE_ORDER and daily.columns == S.DAILY_ORDER
    borough = features.borough_hour_features(cube)
    assert borough.columns == S.BOROUGH_ORDER and borough.count() == 1


def test_required_columns_are_named(spark):
    with pytest.raises(ValueError, match="cube lacks required columns: hour, trip_count"):
        S.require_columns(spark.range(1), ["id", "hour", "trip_count"], "cube")
