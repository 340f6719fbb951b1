"""Tiny hand-made frames."""

from __future__ import annotations

from datetime import datetime

ZONES = [
    (1, "EWR", "Newark", "EWR"),
    (2, "Queens", "Jamaica", "Boro Zone"),
    (3, "Manhattan", "Soho", "Yellow Zone"),
    (4, "Queens", "JFK", "Airports"),
    (5, None, None, None),
]
ZONE_DDL = "LocationID int, Borough string, Zone string, service_zone string"
TRIP_DDL = (
    "tpep_pickup_datetime timestamp_ntz, tpep_dropoff_datetime timestamp_ntz, PULocationID int, "
    "DOLocationID int, trip_distance double, passenger_count double, fare_amount double, "
    "total_amount double, VendorID bigint, RatecodeID double, store_and_fwd_flag string, "
    "payment_type bigint, tip_amount double, tolls_amount double, airport_fee double"
)
BASE = {
    "pick": datetime(2021, 5, 3, 8, 0), "drop": datetime(2021, 5, 3, 8, 30), "pu": 2, "do": 3,
    "distance": 5.0, "passengers": 1.0, "fare": 20.0, "total": 25.0, "vendor": 1, "rate": 1.0,
    "flag": "N", "pay": 1, "tip": 5.0, "tolls": 0.0, "fee": 0.0,
}


def trip(**changes):
    row = {**BASE, **changes}
    return tuple(row.values())


def trips(spark, *rows):
    return spark.createDataFrame(list(rows), TRIP_DDL)


def zones(spark):
    return spark.createDataFrame(ZONES, ZONE_DDL)


def values(df, *columns):
    return [tuple(r[c] for c in columns) if len(columns) > 1 else r[columns[0]] for r in df.collect()]
