"""Trip and business tables over flagged trips: one keyed aggregation each."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourgrid import schema as S
from hourgrid.operators.rollup import aggregate_trips

# table -> (keys, sort keys; a leading "-" sorts descending)
TABLES = {
    "payment_type_summary": (["payment_type", "payment_type_desc"], ["-trip_count"]),
    "payment_type_by_year": (["year", "payment_type", "payment_type_desc"], ["year", "-trip_count"]),
    "vendor_summary": (["VendorID", "vendor_name"], ["-trip_count"]),
    "ratecode_summary": (["RatecodeID", "ratecode_desc"], ["-trip_count"]),
    "passenger_count_summary": ([S.PASSENGERS], [S.PASSENGERS]),
    "distance_bucket_summary": (["distance_bucket"], ["distance_bucket"]),
    "duration_bucket_summary": (["duration_bucket"], ["duration_bucket"]),
    "fare_bucket_summary": (["fare_bucket"], ["fare_bucket"]),
    "pickup_dropoff_borough_matrix": (
        ["pickup_borough", "dropoff_borough"],
        ["-trip_count", "pickup_borough", "dropoff_borough"],
    ),
    "airport_trip_summary": (["year", "airport_trip_type"], ["year", "airport_trip_type"]),
    "trip_behavior_by_hour": (["hour"], ["hour"]),
}


def sort_keys(names: list[str]):
    return [F.desc(n[1:]) if n.startswith("-") else F.asc(n) for n in names]


def business_table(flagged: DataFrame, name: str) -> DataFrame:
    """One of the tables above, from trips that carry the trip flags."""
    keys, order = TABLES[name]
    return aggregate_trips(flagged, keys).orderBy(*sort_keys(order))
