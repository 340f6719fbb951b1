"""Column names, input schemas, label tables and required-column checks."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

PICKUP_TIME = "tpep_pickup_datetime"
DROPOFF_TIME = "tpep_dropoff_datetime"
PU = "PULocationID"
DO = "DOLocationID"
DISTANCE = "trip_distance"
PASSENGERS = "passenger_count"
FARE = "fare_amount"
TOTAL = "total_amount"
MINUTES = "trip_duration_min"

PICKUP_PLACE = ["pickup_zone", "pickup_borough", "pickup_service_zone"]
DROPOFF_PLACE = ["dropoff_zone", "dropoff_borough", "dropoff_service_zone"]
ROUTE = [PU, *PICKUP_PLACE, DO, *DROPOFF_PLACE, "route_key", "route_name"]
DATE_PARTS = ["year", "month", "day", "year_month", "day_of_week", "weekday_name", "is_weekend"]

# --- fixed values: names and labels that results must carry ---------------------------------
RAW_COLUMNS = [
    "tpep_pickup_datetime", "tpep_dropoff_datetime", "PULocationID", "DOLocationID",
    "trip_distance", "passenger_count", "fare_amount", "total_amount", "VendorID", "RatecodeID",
    "store_and_fwd_flag", "payment_type", "tip_amount", "tolls_amount", "airport_fee", "extra",
    "mta_tax", "improvement_surcharge", "congestion_surcharge",
]
VENDORS = {
    1: "Creative Mobile Technologies, LLC",
    2: "Curb Mobility, LLC",
    6: "Myle Technologies Inc",
    7: "Helix",
}
RATE_CODES = {
    1: "Standard rate",
    2: "JFK",
    3: "Newark",
    4: "Nassau or Westchester",
    5: "Negotiated fare",
    6: "Group ride",
    99: "Null/unknown",
}
PAYMENT_TYPES = {
    0: "Flex Fare trip",
    1: "Credit card",
    2: "Cash",
    3: "No charge",
    4: "Dispute",
    5: "Unknown",
    6: "Voided trip",
}
STORE_FLAGS = {"Y": "Store and forward trip", "N": "Not a store and forward trip"}
UNKNOWN = "Unknown"
AIRPORT_SERVICE_ZONE = "Airports"
AIRPORT_BOROUGH = "EWR"
DISTANCE_BUCKETS = (
    (1, "00_<1_mile"), (3, "01_1_3_miles"), (6, "02_3_6_miles"), (12, "03_6_12_miles"),
    (25, "04_12_25_miles"), (None, "05_25_plus_miles"),
)
DURATION_BUCKETS = (
    (5, "00_<5_min"), (10, "01_5_10_min"), (20, "02_10_20_min"), (40, "03_20_40_min"),
    (60, "04_40_60_min"), (None, "05_60_plus_min"),
)
FARE_BUCKETS = (
    (10, "00_<10"), (20, "01_10_20"), (40, "02_20_40"), (80, "03_40_80"),
    (120, "04_80_120"), (None, "05_120_plus"),
)
# first hour, last hour, order, label
DAY_PERIODS = (
    (0, 5, 1, "late_night_00_05"), (6, 10, 2, "morning_peak_06_10"), (11, 15, 3, "midday_11_15"),
    (16, 19, 4, "evening_peak_16_19"), (20, 23, 5, "night_20_23"),
)
# columns that a typed CSV load leaves as text, whatever they hold
DATE_LIKE = (
    "activity_date", "dropoff_date", "pickup_date", "start_date", "end_date",
    "first_seen_date", "last_seen_date", "year_month",
)
WEEKDAY_NAMES = ("Sun", "Mon", "Tue", "Wed", "Thu", "Fri", "Sat")
# --------------------------------------------------------------------------------------------

ZONE_SCHEMA = T.StructType([
    T.StructField("LocationID", T.IntegerType()),
    T.StructField("Borough", T.StringType()),
    T.StructField("Zone", T.StringType()),
    T.StructField("service_zone", T.StringType()),
])
CENTROID_SCHEMA = T.StructType([
    T.StructField("LocationID", T.IntegerType()),
    T.StructField("zone", T.StringType()),
    T.StructField("borough", T.StringType()),
    T.StructField("service_zone", T.StringType()),
    T.StructField("centroid_lon", T.DoubleType()),
    T.StructField("centroid_lat", T.DoubleType()),
    T.StructField("min_lon", T.DoubleType()),
    T.StructField("min_lat", T.DoubleType()),
    T.StructField("max_lon", T.DoubleType()),
    T.StructField("max_lat", T.DoubleType()),
])

DEMAND_INPUT = [
    PU, "pickup_zone", "pickup_borough", "pickup_date", *DATE_PARTS, "hour", "trip_count",
    "total_revenue", "total_fare_amount", "total_trip_distance", "total_trip_duration_min",
    "total_passenger_count", "credit_card_trip_count", "cash_trip_count",
]
TRIP_INPUT = [
    "pickup_ts", "dropoff_ts", "pickup_date", "year", "month", "hour", *ROUTE, MINUTES, DISTANCE,
    FARE, TOTAL, "tip_amount", PASSENGERS, "payment_type",
]
BUSINESS_INPUT = [
    *TRIP_INPUT, "day_of_week", "weekday_name", "payment_type_desc", "RatecodeID",
    "ratecode_desc", "VendorID", "vendor_name",
]

TRIP_ORDER = [
    "pickup_ts", "dropoff_ts", "pickup_date", "year", "month", "day", "hour", "day_of_week",
    "weekday_name", "is_weekend", "year_month", PU, *PICKUP_PLACE, DO, *DROPOFF_PLACE,
    "route_key", "route_name", MINUTES, DISTANCE, FARE, TOTAL, "tip_amount", "tolls_amount",
    "airport_fee", PASSENGERS, "payment_type", "payment_type_desc", "RatecodeID",
    "ratecode_desc", "VendorID", "vendor_name", "store_and_fwd_flag", "store_and_fwd_desc",
]
TRIP_METRICS_ORDER = [
    "avg_trip_distance", "total_trip_distance", "avg_trip_duration_min",
    "total_trip_duration_min", "avg_fare_amount", "total_fare_amount", "avg_total_amount",
    "total_revenue", "avg_tip_amount", "total_tip_amount", "total_tolls_amount",
    "total_airport_fee", "avg_passenger_count", "total_passenger_count", "avg_speed_mph",
    "credit_card_trip_count", "cash_trip_count", "credit_card_share", "cash_share",
]
CUBE_ORDER = [PU, *PICKUP_PLACE, "pickup_date", *DATE_PARTS, "hour", "trip_count", *TRIP_METRICS_ORDER]
DAILY_ORDER = [PU, *PICKUP_PLACE, "pickup_date", *DATE_PARTS, "trip_count", *TRIP_METRICS_ORDER]
BOROUGH_ORDER = ["pickup_borough", "pickup_date", *DATE_PARTS, "hour", "trip_count", *TRIP_METRICS_ORDER]
ROUTES_ORDER = [
    "route_rank", *ROUTE, "trip_count", "active_days", "avg_trips_per_active_day",
    "first_seen_date", "last_seen_date", *TRIP_METRICS_ORDER,
]


#: Columns that the tables built on a stage use.
STAGE_INPUTS = {
    "trips": TRIP_INPUT,
    "flagged": BUSINESS_INPUT,
    "cube": DEMAND_INPUT,
    "routes": ["route_rank", *ROUTE, "trip_count", "active_days", "total_revenue", "total_trip_distance", "total_trip_duration_min"],
}


def require_columns(df: DataFrame, columns: Iterable[str], table: str) -> DataFrame:
    """Return ``df`` unchanged, or fail with the names that ``table`` lacks."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"{table} lacks required columns: {', '.join(missing)}")
    return df


def missing_columns(stages: dict[str, DataFrame]) -> DataFrame:
    """A row per stage and column its tables use: how many rows the stage has, and whether the column is there."""
    out = None
    for name, df in stages.items():
        wanted = F.array(*[
            F.struct(F.lit(c).alias("column"), F.lit(c in df.columns).alias("present")) for c in dict.fromkeys(STAGE_INPUTS[name])
        ])
        lines = df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("stage"), "row_count", F.inline(wanted))
        out = lines if out is None else out.unionByName(lines)
    return out


def lead_with(df: DataFrame, order: Iterable[str]) -> DataFrame:
    """Put the listed columns first (those that exist); the others keep their order."""
    first = [c for c in order if c in df.columns]
    return df.select(*first, *[c for c in df.columns if c not in set(first)])
