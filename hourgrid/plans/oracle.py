"""DuckDB SQL for every SQL-expressible query, written independently of the operators.

Each oracle is a body over shared CTEs plus its output columns. Column types follow from
the names (``name:type`` overrides); doubles are rounded to six digits on both sides,
because floating sums depend on the order of addition. Cents divided by counts often end
exactly half-way between two roundings, so both sides add the same nudge first.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

WINDOW = ("1996-01-01 00:00:00", "2001-01-01 00:00:00")
YEARS = [1995, 1996, 1997, 1998, 1999, 2000, 2002]
FULL, TRAIN, EVALUATION = (
    ("1996-01-01", "2000-12-31"), ("1996-01-01", "1999-12-31"), ("2000-01-01", "2000-12-31"),
)
ZONES_TOP, ZONES_OVERALL, ROUTES_TOP, MIN_TRIPS = 3, 10, 10, 60
RANK_CHANGE, FLOWS_TOP, REPLAY, SEED, PROFILES_TOP = 5, 20, 200, 42, 100
MONTH = ("1997-03-01 00:00:00", "1997-04-01 00:00:00")
MONTHS = ("1995-07", "2001-03")
CUTOFF = "2024-01-16 00:00:00"
NUDGE = 1.234e-8

_INT = """year month day hour day_of_week is_weekend PULocationID DOLocationID LocationID
 time_period_order prev_year month_index min_hour max_hour peak_hour ring_index step_order
 top_dropoff_location_id first_year last_year replay_trip_id zone_rank_in_hour hour_rank_in_year
 zone_rank_in_year route_rank_in_hour route_rank_in_year_month expected_year expected_month
 is_inter_borough is_pickup_airport is_dropoff_airport is_credit_card is_cash passenger_count""".split()
_BIG = """trip_count total_trips total_passenger_count credit_card_trip_count cash_trip_count
 active_days active_pickup_zones active_boroughs active_years active_zone_hours route_count
 best_route_rank route_rank inter_borough_trip_count airport_pickup_trip_count
 airport_dropoff_trip_count route_order overall_trips cumulative_trips pickup_trip_count
 dropoff_trip_count total_zone_activity net_dropoffs_minus_pickups net_pickups_minus_dropoffs
 peak_hour_trip_count top_dropoff_trip_count row_count removed_rows rows records VendorID
 payment_type lag_1_hour_trip_count lag_24_hour_trip_count first_rank last_rank rank_improvement
 first_year_trips last_year_trips trip_count_change prev_year_trips actual_trip_count
 pickup_epoch_ms dropoff_epoch_ms null_pickup_time null_dropoff_time bad_year_count
 bad_month_count bad_year_month_count""".split()
_DOUBLE = re.compile(
    r"^(avg_|total_|prev_|yoy_|first_year_rev|last_year_rev|.*_share($|_)|.*_ratio$|.*_lon$|.*_lat$|"
    r".*_amount$|revenue_per|trips_per|.*error$|.*_change$|centroid_|signed_area|mean_error|mae$|"
    r"rmse$|mape$|MAE$|RMSE$|R2$|predicted|actual|value$|.*_mph$|trip_d|fare_per|airport_fee|"
    r"RatecodeID|rolling|error|aggregate_|.*_revenue$|.*percentage_error$)"
)


def _typed(column: str) -> str:
    name, _, kind = column.partition(":")
    if not kind:
        if name in _INT:
            kind = "INTEGER"
        elif name in _BIG:
            kind = "BIGINT"
        elif _DOUBLE.match(name):
            kind = "DOUBLE"
    if not kind or kind == "text":
        return name
    if kind.upper() == "DOUBLE":
        return f"round(CAST({name} AS DOUBLE) + {NUDGE}, 6) AS {name}"
    return f"CAST({name} AS {kind}) AS {name}"


def _list(text: str) -> list[str]:
    return text.split()


PU = _list("PULocationID pickup_zone pickup_borough pickup_service_zone")
DO = _list("DOLocationID dropoff_zone dropoff_borough dropoff_service_zone")
ROUTE = [*PU, *DO, "route_key", "route_name"]
PARTS = _list("year month day year_month day_of_week weekday_name is_weekend")
CELL = _list(
    "avg_trip_distance total_trip_distance avg_trip_duration_min total_trip_duration_min "
    "avg_fare_amount total_fare_amount avg_total_amount total_revenue avg_tip_amount "
    "total_tip_amount total_tolls_amount total_airport_fee avg_passenger_count "
    "total_passenger_count avg_speed_mph credit_card_trip_count cash_trip_count "
    "credit_card_share cash_share"
)
RAW = _list(
    "tpep_pickup_datetime tpep_dropoff_datetime PULocationID DOLocationID trip_distance "
    "passenger_count fare_amount total_amount VendorID RatecodeID store_and_fwd_flag payment_type "
    "tip_amount tolls_amount airport_fee"
)
RAW_D = ["passenger_count:double" if c == "passenger_count" else c for c in RAW]
TYPED = [*RAW, "pickup_ts", "dropoff_ts", "trip_duration_min"]
#: The cleaned trips' columns in order, with their types.
CLEANED_TYPES = {
    "tpep_pickup_datetime": "timestamp_ntz", "tpep_dropoff_datetime": "timestamp_ntz", "PULocationID": "int", "DOLocationID": "int",
    "trip_distance": "double", "passenger_count": "int", "fare_amount": "double", "total_amount": "double", "VendorID": "bigint",
    "RatecodeID": "double", "store_and_fwd_flag": "string", "payment_type": "bigint", "tip_amount": "double", "tolls_amount": "double",
    "airport_fee": "double", "pickup_ts": "timestamp_ntz", "dropoff_ts": "timestamp_ntz", "trip_duration_min": "double",
}
EXTRACT_TIES = _list("DOLocationID PULocationID dropoff_ts total_amount trip_distance fare_amount tip_amount VendorID payment_type passenger_count")
#: What the tables built on a stage use of it.
CUBE_USED = [*PU[:3], "pickup_date", *PARTS, *_list(
    "hour trip_count total_revenue total_fare_amount total_trip_distance total_trip_duration_min total_passenger_count "
    "credit_card_trip_count cash_trip_count")]
ROUTES_USED = ["route_rank", *ROUTE, *_list("trip_count active_days total_revenue total_trip_distance total_trip_duration_min")]
TRIPS_USED = [*_list("pickup_ts dropoff_ts pickup_date year month hour"), *ROUTE, *_list(
    "trip_duration_min trip_distance fare_amount total_amount tip_amount passenger_count payment_type")]
LABELS = _list("vendor_name ratecode_desc payment_type_desc store_and_fwd_desc")
TRIP = [*TYPED, *PU[1:], *DO[1:], *LABELS, "pickup_date", "hour", *PARTS, "route_key", "route_name"]
CUBE = [*PU, "pickup_date", *PARTS, "hour", "trip_count", *CELL]
ROUTES = ["route_rank", *ROUTE, "trip_count", "active_days", "avg_trips_per_active_day",
          "first_seen_date", "last_seen_date", *CELL]
DEMAND = _list(
    "total_trips total_revenue total_fare_amount total_trip_distance total_trip_duration_min "
    "total_passenger_count credit_card_trip_count cash_trip_count active_days active_pickup_zones "
    "avg_revenue_per_trip avg_fare_amount avg_trip_distance avg_trip_duration_min "
    "avg_passenger_count credit_card_share cash_share"
)
BUSINESS = _list(
    "trip_count total_revenue total_fare_amount total_trip_distance total_trip_duration_min "
    "total_tip_amount total_tip_share_of_total total_fare_per_mile total_speed_mph "
    "total_passenger_count active_days inter_borough_trip_count airport_pickup_trip_count "
    "airport_dropoff_trip_count avg_revenue_per_trip avg_fare_amount avg_trip_distance "
    "avg_trip_duration_min avg_tip_amount avg_tip_share_of_total avg_fare_per_mile avg_speed_mph"
)
FLOW = _list(
    "trip_count total_revenue total_fare_amount total_trip_distance total_trip_duration_min "
    "total_tip_amount total_tip_share_of_total total_passenger_count total_speed_mph "
    "credit_card_trip_count cash_trip_count active_days avg_revenue_per_trip avg_fare_amount "
    "avg_trip_distance avg_trip_duration_min avg_passenger_count avg_speed_mph "
    "avg_tip_share_of_total credit_card_share cash_share"
)
FRAME = [*PU[:3], "pickup_date", *_list("year month day day_of_week is_weekend hour "
         "avg_trip_distance avg_trip_duration_min avg_fare_amount avg_total_amount "
         "avg_passenger_count avg_speed_mph credit_card_share cash_share lag_1_hour_trip_count "
         "lag_24_hour_trip_count rolling_24h_avg_trip_count trip_count")]
FILLED = _list(
    "avg_trip_distance avg_trip_duration_min avg_fare_amount avg_total_amount avg_passenger_count avg_speed_mph "
    "credit_card_share cash_share lag_1_hour_trip_count lag_24_hour_trip_count rolling_24h_avg_trip_count"
)
NUMERIC = _list("PULocationID year month day day_of_week is_weekend hour") + FILLED
ERRORS = _list(
    "records actual_trip_count predicted_trip_count mean_error mae rmse mape total_absolute_error "
    "aggregate_error aggregate_absolute_error aggregate_absolute_percentage_error"
)
DAY_TYPE = _list(
    "total_trips total_revenue avg_revenue_per_trip avg_fare_amount avg_trip_distance "
    "avg_trip_duration_min avg_passenger_count credit_card_share cash_share active_days "
    "active_pickup_zones"
)


def per(num: str, den: str) -> str:
    return f"CASE WHEN {den} > 0 THEN {num} / ({den}) END"


def _date_parts(d: str) -> str:
    return (
        f"year({d}) AS year, month({d}) AS month, day({d}) AS day, strftime({d}, '%Y-%m') AS year_month, "
        f"dayofweek({d}) + 1 AS day_of_week, strftime({d}, '%a') AS weekday_name, "
        f"CASE WHEN dayofweek({d}) IN (0, 6) THEN 1 ELSE 0 END AS is_weekend"
    )


_AIRPORT = {
    s: f"coalesce({s}_service_zone = 'Airports' OR {s}_borough = 'EWR', false)" for s in ("pickup", "dropoff")
}


def _bucket(c: str, edges: list[tuple[int, str]], last: str) -> str:
    return "CASE " + " ".join(f"WHEN {c} < {e} THEN '{n}'" for e, n in edges) + f" ELSE '{last}' END"


_CELL_SQL = f"""count(*) AS trip_count,
 avg(trip_distance) AS avg_trip_distance, sum(trip_distance) AS total_trip_distance,
 avg(trip_duration_min) AS avg_trip_duration_min, sum(trip_duration_min) AS total_trip_duration_min,
 avg(fare_amount) AS avg_fare_amount, sum(fare_amount) AS total_fare_amount,
 avg(total_amount) AS avg_total_amount, sum(total_amount) AS total_revenue,
 avg(tip_amount) AS avg_tip_amount, sum(tip_amount) AS total_tip_amount,
 sum(tolls_amount) AS total_tolls_amount, sum(airport_fee) AS total_airport_fee,
 avg(passenger_count) AS avg_passenger_count, sum(passenger_count) AS total_passenger_count,
 avg(trip_speed_mph) AS avg_speed_mph,
 sum(is_credit_card) AS credit_card_trip_count, sum(is_cash) AS cash_trip_count,
 sum(is_credit_card) / count(*) AS credit_card_share, sum(is_cash) / count(*) AS cash_share"""

_ROLLUP_SQL = f"""sum(trip_count) AS trip_count,
 sum(total_trip_distance) AS total_trip_distance, sum(total_trip_duration_min) AS total_trip_duration_min,
 sum(total_fare_amount) AS total_fare_amount, sum(total_revenue) AS total_revenue,
 sum(total_tip_amount) AS total_tip_amount, sum(total_tolls_amount) AS total_tolls_amount,
 sum(total_airport_fee) AS total_airport_fee, sum(total_passenger_count) AS total_passenger_count,
 sum(credit_card_trip_count) AS credit_card_trip_count, sum(cash_trip_count) AS cash_trip_count,
 sum(total_trip_distance) / sum(trip_count) AS avg_trip_distance,
 sum(total_trip_duration_min) / sum(trip_count) AS avg_trip_duration_min,
 sum(total_fare_amount) / sum(trip_count) AS avg_fare_amount,
 sum(total_revenue) / sum(trip_count) AS avg_total_amount,
 sum(total_tip_amount) / sum(trip_count) AS avg_tip_amount,
 sum(total_passenger_count) / sum(trip_count) AS avg_passenger_count,
 {per('sum(total_trip_distance)', 'sum(total_trip_duration_min) / 60e0')} AS avg_speed_mph,
 sum(credit_card_trip_count) / sum(trip_count) AS credit_card_share,
 sum(cash_trip_count) / sum(trip_count) AS cash_share"""

_DEMAND_SQL = """sum(trip_count) AS total_trips, sum(total_revenue) AS total_revenue,
 sum(total_fare_amount) AS total_fare_amount, sum(total_trip_distance) AS total_trip_distance,
 sum(total_trip_duration_min) AS total_trip_duration_min,
 sum(total_passenger_count) AS total_passenger_count,
 sum(credit_card_trip_count) AS credit_card_trip_count, sum(cash_trip_count) AS cash_trip_count,
 count(DISTINCT pickup_date) AS active_days, count(DISTINCT PULocationID) AS active_pickup_zones,
 sum(total_revenue) / sum(trip_count) AS avg_revenue_per_trip,
 sum(total_fare_amount) / sum(trip_count) AS avg_fare_amount,
 sum(total_trip_distance) / sum(trip_count) AS avg_trip_distance,
 sum(total_trip_duration_min) / sum(trip_count) AS avg_trip_duration_min,
 sum(total_passenger_count) / sum(trip_count) AS avg_passenger_count,
 sum(credit_card_trip_count) / sum(trip_count) AS credit_card_share,
 sum(cash_trip_count) / sum(trip_count) AS cash_share"""

_BUSINESS_SQL = """count(*) AS trip_count, sum(total_amount) AS total_revenue,
 sum(fare_amount) AS total_fare_amount, sum(trip_distance) AS total_trip_distance,
 sum(trip_duration_min) AS total_trip_duration_min, sum(tip_amount) AS total_tip_amount,
 sum(tip_share_of_total) AS total_tip_share_of_total, sum(fare_per_mile) AS total_fare_per_mile,
 sum(trip_speed_mph) AS total_speed_mph, sum(passenger_count) AS total_passenger_count,
 count(DISTINCT pickup_date) AS active_days, sum(is_inter_borough) AS inter_borough_trip_count,
 sum(is_pickup_airport) AS airport_pickup_trip_count, sum(is_dropoff_airport) AS airport_dropoff_trip_count,
 sum(total_amount) / count(*) AS avg_revenue_per_trip, sum(fare_amount) / count(*) AS avg_fare_amount,
 sum(trip_distance) / count(*) AS avg_trip_distance, sum(trip_duration_min) / count(*) AS avg_trip_duration_min,
 sum(tip_amount) / count(*) AS avg_tip_amount, sum(tip_share_of_total) / count(*) AS avg_tip_share_of_total,
 sum(fare_per_mile) / count(*) AS avg_fare_per_mile, sum(trip_speed_mph) / count(*) AS avg_speed_mph"""


def _flow_sql(date: str) -> str:
    return f"""count(*) AS trip_count, sum(total_amount) AS total_revenue,
 sum(fare_amount) AS total_fare_amount, sum(trip_distance) AS total_trip_distance,
 sum(trip_duration_min) AS total_trip_duration_min, sum(tip_amount) AS total_tip_amount,
 sum(tip_share_of_total) AS total_tip_share_of_total, sum(passenger_count) AS total_passenger_count,
 sum(trip_speed_mph) AS total_speed_mph, sum(is_credit_card) AS credit_card_trip_count,
 sum(is_cash) AS cash_trip_count, count(DISTINCT {date}) AS active_days,
 sum(total_amount) / count(*) AS avg_revenue_per_trip, sum(fare_amount) / count(*) AS avg_fare_amount,
 sum(trip_distance) / count(*) AS avg_trip_distance, sum(trip_duration_min) / count(*) AS avg_trip_duration_min,
 sum(passenger_count) / count(*) AS avg_passenger_count, sum(trip_speed_mph) / count(*) AS avg_speed_mph,
 sum(tip_share_of_total) / count(*) AS avg_tip_share_of_total,
 sum(is_credit_card) / count(*) AS credit_card_share, sum(is_cash) / count(*) AS cash_share"""


CTES: dict[str, str] = {
    "lines": """SELECT l.*, o_orderdate, o_orderpriority, c_nationkey, s_nationkey,
 round(l_extendedprice / 10) AS fare_cents
 FROM (SELECT * FROM lineitem UNION ALL SELECT * FROM lineitem WHERE l_orderkey % 50 = 0) l
 JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey
 JOIN supplier ON s_suppkey = l_suppkey""",
    "money": """SELECT *, floor(fare_cents * round(l_discount * 100) / 100) AS tip_cents,
 floor(fare_cents * round(l_tax * 100) / 100) AS tolls_cents,
 CASE WHEN c_nationkey % 10 = 1 THEN 175e0 ELSE 0e0 END AS fee_cents,
 o_orderdate + to_minutes((l_orderkey * 37 + l_linenumber * 211) % 1440) AS picked FROM lines""",
    "raw_trips": """SELECT picked AS tpep_pickup_datetime,
 picked + to_minutes(l_partkey % 95 - 3) AS tpep_dropoff_datetime,
 c_nationkey AS PULocationID, s_nationkey AS DOLocationID,
 CASE WHEN l_quantity = 50 THEN -1e0 ELSE (l_quantity - 1) * 0.625e0 END AS trip_distance,
 CASE WHEN l_linenumber <> 7 THEN CAST(l_linenumber - 1 AS DOUBLE) END AS passenger_count,
 fare_cents / 100e0 AS fare_amount,
 (fare_cents + tip_cents + tolls_cents + fee_cents) / 100e0 AS total_amount,
 l_suppkey % 8 AS VendorID, CAST(l_linenumber AS DOUBLE) AS RatecodeID,
 CASE WHEN l_linestatus = 'O' THEN 'Y' WHEN l_linestatus = 'F' AND l_returnflag = 'A' THEN 'N' END AS store_and_fwd_flag,
 CAST(o_orderpriority[1:1] AS BIGINT) AS payment_type, tip_cents / 100e0 AS tip_amount,
 tolls_cents / 100e0 AS tolls_amount, fee_cents / 100e0 AS airport_fee FROM money""",
    "zones": """SELECT n_nationkey AS LocationID,
 CASE n_nationkey WHEN 22 THEN 'N/A' WHEN 24 THEN 'EWR' ELSE r_name END AS Borough,
 CASE n_nationkey WHEN 22 THEN 'N/A' ELSE n_name END AS Zone,
 CASE WHEN n_nationkey = 22 THEN 'N/A' WHEN n_nationkey = 24 THEN 'EWR'
  WHEN n_nationkey % 10 = 1 THEN 'Airports' WHEN n_regionkey = 0 THEN 'Yellow Zone' ELSE 'Boro Zone' END AS service_zone
 FROM nation JOIN region ON n_regionkey = r_regionkey WHERE n_nationkey <> 23""",
    "typed": """SELECT * REPLACE (CAST(passenger_count AS INTEGER) AS passenger_count),
 tpep_pickup_datetime AS pickup_ts, tpep_dropoff_datetime AS dropoff_ts,
 date_diff('second', tpep_pickup_datetime, tpep_dropoff_datetime) / 60e0 AS trip_duration_min FROM raw_trips""",
    "timed": """SELECT * FROM typed WHERE pickup_ts IS NOT NULL AND dropoff_ts IS NOT NULL
 AND PULocationID IS NOT NULL AND DOLocationID IS NOT NULL AND dropoff_ts > pickup_ts""",
    "windowed": f"""SELECT * FROM timed WHERE pickup_ts >= TIMESTAMP '{WINDOW[0]}' AND pickup_ts < TIMESTAMP '{WINDOW[1]}'""",
    "counted": """SELECT * FROM windowed WHERE trip_duration_min > 0 AND trip_distance >= 0 AND fare_amount >= 0
 AND total_amount >= 0 AND (passenger_count IS NULL OR passenger_count >= 0)""",
    "known": """SELECT * FROM counted WHERE PULocationID IN (SELECT LocationID FROM zones)
 AND DOLocationID IN (SELECT LocationID FROM zones)""",
    "cleaned": "SELECT DISTINCT * FROM known",
    "placed": """SELECT t.*, p.Zone AS pickup_zone, p.Borough AS pickup_borough, p.service_zone AS pickup_service_zone,
 d.Zone AS dropoff_zone, d.Borough AS dropoff_borough, d.service_zone AS dropoff_service_zone
 FROM cleaned t LEFT JOIN zones p ON p.LocationID = PULocationID LEFT JOIN zones d ON d.LocationID = DOLocationID""",
    "labelled": """SELECT *,
 CASE VendorID WHEN 1 THEN 'Creative Mobile Technologies, LLC' WHEN 2 THEN 'Curb Mobility, LLC'
  WHEN 6 THEN 'Myle Technologies Inc' WHEN 7 THEN 'Helix' ELSE 'Unknown' END AS vendor_name,
 CASE CAST(RatecodeID AS INTEGER) WHEN 1 THEN 'Standard rate' WHEN 2 THEN 'JFK' WHEN 3 THEN 'Newark'
  WHEN 4 THEN 'Nassau or Westchester' WHEN 5 THEN 'Negotiated fare' WHEN 6 THEN 'Group ride'
  WHEN 99 THEN 'Null/unknown' ELSE 'Unknown' END AS ratecode_desc,
 CASE payment_type WHEN 0 THEN 'Flex Fare trip' WHEN 1 THEN 'Credit card' WHEN 2 THEN 'Cash'
  WHEN 3 THEN 'No charge' WHEN 4 THEN 'Dispute' WHEN 6 THEN 'Voided trip' ELSE 'Unknown' END AS payment_type_desc,
 CASE store_and_fwd_flag WHEN 'Y' THEN 'Store and forward trip' WHEN 'N' THEN 'Not a store and forward trip'
  ELSE 'Unknown' END AS store_and_fwd_desc FROM placed""",
    "trips": f"""SELECT *, CAST(pickup_ts AS DATE) AS pickup_date, hour(pickup_ts) AS hour, {_date_parts('pickup_ts')},
 PULocationID || '->' || DOLocationID AS route_key, pickup_zone || ' -> ' || dropoff_zone AS route_name FROM labelled""",
    "measured": f"""SELECT *, {per('trip_distance', 'trip_duration_min / 60e0')} AS trip_speed_mph,
 {per('tip_amount', 'total_amount')} AS tip_share_of_total,
 CASE WHEN payment_type = 1 THEN 1 ELSE 0 END AS is_credit_card,
 CASE WHEN payment_type = 2 THEN 1 ELSE 0 END AS is_cash FROM trips""",
    "flagged": f"""SELECT *, {per('total_amount', 'trip_distance')} AS fare_per_mile,
 CASE WHEN pickup_borough <> dropoff_borough THEN 1 ELSE 0 END AS is_inter_borough,
 CAST({_AIRPORT['pickup']} AS INTEGER) AS is_pickup_airport, CAST({_AIRPORT['dropoff']} AS INTEGER) AS is_dropoff_airport,
 CASE WHEN {_AIRPORT['pickup']} AND {_AIRPORT['dropoff']} THEN 'airport_to_airport' WHEN {_AIRPORT['pickup']} THEN 'airport_pickup'
  WHEN {_AIRPORT['dropoff']} THEN 'airport_dropoff' ELSE 'non_airport' END AS airport_trip_type,
 {_bucket('trip_distance', [(1, '00_<1_mile'), (3, '01_1_3_miles'), (6, '02_3_6_miles'), (12, '03_6_12_miles'), (25, '04_12_25_miles')], '05_25_plus_miles')} AS distance_bucket,
 {_bucket('trip_duration_min', [(5, '00_<5_min'), (10, '01_5_10_min'), (20, '02_10_20_min'), (40, '03_20_40_min'), (60, '04_40_60_min')], '05_60_plus_min')} AS duration_bucket,
 {_bucket('total_amount', [(10, '00_<10'), (20, '01_10_20'), (40, '02_20_40'), (80, '03_40_80'), (120, '04_80_120')], '05_120_plus')} AS fare_bucket
 FROM measured""",
    "cells": f"SELECT {', '.join(PU)}, pickup_date, hour, {_CELL_SQL} FROM measured GROUP BY ALL",
    "cube": f"SELECT *, {_date_parts('pickup_date')} FROM cells",
    "route_cells": f"""SELECT {', '.join(ROUTE)}, {_CELL_SQL}, min(pickup_date) AS first_seen_date,
 max(pickup_date) AS last_seen_date, count(DISTINCT pickup_date) AS active_days,
 count(*) / count(DISTINCT pickup_date) AS avg_trips_per_active_day FROM measured GROUP BY ALL""",
    "routes": "SELECT *, dense_rank() OVER (ORDER BY trip_count DESC, total_revenue DESC) AS route_rank FROM route_cells",
    "dropped": "SELECT * REPLACE (hour(dropoff_ts) AS hour), CAST(dropoff_ts AS DATE) AS dropoff_date FROM measured",
    "drop_cells": f"SELECT {', '.join(DO)}, dropoff_date, hour, {_flow_sql('dropoff_date')} FROM dropped GROUP BY ALL",
    "dropoffs": f"SELECT *, {_date_parts('dropoff_date')} FROM drop_cells",
    "zone_years": f"SELECT year, PULocationID, pickup_zone, pickup_borough, {_DEMAND_SQL} FROM cube GROUP BY ALL",
    "ranked_years": "SELECT *, dense_rank() OVER (PARTITION BY year ORDER BY total_trips DESC, total_revenue DESC) AS zone_rank FROM zone_years",
    "lagged": """SELECT *, lag(trip_count, 1) OVER w AS lag_1_hour_trip_count, lag(trip_count, 24) OVER w AS lag_24_hour_trip_count,
 avg(trip_count) OVER (PARTITION BY PULocationID ORDER BY pickup_date, hour ROWS BETWEEN 24 PRECEDING AND 1 PRECEDING) AS rolling_24h_avg_trip_count
 FROM cube WINDOW w AS (PARTITION BY PULocationID ORDER BY pickup_date, hour)""",
    "frame": "SELECT " + ", ".join(
        f"coalesce({c}, 0) AS {c}" if c in FILLED else c for c in FRAME
    ) + f" FROM lagged WHERE pickup_date BETWEEN DATE '{FULL[0]}' AND DATE '{FULL[1]}'",
    "split": f"""SELECT *, CASE WHEN pickup_date BETWEEN DATE '{TRAIN[0]}' AND DATE '{TRAIN[1]}' THEN 'train'
 WHEN pickup_date BETWEEN DATE '{EVALUATION[0]}' AND DATE '{EVALUATION[1]}' THEN 'evaluation' END AS dataset FROM frame""",
    "predicted": """SELECT *, rolling_24h_avg_trip_count AS predicted_trip_count,
 trip_count - rolling_24h_avg_trip_count AS prediction_error, abs(trip_count - rolling_24h_avg_trip_count) AS absolute_error
 FROM split WHERE dataset = 'evaluation'""",
    "base_models": """SELECT dataset, trip_count, unnest(['lag_1', 'lag_24', 'rolling_24h']) AS model,
 unnest([lag_1_hour_trip_count::DOUBLE, lag_24_hour_trip_count::DOUBLE, rolling_24h_avg_trip_count]) AS predicted FROM split""",
    "areas": """SELECT CAST(c_custkey AS INTEGER) AS id, c_name, c_mktsegment, CAST(c_custkey % 360 AS DOUBLE) AS x,
 CAST(c_custkey // 360 AS DOUBLE) AS y, CASE WHEN c_custkey % 35 = 0 THEN 0e0 ELSE 1 + (c_custkey % 4) * 0.25e0 END AS side FROM customer""",
    "squares": """SELECT id, 0 AS ring_index, x, y, side FROM areas
 UNION ALL SELECT id, 1, x + 4, y + 2, 0.5e0 FROM areas WHERE id % 6 = 0""",
    "points": """SELECT id, ring_index, i, x + dx * side AS px, y + dy * side AS py
 FROM squares CROSS JOIN (VALUES (0, 0, 0), (1, 1, 0), (2, 1, 1), (3, 0, 1), (4, 0, 0)) corners(i, dx, dy)""",
    "edges": """SELECT id, ring_index, px, py, lead(px, 1, px) OVER w AS qx, lead(py, 1, py) OVER w AS qy
 FROM points WINDOW w AS (PARTITION BY id, ring_index ORDER BY i)""",
    "ring_sums": """SELECT id, ring_index, sum(px * qy - qx * py) / 2 AS a, sum((px + qx) * (px * qy - qx * py)) AS sx,
 sum((py + qy) * (px * qy - qx * py)) AS sy FROM edges GROUP BY ALL""",
    "ring_centres": """SELECT id, ring_index, CASE WHEN abs(a) < 1e-12 THEN 0e0 ELSE a END AS signed_area,
 CASE WHEN abs(a) < 1e-12 THEN 0e0 ELSE sx / (6 * a) END AS centroid_x,
 CASE WHEN abs(a) < 1e-12 THEN 0e0 ELSE sy / (6 * a) END AS centroid_y FROM ring_sums""",
    "area_centres": """SELECT id, CASE WHEN sum(abs(signed_area)) > 0 THEN sum(centroid_x * abs(signed_area)) / sum(abs(signed_area)) END AS cx,
 CASE WHEN sum(abs(signed_area)) > 0 THEN sum(centroid_y * abs(signed_area)) / sum(abs(signed_area)) END AS cy
 FROM ring_centres GROUP BY id""",
    "area_boxes": """SELECT id, avg(px) AS mx, avg(py) AS my, min(px) AS x0, min(py) AS y0, max(px) AS x1, max(py) AS y1 FROM points GROUP BY id""",
    "replay_pool": f"""SELECT * FROM trips ORDER BY md5('{SEED}' || '|' || PULocationID || '|' || DOLocationID || '|' ||
 CAST(epoch(pickup_ts) AS BIGINT) || '|' || CAST(epoch(dropoff_ts) AS BIGINT)),
 total_amount, trip_distance, trip_duration_min LIMIT {REPLAY}""",
    "event_hours": """SELECT date_trunc('hour', ts) AS window_start, date_trunc('hour', ts) + INTERVAL 1 HOUR AS window_end,
 CAST(user_id AS INTEGER) AS PULocationID, count(*) AS trip_count, sum(value) AS total_revenue FROM events GROUP BY ALL""",
    "closed_hours": "SELECT * FROM event_hours WHERE window_end <= (SELECT max(ts) - INTERVAL 30 MINUTE FROM events)",
}


def demand(keys: str, extra: str = "", source: str = "cube") -> str:
    return f"SELECT {keys}{extra}, {_DEMAND_SQL} FROM {source} GROUP BY {keys}"


def shared(keys: str, within: str, share: str) -> str:
    return f"SELECT *, total_trips / sum(total_trips) OVER (PARTITION BY {within}) AS {share} FROM ({demand(keys)})"


def business(keys: str) -> str:
    return f"SELECT {keys}, {_BUSINESS_SQL} FROM flagged GROUP BY {keys}"


def errors(keys: str) -> str:
    return f"""SELECT *, actual_trip_count - predicted_trip_count AS aggregate_error,
 abs(actual_trip_count - predicted_trip_count) AS aggregate_absolute_error,
 abs(actual_trip_count - predicted_trip_count) / nullif(actual_trip_count, 0) * 100 AS aggregate_absolute_percentage_error
 FROM (SELECT {keys}, count(*) AS records, sum(trip_count) AS actual_trip_count, sum(predicted_trip_count) AS predicted_trip_count,
 avg(prediction_error) AS mean_error, avg(absolute_error) AS mae, sqrt(avg(prediction_error * prediction_error)) AS rmse,
 avg(absolute_error / nullif(trip_count, 0) * 100) AS mape, sum(absolute_error) AS total_absolute_error
 FROM predicted GROUP BY {keys})"""


def top(body: str, order: str, n: int, where: str = "true") -> str:
    return f"SELECT * FROM ({body}) WHERE {where} ORDER BY {order} LIMIT {n}"


def models(part: str) -> str:
    return f"""SELECT *, row_number() OVER (ORDER BY RMSE, model) = 1 AS is_best_model FROM (
 SELECT model, avg(abs(trip_count - predicted)) AS MAE, sqrt(avg((trip_count - predicted) ** 2)) AS RMSE,
 1 - avg((trip_count - predicted) ** 2) / var_pop(trip_count) AS R2 FROM base_models WHERE dataset = '{part}' GROUP BY model)"""


def extract(body: str, order: str) -> str:
    """The first 100 rows."""
    return f"SELECT * FROM ({body}) ORDER BY {order} LIMIT 100"


CTES["contradicting"] = """SELECT * REPLACE (CASE WHEN PULocationID = 3 THEN year + 1 ELSE year END AS year,
 CASE WHEN PULocationID = 5 THEN 13 - month ELSE month END AS month) FROM cube"""
CTES["parted"] = """SELECT *, CASE WHEN CAST('0x' || substr(md5('42|' || PULocationID || '|' || pickup_date || '|' || hour), 1, 8) AS BIGINT) % 100 < 20
 THEN 'validation' ELSE 'fit' END AS part FROM split WHERE dataset = 'train'"""
CTES["line"] = """SELECT regr_slope(trip_count, rolling_24h_avg_trip_count) AS slope, regr_intercept(trip_count, rolling_24h_avg_trip_count) AS level
 FROM parted WHERE part = 'fit'"""
CTES["linear_predicted"] = """SELECT *, trip_count - predicted_trip_count AS prediction_error, abs(trip_count - predicted_trip_count) AS absolute_error
 FROM (SELECT *, level + slope * rolling_24h_avg_trip_count AS predicted_trip_count FROM split, line WHERE dataset = 'evaluation')"""
_PERIOD = """SELECT *, CASE WHEN hour <= 5 THEN 1 WHEN hour <= 10 THEN 2 WHEN hour <= 15 THEN 3 WHEN hour <= 19 THEN 4 ELSE 5 END AS time_period_order,
 CASE WHEN hour <= 5 THEN 'late_night_00_05' WHEN hour <= 10 THEN 'morning_peak_06_10' WHEN hour <= 15 THEN 'midday_11_15'
 WHEN hour <= 19 THEN 'evening_peak_16_19' ELSE 'night_20_23' END AS time_period FROM cube"""
CTES["periods"] = _PERIOD
_DAY_TYPE = "CASE WHEN is_weekend = 1 THEN 'weekend' ELSE 'weekday' END AS day_type"
_RANKED = "dense_rank() OVER (PARTITION BY {0} ORDER BY {1} DESC, total_revenue DESC)"
_ZONE = "PULocationID, pickup_zone, pickup_borough"


def _top_within(keys: str, within: str, rank: str, n: int) -> str:
    return f"SELECT * FROM (SELECT *, {_RANKED.format(within, 'total_trips')} AS {rank} FROM ({demand(keys)})) WHERE {rank} <= {n}"


def _flows(keys: str, within: str, rank: str, n: int) -> str:
    r = ", ".join(ROUTE)
    return f"""SELECT * FROM (SELECT *, {_RANKED.format(within, 'trip_count')} AS {rank} FROM (
 SELECT {keys}, {r}, {_flow_sql('pickup_date')} FROM measured GROUP BY {keys}, {r})) WHERE {rank} <= {n}"""


_AIRPORT_ROUTE = f"({_AIRPORT['pickup']} OR {_AIRPORT['dropoff']})"
_EFFICIENCY = f"SELECT *, {per('total_revenue', 'total_trip_distance')} AS revenue_per_mile, {per('total_revenue', 'total_trip_duration_min')} AS revenue_per_minute FROM routes"
_TIPS = f"SELECT *, {per('total_tip_amount', 'total_revenue')} AS route_tip_share FROM routes"
TOP_ROUTE_COLS = ["route_rank", *ROUTE, *_list(
    "trip_count active_days avg_trips_per_active_day first_seen_date last_seen_date avg_trip_distance "
    "avg_trip_duration_min avg_fare_amount avg_total_amount total_revenue avg_tip_amount "
    "avg_passenger_count avg_speed_mph credit_card_share cash_share")]

CTES["zone_dest_counts"] = "SELECT PULocationID, DOLocationID, dropoff_zone, dropoff_borough, count(*) AS n FROM trips GROUP BY ALL"
_ZONE_DEST = """SELECT PULocationID, DOLocationID AS top_dropoff_location_id, dropoff_zone AS top_dropoff_zone,
 dropoff_borough AS top_dropoff_borough, n AS top_dropoff_trip_count FROM (
 SELECT *, row_number() OVER (PARTITION BY PULocationID ORDER BY n DESC, DOLocationID) AS r FROM zone_dest_counts) WHERE r = 1"""
_ROUTE_PEAK = """SELECT route_key, hour AS peak_hour, n AS peak_hour_trip_count FROM (
 SELECT *, row_number() OVER (PARTITION BY route_key ORDER BY n DESC, hour) AS r FROM (
 SELECT route_key, hour, count(*) AS n FROM trips GROUP BY route_key, hour)) WHERE r = 1"""
_ZONE_PROFILE_COLS = [*PU, *_list(
    "total_trips total_revenue total_fare_amount total_trip_distance total_trip_duration_min total_passenger_count "
    "credit_card_trip_count cash_trip_count first_seen_date last_seen_date active_days active_zone_hours "
    "avg_revenue_per_trip avg_fare_amount avg_trip_distance avg_trip_duration_min avg_passenger_count "
    "credit_card_share cash_share avg_trips_per_active_day peak_hour peak_hour_trip_count "
    "top_dropoff_location_id top_dropoff_zone top_dropoff_borough top_dropoff_trip_count")]
_ROUTE_PROFILE_COLS = ["route_rank", *ROUTE, *_list(
    "trip_count total_revenue total_fare_amount total_trip_distance total_trip_duration_min total_tip_amount "
    "total_tip_share_of_total total_speed_mph total_passenger_count credit_card_trip_count cash_trip_count "
    "first_seen_date last_seen_date active_days avg_revenue_per_trip avg_fare_amount avg_trip_distance "
    "avg_trip_duration_min avg_tip_amount avg_tip_share_of_total avg_speed_mph credit_card_share cash_share "
    "avg_trips_per_active_day peak_hour peak_hour_trip_count")]
_PREDICTION_COLS = _list(
    "pickup_date year month day hour PULocationID pickup_zone pickup_borough trip_count predicted_trip_count "
    "prediction_error absolute_error")
_MEASURED = _list("trip_speed_mph tip_share_of_total is_credit_card is_cash")
_MONTHLY_PREDICTED = """SELECT strftime(pickup_date, '%Y-%m') AS year_month, sum(trip_count) AS trip_count,
 sum(predicted_trip_count) AS predicted_trip_count FROM predicted GROUP BY 1"""
_PRIMARY = """SELECT year FROM (SELECT year, count(*) AS n, max(count(*)) OVER () AS most FROM daily_rows GROUP BY year)
 WHERE n >= 30 OR most < 30"""
CTES["ring_texts"] = """SELECT id, ring_index, '[' || string_agg('[' || px || ',' || py || ']', ',' ORDER BY i) || ']' AS ring FROM points GROUP BY ALL"""
CTES["hole_texts"] = """SELECT id, '[' || string_agg('[' || (x + 0.25e0 + dx * 0.5e0) || ',' || (y + 0.25e0 + dy * 0.5e0) || ']', ',' ORDER BY i) || ']' AS ring
 FROM areas CROSS JOIN (VALUES (0, 0, 0), (1, 1, 0), (2, 1, 1), (3, 0, 1), (4, 0, 0)) corners(i, dx, dy) WHERE id % 5 = 1 GROUP BY id"""
CTES["borough_index"] = """SELECT pickup_borough AS borough, row_number() OVER (ORDER BY count(*) DESC, pickup_borough) - 1 AS place, count(*) OVER () AS n
 FROM split WHERE dataset = 'train' AND pickup_borough IS NOT NULL GROUP BY 1"""
CTES["daily_rows"] = demand("pickup_date, year, month, day, day_of_week, weekday_name, is_weekend")
CTES["primary_set"] = _PRIMARY
CTES["served_forecast"] = """SELECT pickup_date, year, month, strftime(pickup_date, '%Y-%m') AS year_month, day, hour, PULocationID,
 pickup_zone, pickup_borough, CAST(trip_count AS DOUBLE) AS actual_trip_count, predicted_trip_count, prediction_error, absolute_error,
 absolute_error / nullif(trip_count, 0) * 100 AS absolute_percentage_error FROM predicted"""
CTES["zone_series"] = """SELECT pickup_zone AS zone, CAST(pickup_date AS TIMESTAMP) + to_hours(hour) AS date_time,
 actual_trip_count AS actual_value, predicted_trip_count AS predicted_value FROM served_forecast"""
CTES["yearly"] = demand("year")


@dataclass(frozen=True)
class Limits:
    """Top-N of the ranked tables."""

    zones: int = ZONES_TOP
    overall: int = ZONES_OVERALL
    routes: int = ROUTES_TOP
    flows: int = FLOWS_TOP
    profiles: int = PROFILES_TOP
    changes: int = RANK_CHANGE


def _tables(n: Limits) -> dict[str, tuple[str, list[str]]]:
    """name -> (body, columns)."""
    d = DEMAND
    out = {
        # sources and cleaning
        "scan_trips_merged": ("SELECT * FROM raw_trips", RAW_D),
        "scan_zone_lookup": ("SELECT * FROM zones", _list("LocationID Borough Zone service_zone")),
        "scan_geojson": (
            """SELECT a.id AS LocationID, c_name AS zone, c_mktsegment AS borough, CASE WHEN a.id % 6 = 0 THEN 'MultiPolygon' ELSE 'Polygon' END AS geometry_type,
 CASE WHEN a.id % 6 = 0 THEN '[[' || o.ring || coalesce(',' || h.ring, '') || '],[' || p.ring || ']]' ELSE '[' || o.ring || coalesce(',' || h.ring, '') || ']' END AS coordinates
 FROM areas a JOIN ring_texts o ON o.id = a.id AND o.ring_index = 0 LEFT JOIN hole_texts h ON h.id = a.id LEFT JOIN ring_texts p ON p.id = a.id AND p.ring_index = 1""",
            _list("LocationID zone borough geometry_type coordinates")),
        "typed_csv_load": (
            """SELECT * REPLACE (CAST(pickup_date AS VARCHAR) AS pickup_date), CASE WHEN pickup_date = (SELECT max(pickup_date) FROM daily_rows) THEN 'last' ELSE CAST(day AS VARCHAR) END AS code,
 CAST(NULL AS VARCHAR) AS nothing FROM daily_rows""",
            [f"{c}:BIGINT" if c in _INT else c for c in [*_list("pickup_date year month day day_of_week weekday_name is_weekend"), *d, "code", "nothing"]]),
        "publish_with_provenance": (
            "SELECT *, 'zones' AS _source_table, 'nation,region' AS _source_path, true AS imported FROM zones",
            _list("LocationID Borough Zone service_zone _source_table _source_path imported")),
        "dq_required_columns": (
            " UNION ALL ".join(
                f"SELECT '{stage}' AS stage, (SELECT count(*) FROM {stage if stage != 'trips' else 'cleaned'}) AS row_count, unnest({wanted}) AS \"column\", unnest({[c in there for c in wanted]}) AS present"
                for stage, wanted, there in (
                    ("cube", CUBE_USED, [c for c in CUBE if c != "total_revenue"]), ("routes", ROUTES_USED, ROUTES), ("trips", TRIPS_USED, TYPED))),
            ["stage", "row_count", "\"column\"", "present"]),
        "dq_profile": (
            " UNION ALL ".join(
                f"""SELECT {i} AS position, '{c}' AS name, '{kind}' AS type, count(*) AS row_count, count(*) - count({c}) AS null_count,
 {f'CAST(min({c}) AS DOUBLE)' if kind in ('int', 'bigint', 'double') else 'CAST(NULL AS DOUBLE)'} AS min_number,
 {f'CAST(max({c}) AS DOUBLE)' if kind in ('int', 'bigint', 'double') else 'CAST(NULL AS DOUBLE)'} AS max_number,
 {'CAST(NULL AS VARCHAR)' if kind in ('int', 'bigint', 'double') else f'CAST(min({c}) AS VARCHAR)'} AS min_text,
 {'CAST(NULL AS VARCHAR)' if kind in ('int', 'bigint', 'double') else f'CAST(max({c}) AS VARCHAR)'} AS max_text FROM cleaned"""
                for i, (c, kind) in enumerate(CLEANED_TYPES.items())),
            ["position:INTEGER", "name", "type", "row_count", "null_count:BIGINT", "min_number:DOUBLE", "max_number:DOUBLE", "min_text", "max_text"]),
        "feature_pipeline": (
            "SELECT PULocationID AS zone, pickup_date AS date, hour AS at_hour, "
            "array_to_string(list_transform(range((SELECT any_value(n) FROM borough_index)), lambda i: CASE WHEN i = place THEN '1' ELSE '0' END), ',') AS one_hot, "
            + ", ".join(f"coalesce(({c} - avg({c}) OVER ()) / nullif(stddev_samp({c}) OVER (), 0), 0) AS {c}_scaled" for c in NUMERIC)
            + " FROM split LEFT JOIN borough_index ON borough = pickup_borough WHERE dataset = 'train'",
            ["zone:INTEGER", "date", "at_hour:INTEGER", "one_hot", *[f"{c}_scaled:DOUBLE" for c in NUMERIC]]),
        "extract_trip_enriched": (
            extract("SELECT * FROM trips", ", ".join(f"{c} NULLS FIRST" for c in ["pickup_ts", *EXTRACT_TIES])), TRIP),
        "scan_feature_table": ("SELECT * FROM cube", CUBE),
        "scan_centroids": (
            """SELECT id AS LocationID, coalesce(cx, mx) AS centroid_lon, coalesce(cy, my) AS centroid_lat
 FROM area_centres JOIN area_boxes USING (id)""", _list("LocationID centroid_lon centroid_lat")),
        "normalize_schema": ("SELECT * FROM raw_trips", RAW_D),
        "project_needed": ("SELECT * FROM raw_trips", RAW_D),
        "standardize_columns": ("SELECT * FROM typed", TYPED),
        "filter_null_time": ("SELECT * FROM timed", TYPED),
        "filter_date_window": (
            f"SELECT * FROM typed WHERE pickup_ts >= TIMESTAMP '{WINDOW[0]}' AND pickup_ts < TIMESTAMP '{WINDOW[1]}'", TYPED),
        "filter_numeric": (
            "SELECT * FROM typed WHERE trip_duration_min > 0 AND trip_distance >= 0 AND fare_amount >= 0 AND total_amount >= 0 "
            "AND (passenger_count IS NULL OR passenger_count >= 0)", TYPED),
        "filter_valid_zones": (
            "SELECT * FROM typed WHERE PULocationID IN (SELECT LocationID FROM zones) AND DOLocationID IN (SELECT LocationID FROM zones)", TYPED),
        "drop_duplicates": ("SELECT DISTINCT * FROM typed", TYPED),
        "clean_trips": ("SELECT * FROM cleaned", TYPED),
        "cleaning_report": (
            """SELECT step_order, step, n AS row_count, coalesce(lag(n) OVER (ORDER BY step_order) - n, 0) AS removed_rows,
 (first_value(n) OVER (ORDER BY step_order) - n) / first_value(n) OVER (ORDER BY step_order) AS removal_ratio FROM (
 SELECT 1 AS step_order, 'raw' AS step, count(*) AS n FROM typed UNION ALL SELECT 2, 'time_order', count(*) FROM timed
 UNION ALL SELECT 3, 'date_window', count(*) FROM windowed UNION ALL SELECT 4, 'numeric', count(*) FROM counted
 UNION ALL SELECT 5, 'valid_zones', count(*) FROM known UNION ALL SELECT 6, 'distinct', count(*) FROM cleaned)""",
            _list("step_order step row_count removed_rows removal_ratio")),
        # enrichment steps
        "join_zone_lookup": ("SELECT * FROM placed", [*TYPED, *PU[1:], *DO[1:]]),
        "add_time_features": ("SELECT * FROM trips", [*TYPED, "pickup_date", "hour", *PARTS]),
        "add_business_labels": ("SELECT * FROM labelled", [*TYPED, *LABELS]),
        "add_route_fields": ("SELECT * FROM trips", [*TYPED, *PU[1:], *DO[1:], "route_key", "route_name"]),
        "add_date_fields": (f"SELECT *, {_date_parts('pickup_date')} FROM cells", CUBE),
        "time_period_labels": ("SELECT * FROM periods", [*CUBE, "time_period_order", "time_period"]),
        "trip_flags": ("SELECT * FROM flagged", [*TRIP, *_list(
            "trip_speed_mph tip_share_of_total fare_per_mile is_inter_borough is_pickup_airport is_dropoff_airport "
            "airport_trip_type distance_bucket duration_bucket fare_bucket")]),
        "trip_metrics": ("SELECT * FROM measured", [*TRIP, *_MEASURED]),
        "trip_enriched": ("SELECT * FROM trips", TRIP),
        # feature tables
        "zone_hour_features": ("SELECT * FROM cube", CUBE),
        "zone_daily_features": (
            f"SELECT {', '.join(PU)}, pickup_date, {', '.join(PARTS)}, {_ROLLUP_SQL} FROM cube GROUP BY ALL",
            [*PU, "pickup_date", *PARTS, "trip_count", *CELL]),
        "borough_hour_features": (
            f"SELECT pickup_borough, pickup_date, {', '.join(PARTS)}, hour, {_ROLLUP_SQL} FROM cube GROUP BY ALL",
            ["pickup_borough", "pickup_date", *PARTS, "hour", "trip_count", *CELL]),
        "top_routes": ("SELECT * FROM routes", ROUTES),
        "sample_extract": (
            "SELECT * REPLACE (" + ", ".join(f"round({c}, 4) AS {c}" for c in CELL if _DOUBLE.match(c) and c not in _BIG)
            + ") FROM cube ORDER BY pickup_date, hour, pickup_borough, pickup_zone, PULocationID LIMIT 100", CUBE),
        # generic aggregation operators
        "aggregate_demand": (demand("pickup_borough, year"), ["pickup_borough", "year", *d]),
        "aggregate_trips": (business("pickup_borough, is_weekend"), ["pickup_borough", "is_weekend", *BUSINESS]),
        "aggregate_trip_metrics": (
            f"SELECT dropoff_borough, day_of_week, {_flow_sql('pickup_date')} FROM measured GROUP BY ALL",
            ["dropoff_borough", "day_of_week", *FLOW]),
        "add_partition_share": (
            f"SELECT *, total_revenue / sum(total_revenue) OVER (PARTITION BY pickup_borough) AS revenue_share FROM ({demand('pickup_borough, month')})",
            ["pickup_borough", "month", *d, "revenue_share"]),
        "revenue_efficiency_metrics": (
            f"""SELECT *, total_revenue / total_trip_distance AS revenue_per_mile, total_revenue / total_trip_duration_min AS revenue_per_trip_minute,
 total_trips / (active_days * active_pickup_zones) AS trips_per_active_zone_day FROM ({demand('pickup_borough')})""",
            ["pickup_borough", *d, *_list("revenue_per_mile revenue_per_trip_minute trips_per_active_zone_day")]),
        # temporal
        "kpi_summary": (
            """SELECT sum(trip_count) AS total_trips, sum(total_revenue) AS total_revenue, min(pickup_date) AS start_date, max(pickup_date) AS end_date,
 count(DISTINCT pickup_date) AS active_days, count(DISTINCT PULocationID) AS active_pickup_zones, count(DISTINCT pickup_borough) AS active_boroughs,
 sum(trip_count) / count(DISTINCT pickup_date) AS avg_trips_per_day, sum(total_revenue) / count(DISTINCT pickup_date) AS avg_revenue_per_day FROM cube""",
            _list("total_trips total_revenue start_date end_date active_days active_pickup_zones active_boroughs avg_trips_per_day avg_revenue_per_day")),
        "hourly_demand": (demand("hour"), ["hour", *d]),
        "daily_demand": ("SELECT * FROM daily_rows", [*_list("pickup_date year month day day_of_week weekday_name is_weekend"), *d]),
        "monthly_demand": (demand("year, month, year_month"), ["year", "month", "year_month", *d]),
        "weekday_weekend_hourly": (
            f"SELECT *, {_DAY_TYPE} FROM ({demand('is_weekend, hour')})", ["day_type", "is_weekend", "hour", *DAY_TYPE]),
        "weekday_hour_heatmap": (demand("day_of_week, weekday_name, hour"), ["day_of_week", "weekday_name", "hour", *d]),
        "borough_hourly_pattern": (demand("pickup_borough, hour"), ["pickup_borough", "hour", *d]),
        "rush_hour_summary": (
            demand("time_period_order, time_period", source="periods"), ["time_period_order", "time_period", *d]),
        "top_zones_by_hour": (
            _top_within(f"hour, {_ZONE}", "hour", "zone_rank_in_hour", n.zones), ["hour", *PU[:3], *d, "zone_rank_in_hour"]),
        "top_zones_overall": (
            top(demand(_ZONE), "total_trips DESC, total_revenue DESC, PULocationID", n.overall), [*PU[:3], *d]),
        "yearly_summary": (
            """SELECT *, (total_trips - prev_year_trips) / prev_year_trips AS yoy_trip_change,
 (total_revenue - prev_year_revenue) / prev_year_revenue AS yoy_revenue_change FROM (
 SELECT *, lag(total_trips) OVER (ORDER BY year) AS prev_year_trips, lag(total_revenue) OVER (ORDER BY year) AS prev_year_revenue FROM yearly)""",
            ["year", *d, *_list("prev_year_trips prev_year_revenue yoy_trip_change yoy_revenue_change")]),
        "year_month_demand": (
            f"SELECT *, year * 12 + month AS month_index FROM ({shared('year, month, year_month', 'year', 'monthly_trip_share_in_year')})",
            ["year", "month", "year_month", *d, "monthly_trip_share_in_year", "month_index"]),
        "month_of_year_pattern": (
            f"""SELECT *, strftime(make_date(2024, month, 1), '%b') AS month_name, total_trips / active_years AS avg_trips_per_active_year
 FROM ({demand('month', ', count(DISTINCT year) AS active_years')})""",
            _list("month month_name active_years total_trips avg_trips_per_active_year total_revenue avg_revenue_per_trip avg_fare_amount "
                  "avg_trip_distance avg_trip_duration_min credit_card_share cash_share active_days active_pickup_zones")),
        "year_hourly_pattern": (shared("year, hour", "year", "hourly_trip_share_in_year"), ["year", "hour", *d, "hourly_trip_share_in_year"]),
        "year_weekday_hour_heatmap": (
            shared("year, day_of_week, weekday_name, hour", "year", "cell_trip_share_in_year"),
            ["year", "day_of_week", "weekday_name", "hour", *d, "cell_trip_share_in_year"]),
        "borough_year_month": (
            shared("pickup_borough, year, month, year_month", "pickup_borough, year", "monthly_trip_share_in_borough_year"),
            ["pickup_borough", "year", "month", "year_month", *d, "monthly_trip_share_in_borough_year"]),
        "borough_year_hour": (
            shared("pickup_borough, year, hour", "pickup_borough, year", "hourly_trip_share_in_borough_year"),
            ["pickup_borough", "year", "hour", *d, "hourly_trip_share_in_borough_year"]),
        "rush_hour_by_year": (
            "SELECT *, total_trips / sum(total_trips) OVER (PARTITION BY year) AS time_period_trip_share_in_year FROM ("
            + demand("year, time_period_order, time_period", source="periods") + ")",
            ["year", "time_period_order", "time_period", *d, "time_period_trip_share_in_year"]),
        "peak_hour_summary": (_top_within("year, hour", "year", "hour_rank_in_year", n.zones), ["year", "hour", *d, "hour_rank_in_year"]),
        "top_zones_by_year": (_top_within(f"year, {_ZONE}", "year", "zone_rank_in_year", n.zones), ["year", *PU[:3], *d, "zone_rank_in_year"]),
        "zone_rank_change": (
            f"""SELECT PULocationID, coalesce(b.pickup_zone, a.pickup_zone) AS pickup_zone, coalesce(b.pickup_borough, a.pickup_borough) AS pickup_borough,
 a.year AS first_year, b.year AS last_year, a.zone_rank AS first_rank, b.zone_rank AS last_rank, a.zone_rank - b.zone_rank AS rank_improvement,
 a.total_trips AS first_year_trips, b.total_trips AS last_year_trips, coalesce(b.total_trips, 0) - coalesce(a.total_trips, 0) AS trip_count_change,
 (b.total_trips - a.total_trips) / a.total_trips AS trip_count_pct_change, a.total_revenue AS first_year_revenue, b.total_revenue AS last_year_revenue
 FROM (SELECT * FROM ranked_years WHERE year = (SELECT min(year) FROM cube)) a
 FULL JOIN (SELECT * FROM ranked_years WHERE year = (SELECT max(year) FROM cube)) b USING (PULocationID)
 WHERE a.zone_rank <= {n.changes} OR b.zone_rank <= {n.changes} OR a.zone_rank IS NULL OR b.zone_rank IS NULL""",
            _list("PULocationID pickup_zone pickup_borough first_year last_year first_rank last_rank rank_improvement first_year_trips "
                  "last_year_trips trip_count_change trip_count_pct_change first_year_revenue last_year_revenue")),
        "weekday_weekend_by_year": (
            f"""SELECT *, total_trips / sum(total_trips) OVER (PARTITION BY year, day_type) AS hourly_trip_share_in_day_type_year FROM (
 SELECT *, {_DAY_TYPE} FROM ({demand('year, is_weekend, hour')}))""",
            ["year", "day_type", "is_weekend", "hour", *DAY_TYPE, "hourly_trip_share_in_day_type_year"]),
        "revenue_efficiency_temporal": (
            f"""SELECT *, total_revenue / total_trip_distance AS revenue_per_mile, total_revenue / total_trip_duration_min AS revenue_per_trip_minute,
 total_trips / (active_days * active_pickup_zones) AS trips_per_active_zone_day FROM ({demand('year, month, year_month')})""",
            _list("year month year_month total_trips total_revenue avg_revenue_per_trip avg_fare_amount avg_trip_distance avg_trip_duration_min "
                  "revenue_per_mile revenue_per_trip_minute trips_per_active_zone_day credit_card_share cash_share active_days active_pickup_zones")),
        # routes
        "route_borough_matrix": (
            f"""SELECT pickup_borough, dropoff_borough, count(*) AS route_count, sum(trip_count) AS total_trips, sum(total_revenue) AS total_revenue,
 sum(total_trip_distance) AS total_trip_distance, sum(total_trip_duration_min) AS total_trip_duration_min, sum(total_tip_amount) AS total_tip_amount,
 sum(credit_card_trip_count) AS credit_card_trip_count, sum(cash_trip_count) AS cash_trip_count, min(route_rank) AS best_route_rank,
 sum(total_revenue) / sum(trip_count) AS avg_revenue_per_trip, sum(total_trip_distance) / sum(trip_count) AS avg_route_trip_distance,
 sum(total_trip_duration_min) / sum(trip_count) AS avg_route_trip_duration_min, sum(total_tip_amount) / sum(trip_count) AS avg_tip_amount,
 {per('sum(total_tip_amount)', 'sum(total_revenue)')} AS route_tip_share, {per('sum(total_revenue)', 'sum(total_trip_distance)')} AS revenue_per_mile,
 sum(credit_card_trip_count) / sum(trip_count) AS credit_card_share, sum(cash_trip_count) / sum(trip_count) AS cash_share FROM routes GROUP BY ALL""",
            _list("pickup_borough dropoff_borough route_count total_trips total_revenue total_trip_distance total_trip_duration_min total_tip_amount "
                  "credit_card_trip_count cash_trip_count best_route_rank avg_revenue_per_trip avg_route_trip_distance avg_route_trip_duration_min "
                  "avg_tip_amount route_tip_share revenue_per_mile credit_card_share cash_share")),
        "top_routes_overall": (top("SELECT * FROM routes", "route_rank, route_key", n.routes), TOP_ROUTE_COLS),
        "top_inter_borough_routes": (
            top("SELECT * FROM routes", "trip_count DESC, total_revenue DESC, route_key", n.routes, "pickup_borough <> dropoff_borough"), ROUTES),
        "top_airport_routes": (top("SELECT * FROM routes", "trip_count DESC, total_revenue DESC, route_key", n.routes, _AIRPORT_ROUTE), ROUTES),
        "route_efficiency_ranking": (
            top(_EFFICIENCY, "revenue_per_mile DESC NULLS LAST, trip_count DESC, route_key", n.routes, f"trip_count >= {MIN_TRIPS}"),
            [*ROUTES, "revenue_per_mile", "revenue_per_minute"]),
        "route_tip_ranking": (
            top(_TIPS, "route_tip_share DESC NULLS LAST, avg_tip_amount DESC NULLS LAST, trip_count DESC, route_key", n.routes, f"trip_count >= {MIN_TRIPS}"),
            [*ROUTES, "route_tip_share"]),
        "route_concentration": (
            """SELECT *, cumulative_trips / overall_trips AS cumulative_trip_share FROM (SELECT *, row_number() OVER w AS route_order,
 sum(trip_count) OVER () AS overall_trips, sum(trip_count) OVER (w ROWS UNBOUNDED PRECEDING) AS cumulative_trips
 FROM routes WINDOW w AS (ORDER BY trip_count DESC, total_revenue DESC, route_key))""",
            _list("route_order route_rank route_key route_name pickup_borough dropoff_borough trip_count total_revenue overall_trips "
                  "cumulative_trips cumulative_trip_share")),
        # flows
        "dropoff_zone_hour_features": ("SELECT * FROM dropoffs", [*DO, "dropoff_date", *PARTS, "hour", *_list(
            "trip_count total_revenue avg_revenue_per_trip avg_fare_amount avg_trip_distance avg_trip_duration_min avg_speed_mph "
            "credit_card_share cash_share")]),
        "zone_balance_hour": (
            f"""SELECT *, CASE WHEN balance_ratio >= 0.1e0 THEN 'dropoff_heavy' WHEN balance_ratio <= -0.1e0 THEN 'pickup_heavy' ELSE 'balanced' END AS balance_direction
 FROM (SELECT *, {_date_parts('activity_date')}, pickup_trip_count + dropoff_trip_count AS total_zone_activity,
 dropoff_trip_count - pickup_trip_count AS net_dropoffs_minus_pickups, pickup_trip_count - dropoff_trip_count AS net_pickups_minus_dropoffs,
 (dropoff_trip_count - pickup_trip_count) / (pickup_trip_count + dropoff_trip_count) AS balance_ratio,
 pickup_trip_count / (pickup_trip_count + dropoff_trip_count) AS pickup_share,
 dropoff_trip_count / (pickup_trip_count + dropoff_trip_count) AS dropoff_share FROM (
 SELECT coalesce(p.PULocationID, d.DOLocationID) AS LocationID, coalesce(pickup_zone, dropoff_zone) AS zone,
 coalesce(pickup_borough, dropoff_borough) AS borough, coalesce(pickup_service_zone, dropoff_service_zone) AS service_zone,
 coalesce(pickup_date, dropoff_date) AS activity_date, coalesce(p.hour, d.hour) AS hour,
 coalesce(p.trip_count, 0) AS pickup_trip_count, coalesce(d.trip_count, 0) AS dropoff_trip_count,
 coalesce(p.total_revenue, 0) AS pickup_revenue, coalesce(d.total_revenue, 0) AS dropoff_revenue
 FROM cells p FULL JOIN drop_cells d ON PULocationID = DOLocationID AND pickup_date = dropoff_date AND p.hour = d.hour))""",
            ["LocationID", "zone", "borough", "service_zone", "activity_date", *PARTS, "hour", *_list(
                "pickup_trip_count dropoff_trip_count total_zone_activity net_dropoffs_minus_pickups net_pickups_minus_dropoffs balance_ratio "
                "pickup_share dropoff_share pickup_revenue dropoff_revenue balance_direction")]),
        "od_flow_hour": (_flows("hour", "hour", "route_rank_in_hour", n.flows), ["hour", *ROUTE, *FLOW, "route_rank_in_hour"]),
        "od_flow_year_month": (
            _flows("year, month, year_month", "year_month", "route_rank_in_year_month", n.flows),
            ["year", "month", "year_month", *ROUTE, *FLOW, "route_rank_in_year_month"]),
        "map_replay_sample": (
            """SELECT *, row_number() OVER (ORDER BY pickup_ts, PULocationID, DOLocationID, total_amount, trip_distance, trip_duration_min) AS replay_trip_id,
 epoch_ms(pickup_ts) AS pickup_epoch_ms, epoch_ms(dropoff_ts) AS dropoff_epoch_ms FROM replay_pool
 JOIN (SELECT LocationID AS a, lon AS pickup_lon, lat AS pickup_lat FROM zone_spots) ON a = PULocationID
 JOIN (SELECT LocationID AS b, lon AS dropoff_lon, lat AS dropoff_lat FROM zone_spots) ON b = DOLocationID""",
            _list("replay_trip_id pickup_ts dropoff_ts pickup_epoch_ms dropoff_epoch_ms pickup_date year month year_month hour PULocationID pickup_zone "
                  "pickup_borough pickup_lon pickup_lat DOLocationID dropoff_zone dropoff_borough dropoff_lon dropoff_lat route_key route_name "
                  "trip_duration_min trip_distance total_amount")),
        # geometry
        "exterior_rings": (
            "SELECT id AS LocationID, ring_index, string_agg(px || ',' || py, ';' ORDER BY i) AS ring_text FROM points GROUP BY ALL",
            _list("LocationID ring_index ring_text")),
        "ring_centroid": (
            "SELECT id AS LocationID, * FROM ring_centres", _list("LocationID ring_index signed_area centroid_x centroid_y")),
        "zone_centroids": (
            """SELECT a.id AS LocationID, coalesce(z.Zone, c_name) AS zone, coalesce(z.Borough, c_mktsegment) AS borough, coalesce(z.service_zone, '') AS service_zone,
 round(coalesce(cx, mx), 8) AS centroid_lon, round(coalesce(cy, my), 8) AS centroid_lat, x0 AS min_lon, y0 AS min_lat, x1 AS max_lon, y1 AS max_lat
 FROM areas a JOIN area_centres USING (id) JOIN area_boxes USING (id) LEFT JOIN zones z ON z.LocationID = a.id""",
            _list("LocationID zone borough service_zone centroid_lon centroid_lat min_lon min_lat max_lon max_lat")),
        # profiles
        "zone_peak_hour": (
            """SELECT PULocationID, hour AS peak_hour, n AS peak_hour_trip_count FROM (
 SELECT *, row_number() OVER (PARTITION BY PULocationID ORDER BY n DESC, hour) AS r FROM zone_hour_counts) WHERE r = 1""",
            _list("PULocationID peak_hour peak_hour_trip_count")),
        "zone_top_destination": (_ZONE_DEST, _list("PULocationID top_dropoff_location_id top_dropoff_zone top_dropoff_borough top_dropoff_trip_count")),
        "zone_profile_summary": (
            f"""SELECT * FROM (SELECT {', '.join(PU)}, {_DEMAND_SQL}, min(pickup_date) AS first_seen_date, max(pickup_date) AS last_seen_date,
 count(DISTINCT (pickup_date, hour)) AS active_zone_hours, sum(trip_count) / count(DISTINCT pickup_date) AS avg_trips_per_active_day FROM cube GROUP BY {', '.join(PU)})
 LEFT JOIN (SELECT PULocationID, hour AS peak_hour, n AS peak_hour_trip_count FROM (
 SELECT *, row_number() OVER (PARTITION BY PULocationID ORDER BY n DESC, hour) AS r FROM zone_hour_counts) WHERE r = 1) USING (PULocationID)
 LEFT JOIN ({_ZONE_DEST}) USING (PULocationID)""", _ZONE_PROFILE_COLS),
        "route_peak_hour": (_ROUTE_PEAK, _list("route_key peak_hour peak_hour_trip_count")),
        "route_profile_summary": (
            f"""SELECT * FROM (SELECT *, dense_rank() OVER (ORDER BY trip_count DESC, total_revenue DESC) AS route_rank,
 trip_count / active_days AS avg_trips_per_active_day, total_tip_amount / trip_count AS avg_tip_amount FROM (
 SELECT {', '.join(ROUTE)}, {_flow_sql('pickup_date')}, min(pickup_date) AS first_seen_date, max(pickup_date) AS last_seen_date FROM measured GROUP BY {', '.join(ROUTE)}))
 LEFT JOIN ({_ROUTE_PEAK}) USING (route_key) WHERE route_rank <= {n.profiles}""", _ROUTE_PROFILE_COLS),
        # forecast
        "lag_features": ("SELECT * FROM lagged", [*CUBE, *_list("lag_1_hour_trip_count lag_24_hour_trip_count rolling_24h_avg_trip_count")]),
        "forecast_frame": ("SELECT * FROM frame", FRAME),
        "time_split": ("SELECT * FROM split", [*FRAME, "dataset"]),
        "split_info": (
            """SELECT 'full' AS dataset, count(*) AS rows, min(pickup_date) AS start_date, max(pickup_date) AS end_date FROM split
 UNION ALL SELECT dataset, count(*), min(pickup_date), max(pickup_date) FROM split WHERE dataset IS NOT NULL GROUP BY dataset""",
            _list("dataset rows start_date end_date")),
        "model_comparison": (models("train"), _list("model MAE RMSE R2 is_best_model")),
        "model_evaluation_metrics": (models("evaluation"), _list("model MAE RMSE R2 is_best_model")),
        "forecast_predictions": ("SELECT * FROM predicted", _PREDICTION_COLS),
        "forecast_monthly": (_MONTHLY_PREDICTED, _list("year_month trip_count predicted_trip_count")),
        "forecast_daily": (
            """SELECT *, trip_count - predicted_trip_count AS prediction_error, abs(trip_count - predicted_trip_count) AS absolute_error,
 abs(trip_count - predicted_trip_count) / nullif(trip_count, 0) * 100 AS absolute_percentage_error FROM (
 SELECT pickup_date, year, month, day, sum(trip_count) AS trip_count, sum(predicted_trip_count) AS predicted_trip_count FROM predicted GROUP BY ALL)""",
            _list("pickup_date year month day trip_count predicted_trip_count prediction_error absolute_error absolute_percentage_error")),
        "error_by_hour": (errors("hour"), ["hour", *ERRORS]),
        "error_by_borough": (errors("pickup_borough"), ["pickup_borough", *ERRORS]),
        "zone_accuracy": (errors(_ZONE), [*PU[:3], *ERRORS]),
        "weekday_hour_error_heatmap": (
            f"SELECT *, ['Sun', 'Mon', 'Tue', 'Wed', 'Thu', 'Fri', 'Sat'][day_of_week] AS weekday_name FROM ({errors('day_of_week, hour')})",
            ["day_of_week", "weekday_name", "hour", *ERRORS]),
        "error_distribution": (
            """SELECT prediction_error FROM predicted WHERE prediction_error BETWEEN (SELECT quantile_cont(prediction_error, 0.01) FROM predicted)
 AND (SELECT quantile_cont(prediction_error, 0.99) FROM predicted)""", ["prediction_error"]),
        "forecast_zone_hour": ("SELECT * FROM served_forecast", _list(
            "pickup_date year month year_month day hour PULocationID pickup_zone pickup_borough actual_trip_count:double predicted_trip_count "
            "prediction_error absolute_error absolute_percentage_error")),
        # quality
        "dq_time_range": (
            """SELECT min(tpep_pickup_datetime) AS min_pickup_time, max(tpep_pickup_datetime) AS max_pickup_time, min(tpep_dropoff_datetime) AS min_dropoff_time,
 max(tpep_dropoff_datetime) AS max_dropoff_time, count(*) FILTER (tpep_pickup_datetime IS NULL) AS null_pickup_time,
 count(*) FILTER (tpep_dropoff_datetime IS NULL) AS null_dropoff_time FROM raw_trips""",
            _list("min_pickup_time max_pickup_time min_dropoff_time max_dropoff_time null_pickup_time null_dropoff_time")),
        "dq_month_membership": (
            f"""SELECT tpep_pickup_datetime >= TIMESTAMP '{MONTH[0]}' AND tpep_pickup_datetime < TIMESTAMP '{MONTH[1]}' AS in_expected_month,
 count(*) AS row_count FROM raw_trips GROUP BY 1""", _list("in_expected_month row_count")),
        "dq_rows_by_month": (
            """SELECT 'pickup_month' AS kind, strftime(tpep_pickup_datetime, '%Y-%m') AS period, count(*) AS row_count FROM raw_trips GROUP BY 2
 UNION ALL SELECT 'dropoff_month', strftime(tpep_dropoff_datetime, '%Y-%m'), count(*) FROM raw_trips GROUP BY 2
 UNION ALL SELECT 'pickup_year', strftime(tpep_pickup_datetime, '%Y'), count(*) FROM raw_trips GROUP BY 2""", _list("kind period row_count")),
        "dq_outside_rows": (
            f"SELECT * FROM raw_trips WHERE NOT (tpep_pickup_datetime >= TIMESTAMP '{MONTH[0]}' AND tpep_pickup_datetime < TIMESTAMP '{MONTH[1]}')",
            _list("tpep_pickup_datetime tpep_dropoff_datetime PULocationID DOLocationID trip_distance total_amount")),
        "dq_hour_distribution": (
            "SELECT hour, count(*) AS row_count, min(hour) OVER () AS min_hour, max(hour) OVER () AS max_hour FROM cube GROUP BY hour",
            _list("hour row_count min_hour max_hour")),
        "dq_expected_years": (
            f"""SELECT y AS year, 'missing' AS status FROM (SELECT unnest({YEARS}) AS y) WHERE y NOT IN (SELECT year(tpep_pickup_datetime) FROM raw_trips)
 UNION ALL SELECT DISTINCT year(tpep_pickup_datetime), 'extra' FROM raw_trips WHERE year(tpep_pickup_datetime) NOT IN ({', '.join(map(str, YEARS))})""",
            _list("year status")),
        "dq_date_consistency": (
            """SELECT count(*) FILTER (year <> year(pickup_date)) AS bad_year_count, count(*) FILTER (month <> month(pickup_date)) AS bad_month_count,
 count(*) FILTER (year_month <> strftime(pickup_date, '%Y-%m')) AS bad_year_month_count FROM cube""",
            _list("bad_year_count bad_month_count bad_year_month_count")),
        "dq_outside_years": (
            "SELECT * FROM cube WHERE NOT year BETWEEN 1997 AND 1999",
            _list("pickup_date year month year_month hour pickup_zone pickup_borough trip_count")),
        "dq_unexpected_months": ("SELECT DISTINCT year_month FROM cube WHERE year_month < '1996-06' OR year_month > '2000-06'", ["year_month"]),
        "dq_inconsistent_rows": (
            """SELECT *, year(pickup_date) AS year_from_date, month(pickup_date) AS month_from_date, strftime(pickup_date, '%Y-%m') AS year_month_from_date
 FROM contradicting WHERE PULocationID = 3 OR PULocationID = 5 AND month <> month(pickup_date)""",
            _list("pickup_date year:INTEGER year_from_date:INTEGER month:INTEGER month_from_date:INTEGER year_month year_month_from_date hour pickup_zone trip_count")),
        "dq_date_contradictions": (
            """SELECT count(*) FILTER (PULocationID = 3) AS bad_year_count, count(*) FILTER (PULocationID = 5) AS bad_month_count,
 0 AS bad_year_month_count FROM cube""", _list("bad_year_count bad_month_count bad_year_month_count")),
        "sample_fraction": (
            f"""SELECT * FROM raw_trips WHERE CAST('0x' || substr(md5(concat_ws('|', '42', PULocationID, DOLocationID,
 CAST(epoch(tpep_pickup_datetime) AS BIGINT), CAST(epoch(tpep_dropoff_datetime) AS BIGINT))), 1, 8) AS BIGINT) < {int(0.01 * 2**32)}""", RAW_D),
        "train_validation_split": ("SELECT * FROM parted", [*FRAME, "part"]),
        "trained_reload": (
            """SELECT model, count(*) AS row_count, 0 AS changed_rows FROM parted,
 (VALUES ('Linear Regression'), ('Random Forest'), ('Gradient Boosting')) AS m(model) WHERE part = 'validation' GROUP BY model""",
            ["model", "row_count", "changed_rows:BIGINT"]),
        "trained_coverage": (
            "SELECT pickup_borough, count(*) AS records, sum(trip_count) AS actual_trip_count, true AS adds_up FROM split WHERE dataset = 'evaluation' GROUP BY 1",
            _list("pickup_borough records actual_trip_count adds_up")),
        "linear_evaluation": (
            """SELECT *, row_number() OVER (ORDER BY RMSE, model) = 1 AS is_best_model FROM (
 SELECT model, avg(abs(trip_count - predicted)) AS MAE, sqrt(avg((trip_count - predicted) ** 2)) AS RMSE,
 1 - avg((trip_count - predicted) ** 2) / var_pop(trip_count) AS R2
 FROM (SELECT model, trip_count, predicted FROM base_models WHERE dataset = 'evaluation'
 UNION ALL SELECT 'linear', trip_count, predicted_trip_count FROM linear_predicted) GROUP BY model)""",
            _list("model MAE RMSE R2 is_best_model")),
        "linear_forecast_monthly": (
            _MONTHLY_PREDICTED.replace("FROM predicted", "FROM linear_predicted"), _list("year_month trip_count predicted_trip_count")),
        "linear_error_by_borough": (
            errors("pickup_borough").replace("FROM predicted", "FROM linear_predicted"), ["pickup_borough", *ERRORS]),
        "extract_zone_daily_features": (
            extract(f"SELECT {', '.join(PU)}, pickup_date, {', '.join(PARTS)}, {_ROLLUP_SQL} FROM cube GROUP BY ALL",
                    "pickup_date, pickup_borough, pickup_zone, PULocationID"), [*PU, "pickup_date", *PARTS, "trip_count", *CELL]),
        "extract_borough_hour_features": (
            extract(f"SELECT pickup_borough, pickup_date, {', '.join(PARTS)}, hour, {_ROLLUP_SQL} FROM cube GROUP BY ALL",
                    "pickup_date, hour, pickup_borough"), ["pickup_borough", "pickup_date", *PARTS, "hour", "trip_count", *CELL]),
        "extract_top_routes": (extract("SELECT * FROM routes", "route_rank, route_key"), ROUTES),
        "dq_missing_months": (
            f"""SELECT year(m) AS expected_year, month(m) AS expected_month, strftime(m, '%Y-%m') AS expected_year_month FROM (
 SELECT unnest(generate_series(DATE '{MONTHS[0]}-01', DATE '{MONTHS[1]}-01', INTERVAL 1 MONTH)) AS m)
 WHERE strftime(m, '%Y-%m') NOT IN (SELECT year_month FROM cube)""", _list("expected_year expected_month expected_year_month")),
        # derived views
        "primary_years": ("SELECT * FROM primary_set", ["year"]),
        "scoped_daily_kpis": (
            """SELECT sum(total_trips) AS total_trips, sum(total_revenue) AS total_revenue, count(*) AS active_days, min(pickup_date) AS start_date,
 max(pickup_date) AS end_date, sum(total_revenue) / count(*) AS avg_revenue_per_day, sum(total_trips) / count(*) AS avg_trips_per_day
 FROM daily_rows WHERE year IN (SELECT year FROM primary_set)""",
            _list("total_trips total_revenue active_days start_date end_date avg_revenue_per_day avg_trips_per_day")),
        "scoped_monthly": (
            f"""SELECT * FROM ({demand('year, month, year_month')}) WHERE (year, month) IN (
 SELECT (year, month) FROM daily_rows WHERE year IN (SELECT year FROM primary_set))""", ["year", "month", "year_month", *d]),
        "top_named_zones": (top(demand(_ZONE), "total_trips DESC, PULocationID", 12, "pickup_zone <> 'N/A' AND pickup_zone <> ''"), [*PU[:3], *d]),
        "top_boroughs_hourly": (
            f"""SELECT * FROM ({demand('pickup_borough, hour')}) WHERE pickup_borough IN (SELECT pickup_borough FROM cube
 WHERE pickup_borough NOT IN ('', 'Unknown') GROUP BY pickup_borough ORDER BY sum(trip_count) DESC, pickup_borough LIMIT 5)""",
            ["pickup_borough", "hour", *d]),
        "busiest_zone_forecast": (
            """SELECT * FROM zone_series WHERE zone = (SELECT zone FROM zone_series GROUP BY zone
 ORDER BY sum(coalesce(nullif(actual_value, 0), predicted_value)) DESC, zone LIMIT 1) ORDER BY date_time, actual_value, predicted_value""",
            _list("zone date_time actual_value predicted_value")),
        "named_routes_top": (top("SELECT * FROM routes", "route_rank, route_key", 10, "route_name NOT IN ('', 'N/A -> N/A')"), ROUTES),
        "actual_predicted_long": (
            f"""SELECT year_month, 'Actual' AS series, CAST(trip_count AS DOUBLE) AS value FROM ({_MONTHLY_PREDICTED})
 UNION ALL SELECT year_month, 'Predicted', predicted_trip_count FROM ({_MONTHLY_PREDICTED})""", _list("year_month series value")),
        "forecast_bias": (
            """SELECT *, CASE WHEN error >= 0 THEN 'under predicted' ELSE 'over predicted' END AS bias FROM (
 SELECT sum(trip_count) AS actual, sum(predicted_trip_count) AS predicted, sum(trip_count) - sum(predicted_trip_count) AS error FROM predicted)""",
            _list("actual predicted error bias")),
        "flows_touching_borough": (
            f"SELECT * FROM ({_flows('hour', 'hour', 'route_rank_in_hour', n.flows)}) WHERE pickup_borough = 'EUROPE' OR dropoff_borough = 'EUROPE'",
            ["hour", *ROUTE, *FLOW, "route_rank_in_hour"]),
        # streaming extension
        "batch_speed_live": ("SELECT * FROM event_hours", _list("window_start window_end PULocationID trip_count total_revenue")),
        "stream_replay_demand": ("SELECT * FROM closed_hours", _list("window_start window_end PULocationID trip_count total_revenue")),
        "stream_zone_demand": ("SELECT * FROM closed_hours", _list("window_start window_end PULocationID trip_count total_revenue")),
        "stream_zone_demand_parts": ("SELECT * FROM closed_hours", _list("window_start window_end PULocationID trip_count total_revenue")),
        "stream_hotspots": (
            """SELECT * FROM (SELECT *, dense_rank() OVER (PARTITION BY window_start ORDER BY trip_count DESC, total_revenue DESC) AS hotspot_rank
 FROM closed_hours) WHERE hotspot_rank <= 3""", _list("window_start window_end PULocationID trip_count total_revenue hotspot_rank:INTEGER")),
        "stream_replay_hotspots": (
            """SELECT * FROM (SELECT *, dense_rank() OVER (PARTITION BY window_start ORDER BY trip_count DESC, total_revenue DESC) AS hotspot_rank
 FROM closed_hours) WHERE hotspot_rank <= 3""", _list("window_start window_end PULocationID trip_count total_revenue hotspot_rank:INTEGER")),
        "batch_speed_merge": (
            f"SELECT * FROM event_hours WHERE window_start < TIMESTAMP '{CUTOFF}' UNION ALL SELECT * FROM closed_hours WHERE window_start >= TIMESTAMP '{CUTOFF}'",
            _list("window_start window_end PULocationID trip_count total_revenue")),
        "lk_filters": (
            """SELECT 'year' AS kind, NULL AS zone_id, CAST(year AS VARCHAR) AS name, NULL AS borough FROM yearly
 UNION ALL SELECT DISTINCT 'borough', NULL, pickup_borough, NULL FROM cube
 UNION ALL SELECT DISTINCT 'zone', PULocationID, pickup_zone, pickup_borough FROM cube""",
            ["kind", "zone_id:INTEGER", "name", "borough"]),
    }
    for name, keys in {
        "payment_type_summary": "payment_type, payment_type_desc",
        "payment_type_by_year": "year, payment_type, payment_type_desc",
        "vendor_summary": "VendorID, vendor_name",
        "ratecode_summary": "RatecodeID, ratecode_desc",
        "passenger_count_summary": "passenger_count",
        "distance_bucket_summary": "distance_bucket",
        "duration_bucket_summary": "duration_bucket",
        "fare_bucket_summary": "fare_bucket",
        "pickup_dropoff_borough_matrix": "pickup_borough, dropoff_borough",
        "airport_trip_summary": "year, airport_trip_type",
        "trip_behavior_by_hour": "hour",
    }.items():
        out[name] = (business(keys), [*keys.split(", "), *BUSINESS])
    return out


CTES["zone_hour_counts"] = "SELECT PULocationID, hour, sum(trip_count) AS n FROM cube GROUP BY ALL"
CTES["zone_rings"] = """SELECT LocationID, CAST(LocationID % 360 AS DOUBLE) AS x, CAST(LocationID // 360 AS DOUBLE) AS y,
 CASE WHEN LocationID % 35 = 0 THEN 0e0 ELSE 1 + (LocationID % 4) * 0.25e0 END AS s FROM zones"""
CTES["zone_spots"] = """SELECT LocationID,
 CASE WHEN LocationID % 6 = 0 THEN ((x + s / 2) * s * s + (x + 4.25) * 0.25) / (s * s + 0.25) ELSE x + s / 2 END AS lon,
 CASE WHEN LocationID % 6 = 0 THEN ((y + s / 2) * s * s + (y + 2.25) * 0.25) / (s * s + 0.25) ELSE y + s / 2 END AS lat FROM zone_rings"""


def _needed(sql: str) -> list[str]:
    """CTEs the text refers to, directly or through others, in order of definition."""
    found: set[str] = set()
    queue = [sql]
    while queue:
        words = set(re.findall(r"\w+", queue.pop()))
        for name in words & CTES.keys() - found:
            found.add(name)
            queue.append(CTES[name])
    order: list[str] = []

    def visit(name: str) -> None:
        if name in order:
            return
        for other in sorted((set(re.findall(r"\w+", CTES[name])) & CTES.keys()) - {name}):
            visit(other)
        order.append(name)

    for name in sorted(found):
        visit(name)
    return order


def render(body: str, columns: list[str]) -> str:
    ctes = ",\n".join(f"{n} AS ({CTES[n]})" for n in _needed(body))
    head = f"WITH {ctes}\n" if ctes else ""
    return f"{head}SELECT {', '.join(_typed(c) for c in columns)} FROM (\n{body}\n)"


TABLES = _tables(Limits())
#: The ranked tables with all their rows.
RANKED = _tables(Limits(*[2**31 - 1] * 6))


def lookup(table: str, filters: dict, sort: list[str], limit: int | None) -> str:
    """SQL of a lookup over a table's oracle."""
    body, columns = RANKED[table]
    where = " AND ".join(
        f"{c} = " + (f"'{v}'" if isinstance(v, str) else str(v)) for c, v in filters.items() if v is not None
    ) or "true"
    order = ", ".join(f"{s[1:]} DESC NULLS LAST" if s.startswith("-") else f"{s} ASC NULLS FIRST" for s in sort)
    tail = (f" ORDER BY {order}" if order else "") + (f" LIMIT {limit}" if limit else "")
    return render(f"SELECT * FROM ({body}) WHERE {where}{tail}", columns)


def story(sections: dict[str, tuple[str, dict, list[str], int | None]]) -> str:
    """SQL of a bundle: every section's lookup, one row a field."""
    parts = []
    for name, (table, filters, sort, limit) in sections.items():
        body, columns = RANKED[table]
        where = " AND ".join(f"{c} = " + (f"'{v}'" if isinstance(v, str) else str(v)) for c, v in filters.items()) or "true"
        order = ", ".join(f"{x[1:]} DESC NULLS LAST" if x.startswith("-") else f"{x} ASC NULLS FIRST" for x in sort) or "1"
        fields = []
        for column in columns:
            plain = column.partition(":")[0]
            number = _typed(column) != plain and ":text" not in column
            fields.append(f"""{{'field': '{plain}', 'number': {f'CAST({plain} AS DOUBLE)' if number else 'CAST(NULL AS DOUBLE)'},
 'text': {'CAST(NULL AS VARCHAR)' if number else f'CAST({plain} AS VARCHAR)'}}}""")
        parts.append(f"""SELECT '{name}' AS section, position, unnest([{', '.join(fields)}], recursive := true) FROM (
 SELECT * FROM (SELECT *, row_number() OVER (ORDER BY {order}) AS position FROM ({body}) WHERE {where}) WHERE {f'position <= {limit}' if limit else 'true'})""")
    return render(" UNION ALL ".join(parts), ["section", "position:INTEGER", "field", "number:DOUBLE", "text"])


def sql() -> dict[str, str]:
    return {name: render(body, columns) for name, (body, columns) in TABLES.items()} | {
        f"story_{name}": story(sections) for name, sections in STORIES.items()
    } | {"lk_map_replay": REPLAY_LOOKUP}


_BODY, _COLUMNS = TABLES["map_replay_sample"]
#: A draw of its own from the trips of the year.
REPLAY_LOOKUP = render(
    _BODY.replace("FROM replay_pool", f"""FROM (SELECT t.* FROM trips t WHERE year = 1997 AND PULocationID IN (SELECT LocationID FROM zone_spots)
 AND DOLocationID IN (SELECT LocationID FROM zone_spots) ORDER BY md5('{SEED}' || '|' || PULocationID || '|' || DOLocationID || '|' ||
 CAST(epoch(pickup_ts) AS BIGINT) || '|' || CAST(epoch(dropoff_ts) AS BIGINT)), total_amount, trip_distance, trip_duration_min LIMIT 20)"""), _COLUMNS)

#: The bundles as they are registered: section -> table, filters, sort, limit.
STORIES: dict[str, dict[str, tuple[str, dict, list[str], int | None]]] = {
    "overview": {
        "kpi": ("kpi_summary", {}, [], None),
        "yearly_summary": ("yearly_summary", {}, ["year"], None),
        "year_month_demand": ("year_month_demand", {"year": 1998}, ["year", "month"], None),
        "hourly_demand": ("year_hourly_pattern", {"year": 1998}, ["hour"], None),
        "weekday_hour_heatmap": ("year_weekday_hour_heatmap", {"year": 1998}, ["day_of_week", "hour"], None),
        "top_zones": ("top_zones_by_year", {"year": 1998}, ["zone_rank_in_year", "PULocationID"], 5),
        "top_routes": ("top_routes_overall", {}, ["route_rank", "route_key"], 4),
    },
    "temporal": {
        "yearly_summary": ("yearly_summary", {}, ["year"], None),
        "year_month_demand": ("year_month_demand", {}, ["year", "month"], None),
        "hourly_pattern": ("hourly_demand", {}, ["hour"], None),
        "weekday_hour_heatmap": ("weekday_hour_heatmap", {}, ["day_of_week", "hour"], None),
        "weekday_weekend_hourly": ("weekday_weekend_hourly", {}, ["is_weekend", "hour"], None),
        "rush_hour_by_year": ("rush_hour_by_year", {}, ["year", "time_period_order"], None),
        "borough_year_month": ("borough_year_month", {"pickup_borough": "ASIA"}, ["pickup_borough", "year", "month"], None),
        "borough_hourly_pattern": ("borough_hourly_pattern", {"pickup_borough": "ASIA"}, ["pickup_borough", "hour"], None),
        "month_of_year_pattern": ("month_of_year_pattern", {}, ["month"], None),
        "revenue_efficiency": ("revenue_efficiency_temporal", {}, ["year", "month"], None),
    },
    "spatial": {
        "top_zones": ("top_zones_by_year", {"year": 1997}, ["zone_rank_in_year", "PULocationID"], 6),
        "top_zones_by_hour": ("top_zones_by_hour", {"hour": 8}, ["hour", "zone_rank_in_hour", "PULocationID"], 6),
        "zone_rank_change": ("zone_rank_change", {}, ["-rank_improvement", "-trip_count_change", "PULocationID"], 6),
    },
    "routes": {
        "top_routes": ("top_routes_overall", {}, ["route_rank", "route_key"], 6),
        "top_airport_routes": ("top_airport_routes", {}, ["route_rank", "-trip_count", "route_key"], 6),
        "top_inter_borough_routes": ("top_inter_borough_routes", {}, ["route_rank", "-trip_count", "route_key"], 6),
        "route_borough_matrix": ("route_borough_matrix", {}, ["-total_trips", "pickup_borough", "dropoff_borough"], None),
        "pickup_dropoff_borough_matrix": ("pickup_dropoff_borough_matrix", {}, ["-trip_count", "pickup_borough", "dropoff_borough"], None),
        "airport_trip_summary": ("airport_trip_summary", {}, ["year", "airport_trip_type"], None),
        "route_efficiency_ranking": ("route_efficiency_ranking", {}, ["-revenue_per_mile", "-trip_count", "route_key"], 6),
        "route_tip_ranking": ("route_tip_ranking", {}, ["-route_tip_share", "-avg_tip_amount", "route_key"], 6),
    },
    "business": {
        "payment_type": ("payment_type_by_year", {"year": 1999}, ["-trip_count"], None),
        "trip_behavior_by_hour": ("trip_behavior_by_hour", {}, ["hour"], None),
    },
    "forecast": {
        "model_comparison": ("model_comparison", {}, ["RMSE"], None),
        "model_evaluation_metrics": ("model_evaluation_metrics", {}, ["RMSE"], None),
        "monthly_actual_predicted": ("forecast_monthly", {}, ["year_month"], None),
        "daily_actual_predicted": ("forecast_daily", {}, ["pickup_date"], None),
        "error_by_hour": ("error_by_hour", {}, ["hour"], None),
        "error_by_borough": ("error_by_borough", {}, ["-aggregate_absolute_error"], None),
        "zone_accuracy": ("zone_accuracy", {}, ["-aggregate_absolute_error", "PULocationID"], 7),
        "weekday_hour_error_heatmap": ("weekday_hour_error_heatmap", {}, ["day_of_week", "hour"], None),
    },
}


#: What every registered lookup stands for, written out: table, filters, sort ("-" for descending), limit.
LOOKUPS: dict[str, tuple[str, dict, list[str], int | None]] = {
    "lk_temporal": ("year_hourly_pattern", {"year": 1998}, ["hour"], None),
    "lk_temporal_kpi": ("kpi_summary", {}, [], None),
    "lk_temporal_yearly": ("yearly_summary", {}, ["year"], None),
    "lk_temporal_daily": ("daily_demand", {"year": 1999}, ["pickup_date"], None),
    "lk_temporal_monthly": ("monthly_demand", {"year": 1997}, ["year", "month"], None),
    "lk_temporal_year_month": ("year_month_demand", {"year": 1996}, ["year", "month"], None),
    "lk_temporal_heatmap": ("year_weekday_hour_heatmap", {"year": 2000}, ["day_of_week", "hour"], None),
    "lk_temporal_borough_year_month": ("borough_year_month", {"year": 1998, "pickup_borough": "ASIA"}, ["pickup_borough", "year", "month"], None),
    "lk_temporal_borough_hourly": ("borough_hourly_pattern", {"pickup_borough": "EUROPE"}, ["pickup_borough", "hour"], None),
    "lk_temporal_rush_hour": ("rush_hour_by_year", {"year": 1997}, ["year", "time_period_order"], None),
    "lk_temporal_month_pattern": ("month_of_year_pattern", {}, ["month"], None),
    "lk_temporal_day_type": ("weekday_weekend_hourly", {"day_type": "weekend"}, ["is_weekend", "hour"], None),
    "lk_temporal_efficiency": ("revenue_efficiency_temporal", {"year": 1999}, ["year", "month"], None),
    "lk_spatial": ("top_zones_by_year", {"year": 1998}, ["zone_rank_in_year", "PULocationID"], 2),
    "lk_spatial_overall": ("top_zones_overall", {}, ["-total_trips", "PULocationID"], 5),
    "lk_spatial_rank_change": ("zone_rank_change", {}, ["-rank_improvement", "-trip_count_change", "PULocationID"], 50),
    "lk_spatial_zones_by_hour": ("top_zones_by_hour", {"hour": 8}, ["hour", "zone_rank_in_hour", "PULocationID"], 10),
    "lk_routes": ("top_routes_overall", {}, ["route_rank", "route_key"], 7),
    "lk_routes_all": ("top_routes_overall", {}, ["route_rank", "route_key"], 5000),
    "lk_routes_airport": ("top_airport_routes", {}, ["route_rank", "-trip_count", "route_key"], 5),
    "lk_routes_inter_borough": ("top_inter_borough_routes", {}, ["route_rank", "-trip_count", "route_key"], 25),
    "lk_routes_matrix": ("route_borough_matrix", {}, ["-total_trips"], None),
    "lk_routes_trip_matrix": ("pickup_dropoff_borough_matrix", {}, ["-trip_count"], None),
    "lk_routes_airport_summary": ("airport_trip_summary", {"year": 1998}, ["year", "airport_trip_type"], None),
    "lk_routes_efficiency": ("route_efficiency_ranking", {}, ["-revenue_per_mile", "-trip_count", "route_key"], 5),
    "lk_routes_tips": ("route_tip_ranking", {}, ["-route_tip_share", "-avg_tip_amount", "route_key"], 5),
    "lk_routes_concentration": ("route_concentration", {}, ["route_order"], 100),
    "lk_map": ("zone_balance_hour", {"year": 1998, "hour": 9, "balance_direction": "pickup_heavy"}, ["-total_zone_activity", "LocationID", "activity_date", "hour"], 500),
    "lk_map_centroids": ("zone_centroids", {}, ["LocationID"], None),
    "lk_map_dropoffs": ("dropoff_zone_hour_features", {"month": 5, "dropoff_borough": "ASIA"}, ["-trip_count", "DOLocationID", "dropoff_date", "hour"], 100),
    "lk_map_flows_hour": ("od_flow_hour", {"hour": 17, "pickup_borough": "AMERICA"}, ["hour", "route_rank_in_hour", "route_key"], 500),
    "lk_map_flows_month": ("od_flow_year_month", {"year_month": "1999-02"}, ["year", "month", "route_rank_in_year_month", "route_key"], 500),
    "lk_profiles": ("zone_profile_summary", {"pickup_borough": "AFRICA"}, ["-total_trips", "PULocationID"], 300),
    "lk_profiles_zone": ("zone_profile_summary", {"PULocationID": 7}, [], None),
    "lk_profiles_routes": ("route_profile_summary", {"pickup_borough": "ASIA", "dropoff_borough": "EUROPE"}, ["route_rank", "route_key"], 300),
    "lk_profiles_route": ("route_profile_summary", {"PULocationID": 19, "DOLocationID": 18}, [], None),
    "lk_business": ("payment_type_by_year", {"year": 1999}, ["-trip_count"], None),
    "lk_business_all": ("payment_type_summary", {}, ["-trip_count"], None),
    "lk_business_behavior": ("trip_behavior_by_hour", {}, ["hour"], None),
    "lk_forecast": ("forecast_zone_hour", {"month": 6, "hour": 12}, ["-absolute_error", "pickup_date", "hour", "PULocationID"], 50),
    "lk_forecast_zones": ("zone_accuracy", {}, ["-aggregate_absolute_error", "PULocationID"], 5),
    "lk_forecast_evaluation": ("model_evaluation_metrics", {}, ["RMSE"], None),
    "lk_forecast_comparison": ("model_comparison", {}, ["RMSE"], None),
    "lk_forecast_monthly": ("forecast_monthly", {}, ["year_month"], None),
    "lk_forecast_daily": ("forecast_daily", {}, ["pickup_date"], None),
    "lk_forecast_by_hour": ("error_by_hour", {}, ["hour"], None),
    "lk_forecast_heatmap": ("weekday_hour_error_heatmap", {}, ["day_of_week", "hour"], None),
    "lk_forecast_by_borough": ("error_by_borough", {}, ["-aggregate_absolute_error"], None),
}
