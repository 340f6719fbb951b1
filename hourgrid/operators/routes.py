"""Tables over the route table: matrix, top lists, rankings, concentration curve."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourgrid import schema as S
from hourgrid.functions import exprs as X
from hourgrid.functions import measures as M
from hourgrid.operators.ordering import desc, number_all
from hourgrid.operators.rollup import leading, rollup

_TOP_COLUMNS = [
    "route_rank", *S.ROUTE, "trip_count", "active_days", "avg_trips_per_active_day",
    "first_seen_date", "last_seen_date", "avg_trip_distance", "avg_trip_duration_min",
    "avg_fare_amount", "avg_total_amount", "total_revenue", "avg_tip_amount",
    "avg_passenger_count", "avg_speed_mph", "credit_card_share", "cash_share",
]


def route_borough_matrix(routes: DataFrame) -> DataFrame:
    keys = ["pickup_borough", "dropoff_borough"]
    return rollup(routes, keys, M.route_group()).orderBy(F.desc("total_trips"))


def top_routes_overall(routes: DataFrame, top_n: int | None = 25) -> DataFrame:
    wanted = routes.select(*[c for c in _TOP_COLUMNS if c in routes.columns])
    return leading(wanted.orderBy("route_rank", *desc("trip_count", "total_revenue"), "route_key"), top_n)


def _busiest(routes: DataFrame, top_n: int | None) -> DataFrame:
    return leading(routes.orderBy(*desc("trip_count", "total_revenue"), "route_key"), top_n)


def top_inter_borough_routes(routes: DataFrame, top_n: int | None = 25) -> DataFrame:
    return _busiest(routes.where(F.col("pickup_borough") != F.col("dropoff_borough")), top_n)


def top_airport_routes(routes: DataFrame, top_n: int | None = 25) -> DataFrame:
    return _busiest(routes.where(X.at_airport("pickup") | X.at_airport("dropoff")), top_n)


def route_efficiency_ranking(routes: DataFrame, top_n: int | None = 25, min_trips: int = 1000) -> DataFrame:
    rated = routes.withColumns({
        "revenue_per_mile": X.ratio("total_revenue", "total_trip_distance"),
        "revenue_per_minute": X.ratio("total_revenue", "total_trip_duration_min"),
    })
    order = [*desc("revenue_per_mile", "trip_count"), "route_key"]
    return leading(rated.where(F.col("trip_count") >= min_trips).orderBy(*order), top_n)


def route_tip_ranking(routes: DataFrame, top_n: int | None = 25, min_trips: int = 1000) -> DataFrame:
    rated = routes.withColumn("route_tip_share", X.ratio("total_tip_amount", "total_revenue"))
    order = [*desc("route_tip_share", "avg_tip_amount", "trip_count"), "route_key"]
    return leading(rated.where(F.col("trip_count") >= min_trips).orderBy(*order), top_n)


def route_concentration(routes: DataFrame) -> DataFrame:
    """Cumulative share of trips over the routes, busiest first."""
    placed = number_all(
        routes,
        ["-trip_count", "-total_revenue", "route_key"],
        "route_order",
        running=("cumulative_trips", "trip_count"),
        grand="overall_trips",
    )
    share = X.ratio("cumulative_trips", "overall_trips")
    return placed.withColumn("cumulative_trip_share", share).select(
        "route_order", "route_rank", "route_key", "route_name", "pickup_borough",
        "dropoff_borough", "trip_count", "total_revenue", "overall_trips", "cumulative_trips",
        "cumulative_trip_share",
    ).orderBy("route_order")
