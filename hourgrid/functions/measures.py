"""Measure sets as data: what to aggregate, and the guarded ratios that follow."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from hourgrid import schema as S
from hourgrid.functions import exprs as X


@dataclass(frozen=True)
class MeasureSet:
    """``aggregates``: name -> aggregate column; ``ratios``: name -> (numerator, denominator)."""

    aggregates: dict[str, Column]
    ratios: dict[str, tuple[str | Column, str | Column]]


def _sums(**names: str) -> dict[str, Column]:
    return {out: F.sum(source) for out, source in names.items()}


def _per(count: str, **names: str) -> dict[str, tuple[str, str]]:
    return {out: (source, count) for out, source in names.items()}


_MONEY_AND_WAY = {
    "total_revenue": S.TOTAL,
    "total_fare_amount": S.FARE,
    "total_trip_distance": S.DISTANCE,
    "total_trip_duration_min": S.MINUTES,
}
_CUBE_SUMS = [
    "total_revenue", "total_fare_amount", "total_trip_distance", "total_trip_duration_min",
    "total_passenger_count", "credit_card_trip_count", "cash_trip_count",
]
_TOTALS_PER_TRIP = {
    "avg_revenue_per_trip": "total_revenue",
    "avg_fare_amount": "total_fare_amount",
    "avg_trip_distance": "total_trip_distance",
    "avg_trip_duration_min": "total_trip_duration_min",
}
_PAYMENT_SHARES = {
    "credit_card_share": "credit_card_trip_count",
    "cash_share": "cash_trip_count",
}


def demand() -> MeasureSet:
    """Cube rows, any keys: totals, active days and zones, per-trip averages and shares."""
    return MeasureSet(
        {
            "total_trips": F.sum("trip_count"),
            **_sums(**{c: c for c in _CUBE_SUMS}),
            "active_days": F.count_distinct("pickup_date"),
            "active_pickup_zones": F.count_distinct(S.PU),
        },
        _per("total_trips", **_TOTALS_PER_TRIP, avg_passenger_count="total_passenger_count",
             **_PAYMENT_SHARES),
    )


def trip_cell() -> MeasureSet:
    """Trip rows to one cell (zone-hour or route): plain averages skip nulls, as do the sums."""
    both = {
        "trip_distance": S.DISTANCE,
        "trip_duration_min": S.MINUTES,
        "fare_amount": S.FARE,
        "tip_amount": "tip_amount",
        "passenger_count": S.PASSENGERS,
    }
    return MeasureSet(
        {
            "trip_count": F.count(F.lit(1)),
            **{f"avg_{n}": F.avg(c) for n, c in both.items()},
            **{f"total_{n}": F.sum(c) for n, c in both.items()},
            "avg_total_amount": F.avg(S.TOTAL),
            "total_revenue": F.sum(S.TOTAL),
            "total_tolls_amount": F.sum("tolls_amount"),
            "total_airport_fee": F.sum("airport_fee"),
            "avg_speed_mph": F.avg(X.speed_mph()),
            "credit_card_trip_count": F.sum(X.is_credit()),
            "cash_trip_count": F.sum(X.is_cash()),
        },
        _per("trip_count", **_PAYMENT_SHARES),
    )


def cell_rollup() -> MeasureSet:
    """Cube cells to a coarser cell: sums of sums, averages recomputed from the totals."""
    additive = [
        "trip_count", *_CUBE_SUMS, "total_tip_amount", "total_tolls_amount", "total_airport_fee",
    ]
    return MeasureSet(
        _sums(**{c: c for c in additive}),
        {
            **_per(
                "trip_count",
                avg_trip_distance="total_trip_distance",
                avg_trip_duration_min="total_trip_duration_min",
                avg_fare_amount="total_fare_amount",
                avg_total_amount="total_revenue",
                avg_tip_amount="total_tip_amount",
                avg_passenger_count="total_passenger_count",
                **_PAYMENT_SHARES,
            ),
            "avg_speed_mph": (
                "total_trip_distance", F.col("total_trip_duration_min") / 60.0,
            ),
        },
    )


def business() -> MeasureSet:
    """Flagged trips, any keys: totals, averages over all trips, airport and borough counts."""
    return MeasureSet(
        {
            "trip_count": F.count(F.lit(1)),
            **_sums(**_MONEY_AND_WAY),
            **_sums(
                total_tip_amount="tip_amount",
                total_tip_share_of_total="tip_share_of_total",
                total_fare_per_mile="fare_per_mile",
                total_speed_mph="trip_speed_mph",
                total_passenger_count=S.PASSENGERS,
            ),
            "active_days": F.count_distinct("pickup_date"),
            **_sums(
                inter_borough_trip_count="is_inter_borough",
                airport_pickup_trip_count="is_pickup_airport",
                airport_dropoff_trip_count="is_dropoff_airport",
            ),
        },
        _per(
            "trip_count",
            **_TOTALS_PER_TRIP,
            avg_tip_amount="total_tip_amount",
            avg_tip_share_of_total="total_tip_share_of_total",
            avg_fare_per_mile="total_fare_per_mile",
            avg_speed_mph="total_speed_mph",
        ),
    )


def flow(active_date: str) -> MeasureSet:
    """Trips with metrics, any keys: totals, payment counts, active days, nine ratios."""
    return MeasureSet(
        {
            "trip_count": F.count(F.lit(1)),
            **_sums(**_MONEY_AND_WAY),
            **_sums(
                total_tip_amount="tip_amount",
                total_tip_share_of_total="tip_share_of_total",
                total_passenger_count=S.PASSENGERS,
                total_speed_mph="trip_speed_mph",
                credit_card_trip_count="is_credit_card",
                cash_trip_count="is_cash",
            ),
            "active_days": F.count_distinct(active_date),
        },
        _per(
            "trip_count",
            **_TOTALS_PER_TRIP,
            avg_passenger_count="total_passenger_count",
            avg_speed_mph="total_speed_mph",
            avg_tip_share_of_total="total_tip_share_of_total",
            **_PAYMENT_SHARES,
        ),
    )


def route_group() -> MeasureSet:
    """Route rows to a group of routes, with ratios over the group's totals."""
    return MeasureSet(
        {
            "route_count": F.count(F.lit(1)),
            "total_trips": F.sum("trip_count"),
            **_sums(**{
                c: c for c in [
                    "total_revenue", "total_trip_distance", "total_trip_duration_min",
                    "total_tip_amount", "credit_card_trip_count", "cash_trip_count",
                ]
            }),
            "best_route_rank": F.min("route_rank"),
        },
        {
            **_per(
                "total_trips",
                avg_revenue_per_trip="total_revenue",
                avg_route_trip_distance="total_trip_distance",
                avg_route_trip_duration_min="total_trip_duration_min",
                avg_tip_amount="total_tip_amount",
            ),
            "route_tip_share": ("total_tip_amount", "total_revenue"),
            "revenue_per_mile": ("total_revenue", "total_trip_distance"),
            **_per("total_trips", **_PAYMENT_SHARES),
        },
    )


def zone_profile() -> MeasureSet:
    """Cube rows to one profile per zone."""
    return MeasureSet(
        {
            "total_trips": F.sum("trip_count"),
            **_sums(**{c: c for c in _CUBE_SUMS}),
            "first_seen_date": F.min("pickup_date"),
            "last_seen_date": F.max("pickup_date"),
            "active_days": F.count_distinct("pickup_date"),
            "active_zone_hours": F.count_distinct("pickup_date", "hour"),
        },
        {
            **_per("total_trips", **_TOTALS_PER_TRIP, avg_passenger_count="total_passenger_count",
                   **_PAYMENT_SHARES),
            "avg_trips_per_active_day": ("total_trips", "active_days"),
        },
    )


def route_profile() -> MeasureSet:
    """Trips with metrics to one profile per route."""
    sums = flow("pickup_date").aggregates
    return MeasureSet(
        {
            **sums,
            "first_seen_date": F.min("pickup_date"),
            "last_seen_date": F.max("pickup_date"),
        },
        {
            **_per(
                "trip_count",
                **_TOTALS_PER_TRIP,
                avg_tip_amount="total_tip_amount",
                avg_tip_share_of_total="total_tip_share_of_total",
                avg_speed_mph="total_speed_mph",
                **_PAYMENT_SHARES,
            ),
            "avg_trips_per_active_day": ("trip_count", "active_days"),
        },
    )
