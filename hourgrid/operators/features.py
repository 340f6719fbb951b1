"""Feature tables: the zone-hour cube, its roll-ups, the route table, sample extracts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hourgrid import schema as S
from hourgrid.functions import exprs as X
from hourgrid.functions import measures as M
from hourgrid.functions.measures import MeasureSet
from hourgrid.operators.ordering import dense_rank_all
from hourgrid.operators.rollup import rollup

SAMPLE_ORDERS = {
    "trip_enriched": ["pickup_ts"],
    "zone_hour_features": ["pickup_date", "hour", "pickup_borough", "pickup_zone"],
    "zone_daily_features": ["pickup_date", "pickup_borough", "pickup_zone"],
    "borough_hour_features": ["pickup_date", "hour", "pickup_borough"],
    "top_routes": ["route_rank"],
}


def zone_hour_features(trips: DataFrame) -> DataFrame:
    """The core cube: one row per pickup zone, date and hour."""
    keyed = trips.dropna(subset=[S.PU, "pickup_date", "hour"])
    cells = rollup(keyed, [S.PU, *S.PICKUP_PLACE, "pickup_date", "hour"], M.trip_cell())
    return X.add_date_fields(cells, "pickup_date").transform(S.lead_with, S.CUBE_ORDER)


def zone_daily_features(cube: DataFrame) -> DataFrame:
    """Cube rolled up to pickup zone and date."""
    keys = [S.PU, *S.PICKUP_PLACE, "pickup_date", *S.DATE_PARTS]
    return rollup(cube, keys, M.cell_rollup()).transform(S.lead_with, S.DAILY_ORDER)


def borough_hour_features(cube: DataFrame) -> DataFrame:
    """Cube rolled up to pickup borough, date and hour."""
    keys = ["pickup_borough", "pickup_date", *S.DATE_PARTS, "hour"]
    return rollup(cube, keys, M.cell_rollup()).transform(S.lead_with, S.BOROUGH_ORDER)


def route_totals(trips: DataFrame) -> DataFrame:
    """One unranked row per ordered pair of zones."""
    cell = M.trip_cell()
    measures = MeasureSet(
        {
            **cell.aggregates,
            "first_seen_date": F.min("pickup_date"),
            "last_seen_date": F.max("pickup_date"),
            "active_days": F.count_distinct("pickup_date"),
        },
        {**cell.ratios, "avg_trips_per_active_day": ("trip_count", "active_days")},
    )
    return rollup(trips.dropna(subset=[S.PU, S.DO, "route_key"]), S.ROUTE, measures)


def top_routes(trips: DataFrame) -> DataFrame:
    """Route table with the dense rank of every route by trips, then revenue."""
    ranked = dense_rank_all(
        route_totals(trips), ["trip_count", "total_revenue"], "route_rank", tie=("route_key",)
    )
    return ranked.transform(S.lead_with, S.ROUTES_ORDER)


def sample_extract(table: DataFrame, order: list[str], rows: int = 100, digits: int | None = 4) -> DataFrame:
    """First rows in the stated order, doubles rounded to ``digits`` (not at all for None).

    The remaining columns break ties, so the extract is repeatable.
    """
    ties = [c for c in table.columns if c not in order]
    head = table.orderBy(*order, *ties).limit(rows)
    if digits is None:
        return head
    return head.select(*[
        F.round(f.name, digits).alias(f.name) if isinstance(f.dataType, T.DoubleType) else F.col(f.name)
        for f in head.schema.fields
    ])
