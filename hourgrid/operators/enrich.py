"""Trip enrichment: zone attributes of both ends, labels, calendar, route."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourgrid import schema as S
from hourgrid.functions import exprs as X


def join_zone_lookup(trips: DataFrame, zones: DataFrame) -> DataFrame:
    """Left-join the zone dimension to both ends of the trip.

    Join strategy is Spark's: the lookup is broadcast while it is below the size threshold,
    beyond it the joins shuffle and adaptive execution splits hot zones.
    """
    for side, prefix in ((S.PU, "pickup"), (S.DO, "dropoff")):
        lookup = zones.select(
            F.col("LocationID").cast("int").alias(f"__{prefix}_id"),
            F.col("Zone").alias(f"{prefix}_zone"),
            F.col("Borough").alias(f"{prefix}_borough"),
            F.col("service_zone").alias(f"{prefix}_service_zone"),
        )
        trips = trips.join(lookup, F.col(side) == F.col(f"__{prefix}_id"), "left").drop(
            f"__{prefix}_id"
        )
    return trips


def with_optional_money(trips: DataFrame) -> DataFrame:
    """Add absent optional money columns as nulls, so the cube can always be built."""
    absent = [c for c in ("tip_amount", "tolls_amount", "airport_fee") if c not in trips.columns]
    return trips.withColumns({c: F.lit(None).cast("double") for c in absent}) if absent else trips


def trip_enriched(cleaned: DataFrame, zones: DataFrame) -> DataFrame:
    """Cleaned trips with zones, labels, calendar and route fields, in presentation order."""
    return (
        join_zone_lookup(with_optional_money(cleaned), zones)
        .transform(X.add_business_labels)
        .transform(X.add_time_features)
        .transform(X.add_route_fields)
        .transform(S.lead_with, S.TRIP_ORDER)
    )
