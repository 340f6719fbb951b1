"""The one generic aggregation behind every table, plus shares and efficiency ratios."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hourgrid.functions import exprs as X
from hourgrid.functions import measures as M
from hourgrid.functions.measures import MeasureSet


def rollup(df: DataFrame, keys: list[str], measures: MeasureSet) -> DataFrame:
    """Group by ``keys`` (null is a group), aggregate, then add the guarded ratios.

    Sums combine map-side, so a hot key costs one row per task in the shuffle.
    """
    totals = df.groupBy(*keys).agg(*[c.alias(n) for n, c in measures.aggregates.items()])
    return totals.select("*", *[X.ratio(n, d).alias(out) for out, (n, d) in measures.ratios.items()])


def aggregate_demand(cube: DataFrame, keys: list[str]) -> DataFrame:
    return rollup(cube, keys, M.demand())


def aggregate_trips(flagged: DataFrame, keys: list[str]) -> DataFrame:
    return rollup(flagged, keys, M.business())


def aggregate_trip_metrics(trips: DataFrame, keys: list[str], active_date: str) -> DataFrame:
    return rollup(trips, keys, M.flow(active_date))


def add_partition_share(df: DataFrame, within: list[str], value: str, share: str) -> DataFrame:
    """value / sum(value) over the partition.

    For aggregated tables whose partitions are bounded by the calendar (months, hours or
    weekday-hours of a year), so the window never holds more than a few hundred rows.
    """
    return df.withColumn(share, X.ratio(value, F.sum(value).over(Window.partitionBy(*within))))


def add_revenue_efficiency(df: DataFrame) -> DataFrame:
    """Revenue per mile and per minute, trips per active zone-day."""
    return df.withColumns({
        "revenue_per_mile": X.ratio("total_revenue", "total_trip_distance"),
        "revenue_per_trip_minute": X.ratio("total_revenue", "total_trip_duration_min"),
        "trips_per_active_zone_day": X.ratio(
            "total_trips", F.col("active_days") * F.col("active_pickup_zones")
        ),
    })


def leading(ordered: DataFrame, n: int | None) -> DataFrame:
    """The first ``n`` rows, or all of them for None."""
    return ordered if n is None else ordered.limit(n)
