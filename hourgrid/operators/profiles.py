"""Zone and route profiles with their peak hour and top destination."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourgrid import schema as S
from hourgrid.functions import exprs as X
from hourgrid.functions import measures as M
from hourgrid.operators.ordering import dense_rank_all, desc
from hourgrid.operators.rollup import rollup


def _peak_hour(hours: DataFrame, key: str) -> DataFrame:
    """Hour with most trips per key, the smaller hour on a tie.

    An aggregate over (count, -hour) pairs instead of a window: it combines map-side and
    never sorts a key's rows.
    """
    best = F.max(F.struct(F.col("n"), (-F.col("hour")).alias("h")))
    return hours.groupBy(key).agg(best.alias("b")).select(
        key, (-F.col("b.h")).alias("peak_hour"), F.col("b.n").alias("peak_hour_trip_count")
    )


def zone_peak_hour(cube: DataFrame) -> DataFrame:
    return _peak_hour(cube.groupBy(S.PU, "hour").agg(F.sum("trip_count").alias("n")), S.PU)


def route_peak_hour(trips: DataFrame) -> DataFrame:
    hours = trips.groupBy("route_key", "hour").agg(F.count(F.lit(1)).alias("n"))
    return _peak_hour(hours, "route_key")


def zone_top_destination(trips: DataFrame) -> DataFrame:
    """Dropoff with most trips per pickup zone; the smaller id on a tie."""
    pairs = (
        trips.dropna(subset=[S.PU, S.DO])
        .groupBy(S.PU, S.DO, "dropoff_zone", "dropoff_borough")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    best = F.max_by(
        F.struct(S.DO, "dropoff_zone", "dropoff_borough", "n"),
        F.struct(F.col("n"), (-F.col(S.DO)).alias("id")),
    )
    return pairs.groupBy(S.PU).agg(best.alias("b")).select(
        S.PU,
        F.col(f"b.{S.DO}").alias("top_dropoff_location_id"),
        F.col("b.dropoff_zone").alias("top_dropoff_zone"),
        F.col("b.dropoff_borough").alias("top_dropoff_borough"),
        F.col("b.n").alias("top_dropoff_trip_count"),
    )


def zone_profile_summary(cube: DataFrame, trips: DataFrame) -> DataFrame:
    return (
        rollup(cube, [S.PU, *S.PICKUP_PLACE], M.zone_profile())
        .join(zone_peak_hour(cube), S.PU, "left")
        .join(zone_top_destination(trips), S.PU, "left")
        .orderBy(*desc("total_trips"), S.PU)
    )


def route_profile_summary(trips: DataFrame, top_n: int | None = 1000) -> DataFrame:
    """Profiles of the busiest routes (dense rank at most ``top_n``, all for None; ties stay).

    Ranked over key ranges, so even a rank shared by most routes is spread over tasks.
    """
    measured = X.add_trip_metrics(trips).dropna(subset=["route_key"])
    ranked = dense_rank_all(
        rollup(measured, S.ROUTE, M.route_profile()), ["trip_count", "total_revenue"],
        "route_rank", tie=("route_key",),
    )
    leading = ranked if top_n is None else ranked.where(F.col("route_rank") <= top_n)
    return leading.join(route_peak_hour(measured), "route_key", "left").orderBy("route_rank")
