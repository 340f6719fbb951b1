"""Map and flow tables: dropoff cube, zone balance, origin-destination flows, replay sample."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hourgrid import schema as S
from hourgrid.functions import exprs as X
from hourgrid.operators.ordering import desc
from hourgrid.operators.rollup import aggregate_trip_metrics

HEAVY = 0.1  # fixed value: balance ratio from which a zone counts as one-sided


def dropoff_zone_hour_features(trips: DataFrame) -> DataFrame:
    """Cube by dropoff zone; date and hour come from the dropoff time."""
    timed = X.add_trip_metrics(trips).withColumns(
        {"dropoff_date": F.to_date("dropoff_ts"), "hour": F.hour("dropoff_ts")}
    )
    keys = [S.DO, *S.DROPOFF_PLACE, "dropoff_date", "hour"]
    cells = aggregate_trip_metrics(
        timed.dropna(subset=[S.DO, "dropoff_date", "hour"]), keys, "dropoff_date"
    )
    return X.add_date_fields(cells, "dropoff_date").select(
        S.DO, *S.DROPOFF_PLACE, "dropoff_date", *S.DATE_PARTS, "hour", "trip_count",
        "total_revenue", "avg_revenue_per_trip", "avg_fare_amount", "avg_trip_distance",
        "avg_trip_duration_min", "avg_speed_mph", "credit_card_share", "cash_share",
    )


def zone_balance_hour(cube: DataFrame, dropoffs: DataFrame) -> DataFrame:
    """Pickups against dropoffs per zone, date and hour; a side without trips counts as 0."""
    key = ["LocationID", "activity_date", "hour"]

    def side(table: DataFrame, zone_id: str, prefix: str) -> DataFrame:
        return table.select(
            F.col(zone_id).alias("LocationID"),
            F.col(f"{prefix}_date").alias("activity_date"),
            "hour",
            F.col(f"{prefix}_zone").alias(f"{prefix}_0"),
            F.col(f"{prefix}_borough").alias(f"{prefix}_1"),
            F.col(f"{prefix}_service_zone").alias(f"{prefix}_2"),
            F.col("trip_count").alias(f"{prefix}_trip_count"),
            F.col("total_revenue").alias(f"{prefix}_revenue"),
        )

    both = side(cube, S.PU, "pickup").join(side(dropoffs, S.DO, "dropoff"), key, "full_outer")
    filled = both.fillna(0, ["pickup_trip_count", "dropoff_trip_count"]).fillna(
        0.0, ["pickup_revenue", "dropoff_revenue"]
    )
    up, down = F.col("pickup_trip_count"), F.col("dropoff_trip_count")
    balance = F.col("balance_ratio")
    # the calendar columns of both sides derive from the joined date
    return (
        X.add_date_fields(filled, "activity_date")
        .withColumns({
            "zone": F.coalesce("pickup_0", "dropoff_0"),
            "borough": F.coalesce("pickup_1", "dropoff_1"),
            "service_zone": F.coalesce("pickup_2", "dropoff_2"),
            "total_zone_activity": up + down,
            "net_dropoffs_minus_pickups": down - up,
            "net_pickups_minus_dropoffs": up - down,
            "balance_ratio": X.ratio(down - up, up + down),
            "pickup_share": X.ratio(up, up + down),
            "dropoff_share": X.ratio(down, up + down),
        })
        .withColumn(
            "balance_direction",
            F.when(balance >= HEAVY, "dropoff_heavy")
            .when(balance <= -HEAVY, "pickup_heavy")
            .otherwise("balanced"),
        )
        .select(
            "LocationID", "zone", "borough", "service_zone", "activity_date", *S.DATE_PARTS,
            "hour", "pickup_trip_count", "dropoff_trip_count", "total_zone_activity",
            "net_dropoffs_minus_pickups", "net_pickups_minus_dropoffs", "balance_ratio",
            "pickup_share", "dropoff_share", "pickup_revenue", "dropoff_revenue",
            "balance_direction",
        )
    )


def _ranked_flows(trips: DataFrame, period: list[str], within: str, rank: str, n: int | None) -> DataFrame:
    """Flows per period with dense rank at most n (all for None); the filter becomes a group limit that
    each task applies before the shuffle to the ranking."""
    keyed = X.add_trip_metrics(trips).dropna(subset=[S.PU, S.DO])
    flows = aggregate_trip_metrics(keyed, [*period, *S.ROUTE], "pickup_date")
    window = Window.partitionBy(within).orderBy(*desc("trip_count", "total_revenue"))
    ranked = flows.withColumn(rank, F.dense_rank().over(window))
    return ranked if n is None else ranked.where(F.col(rank) <= n)


def od_flow_hour(trips: DataFrame, top_n: int | None = 500) -> DataFrame:
    flows = _ranked_flows(trips, ["hour"], "hour", "route_rank_in_hour", top_n)
    return flows.orderBy("hour", "route_rank_in_hour")


def od_flow_year_month(trips: DataFrame, top_n: int | None = 500) -> DataFrame:
    period = ["year", "month", "year_month"]
    flows = _ranked_flows(trips, period, "year_month", "route_rank_in_year_month", top_n)
    return flows.orderBy("year", "month", "route_rank_in_year_month")


_REPLAY = [
    "pickup_ts", "dropoff_ts", "pickup_epoch_ms", "dropoff_epoch_ms",
    "pickup_date", "year", "month", "year_month", "hour", S.PU, "pickup_zone",
    "pickup_borough", "pickup_lon", "pickup_lat", S.DO, "dropoff_zone", "dropoff_borough",
    "dropoff_lon", "dropoff_lat", "route_key", "route_name", S.MINUTES, S.DISTANCE, S.TOTAL,
]
_REPLAY_TIES = [S.TOTAL, S.DISTANCE, S.MINUTES]
REPLAY_ORDER = ["pickup_ts", S.PU, S.DO, *_REPLAY_TIES]
REPLAY_DRAW = ["lottery", *_REPLAY_TIES]


def _with_lottery(trips: DataFrame, seed: int) -> DataFrame:
    """Trips with both ends and the hash of seed and trip that random draws go by."""
    stamp = [F.unix_timestamp(F.col(c).cast("timestamp")) for c in ("pickup_ts", "dropoff_ts")]
    lottery = F.md5(F.concat_ws("|", F.lit(str(seed)), S.PU, S.DO, *stamp))
    return trips.dropna(subset=[S.PU, S.DO, "pickup_ts", "dropoff_ts"]).withColumn("lottery", lottery)


def _placed(trips: DataFrame, centroids: DataFrame) -> DataFrame:
    """Coordinates of both ends and epochs; trips from or to a zone without a centroid go."""
    for zone_id, prefix in ((S.PU, "pickup"), (S.DO, "dropoff")):
        spots = centroids.select(
            F.col("LocationID").alias(f"__{prefix}"),
            F.col("centroid_lon").alias(f"{prefix}_lon"),
            F.col("centroid_lat").alias(f"{prefix}_lat"),
        )
        trips = trips.join(spots, F.col(zone_id) == F.col(f"__{prefix}"))
    return trips.withColumns({
        "pickup_epoch_ms": F.unix_timestamp("pickup_ts") * 1000,
        "dropoff_epoch_ms": F.unix_timestamp("dropoff_ts") * 1000,
    })


def numbered_replay(sampled: DataFrame) -> DataFrame:
    """Replay numbers over a drawn sample, in order of time."""
    number = F.row_number().over(Window.partitionBy().orderBy(*REPLAY_ORDER))
    return sampled.withColumn("replay_trip_id", number).select("replay_trip_id", *_REPLAY)


def map_replay_sample(
    trips: DataFrame, centroids: DataFrame, sample_size: int = 5000, seed: int = 42
) -> DataFrame:
    """A repeatable random sample of trips with coordinates, epochs and a replay number.

    The random order is a hash of the seed and the trip, so it does not depend on how the
    rows are partitioned; the limit runs as a top-k per task and one small merge. What
    follows handles at most ``sample_size`` rows.
    """
    sampled = _with_lottery(trips, seed).orderBy(*REPLAY_DRAW).limit(sample_size)
    return numbered_replay(_placed(sampled, centroids))


def map_replay_strata(
    trips: DataFrame, centroids: DataFrame, sample_size: int | None = 5000, seed: int = 42
) -> DataFrame:
    """The ``sample_size`` trips of smallest hash for every year, month and hour (all for None).

    The n smallest of any union of strata are among the n smallest of each, so every calendar
    filter draws its own whole sample of up to ``sample_size`` trips from this table. The
    limit inside a stratum folds in the tasks, below the shuffle.
    """
    drawn = _with_lottery(trips, seed)
    if sample_size is not None:
        inside = Window.partitionBy("year", "month", "hour").orderBy(*REPLAY_DRAW)
        drawn = drawn.withColumn("__n", F.row_number().over(inside)).where(F.col("__n") <= sample_size).drop("__n")
    return _placed(drawn, centroids).select("lottery", *_REPLAY)
