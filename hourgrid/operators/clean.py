"""Cleaning: projection, canonical types, row filters, de-duplication and its report."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourgrid import schema as S
from hourgrid.functions import exprs as X

WINDOW = ("2021-01-01 00:00:00", "2025-01-01 00:00:00")


def project_needed(raw: DataFrame) -> DataFrame:
    """Keep the wanted columns that exist; the capitalised airport-fee spelling is accepted."""
    if "Airport_fee" in raw.columns and "airport_fee" not in raw.columns:
        raw = raw.withColumnRenamed("Airport_fee", "airport_fee")
    return raw.select(*[c for c in S.RAW_COLUMNS if c in raw.columns])


def standardize_columns(trips: DataFrame) -> DataFrame:
    """Timestamps without zone, integer ids and passengers, double amounts, minutes.

    A time column that is already a zone-less timestamp is passed through as it is, so a
    filter on ``pickup_ts`` still reaches the Parquet scan.
    """
    typed = trips.withColumns({
        "pickup_ts": F.col(S.PICKUP_TIME).cast("timestamp_ntz"),
        "dropoff_ts": F.col(S.DROPOFF_TIME).cast("timestamp_ntz"),
        S.PU: F.col(S.PU).cast("int"),
        S.DO: F.col(S.DO).cast("int"),
        S.PASSENGERS: F.col(S.PASSENGERS).cast("int"),
        S.DISTANCE: F.col(S.DISTANCE).cast("double"),
        S.FARE: F.col(S.FARE).cast("double"),
        S.TOTAL: F.col(S.TOTAL).cast("double"),
    })
    seconds = F.unix_timestamp("dropoff_ts") - F.unix_timestamp("pickup_ts")
    return typed.withColumn(S.MINUTES, seconds / F.lit(60.0))


def time_is_valid() -> Column:
    return (
        F.col("pickup_ts").isNotNull()
        & F.col("dropoff_ts").isNotNull()
        & F.col(S.PU).isNotNull()
        & F.col(S.DO).isNotNull()
        & (F.col("dropoff_ts") > F.col("pickup_ts"))
    )


def in_window(start: str, end: str) -> Column:
    """pickup in [start, end); the bounds are typed literals, so the predicate can be pushed."""
    low, high = (F.lit(t).cast("timestamp_ntz") for t in (start, end))
    return (F.col("pickup_ts") >= low) & (F.col("pickup_ts") < high)


def numbers_are_valid() -> Column:
    return (
        (F.col(S.MINUTES) > 0)
        & (F.col(S.DISTANCE) >= 0)
        & (F.col(S.FARE) >= 0)
        & (F.col(S.TOTAL) >= 0)
        & (F.col(S.PASSENGERS).isNull() | (F.col(S.PASSENGERS) >= 0))
    )


def filter_null_time(trips: DataFrame) -> DataFrame:
    return trips.where(time_is_valid())


def filter_date_window(trips: DataFrame, start: str = WINDOW[0], end: str = WINDOW[1]) -> DataFrame:
    return trips.where(in_window(start, end))


def filter_numeric(trips: DataFrame) -> DataFrame:
    return trips.where(numbers_are_valid())


def _known_ids(zones: DataFrame, name: str) -> DataFrame:
    return zones.select(F.col("LocationID").cast("int").alias(name)).dropna()


def filter_valid_zones(trips: DataFrame, zones: DataFrame) -> DataFrame:
    """Keep trips whose two ids exist in the lookup.

    No broadcast hint: Spark broadcasts the lookup when its size is below
    ``spark.sql.autoBroadcastJoinThreshold`` and otherwise shuffles, splitting hot zones.
    """
    for side, name in ((S.PU, "__known_pu"), (S.DO, "__known_do")):
        known = _known_ids(zones, name)
        trips = trips.join(known, F.col(side) == F.col(name), "left_semi")
    return trips


def drop_duplicates(trips: DataFrame) -> DataFrame:
    """Whole-row distinct; copies fold map-side, so a hot row is one row per task."""
    return trips.dropDuplicates()


def clean_trips(
    raw: DataFrame, zones: DataFrame, start: str = WINDOW[0], end: str = WINDOW[1]
) -> DataFrame:
    """All cleaning steps in order."""
    return (
        raw.transform(project_needed)
        .transform(standardize_columns)
        .transform(filter_null_time)
        .transform(filter_date_window, start, end)
        .transform(filter_numeric)
        .transform(filter_valid_zones, zones)
        .transform(drop_duplicates)
    )


def cleaning_report(
    raw: DataFrame, zones: DataFrame, start: str = WINDOW[0], end: str = WINDOW[1]
) -> DataFrame:
    """Rows left after every cleaning step, rows it removed, and the share removed so far.

    One pass: each step is a cumulative predicate that is counted, not a job of its own.
    """
    rows = raw.transform(project_needed).transform(standardize_columns)
    kept = rows.columns
    for side, name in ((S.PU, "__known_pu"), (S.DO, "__known_do")):
        rows = rows.join(_known_ids(zones, name).distinct(), F.col(side) == F.col(name), "left")
    known = F.col("__known_pu").isNotNull() & F.col("__known_do").isNotNull()
    passed, steps = F.lit(True), [("raw", F.lit(True))]
    for name, test in (
        ("time_order", time_is_valid()),
        ("date_window", in_window(start, end)),
        ("numeric", numbers_are_valid()),
        ("valid_zones", known),
    ):
        passed = passed & F.coalesce(test, F.lit(False))
        steps.append((name, passed))
    wide = rows.agg(
        *[F.count_if(test).alias(name) for name, test in steps],
        F.count_distinct(F.when(passed, F.struct(*kept))).alias("distinct"),
    )
    names = [name for name, _ in steps] + ["distinct"]
    lines = [
        F.struct(
            F.lit(i + 1).alias("step_order"),
            F.lit(name).alias("step"),
            F.col(name).alias("row_count"),
            (F.col(names[max(i - 1, 0)]) - F.col(name)).alias("removed_rows"),
            F.when(F.col("raw") > 0, (F.col("raw") - F.col(name)) / F.col("raw")).alias(
                "removal_ratio"
            ),
        )
        for i, name in enumerate(names)
    ]
    return wide.select(F.explode(F.array(*lines)).alias("line")).select("line.*")


def sample_fraction(trips: DataFrame, fraction: float = 0.01, seed: int = 42) -> DataFrame:
    """A share of the trips for trial runs, drawn by a hash of the trip.

    So the sample does not depend on how the rows are partitioned; equal trips are drawn alike.
    """
    stamps = [F.unix_timestamp(F.col(c).cast("timestamp")).cast("string") for c in (S.PICKUP_TIME, S.DROPOFF_TIME)]
    key = F.concat_ws("|", F.lit(str(seed)), F.col(S.PU).cast("string"), F.col(S.DO).cast("string"), *stamps)
    return trips.where(X.hash_number(key) < int(fraction * 2**32))
