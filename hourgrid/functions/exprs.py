"""Column expressions shared by the operators; all built-in, all code-generated."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourgrid import schema as S


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ratio(num: str | Column, den: str | Column) -> Column:
    """num / den, null unless den > 0 (never raises under ANSI mode)."""
    return F.when(col(den) > 0, col(num) / col(den))


def flag(condition: Column) -> Column:
    """1 when the condition holds, 0 when it is false or unknown."""
    return F.when(condition, 1).otherwise(0)


def label(codes: dict, code: Column) -> Column:
    """Text for a code, "Unknown" for codes (or nulls) outside the table."""
    pairs = [F.lit(x) for item in codes.items() for x in item]
    return F.coalesce(F.create_map(*pairs)[code], F.lit(S.UNKNOWN))


def bucket(value: str, steps) -> Column:
    """Label of the first step whose upper edge lies above the value; else the open last step."""
    out = F
    for edge, name in steps:
        if edge is None:
            return out.otherwise(name)
        out = out.when(F.col(value) < edge, name)
    raise ValueError("the last step must be open (edge None)")


def date_parts(source: str) -> dict[str, Column]:
    """Calendar columns of a date or zone-less timestamp; Sunday is day 1.

    Month text and day name avoid ``date_format``, which would convert every row to a zoned
    timestamp first (the text form starts with yyyy-MM for the years 0 to 9999).
    """
    d = F.col(source)
    return {
        "year": F.year(d),
        "month": F.month(d),
        "day": F.dayofmonth(d),
        "year_month": F.substring(d.cast("string"), 1, 7),
        "day_of_week": F.dayofweek(d),
        "weekday_name": F.dayname(d),
        "is_weekend": flag(F.dayofweek(d).isin(1, 7)),
    }


def speed_mph() -> Column:
    return F.when(F.col(S.MINUTES) > 0, F.col(S.DISTANCE) / (F.col(S.MINUTES) / 60.0))


def is_credit() -> Column:
    return flag(F.col("payment_type") == 1)


def is_cash() -> Column:
    return flag(F.col("payment_type") == 2)


def at_airport(side: str) -> Column:
    return (F.col(f"{side}_service_zone") == S.AIRPORT_SERVICE_ZONE) | (
        F.col(f"{side}_borough") == S.AIRPORT_BOROUGH
    )


def day_type() -> Column:
    return F.when(F.col("is_weekend") == 1, "weekend").otherwise("weekday")


def add_date_fields(df: DataFrame, source: str) -> DataFrame:
    """Year, month, day, year-month text, weekday and weekend flag of a date column."""
    return df.withColumns(date_parts(source))


def add_time_features(df: DataFrame, source: str = "pickup_ts") -> DataFrame:
    """Pickup date, hour and calendar columns of the pickup time."""
    return df.withColumns(
        {"pickup_date": F.to_date(source), "hour": F.hour(source), **date_parts(source)}
    )


def add_business_labels(df: DataFrame) -> DataFrame:
    """Text for vendor, rate, payment and store-and-forward codes."""
    return df.withColumns({
        "vendor_name": label(S.VENDORS, F.col("VendorID").cast("int")),
        "ratecode_desc": label(S.RATE_CODES, F.col("RatecodeID").cast("int")),
        "payment_type_desc": label(S.PAYMENT_TYPES, F.col("payment_type").cast("int")),
        "store_and_fwd_desc": label(S.STORE_FLAGS, F.col("store_and_fwd_flag")),
    })


def add_route_fields(df: DataFrame) -> DataFrame:
    """Route key from the two ids and route name from the two zone names."""
    return df.withColumns({
        "route_key": F.concat_ws("->", F.col(S.PU).cast("string"), F.col(S.DO).cast("string")),
        "route_name": F.concat_ws(" -> ", "pickup_zone", "dropoff_zone"),
    })


def add_time_period(df: DataFrame) -> DataFrame:
    """Ordered period of the day from the hour; anything unmatched counts as the last period."""
    order, name = F, F
    for first, last, rank, text in S.DAY_PERIODS[:-1]:
        order = order.when(F.col("hour").between(first, last), rank)
        name = name.when(F.col("hour").between(first, last), text)
    rank, text = S.DAY_PERIODS[-1][2:]
    return df.withColumns(
        {"time_period_order": order.otherwise(rank), "time_period": name.otherwise(text)}
    )


def add_trip_metrics(df: DataFrame) -> DataFrame:
    """Speed, tip share of the total, credit and cash flags."""
    return df.withColumns({
        "trip_speed_mph": speed_mph(),
        "tip_share_of_total": ratio("tip_amount", S.TOTAL),
        "is_credit_card": is_credit(),
        "is_cash": is_cash(),
    })


def add_trip_flags(df: DataFrame) -> DataFrame:
    """Per-trip ratios, airport and borough flags, and the three buckets.

    ``fare_per_mile`` and ``fare_bucket`` use the total amount, as their consumers expect.
    """
    start, end = at_airport("pickup"), at_airport("dropoff")
    return df.withColumns({
        "trip_speed_mph": speed_mph(),
        "tip_share_of_total": ratio("tip_amount", S.TOTAL),
        "fare_per_mile": ratio(S.TOTAL, S.DISTANCE),
        "is_inter_borough": flag(F.col("pickup_borough") != F.col("dropoff_borough")),
        "is_pickup_airport": flag(start),
        "is_dropoff_airport": flag(end),
        "airport_trip_type": F.when(start & end, "airport_to_airport")
        .when(start, "airport_pickup")
        .when(end, "airport_dropoff")
        .otherwise("non_airport"),
        "distance_bucket": bucket(S.DISTANCE, S.DISTANCE_BUCKETS),
        "duration_bucket": bucket(S.MINUTES, S.DURATION_BUCKETS),
        "fare_bucket": bucket(S.TOTAL, S.FARE_BUCKETS),
    })


def hash_number(text: Column) -> Column:
    """A number below 2 ** 32 from a text, the same in every engine: the first digits of its md5."""
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("bigint")
