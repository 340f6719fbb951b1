"""Views derived from served tables: year scope, top lists, forecast series, flow filters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hourgrid.operators.rollup import leading

NOT_NAMED = "N/A"  # fixed value


def primary_years(daily: DataFrame, min_days: int = 30) -> DataFrame:
    """Years with at least ``min_days`` daily rows; every year when none has."""
    years = daily.where(F.col("year").isNotNull()).groupBy("year").agg(F.count(F.lit(1)).alias("n"))
    everywhere = Window.partitionBy()  # one row per year
    full = F.col("n") >= min_days
    marked = years.withColumns({"full": full, "any": F.bool_or(full).over(everywhere)})
    return marked.where(F.col("full") | ~F.col("any")).select("year").orderBy("year")


def scoped_daily(daily: DataFrame, min_days: int = 30) -> DataFrame:
    """Daily rows of the primary years."""
    return daily.join(primary_years(daily, min_days), "year", "left_semi")


def scoped_daily_kpis(daily: DataFrame, min_days: int = 30) -> DataFrame:
    """Headline numbers over the scoped days."""
    totals = scoped_daily(daily, min_days).agg(
        F.coalesce(F.sum("total_trips"), F.lit(0)).alias("total_trips"),
        F.coalesce(F.sum("total_revenue"), F.lit(0.0)).alias("total_revenue"),
        F.count(F.lit(1)).alias("active_days"),
        F.min("pickup_date").alias("start_date"),
        F.max("pickup_date").alias("end_date"),
    )
    days = F.greatest("active_days", F.lit(1))
    return totals.withColumns({
        "avg_revenue_per_day": F.col("total_revenue") / days,
        "avg_trips_per_day": F.col("total_trips") / days,
    })


def scoped_monthly(monthly: DataFrame, daily: DataFrame, min_days: int = 30) -> DataFrame:
    """Monthly rows whose month occurs in the scoped days."""
    months = scoped_daily(daily, min_days).select("year", "month").distinct()
    return monthly.join(months, ["year", "month"], "left_semi")


def top_named_zones(zones: DataFrame, top_n: int = 12) -> DataFrame:
    named = zones.where((F.col("pickup_zone") != NOT_NAMED) & (F.col("pickup_zone") != ""))
    return named.orderBy(F.desc("total_trips"), "PULocationID").limit(top_n)


def top_boroughs_hourly(hourly: DataFrame, top_n: int = 5) -> DataFrame:
    """Hourly rows of the boroughs with most trips; unknown boroughs are left out."""
    rows = hourly.where(
        ~F.col("pickup_borough").isin("", "Unknown")
        & F.col("hour").isNotNull() & F.col("total_trips").isNotNull()
    )
    busiest = (
        rows.groupBy("pickup_borough").agg(F.sum("total_trips").alias("n"))
        .orderBy(F.desc("n"), "pickup_borough").limit(top_n)
    )
    return rows.join(busiest, "pickup_borough", "left_semi").orderBy("pickup_borough", "hour")


def _any_of(table: DataFrame, *names: str) -> Column:
    present = [F.col(n) for n in names if n in table.columns]
    return F.coalesce(*present) if present else F.lit(None)


def _text_of(table: DataFrame, *names: str) -> Column:
    present = [F.nullif(F.col(n), F.lit("")) for n in names if n in table.columns]
    return F.coalesce(*present) if present else F.lit(None)


def busiest_zone_forecast(forecast: DataFrame, rows: int | None = None) -> DataFrame:
    """Forecast series of the zone with the largest actual (else predicted) sum.

    The whole series, or its first ``rows``. Alternative column names of actual, predicted and zone are accepted.
    """
    hour = F.coalesce(_any_of(forecast, "hour").cast("int"), F.lit(0))
    day = F.col("pickup_date").cast("date")
    series = forecast.select(
        F.coalesce(_text_of(forecast, "pickup_zone", "zone"), F.lit("All zones")).alias("zone"),
        F.make_timestamp_ntz(F.year(day), F.month(day), F.dayofmonth(day), hour, F.lit(0), F.lit(0)).alias("date_time"),
        _any_of(forecast, "actual_trip_count", "actual", "trip_count").cast("double").alias("actual_value"),
        _any_of(forecast, "predicted_trip_count", "predicted", "prediction").cast("double").alias("predicted_value"),
    ).where(F.col("date_time").isNotNull() & F.col("predicted_value").isNotNull())
    counted = F.coalesce(F.nullif("actual_value", F.lit(0.0)), "predicted_value")
    busiest = (
        series.groupBy("zone").agg(F.sum(counted).alias("n")).orderBy(F.desc("n"), "zone").limit(1)
    )
    ordered = series.join(busiest, "zone", "left_semi").orderBy("date_time", "actual_value", "predicted_value")
    return leading(ordered, rows)


def named_routes_top(routes: DataFrame, top_n: int = 10) -> DataFrame:
    named = routes.where(~F.col("route_name").isin("", f"{NOT_NAMED} -> {NOT_NAMED}"))
    return named.orderBy("route_rank", "route_key").limit(top_n)


def actual_predicted_long(table: DataFrame, key: str) -> DataFrame:
    """Wide to long: one row per key and series."""
    actual = F.coalesce(
        *[F.nullif(F.col(c).cast("double"), F.lit(0.0)) for c in ("trip_count", "actual_trip_count") if c in table.columns],
        F.lit(0.0),
    )
    predicted = F.coalesce(F.col("predicted_trip_count").cast("double"), F.lit(0.0))
    return table.select(key, actual.alias("Actual"), predicted.alias("Predicted")).unpivot(
        key, ["Actual", "Predicted"], "series", "value"
    )


def forecast_bias(monthly: DataFrame) -> DataFrame:
    """Total actual against predicted, and which way the forecast leans."""
    totals = monthly.agg(
        F.coalesce(F.sum("trip_count"), F.lit(0)).cast("double").alias("actual"),
        F.coalesce(F.sum("predicted_trip_count"), F.lit(0.0)).alias("predicted"),
    ).withColumn("error", F.col("actual") - F.col("predicted"))
    lean = F.when(F.col("error") >= 0, "under predicted").otherwise("over predicted")
    return totals.withColumn("bias", lean)


def flows_touching_borough(flows: DataFrame, borough: str | None) -> DataFrame:
    """Flows that start or end in the borough; every flow when none is chosen."""
    if not borough:
        return flows
    return flows.where((F.col("pickup_borough") == borough) | (F.col("dropoff_borough") == borough))
