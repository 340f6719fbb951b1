"""Parameterised lookups: filter, sort, limit over a named table, and bundles of them."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hourgrid.operators.business import sort_keys
from hourgrid.operators.flows import REPLAY_DRAW, numbered_replay

GetTable = Callable[[str], DataFrame]


def asked_limit(limit: int | None, default: int) -> int:
    """The limit asked for; absent and non-positive ones become the default."""
    return default if limit is None or limit <= 0 else limit


def scoped_lookup(
    table: DataFrame,
    filters: dict | None = None,
    sort: list[str] | None = None,
    limit: int | None = None,
    columns: list[str] | None = None,
) -> DataFrame:
    """Equality filters (None means no filter), sort ("-c" is descending), limit, projection."""
    for name, value in (filters or {}).items():
        if value is not None and value != "":
            table = table.where(F.col(name) == F.lit(value))
    if sort:
        table = table.orderBy(*sort_keys(sort))
    if limit:
        table = table.limit(limit)
    return table.select(*columns) if columns else table


@dataclass(frozen=True)
class Preset:
    """A lookup as data. ``filters`` maps parameter -> column; ``yearly`` replaces table and
    sort when a year is given; ``first`` is the default limit or None for no limit; ``first_needs``
    names a parameter without which the limit does not apply; ``key`` ends every sort that
    has a limit, so that the kept rows are the same on every run; ``drawn`` takes the rows of
    a limit at random, by the table's lottery, instead of the first ones, and numbers them."""

    table: str
    sort: list[str] = field(default_factory=list)
    filters: dict[str, str] = field(default_factory=dict)
    first: int | None = None
    key: list[str] = field(default_factory=list)
    yearly: tuple[str, list[str]] | None = None
    first_needs: str | None = None
    drawn: bool = False


_YEAR = {"year": "year"}
_ZONE_KEY = ["PULocationID"]
_ROUTE_KEY = ["route_key"]
_CALENDAR = {"year": "year", "month": "month", "hour": "hour"}

PRESETS: dict[str, Preset] = {
    # temporal
    "temporal_kpi": Preset("kpi_summary"),
    "temporal_yearly": Preset("yearly_summary", ["year"]),
    "temporal_daily": Preset("daily_demand", ["pickup_date"], _YEAR),
    "temporal_monthly": Preset("monthly_demand", ["year", "month"], _YEAR),
    "temporal_year_month": Preset("year_month_demand", ["year", "month"], _YEAR),
    "temporal_hourly": Preset("hourly_demand", ["hour"], _YEAR, yearly=("year_hourly_pattern", ["hour"])),
    "temporal_heatmap": Preset(
        "weekday_hour_heatmap", ["day_of_week", "hour"], _YEAR,
        yearly=("year_weekday_hour_heatmap", ["day_of_week", "hour"]),
    ),
    "temporal_borough_year_month": Preset(
        "borough_year_month", ["pickup_borough", "year", "month"],
        {"year": "year", "borough": "pickup_borough"},
    ),
    "temporal_borough_hourly": Preset(
        "borough_hourly_pattern", ["pickup_borough", "hour"], {"borough": "pickup_borough"}
    ),
    "temporal_rush_hour": Preset("rush_hour_by_year", ["year", "time_period_order"], _YEAR),
    "temporal_month_pattern": Preset("month_of_year_pattern", ["month"]),
    "temporal_day_type": Preset("weekday_weekend_hourly", ["is_weekend", "hour"], {"day_type": "day_type"}),
    "temporal_efficiency": Preset("revenue_efficiency_temporal", ["year", "month"], _YEAR),
    # spatial
    "spatial_top_zones": Preset(
        "top_zones_overall", ["-total_trips"], _YEAR, 25, _ZONE_KEY,
        yearly=("top_zones_by_year", ["zone_rank_in_year"]),
    ),
    "spatial_rank_change": Preset(
        "zone_rank_change", ["-rank_improvement", "-trip_count_change"], {}, 50, _ZONE_KEY
    ),
    "spatial_zones_by_hour": Preset(
        "top_zones_by_hour", ["hour", "zone_rank_in_hour"], {"hour": "hour"}, 10, _ZONE_KEY,
        first_needs="hour",
    ),
    # routes
    "routes_top": Preset("top_routes_overall", ["route_rank"], {}, 25, _ROUTE_KEY),
    "routes_airport": Preset("top_airport_routes", ["route_rank", "-trip_count"], {}, 25, _ROUTE_KEY),
    "routes_inter_borough": Preset(
        "top_inter_borough_routes", ["route_rank", "-trip_count"], {}, 25, _ROUTE_KEY
    ),
    "routes_matrix": Preset("route_borough_matrix", ["-total_trips", "pickup_borough", "dropoff_borough"]),
    "routes_trip_matrix": Preset("pickup_dropoff_borough_matrix", ["-trip_count", "pickup_borough", "dropoff_borough"]),
    "routes_airport_summary": Preset("airport_trip_summary", ["year", "airport_trip_type"], _YEAR),
    "routes_efficiency": Preset(
        "route_efficiency_ranking", ["-revenue_per_mile", "-trip_count"], {}, 25, _ROUTE_KEY
    ),
    "routes_tips": Preset(
        "route_tip_ranking", ["-route_tip_share", "-avg_tip_amount"], {}, 25, _ROUTE_KEY
    ),
    "routes_concentration": Preset("route_concentration", ["route_order"], {}, 500),
    # map
    "map_centroids": Preset("zone_centroids", ["LocationID"]),
    "map_dropoffs": Preset(
        "dropoff_zone_hour_features", ["-trip_count"], {**_CALENDAR, "borough": "dropoff_borough"},
        500, ["DOLocationID", "dropoff_date", "hour"],
    ),
    "map_balance": Preset(
        "zone_balance_hour", ["-total_zone_activity"],
        {**_CALENDAR, "borough": "borough", "direction": "balance_direction"},
        500, ["LocationID", "activity_date", "hour"],
    ),
    "map_flows_hour": Preset(
        "od_flow_hour", ["hour", "route_rank_in_hour"],
        {"hour": "hour", "borough": "pickup_borough"}, 500, _ROUTE_KEY,
    ),
    "map_flows_month": Preset(
        "od_flow_year_month", ["year", "month", "route_rank_in_year_month"],
        {"year": "year", "month": "month", "year_month": "year_month", "borough": "pickup_borough"},
        500, _ROUTE_KEY,
    ),
    "map_replay": Preset("map_replay_strata", ["pickup_epoch_ms"], _CALENDAR, 5000, ["replay_trip_id"], drawn=True),
    # profiles
    "profiles_zones": Preset(
        "zone_profile_summary", ["-total_trips"], {"borough": "pickup_borough"}, 300, _ZONE_KEY
    ),
    "profiles_zone": Preset("zone_profile_summary", [], {"zone": "PULocationID"}),
    "profiles_routes": Preset(
        "route_profile_summary", ["route_rank"],
        {"pickup_borough": "pickup_borough", "dropoff_borough": "dropoff_borough"}, 300,
        _ROUTE_KEY,
    ),
    "profiles_route": Preset(
        "route_profile_summary", [], {"pickup": "PULocationID", "dropoff": "DOLocationID"}
    ),
    # business
    "business_payment": Preset(
        "payment_type_summary", ["-trip_count"], _YEAR,
        yearly=("payment_type_by_year", ["-trip_count"]),
    ),
    "business_behavior": Preset("trip_behavior_by_hour", ["hour"]),
    # forecast
    "forecast_comparison": Preset("model_comparison", ["RMSE"]),
    "forecast_evaluation": Preset("model_evaluation_metrics", ["RMSE"]),
    "forecast_monthly": Preset("forecast_monthly", ["year_month"]),
    "forecast_daily": Preset("forecast_daily", ["pickup_date"]),
    "forecast_by_hour": Preset("error_by_hour", ["hour"]),
    "forecast_by_borough": Preset("error_by_borough", ["-aggregate_absolute_error"]),
    "forecast_zones": Preset(
        "zone_accuracy", ["-aggregate_absolute_error"], {}, 300, _ZONE_KEY
    ),
    "forecast_heatmap": Preset("weekday_hour_error_heatmap", ["day_of_week", "hour"]),
    "forecast_zone_hour": Preset(
        "forecast_zone_hour", ["-absolute_error"], {**_CALENDAR, "date": "pickup_date"},
        1000, ["pickup_date", "hour", "PULocationID"],
    ),
}


def resolve(name: str, limit: int | None = None, **params) -> tuple[str, dict, list[str], int | None]:
    """(table, filters, sort, limit) of a preset for the given parameters."""
    preset = PRESETS[name]
    unknown = set(params) - set(preset.filters)
    if unknown:
        raise ValueError(f"{name} has no parameter {', '.join(sorted(unknown))}")
    table, sort = preset.table, preset.sort
    filters = {preset.filters[p]: v for p, v in params.items()}
    if preset.yearly:
        if params.get("year"):
            table, sort = preset.yearly
        else:
            filters.pop("year", None)
    limited = preset.first and (preset.first_needs is None or params.get(preset.first_needs) is not None)
    count = asked_limit(limit, preset.first) if limited else None
    return table, filters, [*sort, *(preset.key if count else [])], count


def lookup(tables: GetTable, name: str, limit: int | None = None, **params) -> DataFrame:
    """Run one preset over a provider of ranked but uncut tables (``Tables.ranked.table``)."""
    table, filters, sort, count = resolve(name, limit, **params)
    if PRESETS[name].drawn:
        sample = scoped_lookup(tables(table), filters).orderBy(*REPLAY_DRAW).limit(count)
        return scoped_lookup(numbered_replay(sample), sort=sort)
    return scoped_lookup(tables(table), filters, sort, count)


def bundle(parts: dict[str, DataFrame]) -> DataFrame:
    """Tables of different layouts as one: section, position of the row, field, and its number or text.

    The parts are sorted reports of bounded size (limits, calendar cells), numbered as they
    are sorted. What several of them are built on is one exchange of the common plan.
    """
    out = None
    for section, table in parts.items():
        fields = F.array(*[
            F.struct(
                F.lit(f.name).alias("field"),
                (F.col(f.name).cast("double") if isinstance(f.dataType, T.NumericType) else F.lit(None).cast("double")).alias("number"),
                (F.lit(None).cast("string") if isinstance(f.dataType, T.NumericType) else F.col(f.name).cast("string")).alias("text"),
            )
            for f in table.schema.fields
        ])
        inside = Window.partitionBy("section").orderBy("__at")
        rows = table.withColumn("__at", F.monotonically_increasing_id()).select(F.lit(section).alias("section"), "__at", fields.alias("__f"))
        long = rows.withColumn("position", F.row_number().over(inside)).select("section", "position", F.inline("__f"))
        out = long if out is None else out.unionByName(long)
    return out


def filter_values(tables: GetTable) -> dict[str, DataFrame]:
    """Choices for filter boxes: years, boroughs, and zones once each, by name."""
    zones = (
        tables("zone_hour_features").groupBy("PULocationID")
        .agg(F.min(F.struct("pickup_zone", "pickup_borough")).alias("z"))
        .select("PULocationID", "z.*").orderBy("pickup_zone", "PULocationID")
    )
    return {
        "years": tables("yearly_summary").select("year").distinct().orderBy("year"),
        "boroughs": tables("borough_year_month").select("pickup_borough").distinct().orderBy("pickup_borough"),
        "zones": zones,
    }


def overview(tables: GetTable, year: int | None = None, zone_limit: int = 12, route_limit: int = 8) -> dict[str, DataFrame]:
    return {
        "kpi": lookup(tables, "temporal_kpi"),
        "yearly_summary": lookup(tables, "temporal_yearly"),
        "year_month_demand": lookup(tables, "temporal_year_month", year=year),
        "hourly_demand": lookup(tables, "temporal_hourly", year=year),
        "weekday_hour_heatmap": lookup(tables, "temporal_heatmap", year=year),
        "top_zones": lookup(tables, "spatial_top_zones", limit=asked_limit(zone_limit, 12), year=year),
        "top_routes": lookup(tables, "routes_top", limit=asked_limit(route_limit, 8)),
    }


def temporal_story(tables: GetTable, year: int | None = None, borough: str | None = None) -> dict[str, DataFrame]:
    return {
        "yearly_summary": lookup(tables, "temporal_yearly"),
        "year_month_demand": lookup(tables, "temporal_year_month", year=year),
        "hourly_pattern": lookup(tables, "temporal_hourly", year=year),
        "weekday_hour_heatmap": lookup(tables, "temporal_heatmap", year=year),
        "weekday_weekend_hourly": lookup(tables, "temporal_day_type"),
        "rush_hour_by_year": lookup(tables, "temporal_rush_hour", year=year),
        "borough_year_month": lookup(tables, "temporal_borough_year_month", year=year, borough=borough),
        "borough_hourly_pattern": lookup(tables, "temporal_borough_hourly", borough=borough),
        "month_of_year_pattern": lookup(tables, "temporal_month_pattern"),
        "revenue_efficiency": lookup(tables, "temporal_efficiency", year=year),
    }


def spatial_story(tables: GetTable, year: int | None = None, hour: int | None = None, zone_limit: int = 25) -> dict[str, DataFrame]:
    count = asked_limit(zone_limit, 25)
    by_hour = PRESETS["spatial_zones_by_hour"]
    return {
        "top_zones": lookup(tables, "spatial_top_zones", limit=count, year=year),
        "top_zones_by_hour": scoped_lookup(
            tables(by_hour.table), {"hour": hour}, [*by_hour.sort, *by_hour.key],
            count if hour is not None else None,
        ),
        "zone_rank_change": lookup(tables, "spatial_rank_change", limit=count),
    }


def routes_story(tables: GetTable, route_limit: int = 25) -> dict[str, DataFrame]:
    count = asked_limit(route_limit, 25)
    return {
        "top_routes": lookup(tables, "routes_top", limit=count),
        "top_airport_routes": lookup(tables, "routes_airport", limit=count),
        "top_inter_borough_routes": lookup(tables, "routes_inter_borough", limit=count),
        "route_borough_matrix": lookup(tables, "routes_matrix"),
        "pickup_dropoff_borough_matrix": lookup(tables, "routes_trip_matrix"),
        "airport_trip_summary": lookup(tables, "routes_airport_summary"),
        "route_efficiency_ranking": lookup(tables, "routes_efficiency", limit=count),
        "route_tip_ranking": lookup(tables, "routes_tips", limit=count),
    }


def business_story(tables: GetTable, year: int | None = None) -> dict[str, DataFrame]:
    return {
        "payment_type": lookup(tables, "business_payment", year=year),
        "trip_behavior_by_hour": lookup(tables, "business_behavior"),
    }


def forecast_story(tables: GetTable, zone_limit: int = 300) -> dict[str, DataFrame]:
    return {
        "model_comparison": lookup(tables, "forecast_comparison"),
        "model_evaluation_metrics": lookup(tables, "forecast_evaluation"),
        "monthly_actual_predicted": lookup(tables, "forecast_monthly"),
        "daily_actual_predicted": lookup(tables, "forecast_daily"),
        "error_by_hour": lookup(tables, "forecast_by_hour"),
        "error_by_borough": lookup(tables, "forecast_by_borough"),
        "zone_accuracy": lookup(tables, "forecast_zones", limit=asked_limit(zone_limit, 300)),
        "weekday_hour_error_heatmap": lookup(tables, "forecast_heatmap"),
    }
