"""Registered queries: every operator over the fixture, and its lookups."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hourgrid import schema as S
from hourgrid.functions import exprs as X
from hourgrid.operators import clean, enrich, features, flows, forecast, lookups, quality, rollup, views
from hourgrid.plans import oracle as O
from hourgrid.plans.catalog import Params, Tables, builders
from hourgrid.session import scratch_path
from hourgrid.sources import fixture as FX
from hourgrid.sources import sinks, trips as SRC
from hourgrid.streaming import demand as ST

REPLAY_SECONDS = 4 * 86_400  # of event time in a replayed file

Query = Callable[[SparkSession, str], DataFrame]

FIXTURE_PARAMS = Params(
    window=O.WINDOW, zones_top=O.ZONES_TOP, zones_overall=O.ZONES_OVERALL,
    routes_top=O.ROUTES_TOP, min_route_trips=O.MIN_TRIPS, rank_change=O.RANK_CHANGE,
    flows_top=O.FLOWS_TOP, replay_size=O.REPLAY, replay_seed=O.SEED,
    profiles_top=O.PROFILES_TOP, full=O.FULL, train=O.TRAIN, evaluation=O.EVALUATION,
)


def tables(spark: SparkSession, sf_dir: str) -> Tables:
    return Tables(
        {
            "raw": lambda: FX.raw_trips(spark, sf_dir),
            "zones": lambda: FX.zones(spark, sf_dir),
            "area_features": lambda: SRC.features_of(FX.area_documents(FX.customer_areas(spark, sf_dir))),
            "zone_features": lambda: SRC.features_of(FX.area_documents(FX.zone_areas(spark, sf_dir))),
        },
        FIXTURE_PARAMS,
    )


def rounded(df: DataFrame) -> DataFrame:
    """Doubles to six digits after a nudge off the half-way points, as in the oracle.

    Floating sums depend on the order of addition; the operators themselves do not round.
    """
    return df.select(*[
        F.round(F.col(f.name) + F.lit(O.NUDGE), 6).alias(f.name) if isinstance(f.dataType, T.DoubleType) else F.col(f.name)
        for f in df.schema.fields
    ])


# --- sources: write the drifting files, CSVs and GeoJSON first, then scan them ----------------

def scan_trips_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_path(spark, "trips")
    raw = FX.raw_trips(spark, sf_dir)
    early = F.col(S.PICKUP_TIME) < F.lit("1998-01-01 00:00:00").cast("timestamp_ntz")
    drifted = raw.withColumns({
        S.PASSENGERS: F.col(S.PASSENGERS).cast("bigint"),
        "RatecodeID": F.col("RatecodeID").cast("bigint"),
        S.PU: F.col(S.PU).cast("bigint"),
    }).withColumnRenamed("airport_fee", "Airport_fee")
    raw.where(early).write.parquet(f"{folder}/a")
    drifted.where(~early).write.parquet(f"{folder}/b")
    return SRC.load_trips(spark, folder).select(*O.RAW)


def scan_zone_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "zones")
    sinks.write_table_csv(FX.zones(spark, sf_dir), path, files=1)
    return SRC.scan_zone_lookup(spark, path)


def scan_feature_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "cube")
    sinks.write_cube_parquet(tables(spark, sf_dir).cube, path)
    return SRC.scan_feature_table(spark, path, S.DEMAND_INPUT, "zone_hour_features").select(*S.CUBE_ORDER)


def scan_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "centroids")
    sinks.write_table_csv(tables(spark, sf_dir).table("zone_centroids"), path)
    return SRC.scan_centroids(spark, path)


def scan_geojson(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "areas")
    FX.area_documents(FX.customer_areas(spark, sf_dir)).write.text(path)
    return SRC.scan_geojson(spark, path)


def typed_csv_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily demand through CSV without a declared schema; ``code`` is a number but for the last day."""
    path = scratch_path(spark, "daily")
    daily = tables(spark, sf_dir).table("daily_demand")
    last = F.col("pickup_date") == daily.agg(F.max("pickup_date")).scalar()
    sinks.write_table_csv(daily.withColumns({
        "code": F.when(last, F.lit("last")).otherwise(F.col("day").cast("string")),
        "nothing": F.lit(None).cast("string"),
    }), path)
    return SRC.inferred_csv(spark, path)


def publish_with_provenance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zones published twice, the second time whole; read back with their provenance."""
    target = scratch_path(spark, "published")
    zones = FX.zones(spark, sf_dir)
    sinks.publish(zones.where("LocationID < 10"), target, "zones", "nation,region", "first")
    sinks.publish(zones, target, "zones", "nation,region", "second")
    back = sinks.read_published(spark, target)
    return back.withColumn("imported", F.col("_imported_at").isNotNull()).drop("_imported_at")


# --- streaming -------------------------------------------------------------------------------

def _event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    # a glob, so that the table may be one file or a folder of parts
    return FX.event_trips(ST.trip_stream(spark, f"{sf_dir}/events.parquet*", FX.EVENT_SCHEMA))


def stream_zone_demand(spark: SparkSession, sf_dir: str) -> DataFrame:
    target, log = scratch_path(spark, "demand"), scratch_path(spark, "demand-log")
    ST.start_zone_demand(_event_stream(spark, sf_dir), target, log).awaitTermination()
    return spark.read.parquet(target)


def stream_zone_demand_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same stream from many files whose times are not in order."""
    source, target, log = (scratch_path(spark, name) for name in ("events", "demand", "demand-log"))
    FX.read(spark, sf_dir, "events").repartition(120, "event_id").write.parquet(source)
    stream = FX.event_trips(ST.trip_stream(spark, source, FX.EVENT_SCHEMA))
    ST.start_zone_demand(stream, target, log).awaitTermination()
    return spark.read.parquet(target)


def stream_hotspots(spark: SparkSession, sf_dir: str) -> DataFrame:
    target, log = scratch_path(spark, "hotspots"), scratch_path(spark, "hotspots-log")
    ST.start_hotspots(_event_stream(spark, sf_dir), target, log).awaitTermination()
    return spark.read.parquet(target).drop("batch")


def batch_speed_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    batch = ST.zone_demand(FX.event_trips(FX.read(spark, sf_dir, "events")))
    return ST.batch_speed_merge(batch, stream_zone_demand(spark, sf_dir), O.CUTOFF)


def batch_speed_live(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batch windows before the cut-off, live ones from it on, the last open hours included."""
    target, log = scratch_path(spark, "live"), scratch_path(spark, "live-log")
    ST.start_live_demand(_event_stream(spark, sf_dir), target, log).awaitTermination()
    batch = ST.zone_demand(FX.event_trips(FX.read(spark, sf_dir, "events")))
    return ST.batch_speed_merge(batch, ST.live_demand(spark, target), O.CUTOFF)


def _replayed(spark: SparkSession, sf_dir: str, start) -> str:
    """The folder that ``start`` filled from a replay of the events, in two runs of both."""
    staged, source, target, log = (scratch_path(spark, f"replay-{n}") for n in ("staged", "files", "target", "log"))
    events = FX.event_trips(FX.read(spark, sf_dir, "events"))
    ST.stage_replay(events, staged, seconds=REPLAY_SECONDS)
    for most in (3, None):
        ST.replay(spark, staged, source, most=most)
        stream = ST.trip_stream(spark, source, events.schema, per_batch=1)
        start(stream, target, log).awaitTermination()
    return target


def stream_replay_demand(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(_replayed(spark, sf_dir, ST.start_zone_demand))


def stream_replay_hotspots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(_replayed(spark, sf_dir, ST.start_hotspots)).drop("batch")


# --- models ----------------------------------------------------------------------------------

def feature_pipeline(t: Tables) -> DataFrame:
    """The feature vector of every training row: one-hot digits, then a column a scaled number."""
    framed = t.with_frame(scratch_path(t.zones.sparkSession, "features"))
    ready = forecast.feature_pipeline(framed.train).withColumn("v", vector_to_array("features"))
    digits = F.size("v") - len(forecast.NUMERIC)
    return ready.select(
        F.col(S.PU).alias("zone"), F.col("pickup_date").alias("date"), F.col("hour").alias("at_hour"),
        F.array_join(F.transform(F.slice("v", F.lit(1), digits), lambda x: x.cast("int").cast("string")), ",").alias("one_hot"),
        *[F.get("v", digits + i).alias(f"{name}_scaled") for i, name in enumerate(forecast.NUMERIC)],
    )


def contradicting(cube: DataFrame) -> DataFrame:
    """The cube with a wrong year in the rows of one zone and a wrong month in those of another."""
    return cube.withColumns({
        "year": F.when(F.col(S.PU) == 3, F.col("year") + 1).otherwise(F.col("year")),
        "month": F.when(F.col(S.PU) == 5, 13 - F.col("month")).otherwise(F.col("month")),
    })


_TRAINED: dict[tuple[str, str], str] = {}


def model_folder(spark: SparkSession, sf_dir: str) -> str:
    """The folder of the trained models; the first query of an application that asks for it trains them."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _TRAINED:
        folder = scratch_path(spark, "models")
        tables(spark, sf_dir).trained(folder)
        _TRAINED[key] = folder
    return _TRAINED[key]


def _trained(name: str) -> Query:
    """A table over the predictions of the trained models."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return tables(spark, sf_dir).with_models(model_folder(spark, sf_dir)).table(name)

    return run


def train_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metrics of the trained models on the validation rows."""
    t = tables(spark, sf_dir).with_models(model_folder(spark, sf_dir))
    return forecast.model_metrics(t.validation)


def trained_reload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Validation rows of each model, and those that the loaded model predicts otherwise than the fitted one."""
    folder = model_folder(spark, sf_dir)
    # from the frame of the fit: averages rolled up anew differ in their last digits, and then predictions do
    return forecast.reload_report(tables(spark, sf_dir).from_frame(folder).train, folder)


def trained_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What of the best model's table by borough does not depend on the model, and whether its sums agree."""
    table = _trained("error_by_borough")(spark, sf_dir)
    near = F.abs(F.col("aggregate_error") - F.col("mean_error") * F.col("records")) <= 1e-6 * (F.col("total_absolute_error") + 1)
    return table.select(
        "pickup_borough", "records", "actual_trip_count",
        (near & (F.col("rmse") >= F.col("mae") - 1e-9) & (F.abs("mean_error") <= F.col("mae") + 1e-9)).alias("adds_up"),
    )


def _with_linear(t: Tables) -> Tables:
    """The tables with one trained model, least squares on the rolling mean; the frame is written once."""
    framed = t.with_frame(scratch_path(t.zones.sparkSession, "linear"))
    fit = forecast.train_validation_split(framed.train).where("part = 'fit'")
    models = {"linear": forecast.one_feature_model(fit, "rolling_24h_avg_trip_count")}
    framed.sources["models"] = lambda: models
    return framed


def linear_evaluation(t: Tables) -> DataFrame:
    """The trained model against the lag columns, on the evaluation rows."""
    linear = _with_linear(t)
    both = forecast.baseline_predictions(linear.evaluation).unionByName(linear.scored)
    return forecast.model_metrics(both)


# --- lookups ---------------------------------------------------------------------------------

LOOKUPS: dict[str, tuple[str, dict, int | None]] = {
    "lk_temporal": ("temporal_hourly", {"year": 1998}, None),
    "lk_temporal_kpi": ("temporal_kpi", {}, None),
    "lk_temporal_yearly": ("temporal_yearly", {}, None),
    "lk_temporal_daily": ("temporal_daily", {"year": 1999}, None),
    "lk_temporal_monthly": ("temporal_monthly", {"year": 1997}, None),
    "lk_temporal_year_month": ("temporal_year_month", {"year": 1996}, None),
    "lk_temporal_heatmap": ("temporal_heatmap", {"year": 2000}, None),
    "lk_temporal_borough_year_month": ("temporal_borough_year_month", {"year": 1998, "borough": "ASIA"}, None),
    "lk_temporal_borough_hourly": ("temporal_borough_hourly", {"borough": "EUROPE"}, None),
    "lk_temporal_rush_hour": ("temporal_rush_hour", {"year": 1997}, None),
    "lk_temporal_month_pattern": ("temporal_month_pattern", {}, None),
    "lk_temporal_day_type": ("temporal_day_type", {"day_type": "weekend"}, None),
    "lk_temporal_efficiency": ("temporal_efficiency", {"year": 1999}, None),
    "lk_spatial": ("spatial_top_zones", {"year": 1998}, 2),
    "lk_spatial_overall": ("spatial_top_zones", {}, 5),
    "lk_spatial_rank_change": ("spatial_rank_change", {}, None),
    "lk_spatial_zones_by_hour": ("spatial_zones_by_hour", {"hour": 8}, None),
    "lk_routes": ("routes_top", {}, 7),
    "lk_routes_all": ("routes_top", {}, 5000),
    "lk_routes_airport": ("routes_airport", {}, 5),
    "lk_routes_inter_borough": ("routes_inter_borough", {}, None),
    "lk_routes_matrix": ("routes_matrix", {}, None),
    "lk_routes_trip_matrix": ("routes_trip_matrix", {}, None),
    "lk_routes_airport_summary": ("routes_airport_summary", {"year": 1998}, None),
    "lk_routes_efficiency": ("routes_efficiency", {}, 5),
    "lk_routes_tips": ("routes_tips", {}, 5),
    "lk_routes_concentration": ("routes_concentration", {}, 100),
    "lk_map": ("map_balance", {"year": 1998, "hour": 9, "direction": "pickup_heavy"}, None),
    "lk_map_centroids": ("map_centroids", {}, None),
    "lk_map_dropoffs": ("map_dropoffs", {"month": 5, "borough": "ASIA"}, 100),
    "lk_map_flows_hour": ("map_flows_hour", {"hour": 17, "borough": "AMERICA"}, None),
    "lk_map_flows_month": ("map_flows_month", {"year_month": "1999-02"}, None),
    "lk_map_replay": ("map_replay", {"year": 1997}, 20),
    "lk_profiles": ("profiles_zones", {"borough": "AFRICA"}, None),
    "lk_profiles_zone": ("profiles_zone", {"zone": 7}, None),
    "lk_profiles_routes": ("profiles_routes", {"pickup_borough": "ASIA", "dropoff_borough": "EUROPE"}, None),
    "lk_profiles_route": ("profiles_route", {"pickup": 19, "dropoff": 18}, None),
    "lk_business": ("business_payment", {"year": 1999}, None),
    "lk_business_all": ("business_payment", {}, None),
    "lk_business_behavior": ("business_behavior", {}, None),
    "lk_forecast": ("forecast_zone_hour", {"month": 6, "hour": 12}, 50),
    "lk_forecast_zones": ("forecast_zones", {}, 5),
    "lk_forecast_evaluation": ("forecast_evaluation", {}, None),
    "lk_forecast_comparison": ("forecast_comparison", {}, None),
    "lk_forecast_monthly": ("forecast_monthly", {}, None),
    "lk_forecast_daily": ("forecast_daily", {}, None),
    "lk_forecast_by_hour": ("forecast_by_hour", {}, None),
    "lk_forecast_heatmap": ("forecast_heatmap", {}, None),
    "lk_forecast_by_borough": ("forecast_by_borough", {}, None),
}


def lk_filters(t: Tables) -> DataFrame:
    """The three choice lists in one long table."""
    parts = lookups.filter_values(t.table)
    empty = F.lit(None)

    def line(df: DataFrame, kind: str, zone, name: str, borough) -> DataFrame:
        return df.select(
            F.lit(kind).alias("kind"), zone.cast("int").alias("zone_id"),
            F.col(name).cast("string").alias("name"), borough.cast("string").alias("borough"),
        )

    return (
        line(parts["years"], "year", empty, "year", empty)
        .unionByName(line(parts["boroughs"], "borough", empty, "pickup_borough", empty))
        .unionByName(line(parts["zones"], "zone", F.col(S.PU), "pickup_zone", F.col("pickup_borough")))
    )


STORIES: dict[str, Callable] = {
    "overview": lambda table: lookups.overview(table, year=1998, zone_limit=5, route_limit=4),
    "temporal": lambda table: lookups.temporal_story(table, borough="ASIA"),
    "spatial": lambda table: lookups.spatial_story(table, year=1997, hour=8, zone_limit=6),
    "routes": lambda table: lookups.routes_story(table, route_limit=6),
    "business": lambda table: lookups.business_story(table, year=1999),
    "forecast": lambda table: lookups.forecast_story(table, zone_limit=7),
}


# --- registry --------------------------------------------------------------------------------

def _over_tables() -> dict[str, Callable[[Tables], DataFrame]]:
    """Queries over the stage tables beyond the named analytic ones."""

    def typed(t: Tables) -> DataFrame:
        return clean.standardize_columns(clean.project_needed(t.raw))

    def daily(t: Tables) -> DataFrame:
        return t.table("daily_demand")

    return {
        "sample_extract": lambda t: features.sample_extract(
            t.cube, features.SAMPLE_ORDERS["zone_hour_features"] + [S.PU]
        ),
        "normalize_schema": lambda t: SRC.normalize_schema(t.raw),
        "project_needed": lambda t: clean.project_needed(t.raw),
        "standardize_columns": typed,
        "filter_null_time": lambda t: clean.filter_null_time(typed(t)),
        "filter_date_window": lambda t: clean.filter_date_window(typed(t), *t.params.window),
        "filter_numeric": lambda t: clean.filter_numeric(typed(t)),
        "filter_valid_zones": lambda t: clean.filter_valid_zones(typed(t), t.zones),
        "drop_duplicates": lambda t: clean.drop_duplicates(typed(t)),
        "cleaning_report": lambda t: clean.cleaning_report(t.raw, t.zones, *t.params.window),
        "sample_fraction": lambda t: clean.sample_fraction(t.raw),
        "join_zone_lookup": lambda t: enrich.join_zone_lookup(t.cleaned, t.zones),
        "add_time_features": lambda t: X.add_time_features(t.cleaned),
        "add_business_labels": lambda t: X.add_business_labels(t.cleaned),
        "add_route_fields": lambda t: X.add_route_fields(enrich.join_zone_lookup(t.cleaned, t.zones)),
        "add_date_fields": lambda t: X.add_date_fields(t.cube.drop(*S.DATE_PARTS), "pickup_date"),
        "time_period_labels": lambda t: X.add_time_period(t.cube),
        "trip_flags": lambda t: t.flagged,
        "trip_metrics": lambda t: X.add_trip_metrics(t.trips),
        "aggregate_demand": lambda t: rollup.aggregate_demand(t.cube, ["pickup_borough", "year"]),
        "aggregate_trips": lambda t: rollup.aggregate_trips(t.flagged, ["pickup_borough", "is_weekend"]),
        "aggregate_trip_metrics": lambda t: rollup.aggregate_trip_metrics(
            X.add_trip_metrics(t.trips), ["dropoff_borough", "day_of_week"], "pickup_date"
        ),
        "add_partition_share": lambda t: rollup.add_partition_share(
            rollup.aggregate_demand(t.cube, ["pickup_borough", "month"]),
            ["pickup_borough"], "total_revenue", "revenue_share",
        ),
        "revenue_efficiency_metrics": lambda t: rollup.add_revenue_efficiency(
            rollup.aggregate_demand(t.cube, ["pickup_borough"])
        ),
        "exterior_rings": lambda t: t.table("exterior_rings").select(
            "LocationID", "ring_index",
            F.array_join(F.transform("ring", lambda p: F.array_join(p.cast("array<string>"), ",")), ";").alias("ring_text"),
        ),
        "train_validation_split": lambda t: forecast.train_validation_split(t.train),
        "feature_pipeline": feature_pipeline,
        "linear_evaluation": linear_evaluation,
        "linear_forecast_monthly": lambda t: _with_linear(t).table("forecast_monthly"),
        "linear_error_by_borough": lambda t: _with_linear(t).table("error_by_borough"),
        "dq_outside_years": lambda t: quality.dq_outside_years(t.cube, 1997, 1999),
        "dq_unexpected_months": lambda t: quality.dq_unexpected_months(t.cube, "1996-06", "2000-06"),
        "dq_inconsistent_rows": lambda t: quality.dq_inconsistent_rows(contradicting(t.cube)),
        "dq_date_contradictions": lambda t: quality.dq_date_consistency(contradicting(t.cube)),
        "dq_required_columns": lambda t: S.missing_columns({"cube": t.cube.drop("total_revenue"), "routes": t.routes, "trips": t.cleaned}),
        "dq_profile": lambda t: quality.column_profile(t.cleaned).drop("distinct_estimate", "samples"),
        "extract_trip_enriched": lambda t: features.sample_extract(t.trips, [*features.SAMPLE_ORDERS["trip_enriched"], *O.EXTRACT_TIES], digits=None),
        **{f"story_{name}": (lambda t, name=name: lookups.bundle(STORIES[name](t.ranked.table))) for name in STORIES},
        **{
            f"extract_{name}": (lambda t, name=name: features.sample_extract(t.table(name), features.SAMPLE_ORDERS[name], digits=None))
            for name in ("zone_daily_features", "borough_hour_features", "top_routes")
        },
        "dq_time_range": lambda t: quality.dq_time_range(t.raw),
        "dq_month_membership": lambda t: quality.dq_month_membership(t.raw, *O.MONTH),
        "dq_rows_by_month": lambda t: quality.dq_rows_by_month(t.raw),
        "dq_outside_rows": lambda t: quality.dq_outside_rows(t.raw, *O.MONTH),
        "dq_hour_distribution": lambda t: quality.dq_hour_distribution(t.cube),
        "dq_expected_years": lambda t: quality.dq_expected_years(
            t.raw.select(F.year(S.PICKUP_TIME).alias("year")), O.YEARS
        ),
        "dq_date_consistency": lambda t: quality.dq_date_consistency(t.cube),
        "dq_missing_months": lambda t: quality.dq_missing_months(t.cube, *O.MONTHS),
        "primary_years": lambda t: views.primary_years(daily(t)),
        "scoped_daily_kpis": lambda t: views.scoped_daily_kpis(daily(t)),
        "scoped_monthly": lambda t: views.scoped_monthly(t.table("monthly_demand"), daily(t)),
        "top_named_zones": lambda t: views.top_named_zones(rollup.aggregate_demand(t.cube, [S.PU, "pickup_zone", "pickup_borough"])),
        "top_boroughs_hourly": lambda t: views.top_boroughs_hourly(t.table("borough_hourly_pattern")),
        "busiest_zone_forecast": lambda t: views.busiest_zone_forecast(t.table("forecast_zone_hour")),
        "named_routes_top": lambda t: views.named_routes_top(t.routes),
        "actual_predicted_long": lambda t: views.actual_predicted_long(t.table("forecast_monthly"), "year_month"),
        "forecast_bias": lambda t: views.forecast_bias(t.table("forecast_monthly")),
        "flows_touching_borough": lambda t: views.flows_touching_borough(t.table("od_flow_hour"), "EUROPE"),
        "lk_filters": lk_filters,
        **{
            key: (lambda t, p=preset, kw=params, n=limit: lookups.lookup(t.ranked.table, p, n, **kw))
            for key, (preset, params, limit) in LOOKUPS.items()
        },
    }


def queries() -> dict[str, Query]:
    out: dict[str, Query] = {
        f.__name__: f for f in (
            scan_trips_merged, scan_zone_lookup, scan_feature_table, scan_centroids, scan_geojson,
            typed_csv_load, publish_with_provenance,
            stream_zone_demand, stream_zone_demand_parts, stream_hotspots, batch_speed_merge,
            batch_speed_live, stream_replay_demand, stream_replay_hotspots,
            train_models, trained_reload, trained_coverage,
        )
    }
    out |= {
        f"trained_{name}": _trained(name) for name in (
            "model_evaluation_metrics", "forecast_predictions", "forecast_daily", "error_by_hour",
            "error_by_borough", "zone_accuracy", "error_distribution",
        )
    }
    for name, build in {**builders(), **_over_tables()}.items():
        out[name] = lambda spark, sf_dir, build=build: build(tables(spark, sf_dir))
    return {
        name: (lambda spark, sf_dir, q=query: rounded(q(spark, sf_dir))) for name, query in out.items()
    }


def oracle_sql() -> dict[str, str]:
    return O.sql() | {key: O.lookup(*wanted) for key, wanted in O.LOOKUPS.items()}
