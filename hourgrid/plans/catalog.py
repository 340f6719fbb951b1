"""Named tables, composed lazily from one set of inputs."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourgrid import schema as S
from hourgrid.functions import exprs as X
from hourgrid.operators import (
    business, clean, enrich, features, flows, forecast, geo, profiles, routes, temporal,
)

from hourgrid.sources import sinks


@dataclass(frozen=True)
class Params:
    """Everything a table can be asked for; the defaults are those of the full data.

    A top-N of None keeps all ranked rows.
    """

    window: tuple[str, str] = clean.WINDOW
    zones_top: int | None = 10
    zones_overall: int | None = 25
    routes_top: int | None = 25
    min_route_trips: int = 1000
    rank_change: int | None = 50
    flows_top: int | None = 500
    replay_size: int | None = 5000
    replay_seed: int = 42
    profiles_top: int | None = 1000
    full: tuple[str, str] = forecast.FULL
    train: tuple[str, str] = forecast.TRAIN
    evaluation: tuple[str, str] = forecast.EVALUATION


@dataclass
class Tables:
    """Stage tables as attributes, analytic tables by name through ``table``.

    Nothing runs until a table is used. Tables that share an ancestor share its DataFrame,
    so a query that needs it twice lets Spark reuse the exchange; ``staged`` writes the
    common stages once for a run over many tables.
    """

    sources: dict[str, Callable]  # raw, zones, area_features, zone_features; models (name -> fitted model) if trained
    params: Params = Params()

    @cached_property
    def raw(self) -> DataFrame:
        return self.sources["raw"]()

    @cached_property
    def zones(self) -> DataFrame:
        return self.sources["zones"]()

    @cached_property
    def area_features(self) -> DataFrame:
        return self.sources["area_features"]()

    @cached_property
    def zone_features(self) -> DataFrame:
        return self.sources["zone_features"]()

    @cached_property
    def cleaned(self) -> DataFrame:
        return clean.clean_trips(self.raw, self.zones, *self.params.window)

    @cached_property
    def trips(self) -> DataFrame:
        return enrich.trip_enriched(self.cleaned, self.zones)

    @cached_property
    def flagged(self) -> DataFrame:
        return X.add_trip_flags(self.trips)

    @cached_property
    def cube(self) -> DataFrame:
        return features.zone_hour_features(self.trips)

    @cached_property
    def dropoffs(self) -> DataFrame:
        return flows.dropoff_zone_hour_features(self.trips)

    @cached_property
    def routes(self) -> DataFrame:
        return features.top_routes(self.trips)

    @cached_property
    def centroids(self) -> DataFrame:
        return geo.zone_centroids(self.zone_features, self.zones)

    @cached_property
    def frame(self) -> DataFrame:
        return forecast.forecast_frame(self.cube, self.params.full)

    @cached_property
    def split(self) -> DataFrame:
        return forecast.time_split(self.frame, self.params.train, self.params.evaluation)

    @cached_property
    def train(self) -> DataFrame:
        return self.split.where(F.col("dataset") == "train").drop("dataset")

    @cached_property
    def evaluation(self) -> DataFrame:
        return self.split.where(F.col("dataset") == "evaluation").drop("dataset")

    @cached_property
    def predictions(self) -> DataFrame:
        """Evaluation rows predicted by the best of the loaded models, by the rolling mean without any."""
        if "models" in self.sources:
            return forecast.best_predictions(self.scored)
        return self.evaluation.withColumn("predicted_trip_count", F.col("rolling_24h_avg_trip_count"))

    @cached_property
    def scored(self) -> DataFrame:
        """Long predictions of the evaluation rows: by the models of the source ``models`` (name ->
        fitted model), by the lag columns without it."""
        if "models" in self.sources:
            return forecast.predict_all(self.sources["models"](), self.evaluation)
        return forecast.baseline_predictions(self.evaluation)

    def trained(self, folder: str) -> Tables:
        """Train, save, load and score the models once; return tables that read the stored predictions.

        Metrics, predictions and error tables of the result are those of the trained models;
        the source ``models`` is what was loaded, ``validation`` the validation predictions.
        """
        folder = folder.rstrip("/")
        framed = self.with_frame(folder)
        forecast.model_stage(framed.train, framed.evaluation, folder)
        return self.with_models(folder)

    def with_frame(self, folder: str) -> Tables:
        """Write the forecast frame once below ``folder``; return tables that read it.

        For models: their fits and scores read the frame several times, and each time would
        join, clean and roll up the raw trips again. Its rows are bounded by zones and hours.
        """
        sinks.write_table_parquet(self.frame, f"{folder.rstrip('/')}/frame")
        return self.from_frame(folder)

    def from_frame(self, folder: str) -> Tables:
        """Tables that read the frame which ``with_frame`` wrote below ``folder``."""
        path = f"{folder.rstrip('/')}/frame"
        out = Tables({**self.sources}, self.params)
        out.__dict__.update({k: v for k, v in self.__dict__.items() if k in ("trips", "cube", "routes")})
        out.__dict__["frame"] = self.zones.sparkSession.read.schema(self.frame.schema).parquet(path)
        return out

    def with_models(self, folder: str) -> Tables:
        """The same tables with the models and predictions that ``trained`` left in ``folder``."""
        spark = self.zones.sparkSession
        out = Tables({**self.sources, "models": lambda: forecast.load_models(folder)}, self.params)
        out.__dict__.update({k: v for k, v in self.__dict__.items() if k in ("trips", "cube", "routes")})
        out.__dict__["scored"] = spark.read.parquet(f"{folder}/evaluation")
        out.__dict__["validation"] = spark.read.parquet(f"{folder}/validation")
        return out

    def need(self, stage: str) -> DataFrame:
        """A stage table, or an error that names the required columns it lacks."""
        return S.require_columns(getattr(self, stage), S.STAGE_INPUTS[stage], stage)

    def staged(self, folder: str) -> Tables:
        """Write enriched trips, cube and routes once; return tables that read them.

        For runs over many tables: the joins and the whole-row distinct behind the trips
        happen once, every table then scans only its own columns, and a lost executor costs
        a re-read instead of a recomputation. Trips and cube are partitioned by month.
        """
        spark = self.zones.sparkSession
        staged = Tables(self.sources, self.params)
        steps = {
            "trips": (self._trips_by_month, ["year_month"], S.TRIP_ORDER),
            "cube": (lambda: features.zone_hour_features(staged.trips).hint("rebalance", "year_month"), ["year_month"], S.CUBE_ORDER),
            "routes": (lambda: features.top_routes(staged.trips), [], S.ROUTES_ORDER),
        }
        for name, (build, by, order) in steps.items():
            path = f"{folder.rstrip('/')}/{name}"
            table = build()
            sinks.write_table_parquet(table, path, by)
            back = spark.read.schema(table.schema).parquet(path)
            # fills the cached stage, so later stages and tables start from the files
            staged.__dict__[name] = back.transform(S.lead_with, order)
        return staged

    def _trips_by_month(self) -> DataFrame:
        """Trips dealt by month while they are narrow; names and labels join after the shuffle."""
        narrow = self.cleaned.withColumn("__month", F.date_format("pickup_ts", "yyyy-MM"))
        return enrich.trip_enriched(narrow.hint("rebalance", "__month").drop("__month"), self.zones)

    def table(self, name: str) -> DataFrame:
        """An analytic table by name."""
        return builders()[name](self)

    def with_params(self, **changes) -> Tables:
        """The same inputs and staged tables under other parameters."""
        other = Tables(self.sources, replace(self.params, **changes))
        if "window" not in changes:
            other.__dict__.update({k: v for k, v in self.__dict__.items() if k in ("trips", "cube", "routes")})
        return other

    @cached_property
    def ranked(self) -> Tables:
        """Ranked tables with all their rows, as lookups need them."""
        return self.with_params(zones_top=None, zones_overall=None, routes_top=None, flows_top=None, profiles_top=None,
                                rank_change=None, replay_size=None)


def builders() -> dict[str, Callable[[Tables], DataFrame]]:
    """Every analytic table: name -> builder over the stage tables."""
    cube_tables = {
        f.__name__: f for f in (
            temporal.kpi_summary, temporal.hourly_demand, temporal.daily_demand,
            temporal.monthly_demand, temporal.weekday_weekend_hourly,
            temporal.weekday_hour_heatmap, temporal.borough_hourly_pattern,
            temporal.rush_hour_summary, temporal.yearly_summary, temporal.year_month_demand,
            temporal.month_of_year_pattern, temporal.year_hourly_pattern,
            temporal.year_weekday_hour_heatmap, temporal.borough_year_month,
            temporal.borough_year_hour, temporal.rush_hour_by_year,
            temporal.weekday_weekend_by_year, temporal.revenue_efficiency_temporal,
            features.zone_daily_features, features.borough_hour_features,
            profiles.zone_peak_hour, forecast.lag_features,
        )
    }
    forecast_tables = {
        f.__name__: f for f in (
            forecast.forecast_predictions, forecast.forecast_monthly, forecast.forecast_daily,
            forecast.error_by_hour, forecast.error_by_borough, forecast.zone_accuracy,
            forecast.weekday_hour_error_heatmap, forecast.error_distribution,
        )
    }
    out: dict[str, Callable[[Tables], DataFrame]] = {
        "clean_trips": lambda t: t.cleaned,
        "trip_enriched": lambda t: t.trips,
        "zone_hour_features": lambda t: t.cube,
        "top_routes": lambda t: t.routes,
        **{n: (lambda t, f=f: f(t.need("cube"))) for n, f in cube_tables.items()},
        "top_zones_by_hour": lambda t: temporal.top_zones_by_hour(t.need("cube"), t.params.zones_top),
        "top_zones_overall": lambda t: temporal.top_zones_overall(t.need("cube"), t.params.zones_overall),
        "peak_hour_summary": lambda t: temporal.peak_hour_summary(t.need("cube"), t.params.zones_top),
        "top_zones_by_year": lambda t: temporal.top_zones_by_year(t.need("cube"), t.params.zones_top),
        "zone_rank_change": lambda t: temporal.zone_rank_change(t.need("cube"), t.params.rank_change),
        **{n: (lambda t, n=n: business.business_table(t.need("flagged"), n)) for n in business.TABLES},
        "route_borough_matrix": lambda t: routes.route_borough_matrix(t.need("routes")),
        "top_routes_overall": lambda t: routes.top_routes_overall(t.need("routes"), t.params.routes_top),
        "top_inter_borough_routes": lambda t: routes.top_inter_borough_routes(t.need("routes"), t.params.routes_top),
        "top_airport_routes": lambda t: routes.top_airport_routes(t.need("routes"), t.params.routes_top),
        "route_efficiency_ranking": lambda t: routes.route_efficiency_ranking(
            t.need("routes"), t.params.routes_top, t.params.min_route_trips
        ),
        "route_tip_ranking": lambda t: routes.route_tip_ranking(
            t.need("routes"), t.params.routes_top, t.params.min_route_trips
        ),
        "route_concentration": lambda t: routes.route_concentration(t.need("routes")),
        "dropoff_zone_hour_features": lambda t: t.dropoffs,
        "zone_balance_hour": lambda t: flows.zone_balance_hour(t.need("cube"), t.dropoffs),
        "od_flow_hour": lambda t: flows.od_flow_hour(t.need("trips"), t.params.flows_top),
        "od_flow_year_month": lambda t: flows.od_flow_year_month(t.need("trips"), t.params.flows_top),
        "map_replay_sample": lambda t: flows.map_replay_sample(
            t.need("trips"), t.centroids, t.params.replay_size or Params.replay_size, t.params.replay_seed
        ),
        "map_replay_strata": lambda t: flows.map_replay_strata(
            t.need("trips"), t.centroids, t.params.replay_size, t.params.replay_seed
        ),
        "exterior_rings": lambda t: geo.exterior_rings(t.area_features),
        "ring_centroid": lambda t: geo.ring_centroid(geo.exterior_rings(t.area_features)),
        "zone_centroids": lambda t: geo.zone_centroids(t.area_features, t.zones),
        "zone_top_destination": lambda t: profiles.zone_top_destination(t.need("trips")),
        "zone_profile_summary": lambda t: profiles.zone_profile_summary(t.need("cube"), t.need("trips")),
        "route_peak_hour": lambda t: profiles.route_peak_hour(t.need("trips")),
        "route_profile_summary": lambda t: profiles.route_profile_summary(t.need("trips"), t.params.profiles_top),
        "forecast_frame": lambda t: forecast.published_frame(t.frame),
        "time_split": lambda t: t.split,
        "split_info": lambda t: forecast.split_info(t.split),
        "model_comparison": lambda t: forecast.model_metrics(forecast.baseline_predictions(t.train)),
        "model_evaluation_metrics": lambda t: forecast.model_metrics(t.scored),
        **{n: (lambda t, f=f: f(t.predictions)) for n, f in forecast_tables.items()},
        "forecast_zone_hour": lambda t: forecast.forecast_zone_hour(
            forecast.forecast_predictions(t.predictions)
        ),
    }
    return out
