"""Demand forecasting: lag features, splits, Spark ML models, error tables."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hourgrid import schema as S
from hourgrid.functions import exprs as X
from hourgrid.operators import forest as grown
from hourgrid.operators.ordering import between_quantiles
from hourgrid.session import settle

# --- fixed values: frame layout, features and model settings ---------------------------------
FRAME = [
    S.PU, "pickup_zone", "pickup_borough", "pickup_date", "year", "month", "day", "day_of_week",
    "is_weekend", "hour", "avg_trip_distance", "avg_trip_duration_min", "avg_fare_amount",
    "avg_total_amount", "avg_passenger_count", "avg_speed_mph", "credit_card_share",
    "cash_share", "lag_1_hour_trip_count", "lag_24_hour_trip_count",
    "rolling_24h_avg_trip_count", "trip_count",
]
FILLED = [
    "avg_trip_distance", "avg_trip_duration_min", "avg_fare_amount", "avg_total_amount",
    "avg_passenger_count", "avg_speed_mph", "credit_card_share", "cash_share",
    "lag_1_hour_trip_count", "lag_24_hour_trip_count", "rolling_24h_avg_trip_count",
]
NUMERIC = [
    S.PU, "year", "month", "day", "day_of_week", "is_weekend", "hour", *FILLED,
]
CATEGORY = "pickup_borough"
TARGET = "trip_count"
FULL = ("2021-01-01", "2024-12-31")
TRAIN = ("2021-01-01", "2023-12-31")
EVALUATION = ("2024-01-01", "2024-12-31")
VALIDATION_PERCENT = 20
SEED = 42
FOREST = {"numTrees": 60, "maxDepth": 18, "minInstancesPerNode": 3}
BOOSTING = {"maxIter": 80, "stepSize": 0.08, "maxDepth": 4}
TAIL = (0.01, 0.99)
#: Rows times trees up to which a forest is grown by Spark, all trees on the driver.
DRIVER_ROWS = 2_000_000
# --------------------------------------------------------------------------------------------


def lag_features(cube: DataFrame) -> DataFrame:
    """Previous row, 24 rows back, and mean of the 24 rows before, per zone in time order.

    Lags count rows, not clock hours. A zone has at most one cube row per hour of the
    cleaning window, so a window partition is bounded by the calendar, not by the trips.
    """
    order = Window.partitionBy(S.PU).orderBy("pickup_date", "hour")
    return cube.withColumns({
        "lag_1_hour_trip_count": F.lag("trip_count", 1).over(order),
        "lag_24_hour_trip_count": F.lag("trip_count", 24).over(order),
        "rolling_24h_avg_trip_count": F.avg("trip_count").over(order.rowsBetween(-24, -1)),
    })


def dense_hours(cube: DataFrame) -> DataFrame:
    """Optional calendar-dense variant: add zero rows for hours a zone had no trips in.

    Each zone spans its own first to last hour.
    """
    stamp = F.make_timestamp_ntz(
        F.year("pickup_date"), F.month("pickup_date"), F.dayofmonth("pickup_date"),
        F.col("hour"), F.lit(0), F.lit(0),
    )
    place = [S.PU, *S.PICKUP_PLACE]
    spine = (
        cube.groupBy(*place)
        .agg(F.min(stamp).alias("a"), F.max(stamp).alias("z"))
        .select(*place, F.explode(F.sequence("a", "z", F.expr("interval 1 hour"))).alias("t"))
        .select(*place, F.to_date("t").alias("pickup_date"), F.hour("t").alias("hour"))
    )
    values = cube.drop(*S.PICKUP_PLACE, *S.DATE_PARTS)
    full = spine.join(values, [S.PU, "pickup_date", "hour"], "left").fillna(0, ["trip_count"])
    return X.add_date_fields(full, "pickup_date").select(*cube.columns)


def _between(bounds: tuple[str, str]) -> Column:
    return F.col("pickup_date").between(*[F.lit(d).cast("date") for d in bounds])


def forecast_frame(cube: DataFrame, full: tuple[str, str] = FULL) -> DataFrame:
    """Model input: lags first, then nulls to 0 in the features, then the date filter; in no order."""
    return lag_features(cube).select(*FRAME).fillna(0, FILLED).where(_between(full))


def published_frame(frame: DataFrame) -> DataFrame:
    """The frame in time order, for the published table only."""
    return frame.orderBy("pickup_date", "hour", S.PU)


def time_split(
    frame: DataFrame,
    train: tuple[str, str] = TRAIN,
    evaluation: tuple[str, str] = EVALUATION,
) -> DataFrame:
    """Tag rows ``train`` or ``evaluation`` by date (both ends included)."""
    tag = F.when(_between(train), "train").when(_between(evaluation), "evaluation")
    return frame.withColumn("dataset", tag)


def split_info(split: DataFrame) -> DataFrame:
    """Rows, first and last date of the whole frame and of both parts, in one pass."""
    parts = {
        "full": F.lit(True),
        "train": F.col("dataset") == "train",
        "evaluation": F.col("dataset") == "evaluation",
    }
    wide = split.agg(*[
        F.struct(
            F.lit(name).alias("dataset"),
            F.count_if(test).alias("rows"),
            F.min(F.when(test, F.col("pickup_date"))).alias("start_date"),
            F.max(F.when(test, F.col("pickup_date"))).alias("end_date"),
        ).alias(name)
        for name, test in parts.items()
    ])
    return wide.select(F.explode(F.array(*parts)).alias("p")).select("p.*")


def train_validation_split(train: DataFrame, percent: int = VALIDATION_PERCENT, seed: int = SEED) -> DataFrame:
    """Tag rows ``fit`` or ``validation`` by a hash of the row key.

    Unlike a random draw this is the same for every partitioning and on every retry.
    """
    key = F.concat_ws("|", F.lit(str(seed)), S.PU, F.col("pickup_date").cast("string"), "hour")
    draw = X.hash_number(key) % 100
    return train.withColumn("part", F.when(draw < percent, "validation").otherwise("fit"))


def feature_stages() -> list:
    """One-hot borough (unknown gives all zeros) and standardised numeric columns."""
    return [
        StringIndexer(inputCol=CATEGORY, outputCol="borough_index", handleInvalid="keep"),
        OneHotEncoder(inputCol="borough_index", outputCol="borough_vector", dropLast=True),
        VectorAssembler(inputCols=NUMERIC, outputCol="numbers", handleInvalid="keep"),
        StandardScaler(inputCol="numbers", outputCol="scaled", withMean=True, withStd=True),
        VectorAssembler(inputCols=["borough_vector", "scaled"], outputCol="features"),
    ]


def feature_pipeline(rows: DataFrame) -> DataFrame:
    """Rows with the assembled feature vector."""
    return Pipeline(stages=feature_stages()).fit(rows).transform(rows)


def estimators(forest: dict | None = None, boosting: dict | None = None) -> dict:
    """The three model kinds, by name."""
    io = {"featuresCol": "features", "labelCol": TARGET, "predictionCol": "predicted_trip_count"}
    return {
        "Linear Regression": LinearRegression(**io),
        "Random Forest": RandomForestRegressor(
            **io,
            # every running task holds node statistics up to maxMemoryInMB, and again while it combines
            # and serialises them; without cached node ids it also gets its own copy of the trees that
            # grow. Both settings change the passes, not the trees
            **{"featureSubsetStrategy": "all", "seed": SEED, "maxMemoryInMB": 64, "cacheNodeIds": True, **FOREST, **(forest or {})},
        ),
        "Gradient Boosting": GBTRegressor(**io, **{"seed": SEED, **BOOSTING, **(boosting or {})}),
    }


def fit_estimator(estimator, rows: DataFrame, count: int):
    """``estimator`` fitted; a forest of more nodes than the driver should hold is grown in tasks."""
    if grown.can_grow(estimator) and count * estimator.getNumTrees() > DRIVER_ROWS:
        return grown.grow(estimator, rows, count)
    return estimator.fit(rows)


def train_models(train: DataFrame, models: dict | None = None) -> tuple[dict[str, PipelineModel], DataFrame]:
    """Fit every model on the fit part; return the models and their validation predictions."""
    tagged = train_validation_split(train)
    fit = tagged.where(F.col("part") == "fit")
    validation = tagged.where(F.col("part") == "validation")
    prepared = Pipeline(stages=feature_stages()).fit(fit)
    # settled, so that blocks lost with an executor are read again, not predicted from raw
    ready = settle(prepared.transform(fit).select("features", TARGET)).persist()
    try:
        count = ready.count()
        fitted = {
            name: PipelineModel([*prepared.stages, fit_estimator(estimator, ready, count)])
            for name, estimator in (models or estimators()).items()
        }
    finally:
        ready.unpersist()
    return fitted, predict_all(fitted, validation)


def predict_all(models: dict[str, PipelineModel], rows: DataFrame) -> DataFrame:
    """Long predictions, one row per model and input row, from one pass over ``rows``.

    Every model adds a column; models that share their feature stages (equal uids, which
    saving keeps) share the feature vector too. The columns become rows at the end.
    """
    wide, prepared, done = rows, None, []
    for at, model in enumerate(models.values()):
        *features, last = model.stages
        mark = [stage.uid for stage in features]
        if mark != prepared:
            wide, prepared = PipelineModel(features).transform(wide.select(*rows.columns, *done)), mark
        done.append(f"__predicted_{at}")
        wide = last.transform(wide).withColumnRenamed("predicted_trip_count", done[-1])
    pairs = F.array(*[
        F.struct(F.lit(name).alias("model"), F.col(c).alias("predicted_trip_count"))
        for name, c in zip(models, done)
    ])
    return wide.select(*rows.columns, F.explode(pairs).alias("__p")).select(
        F.col("__p.model").alias("model"), *rows.columns, F.col("__p.predicted_trip_count")
    )


def one_feature_model(rows: DataFrame, feature: str) -> PipelineModel:
    """Least squares on a single column, fitted on ``rows``."""
    stages = [
        VectorAssembler(inputCols=[feature], outputCol="one"),
        LinearRegression(featuresCol="one", labelCol=TARGET, predictionCol="predicted_trip_count", solver="normal"),
    ]
    return Pipeline(stages=stages).fit(rows)


def best_predictions(predictions: DataFrame) -> DataFrame:
    """Of long predictions, those of the model with the lowest RMSE over the same rows."""
    best = model_metrics(predictions).where("is_best_model").select("model")
    return predictions.join(best, "model", "left_semi").drop("model")


def model_stage(train: DataFrame, evaluation: DataFrame, folder: str, models: dict | None = None) -> None:
    """Train, save, load and score, all below ``folder``.

    Writes one folder per fitted pipeline, the validation predictions (``validation``) and,
    by the models as loaded again, the predictions of the evaluation rows (``evaluation``).
    Predictions are partitioned by model, so that a reader of one model scans only its files.
    """
    fitted, validation = train_models(train, models)
    save_models(fitted, folder)
    write_predictions(validation, f"{folder}/validation")
    write_predictions(predict_all(load_models(folder, list(fitted)), evaluation), f"{folder}/evaluation")


def write_predictions(predictions: DataFrame, path: str) -> None:
    predictions.write.mode("overwrite").partitionBy("model").parquet(path)


def reload_report(train: DataFrame, folder: str, names: list[str] | None = None) -> DataFrame:
    """Per model: validation rows, and how many the saved model predicts otherwise than the fitted one did."""
    key = [S.PU, "pickup_date", "hour"]
    tagged = train_validation_split(train)
    again = predict_all(load_models(folder, names), tagged.where(F.col("part") == "validation"))
    first = train.sparkSession.read.parquet(f"{folder}/validation")
    both = again.select("model", *key, F.col("predicted_trip_count").alias("__again")).join(
        first.select("model", *key, "predicted_trip_count"), ["model", *key], "full_outer"
    )
    same = F.col("__again").eqNullSafe(F.col("predicted_trip_count"))
    return both.groupBy("model").agg(
        F.count(F.lit(1)).alias("row_count"), F.count_if(~same).alias("changed_rows")
    )


def model_folder(folder: str, name: str) -> str:
    return f"{folder}/{name.lower().replace(' ', '_')}_model"


def load_models(folder: str, names: list[str] | None = None) -> dict[str, PipelineModel]:
    """The models that ``save_models`` wrote, by name."""
    names = list(names or estimators())
    return dict(zip(names, _beside(lambda name: PipelineModel.load(model_folder(folder, name)), names)))


def save_models(models: dict[str, PipelineModel], folder: str) -> None:
    """Save each fitted model below ``folder``, named after the model."""
    _beside(lambda name: models[name].write().overwrite().save(model_folder(folder, name)), list(models))


def _beside(run, names: list[str]) -> list:
    """``run`` of every name, beside each other: a model is many files of a few rows, a job each."""
    with ThreadPoolExecutor(max(1, len(names))) as pool:
        return list(pool.map(inheritable_thread_target(SparkSession.active())(run), names))


def baseline_predictions(frame: DataFrame) -> DataFrame:
    """Three model-free predictors from the lag columns, in the layout of ``predict_all``."""
    lags = {
        "lag_1": "lag_1_hour_trip_count",
        "lag_24": "lag_24_hour_trip_count",
        "rolling_24h": "rolling_24h_avg_trip_count",
    }
    pairs = F.array(*[
        F.struct(F.lit(n).alias("model"), F.col(c).cast("double").alias("predicted_trip_count"))
        for n, c in lags.items()
    ])
    return frame.withColumn("__p", F.explode(pairs)).select(
        F.col("__p.model").alias("model"), *frame.columns, F.col("__p.predicted_trip_count")
    )


def model_metrics(predictions: DataFrame) -> DataFrame:
    """MAE, RMSE and R2 per model, best (lowest RMSE) first and flagged."""
    error = F.col(TARGET) - F.col("predicted_trip_count")
    spread = F.var_pop(TARGET)
    table = predictions.groupBy("model").agg(
        F.avg(F.abs(error)).alias("MAE"),
        F.sqrt(F.avg(error * error)).alias("RMSE"),
        F.when(spread > 0, F.lit(1.0) - F.avg(error * error) / spread).alias("R2"),
    )
    by_rmse = Window.partitionBy().orderBy("RMSE", "model")  # one row per model
    return table.withColumn("is_best_model", F.row_number().over(by_rmse) == 1).orderBy("RMSE", "model")


def with_errors(predictions: DataFrame) -> DataFrame:
    """Signed and absolute error of each prediction."""
    error = F.col(TARGET) - F.col("predicted_trip_count")
    return predictions.withColumns({"prediction_error": error, "absolute_error": F.abs(error)})


def with_weekday_name(rows: DataFrame) -> DataFrame:
    """Weekday text from the 1..7 index (Sunday is 1)."""
    names = F.array(*[F.lit(n) for n in S.WEEKDAY_NAMES])
    return rows.withColumn("weekday_name", F.get(names, F.col("day_of_week") - 1))


def forecast_predictions(predictions: DataFrame) -> DataFrame:
    return with_errors(predictions).select(
        "pickup_date", "year", "month", "day", "hour", S.PU, "pickup_zone", "pickup_borough",
        TARGET, "predicted_trip_count", "prediction_error", "absolute_error",
    )


def _sums() -> list[Column]:
    return [F.sum(c).alias(c) for c in (TARGET, "predicted_trip_count")]


def forecast_monthly(predictions: DataFrame) -> DataFrame:
    month = F.date_format("pickup_date", "yyyy-MM").alias("year_month")
    return predictions.groupBy(month).agg(*_sums()).orderBy("year_month")


def _percent(error: str, actual: str) -> Column:
    return F.when(F.col(actual) != 0, F.col(error) / F.col(actual) * 100)


def forecast_daily(predictions: DataFrame) -> DataFrame:
    days = predictions.groupBy("pickup_date", "year", "month", "day").agg(*_sums())
    percent = _percent("absolute_error", TARGET)
    return with_errors(days).withColumn("absolute_percentage_error", percent).orderBy("pickup_date")


def error_summary(predictions: DataFrame, keys: list[str]) -> DataFrame:
    """Error statistics per group; null is a group of its own."""
    error, off = F.col("prediction_error"), F.col("absolute_error")
    table = with_errors(predictions).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("records"),
        F.sum(TARGET).alias("actual_trip_count"),
        F.sum("predicted_trip_count").alias("predicted_trip_count"),
        F.avg(error).alias("mean_error"),
        F.avg(off).alias("mae"),
        F.sqrt(F.avg(error * error)).alias("rmse"),
        F.avg(_percent("absolute_error", TARGET)).alias("mape"),
        F.sum(off).alias("total_absolute_error"),
    )
    gap = F.col("actual_trip_count") - F.col("predicted_trip_count")
    return table.withColumns({
        "aggregate_error": gap,
        "aggregate_absolute_error": F.abs(gap),
    }).withColumn(
        "aggregate_absolute_percentage_error",
        _percent("aggregate_absolute_error", "actual_trip_count"),
    )


def error_by_hour(predictions: DataFrame) -> DataFrame:
    return error_summary(predictions, ["hour"]).orderBy("hour")


def error_by_borough(predictions: DataFrame) -> DataFrame:
    return error_summary(predictions, ["pickup_borough"]).orderBy(F.desc("aggregate_absolute_error"))


def zone_accuracy(predictions: DataFrame) -> DataFrame:
    table = error_summary(predictions, [S.PU, "pickup_zone", "pickup_borough"])
    return table.orderBy(F.desc("aggregate_absolute_error"))


def weekday_hour_error_heatmap(predictions: DataFrame) -> DataFrame:
    table = error_summary(with_weekday_name(predictions), ["day_of_week", "weekday_name", "hour"])
    return table.orderBy("day_of_week", "hour")


def error_distribution(predictions: DataFrame) -> DataFrame:
    """Errors between the exact 1st and 99th percentile, ends included."""
    return between_quantiles(with_errors(predictions).select("prediction_error"), "prediction_error", *TAIL)


def forecast_zone_hour(predictions: DataFrame) -> DataFrame:
    """Prediction rows in the served layout, whatever of the optional columns they carry."""

    def first(*names: str) -> Column:
        present = [F.col(n) for n in names if n in predictions.columns]
        return F.coalesce(*present) if present else F.lit(None)

    def number(value: Column, default: Column) -> Column:
        return F.coalesce(value.cast("double"), default)

    actual, predicted = F.col("actual_trip_count"), F.col("predicted_trip_count")
    keys = ["pickup_date", "year", "month", "day", "hour", S.PU, "pickup_zone", "pickup_borough"]
    base = predictions.select(
        *[first(k).alias(k) for k in keys],
        F.coalesce(
            first("year_month").cast("string"), F.substring(first("pickup_date").cast("string"), 1, 7)
        ).alias("year_month"),
        number(first("trip_count", "actual_trip_count"), F.lit(0.0)).alias("actual_trip_count"),
        number(first("predicted_trip_count"), F.lit(0.0)).alias("predicted_trip_count"),
        first("prediction_error").cast("double").alias("__error"),
        first("absolute_error").cast("double").alias("__off"),
    )
    return (
        base.withColumn("prediction_error", F.coalesce("__error", actual - predicted))
        .withColumn("absolute_error", F.coalesce("__off", F.abs("prediction_error")))
        .withColumn("absolute_percentage_error", _percent("absolute_error", "actual_trip_count"))
        .select(
            "pickup_date", "year", "month", "year_month", "day", "hour", S.PU, "pickup_zone",
            "pickup_borough", "actual_trip_count", "predicted_trip_count", "prediction_error",
            "absolute_error", "absolute_percentage_error",
        )
    )
