from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from hourgrid.operators import forecast as FC
from hourgrid.operators import views
from tests.rows import trip, trips, values, zones

DDL = (
    "PULocationID int, pickup_zone string, pickup_borough string, pickup_service_zone string, pickup_date date, "
    "year int, month int, day int, year_month string, day_of_week int, weekday_name string, is_weekend int, hour int, "
    "trip_count bigint, avg_trip_distance double, avg_trip_duration_min double, avg_fare_amount double, "
    "avg_total_amount double, avg_passenger_count double, avg_speed_mph double, credit_card_share double, cash_share double"
)


def cell(zone, day, hour, n, borough="B"):
    return (
        zone, f"z{zone}", borough, "s", day, day.year, day.month, day.day, day.strftime("%Y-%m"),
        day.isoweekday() % 7 + 1, day.strftime("%a"), int(day.isoweekday() > 5), hour, n,
        1.0 + n, 10.0, 5.0 + n, 6.0, None, 12.0, 0.5, 0.5,
    )


@pytest.fixture(scope="module")
def cube(spark):
    start = date(2020, 12, 31)
    rows = [cell(1, start + timedelta(days=d), h, (d * 3 + h) % 7 + 1) for d in range(40) for h in (5, 6, 9)]
    rows += [cell(2, date(2024, 5, 1), 3, 4, None)]
    return spark.createDataFrame(rows, DDL)


def test_lags_count_rows_and_start_before_the_filter(cube):
    frame = FC.forecast_frame(cube)
    assert frame.columns == FC.FRAME
    first = frame.where("PULocationID = 1").orderBy("pickup_date", "hour").first()
    # 2021-01-01 05:00 follows three rows of 2020-12-31 that the date filter removes
    assert first.lag_1_hour_trip_count == 3 and first.lag_24_hour_trip_count == 0
    assert first.rolling_24h_avg_trip_count == pytest.approx((6 + 7 + 3) / 3)
    assert frame.where("pickup_date < '2021-01-01'").count() == 0
    assert values(frame.where("PULocationID = 2"), "rolling_24h_avg_trip_count", "avg_passenger_count") == [(0.0, 0.0)]


def test_dense_hours_fill_gaps(cube):
    dense = FC.dense_hours(cube.where("PULocationID = 1 and pickup_date = '2021-01-01'"))
    assert sorted(values(dense, "hour")) == [5, 6, 7, 8, 9]
    assert values(dense.where("hour = 7"), "trip_count", "weekday_name") == [(0, "Fri")]


def test_split_info_reports_empty_parts(cube):
    split = FC.time_split(FC.forecast_frame(cube), evaluation=("2030-01-01", "2030-12-31"))
    info = {r.dataset: r for r in FC.split_info(split).collect()}
    assert info["full"].rows == 118 and info["train"].rows == 117
    assert info["evaluation"].rows == 0 and info["evaluation"].start_date is None


def test_validation_split_ignores_partitioning(cube):
    frame = FC.forecast_frame(cube)
    a = sorted(values(FC.train_validation_split(frame), "pickup_date", "hour", "part"))
    b = sorted(values(FC.train_validation_split(frame.repartition(9)), "pickup_date", "hour", "part"))
    assert a == b and 5 < sum(p == "validation" for *_, p in a) < 45


@pytest.fixture(scope="module")
def errors(spark):
    rows = [
        (date(2024, 1, 1), 2024, 1, 1, 2, 8, 1, "a", "B", 10, 8.0), (date(2024, 1, 1), 2024, 1, 1, 2, 9, 1, "a", "B", 0, 2.0),
        (date(2024, 2, 3), 2024, 2, 3, 7, 8, 2, "b", None, 6, 6.0),
    ]
    return spark.createDataFrame(rows, (
        "pickup_date date, year int, month int, day int, day_of_week int, hour int, PULocationID int, pickup_zone string, "
        "pickup_borough string, trip_count bigint, predicted_trip_count double"
    ))


def test_error_tables(errors):
    hour = {r.hour: r for r in FC.error_by_hour(errors).collect()}
    assert hour[9].mape is None and hour[9].aggregate_absolute_percentage_error is None
    assert (hour[8].records, hour[8].mae, hour[8].mape) == (2, 1.0, 10.0)
    assert hour[8].rmse == pytest.approx(2 ** 0.5)
    assert None in values(FC.error_by_borough(errors), "pickup_borough")
    assert values(FC.weekday_hour_error_heatmap(errors), "weekday_name") == ["Mon", "Mon", "Sat"]
    assert values(FC.forecast_daily(errors), "absolute_percentage_error") == [0.0, 0.0]
    assert FC.forecast_predictions(errors).columns[-2:] == ["prediction_error", "absolute_error"]


def test_zone_hour_layout_accepts_other_names(errors):
    served = FC.forecast_zone_hour(errors.withColumnRenamed("trip_count", "actual_trip_count").drop("day"))
    row = served.where("hour = 9").first()
    assert (row.actual_trip_count, row.absolute_error, row.absolute_percentage_error, row.day) == (0.0, 2.0, None, None)
    assert row.year_month == "2024-01"


def test_distribution_keeps_everything_on_constant_error(errors):
    constant = errors.withColumn("predicted_trip_count", F.col("trip_count") - 1.0)
    assert values(FC.error_distribution(constant), "prediction_error") == [1.0] * 3


def test_models_beat_the_mean_and_save(spark, cube, tmp_path):
    frame = FC.forecast_frame(cube).persist()
    small = FC.estimators({"numTrees": 5, "maxDepth": 5}, {"maxIter": 5})
    models, validation = FC.train_models(frame.where("PULocationID = 1"), small)
    table = FC.model_metrics(validation).collect()
    assert {r.model for r in table} == set(small)
    assert [r.is_best_model for r in table] == [True, False, False]
    assert table[0].RMSE == min(r.RMSE for r in table) and all(r.R2 > 0 for r in table)
    FC.save_models(models, str(tmp_path))
    again = FC.PipelineModel.load(str(tmp_path / "random_forest_model"))
    # an unseen borough is ignored, not an error
    assert again.transform(frame.where("PULocationID = 2")).count() == 1


def _near(rows):
    return sorted([tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in rows], key=repr)


def test_model_stage_feeds_the_error_tables(spark, small_dir, tmp_path):
    """Train, save, load, score; SQL over the stored predictions gives the same metrics and error tables."""
    import duckdb

    from hourgrid.plans import queries as Q

    small = FC.estimators({"numTrees": 4, "maxDepth": 4}, {"maxIter": 3})
    t = Q.tables(spark, small_dir)
    folder = str(tmp_path / "models")
    FC.model_stage(t.train, t.evaluation, folder, small)
    out = t.with_models(folder)
    stored = f"read_parquet('{folder}/evaluation/*/*.parquet', hive_partitioning = true)"
    metrics = duckdb.sql(f"""SELECT model, avg(abs(e)), sqrt(avg(e * e)), 1 - avg(e * e) / var_pop(trip_count)
        FROM (SELECT *, trip_count - predicted_trip_count AS e FROM {stored}) GROUP BY model ORDER BY 3""").fetchall()
    got = out.table("model_evaluation_metrics").collect()
    assert {r.model for r in got} == set(small)
    assert _near(tuple(r)[:4] for r in got) == _near(metrics)
    assert [r.model for r in got if r.is_best_model] == [metrics[0][0]]
    best = f"(SELECT *, trip_count - predicted_trip_count AS e FROM {stored} WHERE model = '{metrics[0][0]}')"
    for table, key in ("error_by_borough", "pickup_borough"), ("error_by_hour", "hour"):
        want = duckdb.sql(f"SELECT {key}, count(*), sum(trip_count), sum(predicted_trip_count), avg(e), avg(abs(e)), sqrt(avg(e * e)) FROM {best} GROUP BY 1").fetchall()
        columns = [key, "records", "actual_trip_count", "predicted_trip_count", "mean_error", "mae", "rmse"]
        assert _near(tuple(r[c] for c in columns) for r in out.table(table).collect()) == _near(want)
    assert out.table("forecast_predictions").count() == t.evaluation.count()
    report = FC.reload_report(t.train, folder).collect()
    assert {r.model for r in report} == set(small) and all(r.changed_rows == 0 and r.row_count > 0 for r in report)
    wanted = {tuple(r) for r in FC.predict_all(dict(list(FC.load_models(folder).items())[:1]), t.evaluation).collect()}
    first = out.scored.where("model = 'Linear Regression'").select("model", *t.evaluation.columns, "predicted_trip_count")
    assert {tuple(r) for r in first.collect()} == wanted


def test_forest_statistics_fit_beside_each_other(spark):
    assert FC.estimators()["Random Forest"].getMaxMemoryInMB() <= 256  # a task; an executor runs several


def test_linear_queries_read_a_stored_frame(spark):
    """Fit and scores read the frame from files; raw trips are not joined and cleaned again for each."""
    from hourgrid.plans import queries as Q
    from hourgrid.plans.catalog import Tables

    picks = [datetime(year, 5, day, hour, 0) for year in (2021, 2024) for day in (3, 4, 5) for hour in range(0, 24, 3)]
    made = trips(spark, *[
        trip(pick=p, drop=p.replace(minute=30), pu=2 + i % 2, total=20.0 + n) for i, p in enumerate(picks) for n in range(1 + i % 3)
    ])
    t = Tables({"raw": lambda: made, "zones": lambda: zones(spark)})
    linear = Q._with_linear(t)
    for df in (linear.frame, linear.scored, linear.table("forecast_monthly")):
        assert df.inputFiles() and all("/frame/" in f for f in df.inputFiles())
    assert linear.frame.dtypes == t.frame.dtypes
    assert sorted(map(repr, linear.frame.collect())) == sorted(map(repr, t.frame.collect()))
    got = linear.table("forecast_monthly").collect()
    assert [(r.year_month, r.trip_count) for r in got] == [("2024-05", sum(1 + i % 3 for i in range(24, 48)))]


def test_views_over_forecasts(spark, errors):
    long = views.actual_predicted_long(FC.forecast_monthly(errors), "year_month")
    assert sorted(values(long, "year_month", "series", "value"))[0] == ("2024-01", "Actual", 10.0)
    bias = views.forecast_bias(FC.forecast_monthly(errors)).first()
    assert (bias.error, bias.bias) == (0.0, "under predicted")
    series = views.busiest_zone_forecast(errors)
    assert values(series, "zone", "actual_value") == [("a", 10.0), ("a", 0.0)]
    other = spark.createDataFrame([(date(2024, 1, 1), 3, None, 7.0)], "pickup_date date, hour int, actual double, prediction double")
    assert values(views.busiest_zone_forecast(other), "zone", "predicted_value") == [("All zones", 7.0)]


def test_forest_tasks_get_no_trees_and_grow_the_same_ones(spark):
    forest = FC.estimators()["Random Forest"]
    assert forest.getCacheNodeIds() and forest.getMaxMemoryInMB() <= 64
    rows = spark.range(600, numPartitions=3).selectExpr("id % 7 AS a", "id * 37 % 101 AS b", "id * id % 53 AS trip_count")
    ready = FC.VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(rows)
    grown = [
        FC.estimators({"numTrees": 4, "maxDepth": 12, **change})["Random Forest"].fit(ready).toDebugString.split("\n", 1)[1]
        for change in ({}, {"cacheNodeIds": False, "maxMemoryInMB": 256}, {"maxMemoryInMB": 1})
    ]
    assert grown[0].count("Predict") > 100 and grown[1:] == grown[:1] * 2


def test_trees_grown_in_tasks_are_those_of_spark(spark):
    """Without a draw the trees predict the same numbers, before and after saving."""
    from hourgrid.operators import forest as G

    rows = spark.range(3000, numPartitions=3).selectExpr(
        "cast(id % 7 as double) AS a", "id * 37 % 101 AS b", "cast(id * id % 53 as double) / 7 AS c", "id % 3 = 0 AS d",
        "CASE WHEN id % 11 = 0 THEN 'x' WHEN id % 2 = 0 THEN 'y' ELSE 'z' END AS e", "id * id % 53 + id % 7 * 3 AS trip_count",
    )
    stages = [FC.StringIndexer(inputCol="e", outputCol="i"), FC.OneHotEncoder(inputCol="i", outputCol="o"),
              FC.VectorAssembler(inputCols=["a", "b", "c", "d", "o"], outputCol="features")]
    ready = FC.Pipeline(stages=stages).fit(rows).transform(rows).select("features", "trip_count").persist()
    for change in {}, {"maxDepth": 5, "minInfoGain": 0.5, "minInstancesPerNode": 20}, {"maxBins": 8}:
        forest = FC.estimators({"numTrees": 2, "bootstrap": False, **change})["Random Forest"]
        grown = G.grow(forest, ready, 3000)
        want = values(forest.fit(ready).transform(ready), "predicted_trip_count")
        assert len(set(want)) > 20 and values(grown.transform(ready), "predicted_trip_count") == want


def test_a_large_forest_is_grown_in_tasks(spark, cube, tmp_path, monkeypatch):
    """All trees with their draws, saved, loaded and scored like any model, none of them on the driver."""
    from hourgrid.operators import forest as G

    monkeypatch.setattr(FC, "DRIVER_ROWS", 100)
    frame = FC.forecast_frame(cube).where("PULocationID = 1").persist()
    small = FC.estimators({"numTrees": 7, "maxDepth": 5}, {"maxIter": 3})
    folder = str(tmp_path)
    FC.model_stage(frame, frame, folder, small)
    again = FC.load_models(folder)
    assert [type(m.stages[-1]) is G.GrownForest for m in again.values()] == [False, True, False]
    trees = spark.read.parquet(again["Random Forest"].stages[-1].trees)
    assert sorted(values(trees, "tree")) == list(range(7)) and trees.select("value").distinct().count() > 3
    assert all(r.changed_rows == 0 and r.row_count > 0 for r in FC.reload_report(frame, folder).collect())
    forest = spark.read.parquet(f"{folder}/evaluation").where("model = 'Random Forest'")
    assert forest.count() == frame.count()
    plain = {r.model: r for r in FC.model_metrics(spark.read.parquet(f"{folder}/evaluation")).collect()}
    assert plain["Random Forest"].R2 > 0.3
    # only what fits the driver is left to Spark
    assert not G.can_grow(small["Gradient Boosting"]) and not G.can_grow(FC.estimators({"featureSubsetStrategy": "sqrt"})["Random Forest"])


def test_a_tree_of_many_nodes_is_grown_in_parts(monkeypatch):
    import numpy as np

    from hourgrid.operators import forest as G

    random = np.random.default_rng(2)
    x, y = random.integers(0, 32, (3, 4000)).astype(np.uint8), random.integers(0, 99, 4000).astype(float)
    times = G.drawn(4000, 1, 42, 1.0, True)
    assert 3800 < times.sum() < 4200 and (times != G.drawn(4000, 2, 42, 1.0, True)).any()
    whole = G.grow_tree(x, [32] * 3, set(), y, times, 18, 3, 0.0)
    monkeypatch.setattr(G, "NODES_AT_ONCE", 5)
    parts = G.grow_tree(x, [32] * 3, set(), y, times, 18, 3, 0.0)
    assert len(whole["left"]) > 500 and all((whole[k] == parts[k]).all() for k in G.KINDS)


def test_reload_compares_over_the_stored_frame(spark, small_dir, tmp_path, monkeypatch):
    """The rows that were predicted after the fit, not rows rolled up anew, whose averages may differ in the last digits."""
    from hourgrid.plans import queries as Q

    folder = str(tmp_path / "models")
    framed = Q.tables(spark, small_dir).with_frame(folder)
    FC.model_stage(framed.train, framed.evaluation, folder, FC.estimators({"numTrees": 2, "maxDepth": 3}, {"maxIter": 2}))
    monkeypatch.setattr(Q, "model_folder", lambda *_: folder)
    report = Q.trained_reload(spark, small_dir)
    assert report.inputFiles() and all(folder in f for f in report.inputFiles())
    assert {r.model: r.changed_rows for r in report.collect()} == dict.fromkeys(FC.estimators(), 0)
