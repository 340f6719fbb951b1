from datetime import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hourgrid.operators import lookups, quality, views
from hourgrid.sources import sinks
from hourgrid.sources import trips as SRC
from tests.rows import trip, trips, values, zones


def test_drifting_files_become_one_table(spark, tmp_path):
    base = trips(spark, trip(), trip(passengers=2.0))
    base.coalesce(1).write.parquet(str(tmp_path / "1"))
    base.withColumn("passenger_count", F.lit(3).cast("bigint")).withColumnRenamed("airport_fee", "Airport_fee").coalesce(1).write.parquet(str(tmp_path / "2"))
    base.drop("airport_fee").withColumn("PULocationID", F.lit(4).cast("bigint")).coalesce(1).write.parquet(str(tmp_path / "3"))
    base.withColumn("passenger_count", F.lit("x")).coalesce(1).write.parquet(str(tmp_path / "4"))
    base.where("false").coalesce(1).write.parquet(str(tmp_path / "5"))
    out = SRC.load_trips(spark, str(tmp_path))
    assert dict(out.dtypes)["PULocationID"] == "int" and dict(out.dtypes)["passenger_count"] == "double"
    assert sorted(values(out, "passenger_count"), key=str) == [1.0, 1.0, 2.0, 2.0, 3.0, 3.0, None, None]
    assert sorted(values(out, "airport_fee"), key=str) == [0.0] * 6 + [None] * 2
    (tmp_path / "none").mkdir()
    with pytest.raises(FileNotFoundError):
        SRC.load_trips(spark, str(tmp_path / "none"))


def test_csv_parts_must_share_the_header(spark, tmp_path):
    schema = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.StringType())])
    (tmp_path / "part-1.csv").write_text("a,b\n1,x\n")
    (tmp_path / "part-2.csv").write_text("a,b\n2,\n")
    assert sorted(values(SRC.scan_csv_parts(spark, str(tmp_path), schema), "a", "b")) == [(1, "x"), (2, None)]
    (tmp_path / "part-3.csv").write_text("b,a\ny,3\n")
    with pytest.raises(Exception, match="(?i)header"):
        SRC.scan_csv_parts(spark, str(tmp_path), schema).collect()


def test_typed_csv(spark, tmp_path):
    (tmp_path / "t.csv").write_text("n,x,year_month\n1,2.5,2021-03\n , ,\nq,1e2,2021-04\n")
    schema = T.StructType([T.StructField("n", T.LongType()), T.StructField("x", T.DoubleType()), T.StructField("year_month", T.StringType())])
    rows = values(SRC.typed_csv(spark, str(tmp_path / "t.csv"), schema), "n", "x", "year_month")
    assert rows == [(1, 2.5, "2021-03"), (None, None, None), (None, 100.0, "2021-04")]


def test_zone_lookup_round_trip(spark, tmp_path):
    path = str(tmp_path / "zones")
    sinks.write_table_csv(zones(spark).repartition(3), path, files=1)
    assert sorted(SRC.scan_zone_lookup(spark, path).collect()) == sorted(zones(spark).collect())
    assert len(list((tmp_path / "zones").glob("part-*.csv"))) == 1
    sinks.write_table_csv(zones(spark).repartition(3), str(tmp_path / "many"))
    assert len(list((tmp_path / "many").glob("part-*.csv"))) > 1
    assert SRC.scan_zone_lookup(spark, str(tmp_path / "many")).count() == 5


def test_parquet_and_provenance(spark, tmp_path):
    table = spark.createDataFrame([(1, "2021-01"), (2, "2021-02")], "n int, year_month string")
    sinks.write_cube_parquet(table, str(tmp_path / "cube"))
    back = SRC.scan_feature_table(spark, str(tmp_path / "cube"), ["n", "year_month"])
    assert sorted(values(back, "n", "year_month")) == [(1, "2021-01"), (2, "2021-02")]
    with pytest.raises(ValueError, match="cube lacks required columns: hour"):
        SRC.scan_feature_table(spark, str(tmp_path / "cube"), ["hour"], "cube")
    for fmt in ("parquet", "json"):
        sinks.publish_with_provenance(table, str(tmp_path / fmt), "t", "a/b", fmt)
        sinks.publish_with_provenance(table, str(tmp_path / fmt), "t", "a/b", fmt)
        rows = spark.read.format(fmt).load(str(tmp_path / fmt))
        assert rows.count() == 2 and values(rows.select("_source_table").distinct(), "_source_table") == ["t"]
        assert rows.where("_imported_at is null").count() == 0


def test_publication_is_whole_or_not_at_all(spark, tmp_path, monkeypatch):
    target = str(tmp_path / "published")
    one, two = spark.range(5).toDF("n"), spark.range(9).toDF("n")
    with pytest.raises(Exception, match="(?i)path"):
        sinks.read_published(spark, target)
    sinks.publish(one, target, "t", "a/b", "v1")
    assert sinks.read_published(spark, target).count() == 5
    stop = monkeypatch.context()
    with stop as broken:  # fails between the rows and the log
        broken.setattr(F, "current_timestamp", lambda calls=iter([F.current_timestamp()]): next(calls))
        with pytest.raises(StopIteration):
            sinks.publish(two, target, "t", "a/b", "v2")
    assert (tmp_path / "published" / "v2").exists()
    assert sinks.read_published(spark, target).count() == 5
    sinks.publish(two, target, "t", "a/b", "v2")
    sinks.publish(two.limit(1), target, "t", "a/b", "v2")  # a retry after success
    rows = sinks.read_published(spark, target)
    assert rows.count() == 9 and rows.where("_imported_at IS NULL").count() == 0
    assert values(rows.select("_source_table", "_source_path").distinct(), "_source_table", "_source_path") == [("t", "a/b")]
    sinks.publish(one.limit(0), target, "t", "a/b", "v3")
    assert sinks.read_published(spark, target).count() == 0


def test_inferred_csv(spark, tmp_path):
    rows = "".join(f"{i},{i}.5,{i},{i},,2021-0{i},{i}e1, ,{i}\n" for i in range(1, 9))
    (tmp_path / "t.csv").write_text("n,x,mixed,odd,nothing,year_month,power,blank,big\n" + rows + "9,7,1.5,q,,2021-09,5,,99999999999999999999\n")
    table = SRC.inferred_csv(spark, str(tmp_path / "t.csv"))
    assert dict(table.dtypes) == {"n": "bigint", "x": "double", "mixed": "double", "odd": "string", "nothing": "string",
                                  "year_month": "string", "power": "double", "blank": "string", "big": "string"}
    last = table.where("n = 9").first()
    assert (last.x, last.odd, last.nothing, last.year_month, last.power, last.big) == (7.0, "q", None, "2021-09", 5.0, "9" * 20)
    assert table.where("n = 3").first().power == 30.0


def test_geojson_on_one_line_is_split(spark, tmp_path):
    one = '{ "type" : "Feature", "id": %d, "properties":{"LocationID":%d,"zone":"z, {\\"type\\":[%d]}","borough":"b"},"geometry":{"type":"Polygon","coordinates":[[[0,%d.5],[1,1],[2,0],[0,%d.5]]]}}'
    n = 30_000
    text = '{"type":"FeatureCollection","crs":{"type":"name","properties":{}},"features":[' + " ,\n".join(one % ((i,) * 5) for i in range(n)) + '],"bbox":[0,1]}'
    (tmp_path / "one.json").write_text(text)
    (tmp_path / "two.json").write_text('\ufeff{"type":"FeatureCollection","features":[]}')
    (tmp_path / "three.json").write_text(('{"type":"FeatureCollection","features":[' + one % ((n,) * 5) + "]}\n") * 2)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "512k")
    try:
        got = SRC.scan_geojson(spark, str(tmp_path))
        assert got.rdd.getNumPartitions() > 5
        rows = got.collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert sorted(r.LocationID for r in rows) == sorted([*range(n), n, n])
    some = next(r for r in rows if r.LocationID == 77)
    assert (some.zone, some.borough, some.geometry_type, some.coordinates) == ('z, {"type":[77]}', "b", "Polygon", "[[[0,77.5],[1,1],[2,0],[0,77.5]]]")
    whole = SRC.scan_geojson(spark, str(tmp_path / "one.json"), whole=True)
    assert sorted(whole.collect()) == sorted(r for r in rows if r.LocationID < n)
    (tmp_path / "other").mkdir()
    (tmp_path / "other" / "x.json").write_text('{"type":"FeatureCollection","features":[{"properties":{"LocationID":1},"type":"Feature","geometry":null}]}')
    with pytest.raises(Exception, match="not a feature"):
        SRC.scan_geojson(spark, str(tmp_path / "other")).collect()


def test_drift_by_folder_and_inside_a_folder(spark, tmp_path):
    base = trips(spark, trip(), trip(passengers=2.0))
    whole = base.withColumn("passenger_count", F.lit(3).cast("bigint"))
    for month in range(1, 5):
        base.coalesce(1).write.parquet(str(tmp_path / f"y=1/{month}"))
        whole.coalesce(1).write.parquet(str(tmp_path / f"y=2/{month}"))
    out = SRC.load_trips(spark, str(tmp_path))
    assert out.count() == 16
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == 2  # one scan a schema
    whole.coalesce(1).write.mode("append").parquet(str(tmp_path / "y=1/1"))
    out = SRC.load_trips(spark, str(tmp_path))
    assert out.count() == 18 and sorted(set(values(out, "passenger_count"))) == [1.0, 2.0, 3.0]


def test_quality(spark):
    raw = trips(spark, trip(), trip(pick=datetime(2021, 1, 31, 23, 50)), trip(pick=None))
    january = ("2021-01-01 00:00:00", "2021-02-01 00:00:00")
    groups = {r.in_expected_month: r.row_count for r in quality.dq_month_membership(raw, *january).collect()}
    assert groups == {True: 1, False: 1, None: 1}
    assert quality.dq_outside_rows(raw, *january).count() == 1
    assert quality.dq_time_range(raw).first().null_pickup_time == 1
    profile = quality.dq_profile(raw)
    assert profile["row_count"].first().row_count == 3 and profile["sample"].count() == 3
    assert profile["schema"].count() == len(raw.columns)
    years = spark.createDataFrame([(2021,), (2021,), (2026,)], "year int")
    assert values(quality.dq_expected_years(years, [2021, 2022]), "year", "status") == [(2022, "missing"), (2026, "extra")]
    bad = spark.sql("select date'2021-02-03' pickup_date, 2021 year, 3 month, '2021-02' year_month, 5 hour, 'z' pickup_zone, 1 trip_count")
    row = quality.dq_date_consistency(bad).first()
    assert (row.bad_year_count, row.bad_month_count, row.bad_year_month_count) == (0, 1, 0)
    assert values(quality.dq_inconsistent_rows(bad), "month_from_date") == [2]
    assert values(quality.dq_missing_months(bad, "2021-01", "2021-03"), "expected_year_month") == ["2021-01", "2021-03"]
    assert values(quality.dq_unexpected_months(bad, "2021-03", "2021-05"), "year_month") == ["2021-02"]


def test_lookup_rules(spark):
    table = spark.createDataFrame([(1, "a", 3), (2, "b", 3), (3, None, 9)], "route_rank int, route_key string, trip_count int")
    assert lookups.asked_limit(0, 25) == 25 and lookups.asked_limit(900, 25) == 900
    assert values(lookups.scoped_lookup(table, {"route_key": None}, ["-trip_count", "route_key"], 2, ["route_key"]), "route_key") == [None, "a"]
    assert values(lookups.scoped_lookup(table, {"route_key": "b"}), "route_rank") == [2]
    assert lookups.resolve("temporal_hourly", year=None)[0] == "hourly_demand"
    assert lookups.resolve("temporal_hourly", year=2020)[:2] == ("year_hourly_pattern", {"year": 2020})
    assert lookups.resolve("spatial_zones_by_hour", limit=7)[3] is None
    assert lookups.resolve("spatial_zones_by_hour", limit=7, hour=3)[3] == 7
    with pytest.raises(ValueError, match="no parameter year"):
        lookups.resolve("routes_top", year=2020)


def test_stories_are_bundles_of_lookups(spark):
    from hourgrid.operators.lookups import PRESETS

    wide = {p.table for p in PRESETS.values()} | {p.yearly[0] for p in PRESETS.values() if p.yearly}
    names = {c.lstrip("-") for p in PRESETS.values() for c in [*p.sort, *p.key, *p.filters.values(), *(p.yearly[1] if p.yearly else [])]}
    row = spark.range(1).select(*[F.lit(1).cast("string").alias(n) for n in sorted(names)])
    get = {t: row for t in wide}.__getitem__
    assert set(lookups.overview(get, 2021)) == {"kpi", "yearly_summary", "year_month_demand", "hourly_demand", "weekday_hour_heatmap", "top_zones", "top_routes"}
    assert len(lookups.temporal_story(get, 2021, "B")) == 10
    assert len(lookups.spatial_story(get, hour=3)) == 3
    assert len(lookups.routes_story(get)) == 8
    assert set(lookups.business_story(get)) == {"payment_type", "trip_behavior_by_hour"}
    assert len(lookups.forecast_story(get)) == 8


def test_primary_years_fall_back_to_all(spark):
    days = spark.sql("select year, make_date(year, 1, cast(d as int)) pickup_date, 1L total_trips, 2.0D total_revenue, 1 month "
                     "from (select explode(sequence(1, 31)) d), (select explode(array(2021)) year) "
                     "union all select 2019, date'2019-01-01', 5L, 1.0D, 1")
    assert values(views.primary_years(days), "year") == [2021]
    assert values(views.primary_years(days.where("year = 2019")), "year") == [2019]
    kpi = views.scoped_daily_kpis(days).first()
    assert (kpi.total_trips, kpi.active_days, kpi.avg_revenue_per_day) == (31, 31, 2.0)
    empty = views.scoped_daily_kpis(days.where("false")).first()
    assert (empty.total_trips, empty.avg_trips_per_day) == (0, 0.0)
    months = spark.createDataFrame([(2019, 1), (2021, 1), (2021, 2)], "year int, month int")
    assert values(views.scoped_monthly(months, days), "year", "month") == [(2021, 1)]


def test_date_window_reaches_the_scan(spark, tmp_path):
    from hourgrid.operators import clean

    trips(spark, trip()).write.parquet(str(tmp_path / "raw"))
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    try:
        cleaned = clean.clean_trips(spark.read.parquet(str(tmp_path / "raw")), zones(spark))
        plan = cleaned._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    scan = next(line for line in plan.splitlines() if "tpep_pickup_datetime" in line and "FileScan" in line)
    assert "GreaterThanOrEqual(fare_amount,0.0)" in scan
    assert "GreaterThanOrEqual(tpep_pickup_datetime,2021-01-01T00:00)" in scan
