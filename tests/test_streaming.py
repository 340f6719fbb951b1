from datetime import datetime

from hourgrid.streaming import demand as ST
from tests.rows import values

DDL = "pickup_ts timestamp_ntz, PULocationID int, total_amount double"


def put(spark, folder, *rows):
    spark.createDataFrame(list(rows), DDL).coalesce(1).write.mode("append").parquet(folder)


def run(spark, start, source, target, log):
    stream = ST.trip_stream(spark, source, DDL, per_batch=1)
    start(stream, target, log).awaitTermination()


def hour(h, m=0, zone=1, amount=1.0):
    return (datetime(2024, 1, 1, h, m), zone, amount)


def test_late_rows_drop_and_open_windows_wait(spark, tmp_path):
    source, target, log = (str(tmp_path / n) for n in ("in", "out", "log"))
    put(spark, source, hour(8, 5), hour(8, 50, amount=2.0), hour(8, 10, zone=2))
    run(spark, ST.start_zone_demand, source, target, log)
    put(spark, source, hour(9, 20), hour(8, 55))  # 8:55 is late but within the watermark (8:20)
    run(spark, ST.start_zone_demand, source, target, log)
    put(spark, source, hour(11, 0))  # watermark 10:30 closes 8 and 9 o'clock
    run(spark, ST.start_zone_demand, source, target, log)
    put(spark, source, hour(8, 59, amount=99.0), hour(11, 5))  # too late
    run(spark, ST.start_zone_demand, source, target, log)
    run(spark, ST.start_zone_demand, source, target, log)  # nothing new: nothing twice
    out = spark.read.parquet(target)
    assert sorted(values(out, "window_start", "PULocationID", "trip_count", "total_revenue")) == [
        (datetime(2024, 1, 1, 8), 1, 3, 4.0), (datetime(2024, 1, 1, 8), 2, 1, 1.0), (datetime(2024, 1, 1, 9), 1, 1, 1.0),
    ]


def test_back_fill_from_unsorted_files_loses_nothing(spark, tmp_path):
    source, target, log = (str(tmp_path / n) for n in ("in", "out", "log"))
    for h in (20, 3, 15, 8, 1, 11):
        put(spark, source, hour(h), hour(h, 30))
    query = ST.start_zone_demand(ST.trip_stream(spark, source, DDL), target, log)
    query.awaitTermination()
    assert ST.late_rows(query) == 0
    assert sorted(values(spark.read.parquet(target), "trip_count")) == [2] * 5
    put(spark, source, hour(2), hour(4))  # behind the watermark of the run before
    query = ST.start_zone_demand(ST.trip_stream(spark, source, DDL), target, log)
    query.awaitTermination()
    assert ST.late_rows(query) == 2


def test_hotspots_rank_closed_windows(spark, tmp_path):
    source, target, log = (str(tmp_path / n) for n in ("in", "out", "log"))
    put(spark, source, hour(8, 5), hour(8, 6), hour(8, 7, zone=2), hour(8, 7, zone=3, amount=0.5), hour(12))
    stream = ST.trip_stream(spark, source, DDL)
    ST.start_hotspots(stream, target, log, top_n=2).awaitTermination()
    out = spark.read.parquet(target)
    assert sorted(values(out, "hotspot_rank", "PULocationID")) == [(1, 1), (2, 2)]


def test_batch_and_speed_meet_at_the_cutoff(spark):
    rows = spark.createDataFrame([hour(8), hour(9), hour(10)], DDL)
    table = ST.zone_demand(rows)
    merged = ST.batch_speed_merge(table, table.withColumn("trip_count", table.trip_count + 10), "2024-01-01 09:00:00")
    assert sorted(values(merged, "trip_count")) == [1, 11, 11]


def test_live_view_equals_the_batch_at_every_cutoff(spark, tmp_path):
    source, target, log = (str(tmp_path / n) for n in ("in", "live", "log"))
    parts = [[hour(8, 5), hour(8, 50, amount=2.0)], [hour(9, 20), hour(8, 55)], [hour(10, 1, zone=2), hour(9, 59)], [hour(10, 30)]]
    for part in parts:
        put(spark, source, *part)
        run(spark, ST.start_live_demand, source, target, log)
    batch = ST.zone_demand(spark.createDataFrame([r for p in parts for r in p], DDL))
    columns = ("window_start", "PULocationID", "trip_count", "total_revenue")
    want = sorted(values(batch, *columns))
    live = ST.live_demand(spark, target)
    assert sorted(values(live, *columns)) == want
    for h in range(7, 12):
        assert sorted(values(ST.batch_speed_merge(batch, live, f"2024-01-01 {h:02d}:00:00"), *columns)) == want


def test_replay_goes_on_behind_its_last_file(spark, tmp_path):
    staged, source, target, log = (str(tmp_path / n) for n in ("staged", "files", "out", "log"))
    rows = [hour(h, m) for h in (20, 3, 15, 8, 11) for m in (0, 30)] + [(None, 1, 1.0)]
    ST.stage_replay(spark.createDataFrame(rows, DDL), staged, seconds=1800)
    assert ST.replay(spark, staged, source, most=4) == 4
    times = sorted(values(spark.read.parquet(source), "pickup_ts"))
    assert times == [datetime(2024, 1, 1, h, m) for h in (3, 8) for m in (0, 30)]
    run(spark, ST.start_zone_demand, source, target, log)
    assert ST.replay(spark, staged, source, speed_up=1e7) == 6  # a stop and a restart of both
    assert ST.replay(spark, staged, source) == 0
    run(spark, ST.start_zone_demand, source, target, log)
    out = spark.read.parquet(target)
    assert sorted(values(out, "window_start", "trip_count")) == [(datetime(2024, 1, 1, h), 2) for h in (3, 8, 11, 15)]
