"""Streaming extension: live zone demand, hotspots per closed window, batch-speed merge."""

from __future__ import annotations

from time import sleep

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from hourgrid import schema as S

WINDOW = "1 hour"
LATE = "30 minutes"


def trip_stream(spark: SparkSession, folder: str, schema, pattern: str = "*.parquet", per_batch: int | None = None) -> DataFrame:
    """Trip files as a stream; every trigger takes all files that are new.

    So a back-fill is one micro-batch, and the watermark moves only after all of it. With
    ``per_batch`` files a trigger, files must arrive in the order of their times: the watermark
    advances between micro-batches, and rows older than it are dropped as late.
    """
    reader = spark.readStream.schema(schema).option("pathGlobFilter", pattern)
    return (reader.option("maxFilesPerTrigger", per_batch) if per_batch else reader).parquet(folder)


def late_rows(query: StreamingQuery) -> int:
    """Rows (partial sums, after map-side aggregation) that the watermark has dropped so far."""
    return sum(s.numRowsDroppedByWatermark for p in query.recentProgress for s in p.stateOperators)


def zone_demand(trips: DataFrame, time: str = "pickup_ts", window: str = WINDOW, late: str = LATE) -> DataFrame:
    """Trips and revenue per zone and tumbling window; rows later than the watermark drop.

    Event time must be a zoned timestamp for watermarks, hence the cast; results carry
    zone-less times. Works on a stream and, for back-fills, on a batch.
    """
    events = trips.withColumn("__t", F.col(time).cast("timestamp"))
    return (
        events.withWatermark("__t", late)
        .groupBy(F.window("__t", window).alias("w"), S.PU)
        .agg(F.count(F.lit(1)).alias("trip_count"), F.sum(S.TOTAL).alias("total_revenue"))
        .select(
            F.col("w.start").cast("timestamp_ntz").alias("window_start"),
            F.col("w.end").cast("timestamp_ntz").alias("window_end"),
            S.PU, "trip_count", "total_revenue",
        )
    )


def start_zone_demand(trips: DataFrame, target: str, checkpoint: str, available_now: bool = True, **kw) -> StreamingQuery:
    """Append every closed window to a Parquet folder (exactly once, by the file sink's log)."""
    writer = (
        zone_demand(trips, **kw).writeStream.outputMode("append").format("parquet")
        .option("path", target).option("checkpointLocation", checkpoint)
    )
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def hotspots(demand: DataFrame, top_n: int = 3) -> DataFrame:
    """Zones with dense rank at most n by trips, revenue in each window."""
    order = Window.partitionBy("window_start").orderBy(F.desc("trip_count"), F.desc("total_revenue"))
    return demand.withColumn("hotspot_rank", F.dense_rank().over(order)).where(F.col("hotspot_rank") <= top_n)


def start_hotspots(trips: DataFrame, target: str, checkpoint: str, top_n: int = 3, available_now: bool = True, **kw) -> StreamingQuery:
    """Rank the zones of each closed window.

    A closed window leaves the append-mode aggregation in a single micro-batch, so ranking
    inside the batch sees all of its zones. Each batch overwrites its own folder, so a
    batch that is replayed after a failure leaves no copies.
    """

    def rank_batch(batch: DataFrame, number: int) -> None:
        hotspots(batch, top_n).write.mode("overwrite").parquet(f"{target}/batch={number}")

    writer = (
        zone_demand(trips, **kw).writeStream.outputMode("append")
        .foreachBatch(rank_batch).option("checkpointLocation", checkpoint)
    )
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def batch_speed_merge(batch: DataFrame, speed: DataFrame, cutoff: str, time: str = "window_start") -> DataFrame:
    """Batch rows before the cut-off and stream rows from it on, under one schema."""
    edge = F.lit(cutoff).cast("timestamp_ntz")
    return batch.where(F.col(time) < edge).unionByName(speed.where(F.col(time) >= edge))


# --- live view: open windows too --------------------------------------------------------------

def start_live_demand(trips: DataFrame, target: str, checkpoint: str, available_now: bool = True, **kw) -> StreamingQuery:
    """Every changed window, open ones included, as the update of its micro-batch.

    A batch overwrites its own folder, so one that is replayed leaves no copies; ``live_demand``
    reads the last update of every window and zone.
    """
    def put(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{target}/batch={number}")

    writer = (
        zone_demand(trips, **kw).writeStream.outputMode("update")
        .foreachBatch(put).option("checkpointLocation", checkpoint)
    )
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def live_demand(spark: SparkSession, target: str) -> DataFrame:
    """The newest row of every window and zone (an upsert on reading; one fold per key, map-side)."""
    updates = spark.read.parquet(target)
    keys = ["window_start", "window_end", S.PU]
    newest = F.max_by(F.struct("trip_count", "total_revenue"), "batch").alias("n")
    return updates.groupBy(*keys).agg(newest).select(*keys, "n.*")


# --- replay of history as a watched stream of small files ---------------------------------------

_SLICE = "replay_slice"


def stage_replay(trips: DataFrame, folder: str, seconds: int, time: str = "pickup_ts") -> None:
    """Deal history by slices of event time, ``seconds`` long, in one pass; a slice is a partition folder."""
    stamp = F.unix_timestamp(F.col(time).cast("timestamp"))
    sliced = trips.where(F.col(time).isNotNull()).withColumn(_SLICE, F.floor(stamp / seconds) * seconds)
    sliced.hint("rebalance", _SLICE).write.mode("overwrite").partitionBy(_SLICE).parquet(folder)


def replay(spark: SparkSession, staged: str, target: str, speed_up: float | None = None, most: int | None = None) -> int:
    """Put the staged slices that ``target`` does not have yet into it, oldest first; how many.

    A slice is one file, which appears whole by a rename, so a replay that was stopped goes on
    behind its last file. Time runs ``speed_up`` times as fast as it did (None: without
    waiting); ``most`` slices are put. Slices should be short enough for small files.
    """
    slices = spark.read.parquet(staged)
    known = sorted(r[_SLICE] for r in slices.select(_SLICE).distinct().collect())  # one a slice of the calendar
    try:
        last = spark.read.parquet(target).agg(F.max(_SLICE)).first()[0]
    except AnalysisException as error:
        if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        last = None
    todo = [s for s in known if last is None or s > last][:most]
    for before, at in zip([None, *todo], todo):
        if speed_up and before is not None:
            sleep((at - before) / speed_up)
        rows = slices.where(F.col(_SLICE) == at)
        rows.coalesce(1).write.mode("append").parquet(target)
    return len(todo)
