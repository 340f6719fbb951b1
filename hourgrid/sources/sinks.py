"""Table sinks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_table_parquet(table: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Overwrite a Parquet folder; the cube is best partitioned by ``year_month``."""
    writer = table.write.mode("overwrite")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def write_cube_parquet(cube: DataFrame, path: str) -> None:
    """The cube by month; rows of a month meet before the write, so months are not split
    into one small file per task, and the rebalance splits a month that is too large."""
    write_table_parquet(cube.hint("rebalance", "year_month"), path, ["year_month"])


def write_table_csv(table: DataFrame, path: str, files: int | None = None) -> None:
    """Overwrite a folder of CSV parts with header; ``files`` asks for so many parts at any size."""
    rows = table.repartition(files) if files else table
    rows.write.mode("overwrite").option("header", True).csv(path)


def with_provenance(table: DataFrame, name: str, source: str) -> DataFrame:
    """The table plus its name, source path and import time in every row."""
    return table.withColumns({
        "_source_table": F.lit(name),
        "_source_path": F.lit(source),
        "_imported_at": F.current_timestamp(),
    })


def publish_with_provenance(table: DataFrame, target: str, name: str, source: str, fmt: str = "parquet") -> None:
    """Replace the target with the table plus its provenance; readers meanwhile find nothing (see ``publish``)."""
    with_provenance(table, name, source).write.mode("overwrite").format(fmt).save(target)


_LOG = "version string, published_at timestamp"


def _log(spark: SparkSession, target: str) -> DataFrame:
    """One row per publication; empty where nothing has been published."""
    return spark.read.schema(_LOG).option("pathGlobFilter", "*.json").json(f"{target}/log")


def publish(table: DataFrame, target: str, name: str, source: str, version: str) -> None:
    """Publish a version of the table, with its provenance, as a whole or not at all.

    The rows go to a folder of their own; only then one more file in the log, which appears
    by a single rename, makes it the current version. Readers see the version before or this
    one, never a part. A run that failed half-way is repeated under the same ``version``: its
    folder is overwritten if it was not published, and left alone if it was.
    """
    spark = table.sparkSession
    first = spark.createDataFrame([], _LOG)
    first.coalesce(1).write.mode("append").json(f"{target}/log")  # the folder exists from now on
    if _log(spark, target).where(F.col("version") == version).isEmpty():
        with_provenance(table, name, source).write.mode("overwrite").parquet(f"{target}/{version}")
        entry = spark.range(1).select(F.lit(version).alias("version"), F.current_timestamp().alias("published_at"))
        entry.coalesce(1).write.mode("append").json(f"{target}/log")


def read_published(spark: SparkSession, target: str) -> DataFrame:
    """The current version: the one that was published last."""
    last = _log(spark, target).agg(F.max_by("version", F.struct("published_at", "version")).alias("v")).first().v
    if last is None:
        raise FileNotFoundError(f"nothing is published in {target}")
    return spark.read.parquet(f"{target}/{last}")
