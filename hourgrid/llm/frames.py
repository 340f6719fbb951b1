"""Small helpers for the frames of this subpackage."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from hourgrid.session import ready, scratch_path


def stored(df: DataFrame, label: str, compression: str | None = None) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back: its lineage ends here."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def extended(schema: T.StructType, new: str) -> T.StructType:
    """``schema`` with the fields of the DDL text ``new`` behind; equal names are replaced."""
    fields = T.StructType.fromDDL(new).fields
    names = {f.name for f in fields}
    return T.StructType([f for f in schema.fields if f.name not in names] + fields)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def row_key(id_col: str, text_col: str) -> "F.Column":
    """Tells rows apart that share an id but not a text; equal rows share a key."""
    return F.xxhash64(F.col(id_col), F.col(text_col))


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    """A registered query: ``f`` on a session whose workers can import the package."""

    @wraps(f)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return f(ready(spark), sf_dir)

    return run
