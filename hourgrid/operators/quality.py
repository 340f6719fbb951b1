"""Data-quality checks as tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hourgrid import schema as S

_TIMES = {"pickup": S.PICKUP_TIME, "dropoff": S.DROPOFF_TIME}
_TRIP_VIEW = [S.PICKUP_TIME, S.DROPOFF_TIME, S.PU, S.DO, S.DISTANCE, S.TOTAL]
_CUBE_VIEW = [
    "pickup_date", "year", "month", "year_month", "hour", "pickup_zone", "pickup_borough", "trip_count",
]


def dq_profile(table: DataFrame, rows: int = 5) -> dict[str, DataFrame]:
    """Schema, row count and a few sample rows of a table."""
    spark = table.sparkSession
    fields = [(i, f.name, f.dataType.simpleString(), f.nullable) for i, f in enumerate(table.schema.fields)]
    return {
        "schema": spark.createDataFrame(fields, "position int, name string, type string, nullable boolean"),
        "row_count": table.agg(F.count(F.lit(1)).alias("row_count")),
        "sample": table.limit(rows),
    }


def column_profile(table: DataFrame, samples: int = 3, rsd: float = 0.02) -> DataFrame:
    """A row per column, from one pass: type, rows, nulls, least and greatest value, distincts, samples.

    Numbers and dates or texts have their own columns for the extremes. ``distinct_estimate``
    is a HyperLogLog count with relative standard deviation ``rsd``; samples are the values of
    smallest hash, one a seed, so they do not depend on how rows are dealt.
    """
    def line(at: int, name: str, kind: T.DataType) -> Column:
        c = F.col(f"`{name}`")
        number = c.cast("double") if isinstance(kind, T.NumericType) else F.lit(None).cast("double")
        text = F.lit(None).cast("string") if isinstance(kind, T.NumericType) else c.cast("string")
        return F.struct(
            F.lit(at).alias("position"), F.lit(name).alias("name"), F.lit(kind.simpleString()).alias("type"),
            F.count(F.lit(1)).alias("row_count"), F.count_if(c.isNull()).alias("null_count"),
            F.min(number).alias("min_number"), F.max(number).alias("max_number"),
            F.min(text).alias("min_text"), F.max(text).alias("max_text"),
            F.approx_count_distinct(c, rsd).alias("distinct_estimate"),
            F.array_distinct(F.array_compact(F.array(*[
                F.min_by(c.cast("string"), F.xxhash64(c, F.lit(seed))) for seed in range(samples)
            ]))).alias("samples"),
        )

    fields = table.schema.fields
    lines = table.agg(*[line(i, f.name, f.dataType).alias(f"c{i}") for i, f in enumerate(fields)])
    return lines.select(F.inline(F.array(*[f"c{i}" for i in range(len(fields))])))


def dq_time_range(trips: DataFrame) -> DataFrame:
    """First and last pickup and dropoff, and how many of each are missing."""
    parts = []
    for side, c in _TIMES.items():
        parts += [F.min(c).alias(f"min_{side}_time"), F.max(c).alias(f"max_{side}_time")]
    parts += [F.count_if(F.col(c).isNull()).alias(f"null_{side}_time") for side, c in _TIMES.items()]
    return trips.agg(*parts)


def _inside(start: str, end: str) -> Column:
    low, high = (F.lit(t).cast("timestamp_ntz") for t in (start, end))
    return (F.col(S.PICKUP_TIME) >= low) & (F.col(S.PICKUP_TIME) < high)


def dq_month_membership(trips: DataFrame, start: str, end: str) -> DataFrame:
    """Rows inside and outside [start, end); rows without a pickup time are a third group."""
    return trips.groupBy(_inside(start, end).alias("in_expected_month")).agg(
        F.count(F.lit(1)).alias("row_count")
    )


def dq_rows_by_month(trips: DataFrame) -> DataFrame:
    """Rows per pickup month, dropoff month and pickup year, from one scan."""
    kinds = {
        "pickup_month": F.date_format(S.PICKUP_TIME, "yyyy-MM"),
        "dropoff_month": F.date_format(S.DROPOFF_TIME, "yyyy-MM"),
        "pickup_year": F.date_format(S.PICKUP_TIME, "yyyy"),
    }
    lines = F.array(*[F.struct(F.lit(k).alias("kind"), v.alias("period")) for k, v in kinds.items()])
    return (
        trips.select(F.explode(lines).alias("l"))
        .groupBy(F.col("l.kind").alias("kind"), F.col("l.period").alias("period"))
        .agg(F.count(F.lit(1)).alias("row_count"))
        .orderBy("kind", "period")
    )


def dq_outside_rows(trips: DataFrame, start: str, end: str) -> DataFrame:
    """Raw rows whose pickup lies outside [start, end)."""
    return trips.where(~_inside(start, end)).select(*_TRIP_VIEW)


def dq_outside_years(cube: DataFrame, first: int, last: int) -> DataFrame:
    """Cube rows whose stored year lies outside [first, last]."""
    return cube.where(~F.col("year").between(first, last)).select(*_CUBE_VIEW).orderBy("pickup_date", "hour")


def dq_hour_distribution(cube: DataFrame) -> DataFrame:
    """Rows per hour, each with the smallest and largest hour of the table."""
    hours = cube.groupBy("hour").agg(F.count(F.lit(1)).alias("row_count"))
    ends = hours.agg(
        F.struct(F.min("hour").alias("min_hour"), F.max("hour").alias("max_hour")).alias("e"),
        F.collect_list(F.struct("hour", "row_count")).alias("rows"),  # at most 24 and null
    )
    return ends.select(F.explode("rows").alias("r"), "e.*").select("r.*", "min_hour", "max_hour").orderBy("hour")


def dq_expected_years(rows: DataFrame, expected: list[int], year: str = "year") -> DataFrame:
    """Expected years without rows and years that were not expected."""
    wanted = rows.sparkSession.createDataFrame([(y,) for y in expected], "year int")
    present = rows.select(F.col(year).alias("year")).where(F.col(year).isNotNull()).distinct()
    missing = wanted.join(present, "year", "left_anti").withColumn("status", F.lit("missing"))
    extra = present.where(~F.col("year").isin(expected)).withColumn("status", F.lit("extra"))
    return missing.unionByName(extra).orderBy("year")


def _disagreements(date: str) -> dict[str, Column]:
    return {
        "year": F.col("year") != F.year(date),
        "month": F.col("month") != F.month(date),
        "year_month": F.col("year_month") != F.date_format(date, "yyyy-MM"),
    }


def dq_date_consistency(cube: DataFrame) -> DataFrame:
    """How many rows store a year, month or year-month that their date contradicts."""
    tests = _disagreements("pickup_date")
    return cube.agg(*[F.count_if(t).alias(f"bad_{n}_count") for n, t in tests.items()])


def dq_inconsistent_rows(cube: DataFrame) -> DataFrame:
    """The rows behind ``dq_date_consistency``, with the values their date implies."""
    tests = list(_disagreements("pickup_date").values())
    return cube.where(tests[0] | tests[1] | tests[2]).select(
        "pickup_date",
        "year", F.year("pickup_date").alias("year_from_date"),
        "month", F.month("pickup_date").alias("month_from_date"),
        "year_month", F.date_format("pickup_date", "yyyy-MM").alias("year_month_from_date"),
        "hour", "pickup_zone", "trip_count",
    )


def dq_missing_months(rows: DataFrame, first: str, last: str, month: str = "year_month") -> DataFrame:
    """Calendar months in [first, last] (``yyyy-MM``) that no row falls into."""
    span = rows.sparkSession.range(1).select(F.explode(F.sequence(
        F.lit(f"{first}-01").cast("date"), F.lit(f"{last}-01").cast("date"),
        F.expr("interval 1 month"),
    )).alias("d"))
    calendar = span.select(
        F.year("d").alias("expected_year"), F.month("d").alias("expected_month"),
        F.date_format("d", "yyyy-MM").alias("expected_year_month"),
    )
    present = rows.select(F.col(month).alias("__m")).distinct()
    missing = calendar.join(present, F.col("expected_year_month") == F.col("__m"), "left_anti")
    return missing.orderBy("expected_year_month")


def dq_unexpected_months(rows: DataFrame, first: str, last: str, month: str = "year_month") -> DataFrame:
    """Months that occur in the rows but lie outside [first, last]."""
    outside = ~F.col(month).between(first, last)
    return rows.where(outside).select(F.col(month).alias("year_month")).distinct().orderBy("year_month")


dq_required_columns = S.require_columns
