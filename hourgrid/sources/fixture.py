"""Trip-shaped data derived from the star-schema tables (FIXTURES.md)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hourgrid import schema as S

EVENT_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("props", T.StringType()),
])


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def raw_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One trip per line item, every 50th order's trips twice.

    Orders meet their customers first, so the large line-item side is shuffled once for the
    orders and once for the suppliers (or not at all while those are small). The copies are
    made after the joins from the same rows instead of by a second scan.
    """
    orders = read(spark, sf_dir, "orders").join(
        read(spark, sf_dir, "customer").select("c_custkey", "c_nationkey"),
        F.col("o_custkey") == F.col("c_custkey"),
    )
    lines = (
        read(spark, sf_dir, "lineitem")
        .join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(
            read(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey"),
            F.col("l_suppkey") == F.col("s_suppkey"),
        )
    )

    def minutes(n: Column) -> Column:
        return F.make_dt_interval(F.lit(0), F.lit(0), n.cast("int"), F.lit(0))

    def part_of_fare(rate: str) -> Column:
        return F.floor(F.col("fare_cents") * F.round(F.col(rate) * 100) / 100)

    airport_fee = F.when(F.col("c_nationkey") % 10 == 1, 1.75).otherwise(0.0)
    cents = (
        lines.withColumn("fare_cents", F.round(F.col("l_extendedprice") / 10))
        .withColumns({"tip_cents": part_of_fare("l_discount"), "tolls_cents": part_of_fare("l_tax")})
        .withColumn("total_cents", F.col("fare_cents") + F.col("tip_cents") + F.col("tolls_cents") + airport_fee * 100)
    )
    pickup = F.col("o_orderdate") + minutes((F.col("l_orderkey") * 37 + F.col("l_linenumber") * 211) % 1440)
    trips = cents.select(
        pickup.alias(S.PICKUP_TIME),
        (pickup + minutes(F.col("l_partkey") % 95 - 3)).alias(S.DROPOFF_TIME),
        F.col("c_nationkey").alias(S.PU),
        F.col("s_nationkey").alias(S.DO),
        F.when(F.col("l_quantity") == 50, -1.0).otherwise((F.col("l_quantity") - 1) * 0.625).alias(S.DISTANCE),
        F.when(F.col("l_linenumber") != 7, (F.col("l_linenumber") - 1).cast("double")).alias(S.PASSENGERS),
        (F.col("fare_cents") / 100).alias(S.FARE),
        (F.col("total_cents") / 100).alias(S.TOTAL),
        (F.col("l_suppkey") % 8).alias("VendorID"),
        F.col("l_linenumber").cast("double").alias("RatecodeID"),
        F.when(F.col("l_linestatus") == "O", "Y")
        .when((F.col("l_linestatus") == "F") & (F.col("l_returnflag") == "A"), "N")
        .alias("store_and_fwd_flag"),
        F.substring("o_orderpriority", 1, 1).cast("bigint").alias("payment_type"),
        (F.col("tip_cents") / 100).alias("tip_amount"),
        (F.col("tolls_cents") / 100).alias("tolls_amount"),
        airport_fee.alias("airport_fee"),
        F.when(F.col("l_orderkey") % 50 == 0, 2).otherwise(1).alias("__copies"),
    )
    twice = F.explode(F.sequence(F.lit(1), "__copies"))
    return trips.withColumn("__copy", twice).drop("__copy", "__copies")


def zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations with their region as zone dimension; nation 23 is missing on purpose."""
    joined = read(spark, sf_dir, "nation").join(
        read(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    key = F.col("n_nationkey")
    no_name = F.when(key == 22, "N/A")
    ewr = F.when(key == 24, "EWR")
    service = (
        F.when(key % 10 == 1, "Airports").when(F.col("n_regionkey") == 0, "Yellow Zone").otherwise("Boro Zone")
    )
    return joined.where(key != 23).select(
        key.cast("int").alias("LocationID"),
        F.coalesce(no_name, ewr, "r_name").alias("Borough"),
        F.coalesce(no_name, F.col("n_name")).alias("Zone"),
        F.coalesce(no_name, ewr, service).alias("service_zone"),
    )


def _square(x: Column, y: Column, side: Column) -> Column:
    corners = [(x, y), (x + side, y), (x + side, y + side), (x, y + side), (x, y)]
    return F.array(*[F.array(a, b) for a, b in corners])


def area_documents(areas: DataFrame) -> DataFrame:
    """One FeatureCollection text per row of (LocationID, zone, borough).

    Squares on a grid; ids divisible by 6 have a second, detached part, ids that leave 1
    modulo 5 a hole, ids divisible by 35 no area.
    """
    key = F.col("LocationID")
    x, y = (key % 360).cast("double"), F.floor(key / 360).cast("double")
    side = F.when(key % 35 == 0, 0.0).otherwise(1 + (key % 4) * 0.25)
    outer = _square(x, y, side)
    hole = _square(x + 0.25, y + 0.25, F.lit(0.5))
    second = F.array(_square(x + 4, y + 2, F.lit(0.5)))
    rings = F.when(key % 5 == 1, F.array(outer, hole)).otherwise(F.array(outer))

    def document(kind: str, coordinates: Column) -> Column:
        feature = F.struct(
            F.lit("Feature").alias("type"),
            F.struct("LocationID", "zone", "borough").alias("properties"),
            F.struct(F.lit(kind).alias("type"), coordinates.alias("coordinates")).alias("geometry"),
        )
        return F.to_json(F.struct(F.lit("FeatureCollection").alias("type"), F.array(feature).alias("features")))

    both = document("MultiPolygon", F.array(rings, second))
    return areas.select(F.when(key % 6 == 0, both).otherwise(document("Polygon", rings)).alias("value"))


def customer_areas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One area per customer; the first ids coincide with zones of the lookup.

    Dealt to all tasks while narrow: a file of a few megabytes has many customers and is one task.
    """
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return read(spark, sf_dir, "customer").repartition(tasks).select(
        F.col("c_custkey").cast("int").alias("LocationID"),
        F.col("c_name").alias("zone"),
        F.col("c_mktsegment").alias("borough"),
    )


def zone_areas(spark: SparkSession, sf_dir: str) -> DataFrame:
    return zones(spark, sf_dir).select("LocationID", F.col("Zone").alias("zone"), F.col("Borough").alias("borough"))


def event_trips(events: DataFrame) -> DataFrame:
    """Events in the columns that the streaming jobs need."""
    return events.select(
        F.col("ts").alias("pickup_ts"),
        F.col("user_id").cast("int").alias(S.PU),
        F.col("value").alias(S.TOTAL),
    )
