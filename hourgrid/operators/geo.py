"""Zone geometry: exterior rings, ring centroids, zone centroids.

A feature's coordinates already sit in its own row, so everything here is row-local
(higher-order functions over arrays); nothing is exploded into a shuffle and back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

POINT = "array<double>"
RING = f"array<{POINT}>"
POLYGON = f"array<{RING}>"
MULTIPOLYGON = f"array<{POLYGON}>"
NO_AREA = 1e-12  # fixed value: rings below this signed area count as degenerate


def with_exterior_rings(features: DataFrame) -> DataFrame:
    """Add ``rings``: the first ring of each polygon; holes are ignored.

    Expects ``geometry_type`` and the coordinates as JSON text in ``coordinates``.
    """
    polygon = F.from_json("coordinates", POLYGON)
    parts = F.from_json("coordinates", MULTIPOLYGON)
    rings = (
        F.when(F.col("geometry_type") == "Polygon", F.slice(polygon, 1, 1))
        .when(
            F.col("geometry_type") == "MultiPolygon",
            F.transform(F.filter(parts, lambda p: F.size(p) > 0), lambda p: F.get(p, 0)),
        )
    )
    return features.withColumn("rings", F.coalesce(rings, F.array().cast(POLYGON)))


def exterior_rings(features: DataFrame) -> DataFrame:
    """One row per exterior ring."""
    return with_exterior_rings(features).select(
        "LocationID", F.posexplode("rings").alias("ring_index", "ring")
    )


def _centroid(ring: Column) -> Column:
    """(area, x, y) of a ring by the shoelace formula; zeros for degenerate rings."""
    following = F.concat(F.slice(ring, 2, F.size(ring)), F.slice(ring, 1, 1))

    def edge(a: Column, b: Column) -> Column:
        ax, ay, bx, by = F.get(a, 0), F.get(a, 1), F.get(b, 0), F.get(b, 1)
        cross = ax * by - bx * ay
        return F.struct(
            cross.alias("c"), ((ax + bx) * cross).alias("x"), ((ay + by) * cross).alias("y")
        )

    zero = F.struct(*[F.lit(0.0).alias(n) for n in ("c", "x", "y")])
    total = F.aggregate(
        F.zip_with(ring, following, edge),
        zero,
        lambda acc, e: F.struct(*[(acc[n] + e[n]).alias(n) for n in ("c", "x", "y")]),
        lambda acc: F.struct(
            (acc["c"] / 2).alias("area"), acc["x"].alias("x"), acc["y"].alias("y")
        ),
    )
    solid = (F.size(ring) >= 3) & (F.abs(total["area"]) >= NO_AREA)
    return F.struct(
        F.when(solid, total["area"]).otherwise(0.0).alias("area"),
        F.when(solid, total["x"] / (total["area"] * 6)).otherwise(0.0).alias("x"),
        F.when(solid, total["y"] / (total["area"] * 6)).otherwise(0.0).alias("y"),
    )


def ring_centroid(rings: DataFrame) -> DataFrame:
    """Signed area and centroid of each ring of ``exterior_rings``."""
    return rings.withColumn("__c", _centroid(F.col("ring"))).select(
        "LocationID", "ring_index",
        F.col("__c.area").alias("signed_area"),
        F.col("__c.x").alias("centroid_x"),
        F.col("__c.y").alias("centroid_y"),
    )


def _total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda acc, v: acc + v)


def zone_centroids(features: DataFrame, zones: DataFrame) -> DataFrame:
    """Area-weighted centroid and bounding box of each feature, with zone attributes.

    Attributes come from the lookup, then from the feature's own properties. A feature
    without any coordinates is an error.
    """
    located = with_exterior_rings(features).withColumns({
        "__points": F.flatten("rings"),
        "__centres": F.transform("rings", _centroid),
    })
    xs = F.transform("__points", lambda p: F.get(p, 0))
    ys = F.transform("__points", lambda p: F.get(p, 1))
    weight = _total(F.transform("__centres", lambda c: F.abs(c["area"])))

    def centre(axis: str, values: Column) -> Column:
        weighted = _total(F.transform("__centres", lambda c: c[axis] * F.abs(c["area"])))
        return F.when(weight > 0, weighted / weight).otherwise(_total(values) / F.size("__points"))

    checked = F.when(
        F.size("__points") == 0, F.raise_error(F.lit("feature has no polygon coordinates"))
    )
    lookup = zones.select(
        F.col("LocationID").alias("__id"),
        *[F.expr(f"nullif({c}, '')").alias(a) for c, a in (
            ("Zone", "__zone"), ("Borough", "__borough"), ("service_zone", "__service"))],
    )
    return (
        located.join(lookup, F.col("LocationID") == F.col("__id"), "left")
        .select(
            "LocationID",
            F.coalesce("__zone", "zone", F.lit("")).alias("zone"),
            F.coalesce("__borough", "borough", F.lit("")).alias("borough"),
            F.coalesce("__service", F.lit("")).alias("service_zone"),
            F.coalesce(checked.cast("double"), F.round(centre("x", xs), 8)).alias("centroid_lon"),
            F.round(centre("y", ys), 8).alias("centroid_lat"),
            F.round(F.array_min(xs), 8).alias("min_lon"),
            F.round(F.array_min(ys), 8).alias("min_lat"),
            F.round(F.array_max(xs), 8).alias("max_lon"),
            F.round(F.array_max(ys), 8).alias("max_lat"),
        )
        .orderBy("LocationID")
    )
