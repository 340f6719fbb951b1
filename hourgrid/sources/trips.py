"""Trip and table sources: drifting Parquet files, CSV dimensions, CSV parts, GeoJSON."""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hourgrid import schema as S

PROBES = 16  # footers that the driver asks Spark for at a time

_CANONICAL = {
    S.PASSENGERS: "double", S.DISTANCE: "double", S.FARE: "double", S.TOTAL: "double",
    S.PU: "int", S.DO: "int",
}


def normalize_schema(trips: DataFrame) -> DataFrame:
    """Cast the six columns whose types drift between files; absent ones stay absent.

    Text that is not a number becomes null instead of an error; plain numbers use ``cast``.
    """
    casts = {}
    for name, target in _CANONICAL.items():
        if name in trips.columns:
            text = isinstance(trips.schema[name].dataType, T.StringType)
            casts[name] = F.col(name).try_cast(target) if text else F.col(name).cast(target)
    return trips.withColumns(casts)


def _listed(spark: SparkSession, root: str) -> DataFrame:
    """``path`` of every Parquet file below a folder (any file system Spark can read)."""
    return (
        spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet")
        .option("recursiveFileLookup", "true").load(root).select("path")
    )


def parquet_folders(spark: SparkSession, root: str) -> list[str]:
    """Sorted folders that hold Parquet files directly; none is an error. No file is named here."""
    folders = _listed(spark, root).select(F.regexp_replace("path", "/[^/]*$", "").alias("folder")).distinct()
    found = sorted(r.folder for r in folders.collect())
    if not found:
        raise FileNotFoundError(f"no Parquet files in {root}")
    return found


def load_trips(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Read trip files whose schemas drift, normalise, union by name.

    Drift follows folders (a type changes from some month on), so one footer a folder is
    probed and folders whose columns agree in type, apart from missing ones, are one scan:
    the plan grows with the number of schema changes, not with files or folders. A scan
    merges all its footers in a distributed job, which finds a folder that drifts inside.
    """
    given = parquet_folders(spark, paths) if isinstance(paths, str) else list(paths)
    if not given:
        raise FileNotFoundError("no Parquet files given")
    scans = [normalize_schema(scan) for group in _agreeing(spark, given) for scan in _scans(spark, group)]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), scans)


def _agreeing(spark: SparkSession, paths: list[str]) -> list[list[str]]:
    """The paths in groups whose probed types do not contradict each other."""
    def probe(path: str) -> dict[str, str]:
        return {f.name.lower(): f.dataType.simpleString() for f in _parquet(spark).parquet(path).schema.fields}

    groups: list[tuple[dict[str, str], list[str]]] = []
    with ThreadPoolExecutor(PROBES) as pool:
        for path, types in zip(paths, pool.map(probe, paths)):
            for known, members in groups:
                if all(known.get(name, kind) == kind for name, kind in types.items()):
                    known.update(types)
                    members.append(path)
                    break
            else:
                groups.append((types, [path]))
    return [members for _, members in groups]


def _parquet(spark: SparkSession):
    return spark.read.option("pathGlobFilter", "*.parquet")


def _cannot_merge(error: Exception) -> bool:
    """Whether Spark says that footers contradict each other."""
    java = getattr(error, "java_exception", None)
    condition = error.getCondition() if hasattr(error, "getCondition") else java.getCondition() if hasattr(java, "getCondition") else None
    return condition in ("CANNOT_MERGE_SCHEMAS", "CANNOT_MERGE_INCOMPATIBLE_DATA_TYPE")


def _scans(spark: SparkSession, paths: list[str]) -> list[DataFrame]:
    """One scan of paths that agree; those that drift inside are looked at file by file."""
    try:
        return [_parquet(spark).option("mergeSchema", True).parquet(*paths)]
    except Exception as error:
        if not _cannot_merge(error):
            raise
    if len(paths) > 1:
        middle = len(paths) // 2
        return _scans(spark, paths[:middle]) + _scans(spark, paths[middle:])
    files = sorted(r.path for r in _listed(spark, paths[0]).collect())  # of this one folder
    return [scan for group in _agreeing(spark, files) for scan in _scans(spark, group)]


def scan_zone_lookup(spark: SparkSession, path: str) -> DataFrame:
    """The zone dimension from CSV with header, types declared."""
    return scan_csv_parts(spark, path, S.ZONE_SCHEMA)


def scan_feature_table(spark: SparkSession, path: str, columns: Sequence[str] = (), table: str = "table") -> DataFrame:
    """A materialised stage table, checked for the columns its reader needs."""
    return S.require_columns(spark.read.parquet(path), columns, table)


def scan_centroids(spark: SparkSession, path: str) -> DataFrame:
    """Zone id and centroid of a centroid CSV; a missing file is Spark's path error."""
    return scan_csv_parts(spark, path, S.CENTROID_SCHEMA).select("LocationID", "centroid_lon", "centroid_lat")


def scan_csv_parts(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A CSV file or a folder of parts that must all carry the schema's header, in order."""
    return (
        spark.read.schema(schema)
        .option("header", True).option("enforceSchema", False).option("nullValue", "")
        .option("mode", "FAILFAST").csv(path)
    )


def typed_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV with declared types where empty is null and unparsable numbers become null.

    Everything is read as text first (date-like columns are declared as text and stay so).
    """
    text = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])
    rows = scan_csv_parts(spark, path, text)
    return rows.select(*[
        F.nullif(F.trim(f.name), F.lit("")).try_cast(f.dataType).alias(f.name) for f in schema.fields
    ])


#: How a value of a column is told: an integer that fits 64 bits, or a decimal or exponent number.
_INTEGER, _NUMBER = "^[+-]?[0-9]+$", r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"


def csv_kinds(text: DataFrame) -> dict[str, str]:
    """``empty``, ``integer``, ``float`` or ``text`` for every column of a table of texts, from one pass over all rows.

    An integer beyond 64 bits makes its column text: as a float it would lose digits.
    """
    columns = {name: F.nullif(F.trim(F.col(f"`{name}`")), F.lit("")) for name in text.columns}
    whole = {name: v.rlike(_INTEGER) & v.try_cast("bigint").isNotNull() for name, v in columns.items()}
    counts = text.agg(*[
        F.struct(
            F.count(v).alias("values"),
            F.count_if(whole[name]).alias("integers"),
            F.count_if(whole[name] | (v.rlike(_NUMBER) & ~v.rlike(_INTEGER))).alias("numbers"),
        ).alias(f"c{i}")
        for i, (name, v) in enumerate(columns.items())
    ]).first()  # one row, whatever the table's size

    def kind(c) -> str:
        if not c["values"]:
            return "empty"
        if c["integers"] == c["values"]:
            return "integer"
        return "float" if c["numbers"] == c["values"] else "text"

    return {name: kind(counts[i]) for i, name in enumerate(columns)}


def inferred_csv(spark: SparkSession, path: str, as_text: Sequence[str] = S.DATE_LIKE) -> DataFrame:
    """CSV parts with one header, each column typed by all its values: bigint, double or text.

    Empty and blank values are null; a column without values and the columns ``as_text``
    stay text. No sample is taken, so a single odd value in the last row counts.
    """
    names = spark.read.option("header", True).csv(path).columns
    text = scan_csv_parts(spark, path, T.StructType([T.StructField(n, T.StringType()) for n in names]))
    types = {"integer": T.LongType(), "float": T.DoubleType()}
    kinds = {n: "text" if n in as_text else k for n, k in csv_kinds(text).items()}
    return typed_csv(spark, path, T.StructType([T.StructField(n, types.get(k, T.StringType())) for n, k in kinds.items()]))


_FEATURE = "struct<properties:struct<LocationID:string,zone:string,borough:string>,geometry:struct<type:string,coordinates:string>>"


def features_of(documents: DataFrame, text: str = "value") -> DataFrame:
    """FeatureCollection documents (one per row) to one row per feature.

    Coordinates stay JSON text here, because their nesting depends on the geometry type.
    """
    parsed = F.from_json(text, f"struct<features:array<{_FEATURE}>>")
    return documents.select(F.explode(parsed["features"]).alias("f")).select(*_feature_columns())


#: Where a feature begins in every usual layout: the value of its member ``type``, which comes first.
_FEATURE_MARK = '"Feature"'


def scan_geojson(spark: SparkSession, path: str, lines: bool = False, whole: bool = False) -> DataFrame:
    """Features of GeoJSON files, one row each; a file of any size and layout is read by many tasks.

    The text is cut at the features' own type values, as records are cut at line ends, so a
    FeatureCollection on a single line is split too. What stands between two cuts is one
    feature less its beginning, then the beginning of the next. Features must begin with
    their ``type``; others are an error here, and can be read with ``whole`` (one row a file)
    or ``lines`` (one FeatureCollection a line).
    """
    if lines or whole:
        return features_of(spark.read.text(path, wholetext=not lines))
    pieces = spark.read.option("lineSep", _FEATURE_MARK).text(path)
    body = F.regexp_replace("value", r"[,\s]*\{\s*\"type\"\s*:\s*$", "")
    first = F.ltrim(F.regexp_replace("value", "^[\\s\ufeff]+", "")).startswith("{")  # a file's own head
    parsed = F.from_json(F.concat(F.lit('{"type":"Feature"'), body), _FEATURE)
    broken = F.raise_error(F.concat(F.lit("not a feature that begins with its type: "), F.left("value", F.lit(200))))
    # a head is no error wherever the optimizer puts its filter
    feature = F.when(first | parsed["properties"].isNotNull() | parsed["geometry"].isNotNull(), parsed).otherwise(broken)
    return pieces.where(~first).select(feature.alias("f")).select(*_feature_columns())


def _feature_columns() -> list:
    return [
        F.col("f.properties.LocationID").cast("int").alias("LocationID"),
        F.col("f.properties.zone").alias("zone"),
        F.col("f.properties.borough").alias("borough"),
        F.col("f.geometry.type").alias("geometry_type"),
        F.col("f.geometry.coordinates").alias("coordinates"),
    ]
