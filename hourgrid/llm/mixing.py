"""Mixing sources to target weights by nested hash-threshold histograms.

Each document has a hash of its id in 60 bits. A source that gives ``r`` times its words
takes every document ``floor(r)`` times and the documents below a hash threshold once more.
The threshold comes from histograms: words summed by source and the highest 12 bits of the
hash, running sums over these buckets, then the same over the next 12 bits for the documents
of the one boundary bucket only, five times. Nothing is sorted but histogram buckets (4,096
a source at most), and each pass is one map-side combined sum over a narrow stored table.

Only built-in DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from hourgrid.llm.frames import stored, table

WORD = "[^\\x20\\x09-\\x0D]+"
DIGITS, LEVELS = 3, 5  # hex digits of the hash per level


def shares(sizes: DataFrame, weights: tuple[float, ...] = (5, 2, 1), most: float = 3.0) -> DataFrame:
    """Targets from one row per source (``source``, ``source_size``).

    Weights repeat along the sources by code point, null last. A target stops at ``most``
    times its source; what is above is reshared by weight. That fixed point is ``level *
    weight`` cut at the cap, and the level follows from running sums over the sources in the
    order of cap / weight. One row per source passes one window; no document does.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    by_cap = Window.orderBy(F.col("__cap") / F.col("__w"), F.col("source").asc_nulls_last())
    before = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    whole = by_cap.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    nth = (F.row_number().over(by_name) - 1) % len(weights)
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (nth + 1).cast("int"))
    out = sizes.withColumn("__w", w).withColumn("__cap", F.lit(most) * F.col("source_size"))
    out = out.withColumns({
        "__all": F.sum("source_size").over(whole).cast("double"), "__sum_w": F.sum("__w").over(whole),
        "__cut": F.coalesce(F.sum("__cap").over(before), F.lit(0.0)), "__cut_w": F.coalesce(F.sum("__w").over(before), F.lit(0.0)),
    })
    # the level if exactly the sources before this one are cut; the first that then stays below its cap settles it
    level = (F.col("__all") - F.col("__cut")) / (F.col("__sum_w") - F.col("__cut_w"))
    out = out.withColumn("__level", F.when(level * F.col("__w") <= F.col("__cap"), level))
    settled = F.coalesce(F.first("__level", ignorenulls=True).over(whole), F.lit(0.0))
    return out.select("source", "source_size", F.least(settled * F.col("__w"), F.col("__cap")).alias("target"))


def _same(a: Column, b: Column) -> Column:
    return a.eqNullSafe(b)


def _thresholds(rows: DataFrame, targets: DataFrame) -> DataFrame:
    """Per source how often all its documents are taken, and the hash below which once more."""
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    whole = F.floor(ratio + F.lit(1e-12))
    budget = F.greatest(F.col("target") - whole * F.col("source_size"), F.lit(0.0))
    bounds = targets.select("source", "source_size", "target", whole.cast("long").alias("whole"), budget.alias("left"),
                            F.lit("").alias("prefix"), F.lit(False).alias("settled"))
    for level in range(LEVELS):
        at = bounds.select(F.col("source").alias("b_source"), "prefix", "left", "settled").filter(~F.col("settled"))
        near = rows if level == 0 else rows.join(
            at.select("b_source", "prefix"),
            _same(F.col("source"), F.col("b_source")) & (F.substring("hash", 1, DIGITS * level) == F.col("prefix")), "left_semi")
        end = DIGITS * (level + 1)
        histogram = near.groupBy("source", F.substring("hash", 1, end).alias("bucket")).agg(F.sum("size").alias("words"))
        run = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        upto = histogram.withColumn("upto", F.sum("words").over(run)).join(
            at.select("b_source", "left"), _same(F.col("source"), F.col("b_source")))
        # the first bucket whose running sum passes the budget is the boundary
        found = upto.filter(F.col("upto") > F.col("left")).groupBy("source").agg(
            F.min(F.struct("bucket", (F.col("upto") - F.col("words")).alias("below"), "words")).alias("m"))
        found = found.select(F.col("source").alias("f_source"), F.col("m.bucket").alias("bucket"),
                             F.col("m.below").alias("below"), F.col("m.words").alias("words"))
        rest = F.col("left") - F.col("below")
        hit = F.col("bucket").isNotNull() & ~F.col("settled")
        # "g" stands behind every hex digit: all hashes of the prefix are below it
        inner = F.col("bucket")
        if level == LEVELS - 1:
            inner = F.when(rest * 2 > F.col("words"), F.concat("bucket", F.lit("g"))).otherwise(F.col("bucket"))
        prefix = F.when(hit, inner).when(~F.col("settled"), F.concat("prefix", F.lit("g"))).otherwise(F.col("prefix"))
        bounds = stored(bounds.join(found, _same(F.col("source"), F.col("f_source")), "left").select(
            "source", "source_size", "target", "whole", F.when(hit, rest).otherwise(F.col("left")).alias("left"),
            prefix.alias("prefix"), (F.col("settled") | F.col("bucket").isNull()).alias("settled")), "mix-bounds")
    return bounds


def mix(docs: DataFrame, weights: tuple[float, ...] = (5, 2, 1), most: float = 3.0,
        id_col: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """``docs`` with ``size, source_size, target, copies, taken`` for every document.

    A null text has size 0, a null source is a source of its own, a null id hashes as the
    word ``null``. Rows with equal id share a hash and so are taken alike. Of the two ends
    of the boundary document the one nearer to the target is taken, the lower on a tie. An
    input column named like a result column is replaced.
    """
    new = ["size", "source_size", "target", "copies", "taken"]
    size = F.coalesce(F.regexp_count(F.col(text).cast("string"), F.lit(WORD)), F.lit(0)).cast("long")
    name = F.coalesce(F.col(id_col).cast("string"), F.lit("null")).cast("binary")
    rows = docs.withColumns({"__source": F.col(source).cast("string"), "__size": size,
                             "__hash": F.substring(F.md5(name), 1, DIGITS * LEVELS)})
    narrow = stored(rows.select(F.col("__source").alias("source"), F.col("__size").alias("size"), F.col("__hash").alias("hash")), "mix")
    targets = stored(shares(narrow.groupBy("source").agg(F.sum("size").alias("source_size")), weights, most), "mix-targets")
    b = _thresholds(narrow, targets).select(
        F.col("source").alias("b_source"), F.col("source_size").alias("b_size"), F.col("target").alias("b_target"), "whole", "prefix")
    copies = F.col("whole") + F.when(F.col("__hash") < F.col("prefix"), 1).otherwise(0)
    return rows.join(b, _same(F.col("__source"), F.col("b_source"))).select(
        *[c for c in docs.columns if c not in new], F.col("__size").alias("size"), F.col("b_size").alias("source_size"),
        F.col("b_target").alias("target"), copies.alias("copies"), (copies * F.col("__size")).alias("taken"))


def op3_mix_sources(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mix(docs).select("doc_id", "size", "source_size", "target", "taken")


#: The same mix with a full sort: running sums over all hashes of a source.
ORACLE = """
WITH d AS (
  SELECT doc_id, source, CAST(COALESCE(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS BIGINT) AS size,
         substr(md5(COALESCE(CAST(doc_id AS VARCHAR), 'null')), 1, 15) AS hash
  FROM documents
), s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source
), w AS (
  SELECT *, CAST([5, 2, 1][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS DOUBLE) AS w,
         3.0::DOUBLE * source_size AS cap
  FROM s
), r AS (
  SELECT *, CAST(sum(source_size) OVER () AS DOUBLE) AS whole, sum(w) OVER () AS sum_w,
         COALESCE(sum(cap) OVER k, 0) AS cut, COALESCE(sum(w) OVER k, 0) AS cut_w,
         row_number() OVER (ORDER BY cap / w, source NULLS LAST) AS nth
  FROM w
  WINDOW k AS (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), l AS (
  SELECT min_by((whole - cut) / (sum_w - cut_w), nth) AS level
  FROM r WHERE (whole - cut) / (sum_w - cut_w) * w <= cap
), t AS (
  SELECT source, source_size, least(COALESCE(level, 0) * w, cap) AS target FROM r, l
), q AS (
  SELECT source, source_size, target,
         CAST(floor(CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END + 1e-12) AS BIGINT) AS whole
  FROM t
), h AS (
  SELECT source, hash, sum(size) AS words, sum(sum(size)) OVER (PARTITION BY source ORDER BY hash) AS upto
  FROM d GROUP BY source, hash
), e AS (
  SELECT h.source, hash, q.source_size, target, whole,
         upto <= greatest(target - whole * q.source_size, 0)
         OR (upto - words <= greatest(target - whole * q.source_size, 0)
             AND 2 * (greatest(target - whole * q.source_size, 0) - (upto - words)) > words) AS extra
  FROM h JOIN q ON h.source IS NOT DISTINCT FROM q.source
)
SELECT d.doc_id, d.size, e.source_size, e.target, CAST((whole + CASE WHEN extra THEN 1 ELSE 0 END) * d.size AS BIGINT) AS taken
FROM d JOIN e ON d.hash = e.hash AND d.source IS NOT DISTINCT FROM e.source
"""
