"""A training-corpus pipeline over ``documents``: each stage is one operator of ``hourgrid.llm``.

``run`` writes every stage as Parquet in the shared folder and reads it back for the next one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from hourgrid.llm.decontaminate import find_contamination
from hourgrid.llm.frames import ready, row_key, stored, table
from hourgrid.llm.mixing import mix
from hourgrid.llm.neardup import near_duplicates
from hourgrid.llm.quality import quality_rules
from hourgrid.llm.templates import drop_recurring_lines


#: What the operators work on; every other column of the input waits under another name.
USED = ("doc_id", "text", "source")


def _aside(docs: DataFrame) -> DataFrame:
    """``docs`` with the columns that no operator reads renamed, so that none of its results meets them."""
    return docs.select(*[F.col(f"`{c}`").alias(c if c in USED else f"__in_{c}") for c in docs.columns])


def _back(columns: list[str]) -> list:
    return [F.col(f"`{c if c in USED else '__in_' + c}`").alias(c) for c in columns]


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep. A null or empty text has too few words and goes;
    equal rows share their fate; all columns stay as they are, whatever their names."""
    return quality_rules(_aside(docs)).filter("kept").select(*_back(docs.columns))


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without their recurring lines; ``n_chars``, where there is one, follows the text.
    No document goes; a null text stays null. Equal rows lose the same lines but for the first
    of a template, which stays in one place of the corpus."""
    out = drop_recurring_lines(_aside(docs)).select(*_back(docs.columns))
    return out.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else out


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, a repeated row once.

    Texts without words are in no group and stay. Of rows with equal id and text the first by
    source, language and a hash of all columns stays, nulls first.
    """
    dropped = near_duplicates(docs).filter("NOT kept").select("doc_id", "row").distinct()
    order = F.struct(*[F.col(c) for c in ("source", "lang") if c in docs.columns], F.xxhash64(*docs.columns))
    held = docs.select(F.col("doc_id").alias("id"), row_key("doc_id", "text").alias("key"), F.struct(*docs.columns).alias("held"), order.alias("order"))
    rest = held.join(dropped, (held["key"] == dropped["row"]) & held["id"].eqNullSafe(dropped["doc_id"]), "left_anti")
    return rest.groupBy("key", "id").agg(F.min_by("held", "order").alias("one")).select("one.*")


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a verbatim window of a benchmark item; a text without words has none and stays."""
    return find_contamination(_aside(docs), table(spark, sf_dir, "benchmark")).filter("n_hit = 0").select(*_back(docs.columns))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes, each with the number of times it is to be repeated.

    A null source is a source of its own. Results are ``size, source_size, target, copies,
    taken``; where the input has a column of that name, it stays and the result is ``mix_`` and the name.
    """
    results = ["size", "source_size", "target", "copies", "taken"]
    named = [F.col(c).alias(f"mix_{c}" if c in docs.columns else c) for c in results]
    return mix(_aside(docs)).filter("copies > 0").select(*_back(docs.columns), *named)


def _on_workers(stage):
    return lambda spark, docs, sf_dir: stage(ready(spark), docs, sf_dir)


STAGES = [
    ("quality_rules", _on_workers(quality_stage)),
    ("line_dedup", _on_workers(line_stage)),
    ("near_duplicates", _on_workers(near_stage)),
    ("decontamination", _on_workers(decontamination_stage)),
    ("mixing", _on_workers(mixing_stage)),
]

#: The suffix arrays and sketches have no SQL; tests hold ``run`` against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
