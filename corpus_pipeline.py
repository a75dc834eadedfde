"""A pipeline of five corpus operators, from documents to a training mixture.

Each stage works on all that its predecessor kept, written as Parquet, and returns the
columns of its table; the last adds the number of the copy. Ids may be null or repeated:
a stage numbers its rows, and what an operator says of a row holds for that row alone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgertie.llm import decontaminate, jaccard, line_dedup, mixing, toxicity
from ledgertie.llm.tables import documents, free_name, materialise, numbered, read
from ledgertie.sources.session import delete, passing_tables, scratch_path


def _numbered(docs: DataFrame) -> tuple[DataFrame, str]:
    """``docs`` with a number for each row, and that column's name."""
    key = free_name(docs, "_row")
    return numbered(docs, key), key


def _by_key(docs: DataFrame, key: str) -> DataFrame:
    """Texts with the rows' numbers as their ids."""
    return docs.select(F.col(key).alias("doc_id"), "text")


def _numbers(rejected: DataFrame, key: str) -> DataFrame:
    """The numbers of rejected rows, which outlive the tables they were found with."""
    return materialise(rejected.select(key), "rejected", lasting=True)


def _without(docs: DataFrame, key: str, rejected: DataFrame) -> DataFrame:
    """``docs`` without the rows whose numbers are in ``rejected``, and without numbers."""
    return docs.join(rejected, key, "left_anti").drop(key)


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity models predict as toxic go."""
    docs, key = _numbered(docs)
    with passing_tables(spark):
        scored = toxicity.score_toxicity(docs, read(spark, sf_dir, "labels"), key)
        rejected = _numbers(scored.filter("predicted = 1"), key)
    return _without(docs, key, rejected)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated lines go; a document that loses all of them stays, with an empty text."""
    kept = line_dedup.dedup_lines(docs)
    if "n_chars" in docs.columns:
        length = F.length("text").cast(docs.schema["n_chars"].dataType)
        kept = kept.withColumn("n_chars", length)
    return kept.select(*docs.columns)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates one document stays: the least id's, null the last."""
    docs, key = _numbered(docs)
    doc_id = F.col("doc_id").cast("long")
    place = docs.select(key, F.struct(doc_id.isNull(), doc_id, key).alias("place"))
    with passing_tables(spark):
        grouped = jaccard.near_duplicates(_by_key(docs, key))
        grouped = grouped.select(F.col("doc_id").alias(key), "class_id").join(place, key)
        grouped = materialise(grouped, "grouped")
        stays = grouped.groupBy("class_id").agg(F.min("place")[key].alias(key))
        rejected = _numbers(grouped.join(stays.select(key), key, "left_anti"), key)
    return _without(docs, key, rejected)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a benchmark passage go."""
    docs, key = _numbered(docs)
    benchmark = read(spark, sf_dir, "benchmark")
    with passing_tables(spark):
        found = decontaminate.contamination(_by_key(docs, key), benchmark).filter("n_hit > 0")
        rejected = _numbers(found.withColumnRenamed("doc_id", key), key)
    return _without(docs, key, rejected)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated to their sources' weights, in random order."""
    return mixing.mix(docs)


STAGES = [
    ("toxicity", toxicity_stage),
    ("line_dedup", line_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("mixing", mixing_stage),
]

# SQL cannot express the toxicity models; the stages are tested one by one instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table documents; of what they write only the predecessor is kept."""
    docs, held = documents(spark, sf_dir), None
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, name)
        with passing_tables(spark):
            stage(spark, docs, sf_dir).write.option("compression", "zstd").parquet(path)
        if held:
            delete(spark, held)
        docs, held = spark.read.schema(docs.schema).parquet(path), path
    return STAGES[-1][1](spark, docs, sf_dir)
