"""The corpus operators as queries over the whole of the given tables."""

from __future__ import annotations

from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from ledgertie.llm import (
    conversations,
    decontaminate,
    fingerprints,
    jaccard,
    line_dedup,
    mixing,
    pii,
    quality,
    spelling,
    substrings,
    token_counts,
    toxicity,
    warc,
)
from ledgertie.llm.tables import documents, read
from ledgertie.sources.session import scratch_path

Query = Callable[[SparkSession, str], DataFrame]
ROOT = str(Path(__file__).resolve().parents[2])


def op1(spark: SparkSession, folder: str) -> DataFrame:
    found = decontaminate.contamination(documents(spark, folder), read(spark, folder, "benchmark"))
    return decontaminate.report(found)


def tokenizer() -> str:
    """Where the installed vocabulary file lies; its path is a parameter of the operator."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op2(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts.count_tokens(documents(spark, folder), tokenizer())


def op3(spark: SparkSession, folder: str) -> DataFrame:
    return pii.find_personal_data(documents(spark, folder))


def op4(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.score_toxicity(documents(spark, folder), read(spark, folder, "labels"))


def op5(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprints.fingerprints(documents(spark, folder))


def op6(spark: SparkSession, folder: str) -> DataFrame:
    return line_dedup.dedup_lines(documents(spark, folder))


def op7(spark: SparkSession, folder: str) -> DataFrame:
    archive = scratch_path(spark, "archive")
    warc.write_archive(read(spark, folder, "pages"), archive)
    return warc.read_archive(spark, archive)


def op8(spark: SparkSession, folder: str) -> DataFrame:
    return substrings.remove_repeats(documents(spark, folder))


def op9(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(documents(spark, folder))


def op10(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.near_duplicates(documents(spark, folder))


def op11(spark: SparkSession, folder: str) -> DataFrame:
    return quality.score_quality(documents(spark, folder), read(spark, folder, "labels"))


def op12(spark: SparkSession, folder: str) -> DataFrame:
    return conversations.repair(read(spark, folder, "conversations"))


def op13(spark: SparkSession, folder: str) -> DataFrame:
    return spelling.spelling_variants(documents(spark, folder))


QUERIES: dict[str, Query] = {
    "op1_benchmark_contamination": op1,
    "op2_token_counts": op2,
    "op3_personal_data": op3,
    "op4_toxicity": op4,
    "op5_document_fingerprints": op5,
    "op6_line_dedup": op6,
    "op7_warc_archives": op7,
    "op8_repeated_substrings": op8,
    "op9_source_mixing": op9,
    "op10_ngram_jaccard_join": op10,
    "op11_quality_classifier": op11,
    "op12_conversation_repair": op12,
    "op13_spelling_variants": op13,
    "pipeline": corpus_pipeline.run,
}


def _importing(query: Query) -> Query:
    """``query`` with this package on the path of the Python workers, wherever they start."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        spark.sparkContext.environment.setdefault("PYTHONPATH", ROOT)
        return query(spark, folder)

    return run


def registry() -> dict[str, Query]:
    return {name: _importing(query) for name, query in QUERIES.items()}
