"""The operators as queries over the given tables, and the SQL some are checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from orderloom.llm import (
    binary_records,
    collocations,
    context_tree,
    conversations,
    decontamination,
    language,
    minhash,
    packing,
    quality_rules,
    simhash,
    toxicity,
    url_rules,
    weak_labels,
)

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality_rules.quality_rules(table(spark, folder, "documents"))


def op2_context_tree(spark: SparkSession, folder: str) -> DataFrame:
    return context_tree.context_tree_scores(table(spark, folder, "documents"))


def op3_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, folder, "documents"))


def op4_binary_records(spark: SparkSession, folder: str) -> DataFrame:
    return binary_records.round_trip(table(spark, folder, "documents"))


def op5_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(table(spark, folder, "documents"), added=True)


def op6_weak_labels(spark: SparkSession, folder: str) -> DataFrame:
    return weak_labels.weak_label_scores(table(spark, folder, "documents"))


def op7_url_rules(spark: SparkSession, folder: str) -> DataFrame:
    found = url_rules.url_verdicts(table(spark, folder, "pages"))
    return found.select("page_id", "host", "path", "rule", "verdict")


def op8_language_id(spark: SparkSession, folder: str) -> DataFrame:
    return language.identify(table(spark, folder, "documents"))


def op9_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.toxicity(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op10_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    found = decontamination.decontaminate(
        table(spark, folder, "documents"), table(spark, folder, "benchmark")
    )
    return decontamination.digest(found)


def op11_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return collocations.collocations(table(spark, folder, "documents"))


def op12_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    report, _ = conversations.repair(table(spark, folder, "conversations"))
    return report


def op13_minhash(spark: SparkSession, folder: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, folder, "documents"))


def llm_queries() -> dict[str, Query]:
    return {
        query.__name__: query
        for query in (
            op1_quality_rules,
            op2_context_tree,
            op3_simhash,
            op4_binary_records,
            op5_best_fit_packing,
            op6_weak_labels,
            op7_url_rules,
            op8_language_id,
            op9_toxicity,
            op10_decontamination,
            op11_collocations,
            op12_conversation_repair,
            op13_minhash,
        )
    }


def llm_oracles() -> dict[str, str]:
    return {
        "op1_quality_rules": quality_rules.SQL,
        "op7_url_rules": url_rules.SQL,
        "op10_decontamination": decontamination.SQL,
        "op11_collocations": collocations.SQL,
        "op13_minhash": minhash.SQL,
    }
