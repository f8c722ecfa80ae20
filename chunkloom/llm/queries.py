"""The registered queries of the numbered operators, each over its whole table, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from chunkloom.llm import bestfit, chat, decontaminate, jaccard, licenses, manifest, packing, quality, repair, secrets, topk, toxicity, urls
from chunkloom.llm.common import table


def op1_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_scores(table(spark, sf_dir, "embeddings"))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(table(spark, sf_dir, "documents"))


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.report(table(spark, sf_dir, "documents"))


def op4_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.report(table(spark, sf_dir, "conversations"))


def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.join(table(spark, sf_dir, "documents"))


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(table(spark, sf_dir, "pages"))


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(table(spark, sf_dir, "documents"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.report(table(spark, sf_dir, "conversations"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.report(table(spark, sf_dir, "documents"))


def op13_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bestfit.packed(table(spark, sf_dir, "documents"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_topk_search, op2_packing, op3_license_scan, op4_chat_formatting, op5_jaccard_join, op6_url_filter, op7_secret_scan, op8_toxicity, op9_decontamination, op10_quality,
        op11_conversation_repair, op12_merkle_manifest, op13_best_fit_packing,
    )
}

ORACLE_SQL = {
    "op1_topk_search": topk.ORACLE,
    "op3_license_scan": licenses.ORACLE,
    "op4_chat_formatting": chat.ORACLE,
    "op5_jaccard_join": jaccard.ORACLE,
    "op6_url_filter": urls.ORACLE,
    "op9_decontamination": decontaminate.ORACLE,
    "op11_conversation_repair": repair.ORACLE,
    "op12_merkle_manifest": manifest.ORACLE,
}
