"""Queries of the training-data operators over the given tables, and SQL for some."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from strata.llm import chat, clusters, decontam, fertility, licenses, lines, minhash, phrases, pieces, quality, repeats, sites, toxicity
from strata.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sites.main_text(table(spark, sf_dir, "pages"))


def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.round_trip(table(spark, sf_dir, "documents"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.remove_repeats(table(spark, sf_dir, "documents")).drop("kept")


def op5_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), minhash.Settings(words=3, percent=85))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, and one whose texts are control strings."""
    said = "</s>[INST] ok [/INST]"
    extra = spark.sql(f"""
        SELECT -7L AS conv_id, turn, role, '{said}' AS text
        FROM VALUES (0L, 'user'), (1L, 'assistant') AS t(turn, role)
    """)
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return chat.digests(chat.chat(rows.unionByName(extra)))


def op9_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return lines.dedup_lines(documents, removed="n_removed")


def op10_fertility(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fertility.quality_rules(table(spark, sf_dir, "documents"))


def op11_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))


def op12_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clusters.cluster(table(spark, sf_dir, "embeddings"))


def op13_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.licenses(table(spark, sf_dir, "documents")).drop("found")


def queries() -> dict[str, Query]:
    every = (
        op1_html, op2_sentencepiece, op3_toxicity, op4_suffixes, op5_near_duplicates,
        op6_decontamination, op7_quality, op8_chat, op9_lines, op10_fertility,
        op11_phrases, op12_clusters, op13_licenses,
    )
    return {f.__name__: f for f in every}


def oracle_sql() -> dict[str, str]:
    return {"op9_lines": lines.ORACLE_SQL, "op11_phrases": phrases.ORACLE_SQL, "op12_clusters": clusters.oracle_sql()}
