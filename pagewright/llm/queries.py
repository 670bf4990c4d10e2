"""Queries of the problems with text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagewright.llm import language, mixing, packing, pii, repair, tokens
from pagewright.session import table


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return repair.found(table(spark, d, "docling_gz"), table(spark, d, "docling_meta"))


def p2_repaired(spark: SparkSession, d: str) -> DataFrame:
    return repair.repaired(table(spark, d, "docling_gz"), table(spark, d, "docling_meta"))


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    pieces = language.pieces(table(spark, d, "docling_gz"))
    mains = language.documents(pieces)
    wrong = mains.where(~language.label_language(F.col("lang_label")).eqNullSafe(F.col("lang"))).select("doc_id", F.lit(-1).alias("text_ix"), "lang")
    return wrong.unionByName(language.foreign(pieces, mains).select("doc_id", "text_ix", "lang"))


def p3_documents(spark: SparkSession, d: str) -> DataFrame:
    return language.documents(language.pieces(table(spark, d, "docling_gz"))).select("doc_id", "lang", F.round("confidence", 4).alias("confidence"))


def p3_segments(spark: SparkSession, d: str) -> DataFrame:
    return language.segments(language.pieces(table(spark, d, "docling_gz")))


def p6_packets(spark: SparkSession, d: str) -> DataFrame:
    docs = tokens.with_tokens(table(spark, d, "documents").select("doc_id", "text"))
    return packing.packets(docs, table(spark, d, "token_budgets"))


def p7_mix(spark: SparkSession, d: str, total_tokens: int | None = None) -> DataFrame:
    docs = tokens.with_tokens(table(spark, d, "documents").select("doc_id", "source", "text"))
    return mixing.draw(docs, table(spark, d, "source_targets"), total_tokens=total_tokens)[0]


def p7_shares(spark: SparkSession, d: str, total_tokens: int | None = None) -> DataFrame:
    docs = tokens.with_tokens(table(spark, d, "documents").select("doc_id", "source", "text"))
    return mixing.draw(docs, table(spark, d, "source_targets"), total_tokens=total_tokens)[1]


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    return pii.places(table(spark, d, "documents").select("doc_id", "text")).select("doc_id", "kind", "start_pos")


def p8_redacted(spark: SparkSession, d: str) -> DataFrame:
    return pii.redacted(table(spark, d, "documents").select("doc_id", "text"))


def queries() -> dict:
    return {q.__name__: q for q in (p2_found, p2_repaired, p3_found, p3_documents, p3_segments, p6_packets, p7_mix, p7_shares, p8_found, p8_redacted)}


def oracle_sql() -> dict[str, str]:
    """None: tokenizers, editors, automata and scored spans are tested by brute force and round trips instead."""
    return {}
