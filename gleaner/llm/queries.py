"""The registered queries: each applies one operator, with production parameters, to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import audit, chat, fingerprints, linededup, media, mixing, neardup, order, packing, suffixes, toxicity, variants, warc
from .common import table


def op5_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.edited_and_next(table(spark, sf_dir, "documents"))


def op1_interleaved_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.document_media(table(spark, sf_dir, "documents"))


def op2_training_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order.materialised(table(spark, sf_dir, "documents"))


def op3_warc_reader(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archived_pages(table(spark, sf_dir, "pages"))


def op4_poisson_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.poisson_mix(table(spark, sf_dir, "documents"))


def op6_line_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linededup.without_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op7_length_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.length_buckets(table(spark, sf_dir, "documents"))


def op8_perspectives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.perspectives(table(spark, sf_dir, "conversations"))


def op9_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = neardup.classes(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "class_id", "class_rows", "keep")


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.scored_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.spelling_variants(table(spark, sf_dir, "documents"))


def op12_repeated_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.removed_bytes(table(spark, sf_dir, "documents"))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.filter_audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def queries() -> dict:
    return {f.__name__: f for f in (op1_interleaved_media, op2_training_order, op3_warc_reader, op4_poisson_mix, op5_order_minhash, op6_line_chunks, op7_length_buckets, op8_perspectives, op9_near_duplicates, op10_toxicity, op11_spelling_variants, op12_repeated_strings, op13_filter_audit)}


def oracle_sql() -> dict[str, str]:
    return {"op3_warc_reader": warc.ORACLE, "op4_poisson_mix": mixing.oracle(), "op8_perspectives": chat.ORACLE, "op11_spelling_variants": variants.oracle(), "op12_repeated_strings": suffixes.ORACLE, "op13_filter_audit": audit.ORACLE}
