"""Queries of the training-text operators by name, and SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from claimlake.llm import boilerplate, canonical, contamination, encoding, history, packing, pii, residue
from claimlake.session import ship_package

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return residue.found(table(spark, d, "items"))


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return boilerplate.found(table(spark, d, "items"))


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return canonical.found(table(spark, d, "items"), table(spark, d, "verdict_labels"))


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return encoding.found(table(spark, d, "items"))


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    return history.found(table(spark, d, "items"), table(spark, d, "seen"))


def p8_packed(spark: SparkSession, d: str) -> DataFrame:
    return packing.packed_documents(table(spark, d, "documents"))


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    return contamination.found(table(spark, d, "documents"), table(spark, d, "eval_items"))


def p9_cleaned(spark: SparkSession, d: str) -> DataFrame:
    """Every document without the stretches that it shares with test items."""
    return contamination.without_leaks(table(spark, d, "documents").select("doc_id", "text"), "doc_id", "text", table(spark, d, "eval_items"), "eval_id", "passage")


def p1_kept(spark: SparkSession, d: str) -> DataFrame:
    """The records whose title and summary hold no residue."""
    return residue.without_residue(table(spark, d, "items").select("arrival", "title", "summary"), ["title", "summary"])


def p2_cleaned(spark: SparkSession, d: str) -> DataFrame:
    """Every body without its site's lines."""
    return boilerplate.without_repeated_lines(table(spark, d, "items").select("arrival", "agency_id", "item_id", "body"), "arrival", "agency_id", "item_id", "body").select("arrival", "body")


def p6_restored(spark: SparkSession, d: str) -> DataFrame:
    """Each garbled field with its text restored as far as it can be."""
    return encoding.restore_fields(table(spark, d, "items"), "arrival", ["title", "summary", "body"]).withColumnRenamed("key", "arrival")


def p10_masked(spark: SparkSession, d: str) -> DataFrame:
    """Every document with typed placeholders; numbers and dates are permuted within their format under a key that a production run sets."""
    key = spark.conf.get("claimlake.pii.key", "claimlake")
    return pii.masked(table(spark, d, "documents").select("doc_id", "text"), "text", key)


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    return pii.found(table(spark, d, "documents"))


QUERIES: dict[str, Query] = {
    "p1_found": p1_found,
    "p2_found": p2_found,
    "p4_found": p4_found,
    "p6_found": p6_found,
    "p7_found": p7_found,
    "p8_packed": p8_packed,
    "p9_found": p9_found,
    "p10_found": p10_found,
    "p1_kept": p1_kept,
    "p2_cleaned": p2_cleaned,
    "p6_restored": p6_restored,
    "p9_cleaned": p9_cleaned,
    "p10_masked": p10_masked,
}

SQL: dict[str, str] = {"p2_found": boilerplate.FOUND_SQL, "p2_cleaned": boilerplate.CLEANED_SQL, "p9_found": contamination.FOUND_SQL}
