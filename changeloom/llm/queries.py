"""Queries of the three text problems and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from changeloom.llm import contamination, packing, reading_level


def _read(spark: SparkSession, d: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{table}.parquet")


def p6_containers(spark: SparkSession, d: str) -> DataFrame:
    return packing.pack(_read(spark, d, "documents"))


def p6_fill(spark: SparkSession, d: str) -> DataFrame:
    return packing.fill_report(p6_containers(spark, d), packing.PackPlan().capacity)


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    return contamination.leaked(_read(spark, d, "documents"), _read(spark, d, "eval_item"))


def p7_matches(spark: SparkSession, d: str) -> DataFrame:
    return contamination.longest_matches(_read(spark, d, "documents"), _read(spark, d, "eval_item"))


def p7_clean(spark: SparkSession, d: str) -> DataFrame:
    return contamination.without_leaks(_read(spark, d, "documents"), _read(spark, d, "eval_item"))


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    return p8_levels(spark, d).select("doc_id", "grade")


def p8_levels(spark: SparkSession, d: str) -> DataFrame:
    return reading_level.reading_levels(_read(spark, d, "documents"), _read(spark, d, "graded_passage"))


QUERIES = {
    "p6_containers": p6_containers, "p6_fill": p6_fill, "p7_found": p7_found, "p7_matches": p7_matches, "p7_clean": p7_clean,
    "p8_found": p8_found, "p8_levels": p8_levels,
}
SQL: dict[str, str] = {}
