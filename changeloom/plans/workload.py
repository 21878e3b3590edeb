"""Workload generators, reproducible by seed and without a driver loop."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _pick(seed: int, salt: int, n: int):
    return F.pmod(F.xxhash64(F.col("id"), F.lit(seed), F.lit(salt)), F.lit(n))


def bank(spark: SparkSession, transfers: int, accounts: int, seed: int = 0) -> DataFrame:
    """``txn, account, delta``: every transfer has two rows of opposite amounts."""
    t = spark.range(transfers).select("id", _pick(seed, 1, accounts).alias("a"), _pick(seed, 2, accounts).alias("b"), _pick(seed, 3, 1000).alias("amount"))
    legs = F.array(F.struct(F.col("a").alias("account"), (-F.col("amount")).alias("delta")), F.struct(F.col("b").alias("account"), F.col("amount").alias("delta")))
    return t.select(F.col("id").alias("txn"), F.explode(legs).alias("x")).select("txn", "x.*")


def sysbench(spark: SparkSession, rows: int, tables: int, seed: int = 0) -> DataFrame:
    """``table_name, id, k, c, pad`` of the usual point-update benchmark."""
    text = lambda salt, n: F.substring(F.sha2(F.concat_ws("-", "id", F.lit(f"{seed}-{salt}")), 256), 1, n)
    return spark.range(rows).select(F.concat(F.lit("sbtest"), (F.col("id") % tables + 1).cast("string")).alias("table_name"), "id", _pick(seed, 4, 100_000).alias("k"), text(1, 30).alias("c"), text(2, 20).alias("pad"))


def large_rows(spark: SparkSession, rows: int, columns: int, width: int, seed: int = 0) -> DataFrame:
    """Rows of ``columns`` text columns of ``width`` characters."""
    one = lambda i: F.substring(F.repeat(F.sha2(F.concat_ws("-", "id", F.lit(f"{seed}-{i}")), 256), width // 64 + 1), 1, width).alias(f"col_{i}")
    return spark.range(rows).select("id", *[one(i) for i in range(columns)])
