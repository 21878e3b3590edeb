"""Per-key results where a few keys hold most rows.

Method: two-stage salted aggregation. The first pass counts the keys (with
map-side combine) and keeps those above ``heavy_share`` of all rows, of which
there are at most 1 / heavy_share. Rows of these get a random salt, one of at
least ``salts`` and of so many that a salt has ``salt_rows`` rows; partial results are made per (key, salt), and the partials are merged
by key. No task gets more than a salt's share of a hot key, even for aggregates
without map-side combine (exact distinct counts, where the salt follows the
value so that partial distinct counts add up).

Defined results: null keys form a key of their own; nulls in values are ignored
as by the plain aggregates; an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class SaltPlan:
    heavy_share: float = 0.01
    salts: int = 64
    salt_rows: int = 10_000_000
    seed: int = 17


@dataclass(frozen=True)
class Agg:
    """An aggregate with a partial and a merging form."""

    name: str
    kind: str  # count, sum, min, max, avg, distinct, approx_distinct
    value: str | None = None


def heavy_keys(df: DataFrame, keys: list[str], share: float) -> DataFrame:
    """Keys with at least ``share`` of all rows: at most 1 / share rows."""
    counts = df.groupBy(*keys).agg(F.count("*").alias("__n"))
    total = counts.agg(F.sum("__n").alias("__total"))
    # one row
    return counts.join(F.broadcast(total), F.col("__n") >= F.col("__total") * F.lit(share)).drop("__total")


def _partials(aggs: list[Agg]) -> list[Column]:
    out: list[Column] = []
    for a in aggs:
        v = F.col(a.value) if a.value else F.lit(1)
        if a.kind == "count":
            out.append(F.count(v).alias(f"__{a.name}"))
        elif a.kind in ("sum", "min", "max"):
            out.append(getattr(F, a.kind)(v).alias(f"__{a.name}"))
        elif a.kind == "avg":
            out += [F.sum(v.cast("double")).alias(f"__{a.name}_s"), F.count(v).alias(f"__{a.name}_n")]
        elif a.kind == "distinct":
            out.append(F.count_distinct(v).alias(f"__{a.name}"))
        elif a.kind == "approx_distinct":
            out.append(F.hll_sketch_agg(v).alias(f"__{a.name}"))
        else:
            raise ValueError(f"no two-stage form of {a.kind}")
    return out


def _merges(aggs: list[Agg]) -> list[Column]:
    out = []
    for a in aggs:
        p = f"__{a.name}"
        if a.kind in ("count", "distinct"):
            c = F.sum(p)
        elif a.kind in ("sum", "min", "max"):
            c = getattr(F, a.kind)(p)
        elif a.kind == "avg":
            c = F.sum(f"{p}_s") / F.sum(f"{p}_n")
        else:
            c = F.hll_sketch_estimate(F.hll_union_agg(p))
        out.append(c.alias(a.name))
    return out


def salted_aggregate(df: DataFrame, keys: list[str], aggs: list[Agg], plan: SaltPlan = SaltPlan()) -> DataFrame:
    """``df.groupBy(keys).agg(...)`` in two stages. Several exact distinct
    counts over different values are not supported in one call."""
    distinct = {a.value for a in aggs if a.kind == "distinct"}
    if len(distinct) > 1:
        raise ValueError("one distinct value column per call")
    hot = heavy_keys(df, keys, plan.heavy_share)
    hot = hot.select(*[F.col(k).alias(f"__hot_{k}") for k in keys], F.greatest(F.lit(plan.salts), F.ceil(F.col("__n") / F.lit(plan.salt_rows))).alias("__hot"))
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"__hot_{k}"))
    if distinct:
        salt = F.pmod(F.xxhash64(F.col(next(iter(distinct)))), F.col("__hot"))
    else:
        salt = F.floor(F.rand(plan.seed) * F.col("__hot"))
    # at most 1 / heavy_share rows
    marked = df.join(F.broadcast(hot), same, "left").withColumn("__salt", F.when(F.col("__hot").isNotNull(), salt).otherwise(F.lit(0)))
    partial = marked.groupBy(*keys, "__salt").agg(*_partials(aggs))
    return partial.groupBy(*keys).agg(*_merges(aggs))
