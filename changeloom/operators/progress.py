"""Watermarks, checkpoints, barriers, sync points and span arithmetic."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changeloom.operators.ordering import last_known, max_before, numbered_blocks, running_flags


def table_resolved(regions: DataFrame, table: str, region: str, ts: str) -> DataFrame:
    """Per table the smallest of its regions' largest resolved ts."""
    return regions.groupBy(table, region).agg(F.max(ts).alias("r")).groupBy(table).agg(F.min("r").alias("resolved_ts"))


def monotone(df: DataFrame, keys: list[str], order: list[str], ts: str) -> DataFrame:
    """A watermark that never goes back."""
    rows = max_before(numbered_blocks(df, keys, [F.col(c) for c in order]), keys, ts, "__before")
    return rows.withColumn(ts, F.greatest(ts, "__before")).select(*df.columns)


def checkpoint(sent: DataFrame, keys: list[str], resolved: DataFrame) -> DataFrame:
    """Earliest commit_ts that is not flushed, less one; if all are flushed, the
    larger of the last commit_ts less one and the resolved ts; with nothing sent
    the resolved ts."""
    per = sent.groupBy(*keys).agg(F.min(F.when(~F.col("flushed"), F.col("commit_ts"))).alias("open"), F.max("commit_ts").alias("last"))
    ck = F.when(F.col("open").isNotNull(), F.col("open") - 1).when(F.col("last").isNull(), F.col("resolved_ts")).otherwise(F.greatest(F.col("last") - 1, F.col("resolved_ts")))
    return resolved.join(per, keys, "left").select(*keys, ck.alias("checkpoint_ts"))


def coverage(spans: DataFrame, keys: list[str]) -> DataFrame:
    """Per key: first and last bound, whether the spans leave no gap, and holes."""
    rows = max_before(numbered_blocks(spans, keys, [F.col("lo"), F.col("hi")]), keys, "hi", "before")
    gaps = rows.withColumn("gap", F.when(F.col("lo") > F.col("before"), F.col("lo") - F.col("before")).otherwise(0))
    return gaps.groupBy(*keys).agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.count_if(F.col("gap") > 0).alias("holes"), F.sum("gap").alias("missing"))


def merge_spans(spans: DataFrame, keys: list[str]) -> DataFrame:
    """Joins spans that touch or overlap; the merged checkpoint is the smallest."""
    rows = max_before(numbered_blocks(spans, keys, [F.col("lo"), F.col("hi"), F.col("ts")]), keys, "hi", "before")
    grouped = running_flags(rows, F.coalesce(F.col("lo") > F.col("before"), F.lit(True)), "grp")
    return grouped.groupBy(*keys, "grp").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.min("ts").alias("ts"), F.count("*").alias("n_spans")).drop("grp")


def intersect_spans(a: DataFrame, b: DataFrame, width: int) -> DataFrame:
    """Overlaps of half-open spans. Spans are cut at multiples of ``width`` to an
    equality join on the cell; an overlap is reported by its first common cell."""
    cells = lambda d, p: d.select(F.col("id").alias(f"{p}_id"), F.col("lo").alias(f"{p}_lo"), F.col("hi").alias(f"{p}_hi"), F.explode(F.sequence(F.floor(F.col("lo") / width), F.floor((F.col("hi") - 1) / width))).alias("cell"))
    j = cells(a, "a").join(cells(b, "b"), "cell").where((F.col("a_lo") < F.col("b_hi")) & (F.col("b_lo") < F.col("a_hi")))
    lo, hi = F.greatest("a_lo", "b_lo"), F.least("a_hi", "b_hi")
    return j.where(F.floor(lo / width) == F.col("cell")).select("a_id", "b_id", lo.alias("lo"), hi.alias("hi"))


def split_evenly(n: Column, parts: int, i: Column) -> Column:
    """Size of part ``i`` when ``n`` regions are dealt to ``parts`` spans."""
    return F.floor(n / parts) + F.when(i < n % parts, 1).otherwise(0)


def synced_status(now_ms: Column, last_synced_ms: Column, checkpoint_ms: Column) -> Column:
    """Synced if nothing was written for 300 s and the checkpoint is at most 15 s
    old; else why not."""
    idle, fresh = now_ms - last_synced_ms > 300_000, now_ms - checkpoint_ms < 15_000
    return F.when(idle & fresh, "synced").when(idle, "checkpoint is behind").otherwise("still writing")


def barrier_done(reports: DataFrame, expected: DataFrame, keys: list[str]) -> DataFrame:
    """A barrier passes when every expected dispatcher has reported."""
    r = reports.groupBy(*keys).agg(F.count_distinct("dispatcher").alias("reported"))
    return expected.join(r, keys, "left").select(*keys, "expected", F.coalesce("reported", F.lit(0)).alias("reported"), (F.coalesce("reported", F.lit(0)) >= F.col("expected")).alias("done"))


def ddl_recovery(ddl_ts: Column, finished: Column, is_syncpoint: Column) -> tuple[Column, Column]:
    """(start ts, skip DML) after a restart from the DDL progress table."""
    start = F.when(finished | is_syncpoint, ddl_ts).otherwise(ddl_ts - 1)
    return start, ~finished & ~is_syncpoint


#: Limits and steps of the scan window in milliseconds and percent, fixed values.
SCAN_MIN_MS, SCAN_MAX_MS = 1_000, 1_800_000
USAGE_CRITICAL, USAGE_HIGH, USAGE_LOW, USAGE_VERY_LOW = 90, 70, 20, 10


def next_interval(now_ms: Column, last: Column, top: Column, may_grow: Column | None = None) -> Column:
    """Next scan interval by memory use in percent: a quarter when critical, half
    when high, half as much again when very low, a quarter more when low."""
    grow = F.lit(True) if may_grow is None else may_grow
    use = F.greatest(last, top)
    div = lambda n, num, den: F.floor(n * num / den).cast("bigint")
    return (
        F.when(use > USAGE_CRITICAL, F.greatest(div(now_ms, 1, 4), F.lit(SCAN_MIN_MS)))
        .when(use > USAGE_HIGH, F.greatest(div(now_ms, 1, 2), F.lit(SCAN_MIN_MS)))
        .when(grow & (use < USAGE_VERY_LOW), F.least(div(now_ms, 3, 2), F.lit(SCAN_MAX_MS)))
        .when(grow & (use < USAGE_LOW), F.least(div(now_ms, 5, 4), F.lit(SCAN_MAX_MS)))
        .otherwise(now_ms)
    )


def should_block(scope: Column, n_tables: Column, split_table: Column, sync_point: Column) -> Column:
    """A schema change blocks if it concerns a database or everything, several
    tables or a table that is split; a sync point always does."""
    return sync_point | scope.isin("db", "all") | (n_tables > 1) | split_table


def paused(df: DataFrame, keys: list[str], order: list[str], usage: str, pause: int, resume: int) -> DataFrame:
    """Adds ``paused``: true from a usage of ``pause`` percent on until it falls
    below ``resume``; the last of the two events decides."""
    flag = F.when(F.col(usage) >= pause, True).when(F.col(usage) < resume, False)
    seen = last_known(df.withColumn("__flag", flag), keys, [F.col(c) for c in order], F.col("__flag"), "__before")
    return seen.select(*keys, *order, F.coalesce("__flag", "__before", F.lit(False)).alias("paused"))
