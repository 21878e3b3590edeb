"""Two-phase matching, bounded reads and log cleaning."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from changeloom.operators.ordering import row_numbers
from changeloom.session import materialize


def match(prewrites: DataFrame, commits: DataFrame, rollbacks: DataFrame, keys: list[str]) -> DataFrame:
    """Committed values. Of several prewrites of a key the largest generation
    wins, then the latest arrival; one without a value never replaces one with."""
    rank = F.struct(F.col("value").isNotNull().alias("real"), "generation", "arrival", "value")
    chosen = prewrites.groupBy(*keys).agg(F.max(rank).alias("p")).select(*keys, F.col("p.value").alias("value"))
    return chosen.join(rollbacks.select(*keys), keys, "left_anti").join(commits, keys).select(*keys, "commit_ts", "value")


def drop_stale(commits: DataFrame, span_start_ts: int) -> DataFrame:
    return commits.where(F.col("commit_ts") > span_start_ts)


def store_events(events: DataFrame, order: list[Column], resolved_ts: int) -> DataFrame:
    """The stored log: events above the resolved ts (those at or below it are
    stored already), in ranges of the order and sorted within each file, so that
    a later scan of a range of commit ts reads few row groups."""
    names = [f"__o{i}" for i in range(len(order))]
    keyed = events.where(F.col("commit_ts") > resolved_ts).select("*", *[c.alias(n) for c, n in zip(order, names)])
    return materialize(keyed.repartitionByRange(*names).sortWithinPartitions(*names).drop(*names), "events")


def resume_scan(df: DataFrame, start_ts: int, end_ts: int, last_start_ts: int) -> DataFrame:
    """(start, end] by commit_ts, going on inside ``start_ts`` after a start_ts."""
    ts = F.col("commit_ts")
    return df.where((ts <= end_ts) & ((ts > start_ts) | ((ts == start_ts) & (F.col("start_ts") > last_start_ts))))


def gc_ranges(df: DataFrame, checkpoint_ts: int, day_ms: int = 86_400_000) -> DataFrame:
    """Days that may be deleted, joined to unbroken ranges. The window runs over
    days, not over rows."""
    days = df.where(F.col("commit_ts") <= checkpoint_ts).groupBy(F.expr(f"shiftright(commit_ts, 18) div {day_ms}").alias("day")).agg(F.count("*").alias("n_rows"))
    grp = F.col("day") - F.row_number().over(Window.orderBy("day"))
    return days.withColumn("grp", grp).groupBy("grp").agg(F.min("day").alias("first_day"), F.max("day").alias("last_day"), F.sum("n_rows").alias("n_rows")).drop("grp")


def running_before(df: DataFrame, order: list[str], value: str, name: str) -> DataFrame:
    """Sum of ``value`` over all rows before each row, in parallel: rows are
    numbered by a range sort, summed in blocks of numbers, and the block sums
    are offset."""
    rows = materialize(row_numbers(df, [F.col(c) for c in order], "__no"), "numbered").withColumn("__blk", F.expr("__no div 65536"))
    sums = rows.groupBy("__blk").agg(F.sum(value).alias("__s"))
    w = Window.orderBy("__blk").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("__blk", F.coalesce(F.sum("__s").over(w), F.lit(0)).alias("__base"))
    inside = Window.partitionBy("__blk").orderBy("__no").rowsBetween(Window.unboundedPreceding, -1)
    return (
        rows.join(sums, "__blk").withColumn(name, F.coalesce(F.sum(value).over(inside), F.lit(0)) + F.col("__base"))
        .drop("__blk", "__no", "__base")
    )
