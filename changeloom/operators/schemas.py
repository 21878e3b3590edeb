"""Schema versions: histories, as-of lookup, snapshots and the effects of
schema changes on the set of physical tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

def versions(ddl: DataFrame) -> DataFrame:
    """``table_id, from_ts, to_ts, version``: half-open lifetimes; a drop ends the
    last one and starts none."""
    w = Window.partitionBy("table_id").orderBy("finished_ts")
    rows = ddl.withColumn("to_ts", F.lead("finished_ts").over(w)).withColumn("version", F.row_number().over(w))
    return rows.where("kind <> 'drop table'").select("table_id", F.col("finished_ts").alias("from_ts"), "to_ts", "version", "kind")


def asof_join(left: DataFrame, vers: DataFrame, key: str, ts: str, cells: int = 256) -> DataFrame:
    """Attaches the newest version at or before ``ts``; rows without one are
    dropped (the table does not exist then).

    The time line is cut into ``cells`` cells and each lifetime is listed under
    the cells it meets, so the join is an equality on (key, cell): a hot table is
    spread over cells and nothing is sorted per key. Lifetimes become at most
    their number plus ``cells`` per table.
    """
    lo, hi = vers.agg(F.min("from_ts"), F.max(F.greatest("from_ts", F.coalesce("to_ts", "from_ts")))).first()
    if lo is None:
        return left.limit(0).withColumn("version", F.lit(None).cast("int"))
    width = max(1, -(-(hi - lo + 1) // cells))
    cell = lambda c: F.greatest(F.lit(0), F.least(F.lit(cells), F.floor((c - lo) / width)))
    last = F.coalesce(cell(F.col("to_ts") - 1), F.lit(cells))
    listed = vers.select(F.col(key).alias("__k"), "from_ts", "to_ts", "version", F.explode(F.sequence(cell(F.col("from_ts")), last)).alias("__cell"))
    j = left.withColumn("__cell", cell(F.col(ts))).join(
        listed.withColumnRenamed("__cell", "__c"), (F.col(key) == F.col("__k")) & (F.col("__cell") == F.col("__c")) & (F.col(ts) >= F.col("from_ts")) & (F.col("to_ts").isNull() | (F.col(ts) < F.col("to_ts"))))
    return j.select(*left.columns, "version", F.col("from_ts").alias("schema_ts"))


def snapshot(ddl: DataFrame, ts: int) -> DataFrame:
    """Tables that exist at ``ts``: the newest change of each is no drop."""
    last = ddl.where(F.col("finished_ts") <= ts).groupBy("table_id").agg(F.max_by("kind", "finished_ts").alias("kind"), F.max("finished_ts").alias("schema_ts"))
    return last.where("kind <> 'drop table'").select("table_id", "schema_ts")


def gc_versions(vers: DataFrame, ts: int) -> DataFrame:
    """Versions to keep: those alive at or after ``ts``."""
    return vers.where(F.col("to_ts").isNull() | (F.col("to_ts") > ts))


def partition_changes(before: Column, after: Column) -> tuple[Column, Column]:
    """(dropped ids, created ids) of a change of partitions."""
    return F.array_except(before, after), F.array_except(after, before)


def unsorted_cache(jobs: DataFrame, ts: int) -> DataFrame:
    """Finished jobs up to ``ts`` in order, equal ones once."""
    return jobs.where(F.col("finished_ts") <= ts).dropDuplicates(["finished_ts", "job"])


def split_multi(ddl: DataFrame, query: str) -> DataFrame:
    """One row per statement of a change that names several tables."""
    return ddl.withColumn("part", F.explode(F.filter(F.transform(F.split(query, ";"), lambda s: F.trim(s)), lambda s: s != "")))
