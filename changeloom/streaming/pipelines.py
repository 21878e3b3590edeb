"""Streaming operators that run to the present end of their source, each with
the same result as its batch form."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from changeloom.functions.codecs.formats import batch_messages
from changeloom.operators.ordering import runs
from changeloom.session import list_names, read_text, remove_path, work_path, write_text
from changeloom.streaming.upsert import stream_files


def run_available(stream: DataFrame, handle: Callable[[DataFrame, int], None], mode: str = "append", checkpoint: str | None = None) -> None:
    """Run ``handle`` on every micro-batch until the source has no more."""
    spark = stream.sparkSession
    path = checkpoint or work_path(spark, "stream")
    q = stream.writeStream.outputMode(mode).option("checkpointLocation", path).trigger(availableNow=True).foreachBatch(handle).start()
    q.awaitTermination()


def stream_table(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(spark.read.parquet(path).schema)
    return stream_files(spark, reader.option("maxFilesPerTrigger", max_files) if max_files else reader, path)


def replayable(df: DataFrame, name: str, files: int) -> tuple[str, DataFrame]:
    """``df`` written as ``files`` files and read as a stream of one file per
    batch: a feed that arrives in pieces."""
    spark = df.sparkSession
    path = work_path(spark, name)
    df.repartition(files).write.parquet(path)
    return path, stream_table(spark, path, 1)


def windowed_counts(stream: DataFrame, ts: str, key: str, width: str, slide: str | None, delay: str) -> DataFrame:
    """Event-time windows: count and largest time per window and key."""
    return stream.withWatermark(ts, delay).groupBy(F.window(ts, width, slide) if slide else F.window(ts, width), key).agg(F.count("*").alias("n"), F.max(ts).alias("last"))


def latest_of_updates(stream: DataFrame, keys: list[str], schema: str) -> DataFrame:
    """Runs an update-mode aggregation; the last update of each key."""
    spark = stream.sparkSession
    out = work_path(spark, "updates")
    run_available(stream, lambda b, i: b.write.mode("overwrite").parquet(f"{out}/version={i}"), "update")
    rows = spark.read.schema(f"{schema}, version bigint").parquet(out)
    values = [c for c in rows.columns if c not in (*keys, "version")]
    return rows.groupBy(*keys).agg(F.max_by(F.struct(*values), "version").alias("x")).select(*keys, *[F.col(f"x.{v}").alias(v) for v in values])


def queue_batches(events: DataFrame, path: str, order: list, group: str, size: str, max_bytes: int, max_events: int) -> DataFrame:
    """Adds ``group_no`` and ``batch`` to the events of each path's queue: a batch
    holds consecutive events of one data group within the limits."""
    changed = F.col("is_first") | ~F.col(f"prev_{group}").eqNullSafe(F.col(group))
    parts = runs(events, [path], order, [group], changed)
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.unionByName(p)
    rows = rows.withColumnRenamed("__run", "group_no").drop("is_first", f"prev_{group}")
    return batch_messages(rows, [path, "group_no"], order, F.col(size), max_bytes, max_events)


class ResolvedBuffer:
    """Releases rows once the data's own watermark has passed them.

    Rows wait in ``pending/version=N`` until a batch brings a resolved ts at or
    above their commit_ts; released ones go to ``out/version=N`` and rows at or
    below the watermark when they arrive to ``late/version=N``. The watermark of
    batch N is stored in ``marks/N``: it never goes back, another driver goes on
    from it, and a batch that runs again overwrites its own folders.
    """

    def __init__(self, spark: SparkSession, schema: str, root: str | None = None):
        self.spark, self.schema = spark, schema
        self.root = root or work_path(spark, "resolved")

    def mark(self, batch_id: int) -> int:
        """The watermark after a batch, 0 before the first."""
        return int(read_text(self.spark, f"{self.root}/marks/{batch_id}") or 0)

    def last_batch(self) -> int:
        return max((int(n) for n in list_names(self.spark, f"{self.root}/marks") if n.isdigit()), default=-1)

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        before = self.mark(batch_id - 1)
        batch = batch.persist()
        top = batch.where("kind = 'resolved'").agg(F.max("commit_ts")).first()[0] or 0
        mark = max(before, top)
        cols = [c for c in batch.columns if c != "kind"]
        arrived = batch.where("kind = 'row'").select(*cols)
        rows = arrived.where(F.col("commit_ts") > before)
        if f"version={batch_id - 1}" in list_names(self.spark, f"{self.root}/pending"):
            rows = rows.unionByName(self.spark.read.schema(self.schema).parquet(f"{self.root}/pending/version={batch_id - 1}"))
        put = lambda d, part: d.write.mode("overwrite").parquet(f"{self.root}/{part}/version={batch_id}")
        put(rows.where(F.col("commit_ts") > mark), "pending")
        put(rows.where(F.col("commit_ts") <= mark), "out")
        put(arrived.where(F.col("commit_ts") <= before), "late")
        batch.unpersist()
        write_text(self.spark, f"{self.root}/marks/{batch_id}", str(mark))
        # a batch only reads the one before
        remove_path(self.spark, f"{self.root}/pending/version={batch_id - 2}")

    def _read(self, part: str) -> DataFrame:
        return self.spark.read.schema(f"{self.schema}, version bigint").parquet(f"{self.root}/{part}")

    def released(self) -> DataFrame:
        return self._read("out")

    def late(self) -> DataFrame:
        return self._read("late")
