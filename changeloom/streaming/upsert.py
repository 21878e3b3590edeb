"""Rebuild tables from a feed of inserts, updates and deletes.

Method: a keyed streaming state. Per row key the state store holds the newest
change: its sequence, its payload and whether it is a tombstone. A change enters
the state only if its sequence is higher, so repeats and late changes have no
effect. Each micro-batch emits the state of the keys it touched, and
``foreachBatch`` writes them below ``version=<batch id>``, overwriting what an
earlier try of the same batch left: the output is idempotent. The current table
is the highest sequence per key over all versions, without tombstones.

The state lives in RocksDB on the executors' disks and is checkpointed to the
shared folder, so it neither needs the heap nor is lost with an executor. The
aggregation combines on the map side: a hot key sends one row per task.

Sequence: (commit_ts, rank, start_ts), where within one commit_ts a delete has
rank 0, the removal of the old key by an update 1, the write of an update 2 and
an insert 3.

:func:`compact` folds the written versions into one, without tombstones: the
state store still knows the newest change of every key, so a later version only
brings newer ones. The state itself keeps one row per key ever seen, tombstones
included, since a change may arrive any time later.

Defined results: rows with neither image or without commit_ts are ignored; of
equal sequences (repeats) the greatest payload stays; an empty log gives an
empty table; a log that holds only tombstones too.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from changeloom.functions import rowimage as R
from changeloom.session import list_names, remove_path, work_path

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: Set for the run: state in RocksDB, with one bound for all stores of an
#: executor (their number is that of the shuffle partitions at the first run),
#: and no empty batches.
STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "256",
    "spark.sql.streaming.noDataMicroBatches.enabled": "false",
}


def row_changes(redo: DataFrame) -> DataFrame:
    """One row per write or removal of a key: ``tbl_id, row_key, seq, alive,
    payload``. An update under another key gives two."""
    row, pre = F.col("row_columns"), F.col("pre_columns")
    base = redo.select(
        F.col("tbl.tbl_id").alias("tbl_id"), "commit_ts", "start_ts",
        R.op_code(row, pre).alias("op"),
        F.when(R.present(row), R.image_key(row)).alias("new_key"),
        F.when(R.present(pre), R.image_key(pre)).alias("old_key"),
        R.image_json(row).alias("payload"),
    ).where("op is not null and commit_ts is not null")

    def change(key: str, rank: Column, payload: Column) -> Column:
        return F.struct(
            F.col(key).alias("row_key"),
            F.struct(F.col("commit_ts"), rank.cast("int").alias("rank"), F.col("start_ts")).alias("seq"),
            payload.alias("payload"),
        )

    gone = F.lit(None).cast("string")
    write = change("new_key", F.when(F.col("op") == "I", 3).otherwise(2), F.col("payload"))
    remove = change("old_key", F.lit(0), gone)
    leave = change("old_key", F.lit(1), gone)
    moved = (F.col("op") == "U") & (F.col("new_key") != F.col("old_key"))
    changes = F.when(F.col("op") == "D", F.array(remove)).when(moved, F.array(leave, write)).otherwise(F.array(write))
    return base.select("tbl_id", F.explode(changes).alias("c")).select("tbl_id", "c.*")


def newest(changes: DataFrame, keys: list[str]) -> DataFrame:
    """The newest change per key; batch or streaming (keyed state)."""
    return (
        changes.groupBy(*keys)
        .agg(F.max(F.struct("seq", "payload")).alias("last"))
        .select(*keys, F.col("last.seq").alias("seq"), F.col("last.payload").alias("payload"))
    )


def apply_feed(
    spark: SparkSession, source: DataFrame, keys: list[str], transform=row_changes, path: str | None = None
) -> str:
    """Run the feed to its present end; returns the folder of the versions.

    ``source`` is a streaming DataFrame. With ``path`` a later call goes on from
    the stored offsets and state; without, the state is dropped at the end.
    """
    root = path or work_path(spark, "upsert")
    out = f"{root}/versions"
    before = {k: spark.conf.get(k, None) for k in STATE_CONF}
    for k, v in STATE_CONF.items():
        spark.conf.set(k, v)

    def emit(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/version={batch_id}")

    try:
        query = (
            newest(transform(source), keys).writeStream.outputMode("update")
            .option("checkpointLocation", f"{root}/state").trigger(availableNow=True).foreachBatch(emit).start()
        )
        query.awaitTermination()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    if path is None:
        remove_path(spark, f"{root}/state")
    return out


_SEQ = "seq struct<commit_ts: bigint, rank: int, start_ts: bigint>"


def _numbers(spark: SparkSession, path: str, prefix: str) -> list[int]:
    return sorted(int(n.removeprefix(prefix)) for n in list_names(spark, path) if n.startswith(prefix))


def _newest_rows(spark: SparkSession, versions: str, key_types: dict[str, str], payload: str) -> tuple[DataFrame, int]:
    """Newest change per key with tombstones, and the last version in it."""
    schema = ", ".join([*(f"`{k}` {t}" for k, t in key_types.items()), _SEQ, f"payload {payload}"])
    done = [n for n in _numbers(spark, versions, "through=") if "_SUCCESS" in list_names(spark, f"{versions}/through={n}")]
    after = [n for n in _numbers(spark, versions, "version=") if not done or n > done[-1]]
    parts = [f"{versions}/through={done[-1]}"] if done else []
    parts += [f"{versions}/version={n}" for n in after]
    if not parts:
        return spark.createDataFrame([], schema), -1
    rows = spark.read.schema(schema).parquet(*parts)
    # one batch or one compacted part has each key once
    return (newest(rows, list(key_types)) if len(parts) > 1 else rows), (after or done)[-1]


def current_rows(spark: SparkSession, versions: str, key_types: dict[str, str], payload: str = "string") -> DataFrame:
    """The present table: keys, ``commit_ts`` of the writing change, payload."""
    rows, _ = _newest_rows(spark, versions, key_types, payload)
    return rows.where("payload is not null").select(*key_types, F.col("seq.commit_ts").alias("commit_ts"), "payload")


def compact(spark: SparkSession, versions: str, key_types: dict[str, str], payload: str = "string") -> None:
    """Fold all written versions into ``through=<last>`` and delete them. A try
    that was cut off leaves a folder without its mark, which is not read."""
    rows, last = _newest_rows(spark, versions, key_types, payload)
    if last < 0 or f"through={last}" in list_names(spark, versions) and f"version={last}" not in list_names(spark, versions):
        return
    rows.where("payload is not null").write.mode("overwrite").parquet(f"{versions}/through={last}")
    for prefix, ends in (("version=", last), ("through=", last - 1)):
        for n in _numbers(spark, versions, prefix):
            if n <= ends:
                remove_path(spark, f"{versions}/{prefix}{n}")


def stream_files(spark: SparkSession, reader, path: str) -> DataFrame:
    """A parquet file stream over a folder or over one single file."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if fs.getFileStatus(target).isDirectory():
        return reader.parquet(path)
    return reader.option("pathGlobFilter", target.getName()).parquet(target.getParent().toString())


def rebuild(spark: SparkSession, path: str, schema, max_files: int | None = None, max_bytes: int | None = 64 << 30) -> DataFrame:
    """Rebuild every table of the redo log stored at ``path``."""
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    elif max_bytes:
        reader = reader.option("maxBytesPerTrigger", str(max_bytes))
    versions = apply_feed(spark, stream_files(spark, reader, path), ["tbl_id", "row_key"])
    return current_rows(spark, versions, {"tbl_id": "bigint", "row_key": "string"})
