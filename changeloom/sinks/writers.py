"""Sinks: choice by URI, SQL text, storage layout, messages, redo, snapshots."""

from __future__ import annotations

import json
import re
import uuid
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from changeloom.functions.codecs.formats import definition_checksum
from changeloom.operators.ordering import place_in_key
from changeloom.session import list_names, remove_path, rename_path, write_text
from changeloom.streaming.upsert import apply_feed, current_rows

#: Kind of sink by URI scheme, fixed values.
SCHEMES = {"mysql": "database", "mysql+ssl": "database", "kafka": "messages", "kafka+ssl": "messages", "pulsar": "messages", "pulsar+ssl": "messages",
           "pulsar+http": "messages", "pulsar+https": "messages", "s3": "storage", "file": "storage", "gcs": "storage", "gs": "storage", "azure": "storage", "azblob": "storage", "noop": "storage", "blackhole": "blackhole"}


def sink_kind(uri: Column) -> Column:
    codes = F.create_map(*[F.lit(x) for kv in SCHEMES.items() for x in kv])
    return F.try_element_at(codes, F.lower(F.regexp_extract(uri, r"^([A-Za-z0-9+]+)://", 1)))


def sql_literal(v: Column, kind: str) -> Column:
    text = F.concat(F.lit("'"), F.replace(v.cast("string"), F.lit("'"), F.lit("''")), F.lit("'")) if kind == "varchar" else v.cast("string")
    return F.coalesce(text, F.lit("NULL"))


def statements(table: str, keys: dict[str, str], values: dict[str, str], replace: bool = False) -> Column:
    """The SQL statement of one change (``pre_`` and ``post_`` columns)."""
    cols = keys | values
    names = ",".join(f"`{c}`" for c in cols)
    row = lambda p: F.concat_ws(",", *[sql_literal(F.col(f"{p}_{c}"), k) for c, k in cols.items()])
    where = F.concat_ws(" AND ", *[F.concat(F.lit(f"`{c}` "), F.when(F.col(f"pre_{c}").isNull(), "IS NULL").otherwise(F.concat(F.lit("= "), sql_literal(F.col(f"pre_{c}"), k)))) for c, k in keys.items()])
    sets = F.concat_ws(",", *[F.concat(F.lit(f"`{c}` = "), sql_literal(F.col(f"post_{c}"), k)) for c, k in cols.items()])
    verb = "REPLACE" if replace else "INSERT"
    return (
        F.when(F.col("op") == "I", F.concat(F.lit(f"{verb} INTO {table} ({names}) VALUES ("), row("post"), F.lit(")")))
        .when(F.col("op") == "U", F.concat(F.lit(f"UPDATE {table} SET "), sets, F.lit(" WHERE "), where, F.lit(" LIMIT 1")))
        .otherwise(F.concat(F.lit(f"DELETE FROM {table} WHERE "), where, F.lit(" LIMIT 1")))
    )


def batched_deletes(df: DataFrame, table: str, key: str, group: list[Column], size: int) -> DataFrame:
    """Deletes of a group as ``DELETE ... WHERE (key) IN (...)``, at most ``size``
    keys in a statement."""
    names = [f"__g{i}" for i in range(len(group))]
    d = df.where("op = 'D'").select(F.col(key).alias("__k"), *[g.alias(n) for g, n in zip(group, names)])
    d = place_in_key(d, names, [F.col("__k")], "__place").withColumn("chunk", F.floor(F.col("__place") / F.lit(size)))
    listed = d.groupBy(*names, "chunk").agg(F.array_sort(F.collect_list("__k")).alias("ks"))
    text = F.concat(F.lit(f"DELETE FROM {table} WHERE (`{key}`) IN ("), F.array_join(F.transform("ks", lambda k: F.concat(F.lit("("), k.cast("string"), F.lit(")"))), ","), F.lit(")"))
    return listed.select(*names, "chunk", text.alias("statement"))


def write_storage(df: DataFrame, root: str, line: str, path: list[str], order: list[Column], max_lines: int, extension: str, checkpoint_ts: int | None = None, definitions: dict[tuple[str, str, int], dict] | None = None) -> int:
    """Text files ``<path values>/CDCnnnnnn.<extension>`` with an index file
    ``meta/CDC.index`` in each folder that names the last, schema files
    ``schema/table/meta/schema_<version>_<checksum>.json`` and the ``metadata``
    file of the checkpoint. Returns the number of files.

    ``path`` are the columns schema, table, version and then partition and date
    where the layout has them. Rows are written in ranges of (path, order), so a
    hot table is many files in order. File numbers go on from those that are
    there; a file gets its name when its batch is complete, one rename a file, as
    the output committer does it. Readers see only named files."""
    spark = df.sparkSession
    staging = f"{root}/_staging-{uuid.uuid4().hex[:12]}"
    keys = [f"__o{i}" for i in range(len(order))]
    rows = df.select(F.col(line).alias("value"), *path, *[c.alias(k) for c, k in zip(order, keys)])
    placed = rows.repartitionByRange(*path, *keys).sortWithinPartitions(*path, *keys).drop(*keys)
    placed.write.option("maxRecordsPerFile", max_lines).partitionBy(*path).text(staging)
    n = 0
    for folder in _leaves(spark, staging, len(path)):
        target = f"{root}/" + "/".join(unquote(p.partition("=")[2]) for p in folder.split("/"))
        last = max((int(m[1]) for x in list_names(spark, target) if (m := re.match(r"CDC(\d+)\.", x))), default=0)
        for name in sorted(x for x in list_names(spark, f"{staging}/{folder}") if x.startswith("part-")):
            last, n = last + 1, n + 1
            rename_path(spark, f"{staging}/{folder}/{name}", f"{target}/CDC{last:06d}.{extension}")
        write_text(spark, f"{target}/meta/CDC.index", f"CDC{last:06d}.{extension}\n")
    remove_path(spark, staging)
    for (schema, table, version), d in (definitions or {}).items():
        write_text(spark, f"{root}/{schema}/{table}/meta/schema_{version}_{definition_checksum(d):010d}.json", json.dumps(d, indent=4))
    if checkpoint_ts is not None:
        write_text(spark, f"{root}/metadata", checkpoint_document(checkpoint_ts))
    return n


def _leaves(spark: SparkSession, root: str, depth: int, at: str = "") -> list[str]:
    """Folders ``a=1/b=2/...`` of the depth below a root."""
    if not depth:
        return [at]
    names = [x for x in list_names(spark, f"{root}/{at}") if "=" in x]
    return [leaf for x in names for leaf in _leaves(spark, root, depth - 1, f"{at}/{x}" if at else x)]


def write_messages(df: DataFrame, root: str) -> None:
    """JSON lines in ``topic=/part=`` folders."""
    df.write.partitionBy("topic", "part").mode("overwrite").json(root)


def checkpoint_document(ts: int) -> str:
    """The ``metadata`` file of a storage sink."""
    return json.dumps({"checkpoint-ts": ts}, separators=(",", ":"))


def expired(files: DataFrame, date: str, keep_days: int, checkpoint_ts: int) -> DataFrame:
    """Dated files older than ``keep_days`` before the checkpoint's date."""
    day = F.to_date(F.timestamp_millis(F.lit(checkpoint_ts >> 18)))
    return files.where(F.to_date(F.col(date)) < F.date_sub(day, keep_days))


def write_redo(df: DataFrame, root: str, checkpoint_ts: int, resolved_ts: int, resource: str = "redo") -> None:
    """Redo rows and the meta row."""
    df.write.mode("overwrite").parquet(f"{root}/rows")
    df.sparkSession.createDataFrame([(checkpoint_ts, resolved_ts, resource)], "checkpoint_ts bigint, resolved_ts bigint, resource string").write.mode("overwrite").parquet(f"{root}/meta")


def redo_garbage(df: DataFrame, checkpoint_ts: int, file: str) -> DataFrame:
    """Redo files whose newest row is at or before the checkpoint."""
    return df.groupBy(file).agg(F.max("commit_ts").alias("newest")).where(F.col("newest") <= checkpoint_ts)


def apply_to_table(spark: SparkSession, stream: DataFrame, keys: dict[str, str], values: dict[str, str], rank: Column, path: str | None = None) -> DataFrame:
    """Database apply of a streamed feed with ``op, commit_ts, start_ts``: the
    table after all its changes. Keyed state keeps the newest change of each key,
    so repeated and late batches change nothing, and a batch writes only the keys
    it touched."""
    image = F.struct(*values)

    def changes(df: DataFrame) -> DataFrame:
        seq = F.struct("commit_ts", rank.cast("int").alias("rank"), "start_ts").alias("seq")
        return df.where("commit_ts is not null").select(*keys, seq, F.when(F.col("op") != "D", image).alias("payload"))

    versions = apply_feed(spark, stream, list(keys), changes, path)
    shape = "struct<" + ", ".join(f"`{v}`: {t}" for v, t in values.items()) + ">"
    return current_rows(spark, versions, keys, shape).select(*keys, "payload.*")


def dry_run(statements: DataFrame, column: str, delay_ms: float = 0.0) -> DataFrame:
    """What a database sink would do, without doing it: per verb the number of
    statements, their bytes and the time they would take at ``delay_ms`` each."""
    verb = F.upper(F.regexp_extract(column, r"^\s*(\w+)", 1)).alias("verb")
    return statements.groupBy(verb).agg(F.count("*").alias("n"), F.sum(F.octet_length(column)).alias("n_bytes"), (F.count("*") * F.lit(delay_ms)).alias("ms"))


def upsert_progress(spark: SparkSession, root: str, update: DataFrame, keys: list[str], ts: str, batch_id: int) -> DataFrame:
    """The progress table after a batch: the largest ts per key of the stored
    version and the update. Versions are written whole (a row per table), a batch
    that runs again overwrites its own, and only the last two stay."""
    stored = [n for n in (batch_id - 1,) if f"version={n}" in list_names(spark, root)]
    rows = update.select(*keys, ts)
    if stored:
        rows = rows.unionByName(spark.read.schema(rows.schema).parquet(f"{root}/version={stored[0]}"))
    rows.groupBy(*keys).agg(F.max(ts).alias(ts)).write.mode("overwrite").parquet(f"{root}/version={batch_id}")
    remove_path(spark, f"{root}/version={batch_id - 2}")
    return spark.read.schema(rows.schema).parquet(f"{root}/version={batch_id}")


def record_syncpoints(points: DataFrame, keep: int) -> DataFrame:
    """``primary_ts, secondary_ts`` of the newest ``keep`` sync points: the first
    secondary ts that was reported at or after the primary one."""
    last = points.where(F.col("secondary_ts") >= F.col("primary_ts")).groupBy("primary_ts").agg(F.min("secondary_ts").alias("secondary_ts"))
    # the kept rows are the result: at most ``keep``
    return last.orderBy(F.desc("primary_ts")).limit(keep)


def parse_uri(uri: str) -> tuple[str, dict[str, str]]:
    """Kind and parameters of a sink URI."""
    scheme = re.match(r"^([A-Za-z0-9+]+)://", uri)
    if not scheme or scheme[1].lower() not in SCHEMES:
        raise ValueError(f"unknown sink: {uri}")
    _, _, query = uri.partition("?")
    return SCHEMES[scheme[1].lower()], dict(p.partition("=")[::2] for p in query.split("&") if p)
