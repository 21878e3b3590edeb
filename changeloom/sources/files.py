"""Stored change logs: object storage layout, message directories, redo files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from changeloom.operators.ordering import op_order

#: ``schema/table/version[/partition][/date]/CDCnnnnnn.ext``
_PATH = r"([^/]+)/([^/]+)/(\d+)(?:/(\d+))?(?:/(\d{4}(?:-\d{2}(?:-\d{2})?)?))?/CDC(\d{6,20})\.(\w+)$"


def path_columns(path: Column, partitioned: bool = True) -> list[Column]:
    """The parts of a data file's path; null where the layout does not have one.
    A layout by year needs ``partitioned`` false if it has no partition folders,
    as a year looks like one."""
    form = _PATH if partitioned else _PATH.replace(r"(?:/(\d+))?", "()", 1)
    part = lambda i: F.nullif(F.regexp_extract(path, form, i), F.lit(""))
    return [
        part(1).alias("schema"), part(2).alias("table"), part(3).cast("bigint").alias("version"), part(4).cast("bigint").alias("partition"),
        part(5).alias("date"), part(6).cast("bigint").alias("file_no"), part(7).alias("extension"),
    ]


def file_order() -> list[Column]:
    """Reading order of data files; a missing partition or date sorts first."""
    return [F.col(c).asc_nulls_first() for c in ("version", "partition", "date", "schema", "table", "file_no")]


def new_files(before: DataFrame, now: DataFrame) -> DataFrame:
    """Ranges of file numbers that are new since the last look, per path."""
    keys = ["schema", "table", "version"]
    done = before.groupBy(*keys).agg(F.max("file_no").alias("done"))
    last = now.groupBy(*keys).agg(F.max("file_no").alias("last"))
    j = last.join(done, keys, "left")
    return j.where(F.col("last") > F.coalesce("done", F.lit(0))).select(*keys, (F.coalesce("done", F.lit(0)) + 1).alias("from_no"), F.col("last").alias("to_no"))


def read_storage(spark: SparkSession, root: str, partitioned: bool = True) -> DataFrame:
    """Lines of all data files with their path columns."""
    lines = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "CDC[0-9]*").text(root)
    return lines.select("value", *path_columns(F.col("_metadata.file_path"), partitioned))


def read_messages(spark: SparkSession, root: str, schema: str) -> DataFrame:
    """JSON lines below ``topic=/part=`` folders."""
    return spark.read.schema(f"{schema}, topic string, part int").json(root)


def read_redo(df: DataFrame, checkpoint_ts: int, resolved_ts: int) -> DataFrame:
    """Redo rows of (checkpoint, resolved], in replay order."""
    ts = F.col("commit_ts")
    return df.where((ts > checkpoint_ts) & (ts <= resolved_ts)).orderBy("commit_ts", "start_ts", op_order())
