"""A change feed as one object: what to read, how to filter and route it, and
where to write it."""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from changeloom.functions import rowimage as R
from changeloom.operators import progress, rules
from changeloom.operators.ordering import op_order
from changeloom.session import read_text, write_text
from changeloom.sinks import writers


@dataclass(frozen=True)
class ChangefeedConfig:
    sink_uri: str
    start_ts: int = 0
    target_ts: int | None = None
    filter_rules: tuple[str, ...] = ("*.*",)
    event_rules: tuple[rules.EventRule, ...] = ()
    ignore_start_ts: tuple[int, ...] = ()
    routes: tuple[tuple[str, str, str], ...] = ()
    topics: tuple[tuple[str, str], ...] = ()
    default_topic: str = "default"
    partitions: int = 6
    case_sensitive: bool = False

    def validate(self) -> None:
        writers.parse_uri(self.sink_uri)
        if self.target_ts is not None and self.target_ts <= self.start_ts:
            raise ValueError("target_ts must be after start_ts")
        for _, t in self.topics:
            if not rules.topic_valid(t):
                raise ValueError(f"bad topic expression: {t}")
        if self.partitions < 1:
            raise ValueError("partitions must be positive")


@dataclass
class Changefeed:
    """create -> run -> (pause, resume, run) -> status, synced, verify_table.

    With ``root`` the state (checkpoint, number of runs) is kept in
    ``<root>/_feed.json`` and ``create`` goes on from it. Run N writes
    ``batch=N`` and only then the state, so a run that was cut off is repeated
    into the same folder.
    """

    spark: SparkSession
    config: ChangefeedConfig
    root: str | None = None
    state: str = "normal"
    checkpoint_ts: int = field(default=0)
    written_ts: int = field(default=0)
    batch: int = field(default=0)

    @classmethod
    def create(cls, spark: SparkSession, config: ChangefeedConfig, root: str | None = None) -> "Changefeed":
        config.validate()
        feed = cls(spark, config, root, checkpoint_ts=config.start_ts)
        kept = read_text(spark, f"{root}/_feed.json") if root else None
        for name, value in (json.loads(kept) if kept else {}).items():
            setattr(feed, name, value)
        return feed

    def _save(self) -> None:
        if self.root:
            kept = {n: getattr(self, n) for n in ("state", "checkpoint_ts", "written_ts", "batch")}
            write_text(self.spark, f"{self.root}/_feed.json", json.dumps(kept))

    def pause(self) -> None:
        self.state = "stopped"
        self._save()

    def resume(self) -> None:
        self.state = "normal"
        self._save()

    def _wanted(self) -> Column:
        """True for changes after the checkpoint that the filters keep."""
        c = self.config
        schema, table = R.clean_name(F.col("tbl.db_name")), R.clean_name(F.col("tbl.tbl_name"))
        keep = (F.col("commit_ts") > self.checkpoint_ts) & rules.table_filter(schema, table, list(c.filter_rules), c.case_sensitive) & rules.not_system(schema)
        if c.target_ts is not None:
            keep = keep & (F.col("commit_ts") <= c.target_ts)
        if c.ignore_start_ts:
            keep = keep & ~F.col("start_ts").isin(list(c.ignore_start_ts))
        if c.event_rules:
            keep = keep & rules.keep_event(schema, table, R.op_code(F.col("row_columns"), F.col("pre_columns")), list(c.event_rules))
        return F.coalesce(keep, F.lit(False))

    def changes(self, redo: DataFrame) -> DataFrame:
        """Filtered and routed changes after the checkpoint."""
        c = self.config
        row, pre = F.col("row_columns"), F.col("pre_columns")
        schema, table = R.clean_name(F.col("tbl.db_name")), R.clean_name(F.col("tbl.tbl_name"))
        out_schema, out_table = rules.route_table(schema, table, list(c.routes))
        key = R.row_key(row, pre)
        part = F.pmod(rules.key_hash(schema, table, [("key", key)]), F.lit(c.partitions)).cast("int")
        return redo.where(self._wanted()).select(
            "commit_ts", "start_ts", R.op_code(row, pre).alias("op"), out_schema.alias("schema"), out_table.alias("table"), key.alias("row_key"),
            R.image_json(pre).alias("pre"), R.image_json(row).alias("post"),
            rules.dispatch_topic(schema, table, list(c.topics), c.default_topic).alias("topic"), part.alias("part"))

    def run(self, redo: DataFrame, root: str | None = None, resolved_ts: int | None = None) -> int:
        """Write the changes up to ``resolved_ts`` to the sink; returns the new
        checkpoint. The log is complete up to its resolved ts, so nothing arrives
        below the checkpoint later; without one, the log counts as complete up to
        its largest commit ts. Running again without new changes writes nothing.

        The ends of the log come from one pass over its commit ts and names."""
        if self.state != "normal":
            raise RuntimeError(f"the change feed is {self.state}")
        target = self.config.target_ts
        ends = [t for t in (target, resolved_ts) if t is not None]
        log = redo if not ends else redo.where(F.col("commit_ts") <= min(ends))
        rows = self.changes(log)
        top, kept = log.agg(F.max("commit_ts"), F.max(F.when(self._wanted(), F.col("commit_ts")))).first()
        kind, _ = writers.parse_uri(self.config.sink_uri)
        root = root or self.root
        order = ["commit_ts", "start_ts", op_order()]
        if kind == "blackhole":
            rows.write.format("noop").mode("overwrite").save()
        else:
            # ranges of (folder, commit_ts): a hot table is several files in order
            by = ["topic", "part"] if kind == "messages" else ["schema", "table"]
            placed = rows.repartitionByRange(*by, "commit_ts").sortWithinPartitions(*by, *order)
            placed.write.mode("overwrite").partitionBy(*by).format("json" if kind == "messages" else "parquet").save(f"{root}/batch={self.batch}")
        self.written_ts = max(self.written_ts, kept or 0)
        reached = resolved_ts if resolved_ts is not None else top or 0
        self.checkpoint_ts = max(self.checkpoint_ts, reached if target is None else min(reached, target))
        self.batch += 1
        if target is not None and self.checkpoint_ts >= target:
            self.state = "finished"
        self._save()
        return self.checkpoint_ts

    def status(self) -> dict:
        return {"state": self.state, "checkpoint_ts": self.checkpoint_ts, "checkpoint_ms": self.checkpoint_ts >> 18, "last_written_ts": self.written_ts}

    def synced(self, now_ms: int) -> str:
        one = self.spark.range(1).select(progress.synced_status(F.lit(now_ms), F.lit(self.written_ts >> 18), F.lit(self.checkpoint_ts >> 18)))
        return one.first()[0]

    def verify_table(self, redo: DataFrame) -> DataFrame:
        """Per table whether the filter keeps it and all its rows have a key."""
        c = self.config
        schema, table = R.clean_name(F.col("tbl.db_name")), R.clean_name(F.col("tbl.tbl_name"))
        key = R.row_key(F.col("row_columns"), F.col("pre_columns"))
        return redo.groupBy(schema.alias("schema"), table.alias("table")).agg(F.bool_and(F.length(key) > 0).alias("has_key")).withColumn(
            "replicated", rules.table_filter(F.col("schema"), F.col("table"), list(c.filter_rules), c.case_sensitive) & rules.not_system(F.col("schema")))
