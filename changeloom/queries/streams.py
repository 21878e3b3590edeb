"""Sinks, streaming operators, comparison, workloads and the change feed."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from changeloom.functions import rowimage as RI
from changeloom.functions import scalars as FS
from changeloom.operators import compaction as C
from changeloom.operators import copy_diff as CD
from changeloom.operators import ordering as O
from changeloom.operators import progress as P
from changeloom.operators.sequence import scan_windows
from changeloom.plans import extensions as X
from changeloom.plans.changefeed import Changefeed, ChangefeedConfig
from changeloom.plans.logs import ctes, log
from changeloom.operators.rules import EventRule
from changeloom.queries.registry import Registry
from changeloom.session import work_path
from changeloom.sinks import writers as W
from changeloom.sources import files as SF
from changeloom.streaming import pipelines as ST

R = Registry()
q = R.query
OL = f"WITH {ctes('orders_log')}"
HL = f"WITH {ctes('history_log')}"
DAY = 86_400_000


# sources


@q("SELECT msg_id, split_part(file_name, '/', 1) AS schema, split_part(file_name, '/', 2) AS \"table\", CAST(split_part(file_name, '/', 3) AS BIGINT) AS version, CAST(substr(split_part(file_name, '/', 4), 4, 6) AS BIGINT) AS file_no FROM sink_message")
def src_file(spark, d):
    m = spark.read.parquet(f"{d}/sink_message.parquet")
    return m.select("msg_id", *SF.path_columns(F.col("file_name"))).select("msg_id", "schema", "table", "version", "file_no")


@q("WITH n AS (SELECT topic, max(file_seq) AS last FROM sink_message GROUP BY topic), b AS (SELECT topic, max(file_seq) AS done FROM sink_message WHERE msg_id % 3 = 0 GROUP BY topic) SELECT topic, coalesce(done, 0) + 1 AS from_no, last AS to_no FROM n LEFT JOIN b USING (topic) WHERE last > coalesce(done, 0)")
def src_file_new(spark, d):
    m = spark.read.parquet(f"{d}/sink_message.parquet").select("msg_id", F.col("topic").alias("schema"), F.lit("t").alias("table"), F.lit(1).alias("version"), F.col("file_seq").alias("file_no"))
    return SF.new_files(m.where("msg_id % 3 = 0"), m).select(F.col("schema").alias("topic"), "from_no", "to_no")


def _messages(spark, d):
    return log(spark, d, "orders_log").select("k", "op", "commit_ts", F.concat(F.lit("shop_"), F.lower("s")).alias("topic"), (F.col("c") % 3).cast("int").alias("part"))


_MSG = f"{OL} SELECT 'shop_' || lower(s) AS topic, CAST(c % 3 AS INTEGER) AS part, count(*) AS n, max(commit_ts) AS watermark, CAST(sum(k) AS BIGINT) AS total FROM orders_log GROUP BY 1, 2"


@q(_MSG)
def src_mq(spark, d):
    root = work_path(spark, "mq")
    W.write_messages(_messages(spark, d), root)
    back = SF.read_messages(spark, root, "k bigint, op string, commit_ts bigint")
    return back.groupBy("topic", "part").agg(F.count("*").alias("n"), F.max("commit_ts").alias("watermark"), F.sum("k").alias("total"))


@q("SELECT log_id, commit_ts, start_ts FROM redo_dml WHERE commit_ts > 464700000000000000 AND commit_ts <= 465100000000000000")
def src_redo(spark, d):
    redo = spark.read.parquet(f"{d}/redo_dml.parquet").withColumn("op", RI.op_code(F.col("row_columns"), F.col("pre_columns")))
    return SF.read_redo(redo, 464700000000000000, 465100000000000000).select("log_id", "commit_ts", "start_ts")


@q("SELECT log_id, commit_ts FROM redo_dml WHERE commit_ts > 464700000000000000")
def src_raw(spark, d):
    """Subscription from a start ts: a stream over the stored log."""
    rows = ST.stream_table(spark, f"{d}/redo_dml.parquet").where("commit_ts > 464700000000000000").select("log_id", "commit_ts")
    out = work_path(spark, "subscribed")
    ST.run_available(rows, lambda b, i: b.write.mode("overwrite").parquet(f"{out}/version={i}"))
    return spark.read.schema("log_id bigint, commit_ts bigint, version bigint").parquet(out).drop("version")


@q("SELECT coalesce(len(row_columns), 0) > 0 AS has_new, coalesce(len(pre_columns), 0) > 0 AS has_old, count(*) AS n, CAST(sum(coalesce(len(row_columns), 0) + coalesce(len(pre_columns), 0)) AS BIGINT) AS n_columns FROM redo_dml GROUP BY 1, 2")
def cd_redo(spark, d):
    """Redo rows written and read back with all their images."""
    root = work_path(spark, "redo-codec")
    W.write_redo(spark.read.parquet(f"{d}/redo_dml.parquet"), root, 0, 1 << 62)
    back = spark.read.parquet(f"{root}/rows")
    size = lambda c: F.coalesce(F.size(c), F.lit(0))
    images = back.select(RI.present(F.col("row_columns")).alias("has_new"), RI.present(F.col("pre_columns")).alias("has_old"), (F.greatest(size("row_columns"), F.lit(0)) + F.greatest(size("pre_columns"), F.lit(0))).alias("c"))
    return images.groupBy("has_new", "has_old").agg(F.count("*").alias("n"), F.sum("c").alias("n_columns"))


# sinks


@q("SELECT p_partkey AS id, CASE p_size % 6 WHEN 0 THEN 'database' WHEN 1 THEN 'messages' WHEN 2 THEN 'messages' WHEN 3 THEN 'storage' WHEN 4 THEN 'blackhole' ELSE NULL END AS kind FROM part")
def sk_dispatch(spark, d):
    schemes = F.array(*[F.lit(s) for s in ("mysql", "kafka+ssl", "pulsar", "S3", "blackhole", "unknown")])
    uri = F.concat(F.get(schemes, F.col("p_size") % 6), F.lit("://host/path?x=1"))
    return spark.read.parquet(f"{d}/part.parquet").select(F.col("p_partkey").alias("id"), W.sink_kind(uri).alias("kind"))


_LAST = "SELECT *, row_number() OVER (PARTITION BY k ORDER BY commit_ts DESC, start_ts DESC) AS rn FROM orders_log"


@q(f"{OL}, l AS ({_LAST}) SELECT k, post_p, c FROM l WHERE rn = 1 AND op <> 'D'")
def sk_db(spark, d):
    """Applied as a stream of three files through the keyed state, so batches may
    come in any order; each writes the keys it touched, once."""
    rows = log(spark, d, "orders_log").select("k", "op", "commit_ts", "start_ts", "post_p", "c")
    _, stream = ST.replayable(rows, "feed", 3)
    return W.apply_to_table(spark, stream, {"k": "bigint"}, {"post_p": "bigint", "c": "bigint"}, O.op_order())


@q(f"""{OL} SELECT k, commit_ts, CASE op WHEN 'I' THEN 'REPLACE INTO `shop`.`orders` (`k`,`p`,`s`) VALUES (' || CAST(k AS VARCHAR) || ',' || CAST(post_p AS VARCHAR) || ',''' || s || ''')'
 WHEN 'U' THEN 'UPDATE `shop`.`orders` SET `k` = ' || CAST(k AS VARCHAR) || ',`p` = ' || CAST(post_p AS VARCHAR) || ',`s` = ''' || s || ''' WHERE `k` = ' || CAST(k AS VARCHAR) || ' LIMIT 1'
 ELSE 'DELETE FROM `shop`.`orders` WHERE `k` = ' || CAST(k AS VARCHAR) || ' LIMIT 1' END AS statement FROM orders_log""")
def sk_sql(spark, d):
    o = log(spark, d, "orders_log").select("op", "commit_ts", "k", F.col("k").alias("pre_k"), F.col("k").alias("post_k"), F.col("pre_p"), F.col("post_p"), F.col("s").alias("pre_s"), F.col("s").alias("post_s"))
    return o.select("k", "commit_ts", W.statements("`shop`.`orders`", {"k": "bigint"}, {"p": "bigint", "s": "varchar"}, replace=True).alias("statement"))


@q(f"{OL}, x AS (SELECT k, c % 20 AS g, (row_number() OVER (PARTITION BY c % 20 ORDER BY k) - 1) // 40 AS chunk FROM orders_log WHERE op = 'D') SELECT g, chunk, 'DELETE FROM `shop`.`orders` WHERE (`k`) IN (' || string_agg('(' || CAST(k AS VARCHAR) || ')', ',' ORDER BY k) || ')' AS statement FROM x GROUP BY g, chunk")
def sk_sql_batch(spark, d):
    rows = W.batched_deletes(log(spark, d, "orders_log"), "`shop`.`orders`", "k", [F.col("c") % 20], 40)
    return rows.withColumnRenamed("__g0", "g")


@q(f"WITH {ctes('ddl_log')} SELECT table_id, job, CASE WHEN n % 3 = 0 OR n % 5 = 0 THEN finished_ts ELSE finished_ts - 1 END AS start_ts, NOT (n % 3 = 0) AND NOT (n % 5 = 0) AS skip_dml FROM ddl_log")
def sk_ddlts(spark, d):
    start, skip = P.ddl_recovery(F.col("finished_ts"), F.col("n") % 3 == 0, F.col("n") % 5 == 0)
    return log(spark, d, "ddl_log").select("table_id", "job", start.alias("start_ts"), skip.alias("skip_dml"))


@q(f"{OL} SELECT c % 50 AS tbl, max(commit_ts) AS checkpoint_ts FROM orders_log WHERE k % 2 = 0 OR c % 50 > 5 GROUP BY 1")
def sk_progress(spark, d):
    """The progress table over three batches, the last of them run twice."""
    o = log(spark, d, "orders_log").select((F.col("c") % 50).alias("tbl"), F.col("commit_ts").alias("checkpoint_ts"), "k")
    per = lambda rows: rows.groupBy("tbl").agg(F.max("checkpoint_ts").alias("checkpoint_ts"))
    root = work_path(spark, "progress")
    batches = [o.where("k % 4 = 0"), o.where("k % 2 = 1 and tbl > 5"), o.where("k % 4 = 2"), o.where("k % 4 = 2")]
    for n, rows in zip((0, 1, 2, 2), batches):
        table = W.upsert_progress(spark, root, per(rows), ["tbl"], "checkpoint_ts", n)
    return table


@q(f"{OL}, p AS (SELECT (commit_ts >> 18) // {DAY} * {DAY} * 262144 AS primary_ts, commit_ts AS secondary_ts FROM orders_log) SELECT primary_ts, min(secondary_ts) AS secondary_ts FROM p WHERE secondary_ts >= primary_ts GROUP BY 1 ORDER BY 1 DESC LIMIT 30")
def sk_syncpoint(spark, d):
    """The ts map of the newest thirty daily sync points."""
    day = F.expr(f"shiftright(commit_ts, 18) div {DAY}")
    points = log(spark, d, "orders_log").select((day * DAY * 262144).alias("primary_ts"), F.col("commit_ts").alias("secondary_ts"))
    return W.record_syncpoints(points, 30)


@q(f"{OL} SELECT CASE op WHEN 'I' THEN 'REPLACE' WHEN 'U' THEN 'UPDATE' ELSE 'DELETE' END AS verb, count(*) AS n, CAST(count(*) * 2.0 AS DOUBLE) AS ms FROM orders_log GROUP BY op")
def sk_dryrun(spark, d):
    """The statements of sk_sql, counted instead of run."""
    return W.dry_run(sk_sql(spark, d), "statement", 2.0).select("verb", "n", "ms")


@q(f"""WITH RECURSIVE {ctes('ev')}, x AS (SELECT k, n, event_type AS grp, 20 + v % 50 AS size FROM ev),
b AS (SELECT k, n, grp, size, CAST(0 AS BIGINT) AS batch, size AS used, 1 AS held FROM x WHERE n = 1 UNION ALL SELECT x.k, x.n, x.grp, x.size, CASE WHEN x.grp <> b.grp OR used + x.size > 150 OR held = 4 THEN batch + 1 ELSE batch END,
CASE WHEN x.grp <> b.grp OR used + x.size > 150 OR held = 4 THEN x.size ELSE used + x.size END, CASE WHEN x.grp <> b.grp OR used + x.size > 150 OR held = 4 THEN 1 ELSE held + 1 END FROM b JOIN x ON x.k = b.k AND x.n = b.n + 1)
SELECT k, min(n) AS first_n, count(*) AS n_events, CAST(sum(size) AS BIGINT) AS n_bytes FROM b GROUP BY k, batch""")
def st_dynstream(spark, d):
    """Batches of each path's queue: events of one data group, at most four and
    150 bytes."""
    x = log(spark, d, "ev").select("k", "n", F.col("event_type").alias("grp"), (F.col("v") % 50 + 20).alias("size"))
    return ST.queue_batches(x, "k", [F.col("n")], "grp", "size", 150, 4).groupBy("k", "group_no", "batch").agg(F.min("n").alias("first_n"), F.count("*").alias("n_events"), F.sum("size").alias("n_bytes")).drop("group_no", "batch")


@q("SELECT l_returnflag AS flag, upper(l_shipmode_) AS word, round(sum(l_extendedprice * l_quantity) / sum(l_quantity), 4) AS weighted FROM (SELECT *, unnest(['air', 'sea']) AS l_shipmode_ FROM lineitem) GROUP BY 1, 2")
def udf_surface(spark, d):
    """A scalar, an aggregate and a table function in Python, used from SQL."""
    X.register_scalar(spark, "shout", lambda v: v.str.upper(), "string")
    X.register_table(spark, "ways", _Ways, "way string")
    X.register_aggregate(spark, "weighted_mean", lambda v, w: float((v * w).sum() / w.sum()), "double")
    lines = spark.read.parquet(f"{d}/lineitem.parquet").select("l_returnflag", "l_extendedprice", "l_quantity")
    sums = spark.sql("SELECT l_returnflag AS flag, weighted_mean(CAST(l_extendedprice AS DOUBLE), CAST(l_quantity AS DOUBLE)) AS mean FROM {l} GROUP BY 1", l=lines)
    return spark.sql("SELECT flag, shout(way) AS word, round(mean, 4) AS weighted FROM {s}, LATERAL ways(2)", s=sums)


class _Ways:
    def eval(self, n: int):
        for word in ("air", "sea")[:n]:
            yield (word,)


@q(_MSG)
def sk_mq(spark, d):
    rows = _messages(spark, d)
    root = work_path(spark, "topics")
    W.write_messages(rows.repartition("topic", "part").sortWithinPartitions("commit_ts", O.op_order(), "k"), root)
    return SF.read_messages(spark, root, "k bigint, op string, commit_ts bigint").groupBy("topic", "part").agg(F.count("*").alias("n"), F.max("commit_ts").alias("watermark"), F.sum("k").alias("total"))


@q(f"""{OL} SELECT 'shop' AS schema, 't_' || lower(s) AS "table", k % 2 AS version, strftime(to_timestamp((commit_ts >> 18) // 1000) AT TIME ZONE 'UTC', '%Y') AS date, count(*) AS n, CAST(sum(length(op || ',' || CAST(k AS VARCHAR))) AS BIGINT) AS chars, true AS numbered FROM orders_log GROUP BY 2, 3, 4""")
def sk_storage(spark, d):
    """Change lines written in the storage layout in two batches, by year, and
    read back through the storage reader."""
    rows = log(spark, d, "orders_log").select(
        F.concat_ws(",", "op", "k").alias("line"), F.lit("shop").alias("schema"), F.concat(F.lit("t_"), F.lower("s")).alias("table"), (F.col("k") % 2).alias("version"),
        FS.date_path(F.timestamp_millis(F.shiftright("commit_ts", 18)), "year").alias("date"), "commit_ts", "k")
    root, path = work_path(spark, "storage"), ["schema", "table", "version", "date"]
    for cond in ("commit_ts <= 225000000000000000", "commit_ts > 225000000000000000"):
        W.write_storage(rows.where(cond), root, "line", path, [F.col("commit_ts"), F.col("k")], 5000, "csv", checkpoint_ts=225000000000000000)
    back = SF.read_storage(spark, root, partitioned=False)
    return back.groupBy(*path).agg(F.count("*").alias("n"), F.sum(F.length("value")).alias("chars"), (F.max("file_no") == F.count_distinct("file_no")).alias("numbered"))


@q("WITH f AS (SELECT msg_id, DATE '2026-02-20' + CAST(msg_id % 40 AS INTEGER) AS day FROM sink_message) SELECT msg_id, strftime(day, '%Y-%m-%d') AS date FROM f WHERE day < DATE '2026-03-10' - 7")
def sk_cleanup(spark, d):
    f = spark.read.parquet(f"{d}/sink_message.parquet").select("msg_id", F.date_add(F.lit("2026-02-20").cast("date"), (F.col("msg_id") % 40).cast("int")).cast("string").alias("date"))
    return W.expired(f, "date", 7, 1_773_100_800_000 << 18)


@q("SELECT log_file, max(commit_ts) AS newest FROM redo_dml GROUP BY log_file HAVING max(commit_ts) <= 465100000000000000")
def sk_redo(spark, d):
    root = work_path(spark, "redo")
    redo = spark.read.parquet(f"{d}/redo_dml.parquet").select("log_file", "commit_ts", "start_ts", "log_id")
    W.write_redo(redo, root, 465100000000000000, 1 << 62)
    at = spark.read.parquet(f"{root}/meta").first()["checkpoint_ts"]
    return W.redo_garbage(spark.read.parquet(f"{root}/rows"), at, "log_file")


@q(f"{OL} SELECT count(*) AS discarded FROM orders_log")
def sk_blackhole(spark, d):
    rows = log(spark, d, "orders_log")
    rows.write.format("noop").mode("overwrite").save()
    return rows.agg(F.count("*").alias("discarded"))


# streaming


@q(f"{HL} SELECT k, n, op, commit_ts FROM history_log WHERE commit_ts <= 447200000000000000")
def st_watermark(spark, d):
    """Rows and watermarks arrive mixed in four pieces; every row at or below
    the last resolved ts is released once."""
    rows = log(spark, d, "history_log").select(F.lit("row").alias("kind"), "k", "n", "op", "commit_ts")
    marks = spark.range(1).select(F.lit("resolved").alias("kind"), F.lit(0).cast("bigint").alias("k"), F.lit(0).alias("n"), F.lit("").alias("op"), F.lit(447200000000000000).alias("commit_ts"))
    _, stream = ST.replayable(rows, "rows", 3)
    buffer = ST.ResolvedBuffer(spark, "k bigint, n int, op string, commit_ts bigint")
    ST.run_available(stream.select("kind", "k", F.col("n").cast("int").alias("n"), "op", "commit_ts"), buffer)
    buffer(marks.select("kind", "k", F.col("n").cast("int").alias("n"), "op", "commit_ts"), buffer.last_batch() + 1)
    return buffer.released().drop("version")


@q(f"{OL}, b AS (SELECT min(commit_ts >> 18) AS lo, max(commit_ts >> 18) AS hi FROM orders_log) SELECT CAST(t AS BIGINT) * 604800000 * 262144 AS sync_ts FROM b, unnest(generate_series((lo + 604799999) // 604800000, hi // 604800000)) x(t)")
def st_tumble(spark, d):
    week = 604_800_000
    b = log(spark, d, "orders_log").agg(F.min(F.shiftright("commit_ts", 18)).alias("lo"), F.max(F.shiftright("commit_ts", 18)).alias("hi"))
    t = F.explode(F.sequence(F.expr(f"(lo + {week - 1}) div {week}"), F.expr(f"hi div {week}")))
    return b.select(t.alias("t")).select((F.col("t") * week * 262144).alias("sync_ts"))


@q(f"{OL}, l AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY commit_ts DESC, start_ts DESC) AS rn FROM orders_log WHERE commit_ts <= 226000000000000000) SELECT k, post_p FROM l WHERE rn = 1 AND op <> 'D'")
def st_snapshot(spark, d):
    return C.apply_log(log(spark, d, "orders_log"), ["k"], [F.col("commit_ts"), F.col("start_ts"), O.op_order()], ["post_p"], at_ts=226000000000000000)


@q(f"WITH {ctes('bank_log')}, d AS (SELECT (commit_ts >> 18) // 604800000 AS week, sum(delta) AS x FROM bank_log GROUP BY 1) SELECT week, CAST(sum(x) OVER (ORDER BY week) AS BIGINT) AS balance FROM d")
def st_bank_invariant(spark, d):
    """The sum of all balances is the same at every sync point."""
    weeks = log(spark, d, "bank_log").groupBy(F.expr("shiftright(commit_ts, 18) div 604800000").alias("week")).agg(F.sum("delta").alias("x"))
    # one row per week
    return weeks.select("week", F.sum("x").over(Window.orderBy("week")).alias("balance"))


@q(f"WITH {ctes('ev')}, u AS (SELECT event_id, v % 100 AS usage, 5000 AS now FROM ev) SELECT event_id, CASE WHEN usage > 90 THEN greatest(now // 4, 1000) WHEN usage > 70 THEN greatest(now // 2, 1000) WHEN usage < 10 THEN least(now * 3 // 2, 1800000) WHEN usage < 20 THEN least(now * 5 // 4, 1800000) ELSE now END AS next_ms FROM u")
def st_scanwin(spark, d):
    u = log(spark, d, "ev").select("event_id", (F.col("v") % 100).alias("usage"))
    return u.select("event_id", P.next_interval(F.lit(5000), F.col("usage"), F.col("usage")).alias("next_ms"))


@q()
def st_scanwin_fold(spark, d):
    """The interval of every user's feed after each of its samples; a fold over
    decisions, tested against the plain rules."""
    u = log(spark, d, "ev").select("k", (F.col("n") * 1500).alias("ms"), (F.col("v") % 100).alias("usage"))
    return scan_windows(u, "k", "ms", "usage")


@q(f"WITH {ctes('ev')}, f AS (SELECT k, n, CASE WHEN v % 100 >= 80 THEN 1 WHEN v % 100 < 50 THEN 0 END AS flag FROM ev), g AS (SELECT *, count(flag) OVER (PARTITION BY k ORDER BY n) AS grp FROM f) SELECT k, n, coalesce(max(flag) OVER (PARTITION BY k, grp), 0) = 1 AS paused FROM g")
def st_memctl(spark, d):
    """A path pauses at 80 % of its quota and goes on below 50 %."""
    ev = log(spark, d, "ev").select("k", "n", (F.col("v") % 100).alias("usage"))
    return P.paused(ev, ["k"], ["n"], "usage", 80, 50)


@q(f"{HL}, a AS (SELECT k, max(commit_ts) AS applied FROM history_log WHERE n <= 10 GROUP BY k), r AS (SELECT * FROM history_log WHERE n > 5) SELECT DISTINCT r.k, r.n, r.op, r.commit_ts FROM r JOIN a USING (k) WHERE r.commit_ts > a.applied")
def st_late(spark, d):
    h = log(spark, d, "history_log").select("k", "n", "op", "commit_ts")
    applied = h.where("n <= 10").groupBy("k").agg(F.max("commit_ts").alias("applied"))
    replay = h.where("n > 5")
    _, stream = ST.replayable(replay.unionByName(replay.where("n % 2 = 0")), "late", 2)
    fresh = stream.join(applied, "k").where("commit_ts > applied").drop("applied").dropDuplicates(["k", "n", "op", "commit_ts"])
    out = work_path(spark, "late-out")
    ST.run_available(fresh, lambda b, i: b.write.mode("overwrite").parquet(f"{out}/version={i}"))
    return spark.read.schema("k bigint, n int, op string, commit_ts bigint, version bigint").parquet(out).drop("version")


@q(f"{HL} SELECT k, count(*) AS released, max(commit_ts) AS up_to FROM history_log WHERE commit_ts <= 447200000000000000 GROUP BY k")
def st_group_resolve(spark, d):
    return log(spark, d, "history_log").where("commit_ts <= 447200000000000000").groupBy("k").agg(F.count("*").alias("released"), F.max("commit_ts").alias("up_to"))


@q(f"WITH {ctes('ddl_log')}, x AS (SELECT *, job * 7919 % 2003 AS arrival FROM ddl_log), w AS (SELECT *, max(finished_ts) OVER (PARTITION BY table_id ORDER BY arrival, job ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS seen FROM x) SELECT job, coalesce(finished_ts < seen, false) AS late FROM w")
def st_ddl_late(spark, d):
    x = log(spark, d, "ddl_log").withColumn("arrival", F.col("job") * 7919 % 2003)
    w = Window.partitionBy("table_id").orderBy("arrival", "job").rowsBetween(Window.unboundedPreceding, -1)
    return x.select("job", F.coalesce(F.col("finished_ts") < F.max("finished_ts").over(w), F.lit(False)).alias("late"))


@q(f"WITH {ctes('regions')}, e AS (SELECT node, count(DISTINCT region_id) AS expected FROM regions GROUP BY node), r AS (SELECT node, count(DISTINCT region_id) AS reported FROM regions WHERE NOT (node % 2 = 0 AND region_id % 10 = 3) GROUP BY node) SELECT node, expected, coalesce(reported, 0) AS reported, coalesce(reported, 0) >= expected AS done FROM e LEFT JOIN r USING (node)")
def st_barrier(spark, d):
    g = log(spark, d, "regions")
    expected = g.groupBy("node").agg(F.count_distinct("region_id").alias("expected"))
    reports = g.where("not (node % 2 = 0 and region_id % 10 = 3)").select("node", F.col("region_id").alias("dispatcher"))
    return P.barrier_done(reports, expected, ["node"])


@q(f"WITH {ctes('ddl_log')} SELECT job, kind IN ('drop table', 'truncate table', 'rename table') OR table_id % 5 = 0 AS blocks FROM ddl_log")
def st_shouldblock(spark, d):
    scope = F.when(F.col("kind").isin("drop table", "truncate table", "rename table"), "db").otherwise("normal")
    return log(spark, d, "ddl_log").select("job", P.should_block(scope, F.lit(1), F.col("table_id") % 5 == 0, F.lit(False)).alias("blocks"))


@q(f"WITH {ctes('ddl_log')}, x AS (SELECT finished_ts AS ts, 0 AS sync, job FROM ddl_log UNION ALL SELECT finished_ts, 1, job FROM ddl_log WHERE n % 4 = 0) SELECT ts, sync, job, row_number() OVER (ORDER BY ts, sync, job) AS pos FROM x")
def st_blockorder(spark, d):
    l = log(spark, d, "ddl_log")
    x = l.select(F.col("finished_ts").alias("ts"), F.lit(0).alias("sync"), "job").unionByName(l.where("n % 4 = 0").select(F.col("finished_ts").alias("ts"), F.lit(1).alias("sync"), "job"))
    return O.row_numbers(x, [F.col("ts"), F.col("sync"), F.col("job")], "pos")


@q(f"WITH {ctes('ddl_log', 'ddl_dml')}, x AS (SELECT table_id, finished_ts, coalesce(lag(finished_ts) OVER (PARTITION BY table_id ORDER BY finished_ts), 0) AS prev, job FROM ddl_log) SELECT x.job, count(m.event_id) AS flushed FROM x LEFT JOIN ddl_dml m ON m.table_id = x.table_id AND m.commit_ts > x.prev AND m.commit_ts <= x.finished_ts GROUP BY x.job")
def st_flushbeforeddl(spark, d):
    """Changes that must be written before each schema change: those since the
    one before, counted over the merged order."""
    ddl = log(spark, d, "ddl_log").select("table_id", F.col("finished_ts").alias("ts"), F.lit(1).alias("kind"), "job")
    dml = log(spark, d, "ddl_dml").select("table_id", F.col("commit_ts").alias("ts"), F.lit(0).alias("kind"), F.lit(None).cast("bigint").alias("job"))
    rows = O.sum_before(dml.unionByName(ddl), ["table_id"], [F.col("ts"), F.col("kind")], 1 - F.col("kind"), "seen")
    marks = rows.where("kind = 1")  # schema changes only: few per table
    return marks.select("job", (F.col("seen") - F.coalesce(F.lag("seen").over(Window.partitionBy("table_id").orderBy("ts")), F.lit(0))).alias("flushed"))


@q(f"WITH {ctes('ddl_log', 'ddl_dml')}, s AS (SELECT table_id, min(finished_ts) AS start_ts FROM ddl_log GROUP BY table_id), x AS (SELECT table_id, commit_ts AS ts, 0 AS kind, event_id AS ref FROM ddl_dml UNION ALL SELECT table_id, finished_ts, 1, job FROM ddl_log) SELECT x.table_id, x.ts, x.kind, x.ref FROM x JOIN s USING (table_id) WHERE x.ts > s.start_ts")
def st_redoapply(spark, d):
    ddl, dml = log(spark, d, "ddl_log"), log(spark, d, "ddl_dml")
    starts = ddl.groupBy("table_id").agg(F.min("finished_ts").alias("start_ts"))
    x = dml.select("table_id", F.col("commit_ts").alias("ts"), F.lit(0).alias("kind"), F.col("event_id").alias("ref")).unionByName(ddl.select("table_id", F.col("finished_ts").alias("ts"), F.lit(1).alias("kind"), F.col("job").alias("ref")))
    return x.join(starts, "table_id").where("ts > start_ts").drop("start_ts").orderBy("ts", "kind", "ref")


@q(f"WITH {ctes('regions')}, n AS (SELECT node, max(resolved_ts >> 18) AS hi, min(resolved_ts >> 18) AS lo FROM regions GROUP BY node) SELECT node, CASE WHEN hi + 1000 * node - lo > 300000 AND 1000 * node < 4000 THEN CASE WHEN 1000 * node < 15000 THEN 'synced' ELSE 'checkpoint is behind' END WHEN hi + 1000 * node - lo > 300000 THEN 'synced' ELSE 'still writing' END AS status FROM n")
def st_synced(spark, d):
    n = log(spark, d, "regions").groupBy("node").agg(F.max(F.shiftright("resolved_ts", 18)).alias("hi"), F.min(F.shiftright("resolved_ts", 18)).alias("lo"))
    return n.select("node", P.synced_status(F.col("hi") + 1000 * F.col("node"), F.col("lo"), F.col("hi")).alias("status"))


@q(f"WITH {ctes('regions')}, m AS (SELECT max(resolved_ts >> 18) AS now FROM regions) SELECT node, max(now) - max(resolved_ts >> 18) AS lag_ms, max(now) - min(resolved_ts >> 18) AS worst_ms FROM regions, m GROUP BY node")
def st_lag(spark, d):
    n = log(spark, d, "regions").groupBy("node").agg(F.max(F.shiftright("resolved_ts", 18)).alias("hi"), F.min(F.shiftright("resolved_ts", 18)).alias("lo"))
    # one row
    return n.join(F.broadcast(n.agg(F.max("hi").alias("now")))).select("node", (F.col("now") - F.col("hi")).alias("lag_ms"), (F.col("now") - F.col("lo")).alias("worst_ms"))


@q("SELECT event_type, epoch_us(ts) // 3600000000 * 3600 AS win_s, count(*) AS n, max(event_id) AS last_id FROM events GROUP BY 1, 2")
def st_tumble_user(spark, d):
    """Hourly windows over the event stream, by a streaming aggregation."""
    s = ST.stream_table(spark, f"{d}/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))
    agg = s.withWatermark("ts", "10 minutes").groupBy(F.window("ts", "1 hour"), "event_type").agg(F.count("*").alias("n"), F.max("event_id").alias("last_id"))
    flat = agg.select("event_type", F.unix_seconds("window.start").alias("win_s"), "n", "last_id")
    return ST.latest_of_updates(flat, ["event_type", "win_s"], "event_type string, win_s bigint, n bigint, last_id bigint")


@q("WITH x AS (SELECT user_id, epoch_us(ts) AS us, CASE WHEN epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY user_id ORDER BY ts, event_id) < 1800000000 THEN 0 ELSE 1 END AS new FROM events), s AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY us ROWS UNBOUNDED PRECEDING) AS session FROM x) SELECT user_id, min(us) AS start_us, count(*) AS n FROM s GROUP BY user_id, session")
def st_session_user(spark, d):
    e = spark.read.parquet(f"{d}/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))
    return e.groupBy(F.session_window("ts", "30 minutes"), "user_id").agg(F.count("*").alias("n"), F.min(F.unix_micros("ts")).alias("start_us")).select("user_id", "start_us", "n")


# comparison


@q(f"""WITH {ctes('lines')}, n AS (SELECT ok, ln, (row_number() OVER (ORDER BY ok, ln) - 1) // 64 AS chunk FROM (SELECT DISTINCT ok, ln FROM lines)), g AS (SELECT chunk, count(*) AS n_rows, max({{'a': ok, 'b': ln}}) AS hi FROM n GROUP BY chunk),
b AS (SELECT *, lag(hi) OVER (ORDER BY chunk) AS lo, max(chunk) OVER () AS last FROM g) SELECT chunk, n_rows, CASE WHEN lo IS NOT NULL THEN lo.a || ',' || lo.b END AS lower, hi.a || ',' || hi.b AS upper,
CASE WHEN lo IS NULL THEN '(TRUE)' ELSE '((`ok` > ' || lo.a || ') OR (`ok` = ' || lo.a || ' AND `ln` > ' || lo.b || '))' END || ' AND ' || CASE WHEN chunk = last THEN '(TRUE)' ELSE '((`ok` < ' || hi.a || ') OR (`ok` = ' || hi.a || ' AND `ln` <= ' || hi.b || '))' END AS condition FROM b""")
def df_chunks(spark, d):
    """Chunks of a table with a composite key, with the conditions that select them."""
    return CD.table_chunks(log(spark, d, "lines").select("ok", "ln").distinct(), ["ok", "ln"], 64)


_DIFF = "SELECT coalesce(a.k, b.k) AS k, CASE WHEN b.k IS NULL THEN 'left_only' WHEN a.k IS NULL THEN 'right_only' ELSE 'different' END AS status FROM pair_left a FULL JOIN pair_right b ON a.k = b.k WHERE a.k IS NULL OR b.k IS NULL OR a.bal IS DISTINCT FROM b.bal OR a.seg IS DISTINCT FROM b.seg"


@q(f"WITH {ctes('pair_left', 'pair_right')} {_DIFF}")
def df_checksum_then_rows(spark, d):
    """Checksums of key ranges first, rows only of ranges that differ."""
    a, b = log(spark, d, "pair_left"), log(spark, d, "pair_right")
    cs = lambda x, n: x.groupBy(F.expr("k div 64").alias("chunk")).agg(F.bit_xor(F.xxhash64("k", "name", "bal", F.col("seg").isNull(), "seg")).alias(n), F.count("*").alias(f"{n}_n"))
    bad = cs(a, "x").join(cs(b, "y"), "chunk", "full_outer").where(~(F.col("x").eqNullSafe(F.col("y")) & F.col("x_n").eqNullSafe(F.col("y_n")))).select("chunk")
    pick = lambda x: x.withColumn("chunk", F.expr("k div 64")).join(bad, "chunk", "left_semi")
    return C.diff_rows(pick(a), pick(b), ["k"], ["name", "bal", "seg"]).where("status <> 'equal'").select("k", "status")


@q(f"WITH {ctes('pair_left', 'pair_right')}, x AS ({_DIFF}) SELECT x.k, CASE WHEN status = 'right_only' THEN 'DELETE FROM `pair` WHERE `k` = ' || CAST(x.k AS VARCHAR) ELSE 'REPLACE INTO `pair` (`k`,`bal`) VALUES (' || CAST(x.k AS VARCHAR) || ',' || CAST(l.bal AS VARCHAR) || ')' END AS statement FROM x LEFT JOIN pair_left l ON l.k = x.k")
def df_fix(spark, d):
    a, b = log(spark, d, "pair_left"), log(spark, d, "pair_right")
    x = C.diff_rows(a, b, ["k"], ["name", "bal", "seg"]).where("status <> 'equal'").join(a.select("k", "bal"), "k", "left")
    text = F.when(F.col("status") == "right_only", F.concat(F.lit("DELETE FROM `pair` WHERE `k` = "), F.col("k").cast("string"))).otherwise(
        F.concat(F.lit("REPLACE INTO `pair` (`k`,`bal`) VALUES ("), F.col("k").cast("string"), F.lit(","), F.col("bal").cast("string"), F.lit(")")))
    return x.select("k", text.alias("statement"))


_TYPE = "CASE column_type WHEN 'VARCHAR' THEN 'string' WHEN 'TIMESTAMP' THEN 'timestamp_ntz' WHEN 'INTEGER' THEN 'int' ELSE lower(column_type) END"
_COLS = "SELECT column_name AS c, {0} AS t FROM (DESCRIBE SELECT * {1} FROM {2})"


@q(f"WITH a AS ({_COLS.format(_TYPE, '', 'sbtest_upstream')}), b AS ({_COLS.format(_TYPE, 'EXCLUDE (pad), 1 AS extra', 'sbtest_downstream')}) SELECT coalesce(a.c, b.c) AS \"column\", a.t AS \"left\", b.t AS \"right\", a.t IS NOT DISTINCT FROM b.t AS equal FROM a FULL JOIN b ON a.c = b.c WHERE coalesce(a.c, b.c) <> 'attrs'")
def df_struct(spark, d):
    """Columns and types of the two copies, one of them changed, without an
    ignored column."""
    a, b = (spark.read.parquet(f"{d}/sbtest_{s}.parquet") for s in ("upstream", "downstream"))
    return C.compare_structure(spark, a.schema, b.drop("pad").withColumn("extra", F.lit(1)).schema, ignore=["attrs"])


@q("SELECT CAST(count(*) * 2 AS BIGINT) AS n, CAST(0 AS BIGINT) AS total FROM orders")
def wl_gen(spark, d):
    """A bank workload: transfers between accounts leave the total unchanged."""
    n = spark.read.parquet(f"{d}/orders.parquet").count()
    from changeloom.plans.workload import bank

    return bank(spark, transfers=n, accounts=1000, seed=3).agg(F.count("*").alias("n"), F.sum("delta").alias("total"))


_NAME = "lower(trim(replace(trim(tbl.db_name), '`', '')))"


@q(f"SELECT CASE WHEN {_NAME} = 'bank' THEN 'ledger_copy' ELSE {_NAME} END AS schema, count(*) AS n, max(commit_ts) AS last_ts FROM redo_dml WHERE {_NAME} IN ('bank', 'shop') AND NOT ({_NAME} = 'shop' AND coalesce(len(row_columns), 0) = 0) GROUP BY 1")
def api_changefeed(spark, d):
    """A change feed end to end: filter, event rule, route, write, read back."""
    redo = spark.read.parquet(f"{d}/redo_dml.parquet")
    feed = Changefeed.create(spark, ChangefeedConfig("file:///out", filter_rules=("bank.*", "shop.*"), event_rules=(EventRule(["shop.*"], ["delete"]),), routes=(("bank.*", "ledger_copy", ""),)))
    root = work_path(spark, "feed")
    feed.run(redo, root)
    return spark.read.parquet(root).groupBy("schema").agg(F.count("*").alias("n"), F.max("commit_ts").alias("last_ts"))


QUERIES, SQL = R.queries, R.sql
