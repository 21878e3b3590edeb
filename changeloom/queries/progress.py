"""Aggregations, ordering with limits, schema changes and span arithmetic."""

from __future__ import annotations

from pyspark.sql import functions as F

from changeloom.operators import ddl as D
from changeloom.operators import ordering as O
from changeloom.operators import progress as P
from changeloom.operators import rules as U
from changeloom.operators import schemas as S
from changeloom.operators.heavy_keys import Agg, salted_aggregate
from changeloom.plans.logs import ctes, log
from changeloom.queries.registry import Registry, crc32_sql, text_bytes_sql

R = Registry()
q = R.query
RG = f"WITH {ctes('regions')}"
OL = f"WITH {ctes('orders_log')}"
DD = f"WITH {ctes('ddl_log')}"


@q(f"{RG}, m AS (SELECT region_id, node, max(resolved_ts) AS r FROM regions GROUP BY 1, 2) SELECT node, min(r) AS resolved_ts FROM m GROUP BY node")
def agg_min_resolved(spark, d):
    return P.table_resolved(log(spark, d, "regions"), "node", "region_id", "resolved_ts")


@q(f"{RG} SELECT x.lo, min(r.resolved_ts) AS ts FROM regions r JOIN (SELECT DISTINCT lo // 100 * 100 AS lo FROM regions) x ON r.lo < x.lo + 100 AND r.hi > x.lo GROUP BY x.lo")
def agg_rangets(spark, d):
    r = log(spark, d, "regions").groupBy("lo", "hi").agg(F.min("resolved_ts").alias("ts"))
    # every span is listed under the hundreds it meets
    cell = r.withColumn("cell", F.explode(F.sequence(F.floor(F.col("lo") / 100), F.floor((F.col("hi") - 1) / 100))))
    return cell.groupBy((F.col("cell") * 100).alias("lo")).agg(F.min("ts").alias("ts"))


@q(f"""{OL}, s AS (SELECT c % 50 AS tbl, commit_ts, k % 9 <> 0 AS flushed FROM orders_log WHERE c % 50 <> 49 AND NOT (c % 50 = 3 AND k % 9 = 0)),
g AS (SELECT tbl, min(CASE WHEN NOT flushed THEN commit_ts END) AS o, max(commit_ts) AS l FROM s GROUP BY tbl), t AS (SELECT DISTINCT c % 50 AS tbl, 225000000000000000 AS resolved_ts FROM orders_log)
SELECT t.tbl, CASE WHEN o IS NOT NULL THEN o - 1 WHEN l IS NULL THEN resolved_ts ELSE greatest(l - 1, resolved_ts) END AS checkpoint_ts FROM t LEFT JOIN g USING (tbl)""")
def agg_checkpoint(spark, d):
    o = log(spark, d, "orders_log").withColumn("tbl", F.col("c") % 50)
    sent = o.where("tbl <> 49 and not (tbl = 3 and k % 9 = 0)").select("tbl", "commit_ts", (F.col("k") % 9 != 0).alias("flushed"))
    return P.checkpoint(sent, ["tbl"], o.select("tbl", F.lit(225000000000000000).alias("resolved_ts")).distinct())


@q(f"{RG}, n AS (SELECT node, max(resolved_ts) AS ts, count(*) AS spans FROM regions GROUP BY node) SELECT min(ts) AS checkpoint_ts, count(*) = 8 AS all_reported, min(ts) FILTER (node <> 3) AS without_node FROM n")
def agg_global_ckpt(spark, d):
    n = log(spark, d, "regions").groupBy("node").agg(F.max("resolved_ts").alias("ts"))
    return n.agg(F.min("ts").alias("checkpoint_ts"), (F.count("*") == 8).alias("all_reported"), F.min(F.when(F.col("node") != 3, F.col("ts"))).alias("without_node"))


@q(f"{RG}, x AS (SELECT DISTINCT node, resolved_ts FROM regions) SELECT node, resolved_ts, max(resolved_ts) OVER (PARTITION BY node ORDER BY resolved_ts % 1000000007, resolved_ts ROWS UNBOUNDED PRECEDING) AS redo_ts FROM x")
def agg_redo_ckpt(spark, d):
    x = log(spark, d, "regions").select("node", "resolved_ts").distinct().withColumn("at", F.col("resolved_ts") % 1000000007).withColumn("redo_ts", F.col("resolved_ts"))
    return P.monotone(x, ["node"], ["at", "resolved_ts"], "redo_ts").select("node", "resolved_ts", "redo_ts")


@q(f"{OL}, p AS (SELECT c % 6 AS part, max(commit_ts) AS ts FROM orders_log GROUP BY 1) SELECT min(ts) AS watermark, count(*) AS parts FROM p")
def agg_global_wm(spark, d):
    p = log(spark, d, "orders_log").groupBy((F.col("c") % 6).alias("part")).agg(F.max("commit_ts").alias("ts"))
    return p.agg(F.min("ts").alias("watermark"), F.count("*").alias("parts"))


@q(f"{RG} SELECT node, min(resolved_ts) AS watermark, count(DISTINCT region_id) AS spans FROM regions GROUP BY node")
def agg_hb(spark, d):
    return log(spark, d, "regions").groupBy("node").agg(F.min("resolved_ts").alias("watermark"), F.count_distinct("region_id").alias("spans"))


@q(f"{OL} SELECT c % 50 AS tbl, max(commit_ts) AS last_synced_ts FROM orders_log WHERE k % 9 <> 0 GROUP BY 1")
def agg_lastsynced(spark, d):
    return log(spark, d, "orders_log").where("k % 9 <> 0").groupBy((F.col("c") % 50).alias("tbl")).agg(F.max("commit_ts").alias("last_synced_ts"))


@q(f"{OL} SELECT c % 50 AS tbl, sum(100 + length(s)) // greatest(1, (max(commit_ts >> 18) - min(commit_ts >> 18)) // 1000) AS bytes_per_s FROM orders_log GROUP BY 1")
def agg_rate(spark, d):
    ms = F.shiftright("commit_ts", 18)
    g = log(spark, d, "orders_log").groupBy((F.col("c") % 50).alias("tbl")).agg(F.sum(F.length("s") + 100).alias("b"), F.max(ms).alias("hi"), F.min(ms).alias("lo"))
    return g.select("tbl", F.expr("b div greatest(1, (hi - lo) div 1000)").alias("bytes_per_s"))


@q(f"{OL} SELECT op, count(*) AS n_rows, count(DISTINCT commit_ts) AS n_txns, sum(CASE WHEN op = 'U' THEN 2 ELSE 1 END) AS physical_rows FROM orders_log GROUP BY op")
def agg_stats(spark, d):
    return log(spark, d, "orders_log").groupBy("op").agg(F.count("*").alias("n_rows"), F.count_distinct("commit_ts").alias("n_txns"), F.sum(F.when(F.col("op") == "U", 2).otherwise(1)).alias("physical_rows"))


@q(f"{OL} SELECT op, s, count(*) AS n_rows, sum(post_p) AS total FROM orders_log GROUP BY CUBE (op, s)")
def agg_cube(spark, d):
    return log(spark, d, "orders_log").cube("op", "s").agg(F.count("*").alias("n_rows"), F.sum("post_p").alias("total"))


@q(f"{OL} SELECT op, s, count(*) AS n_rows FROM orders_log GROUP BY ROLLUP (op, s) HAVING count(*) > 100")
def agg_rollup(spark, d):
    return log(spark, d, "orders_log").rollup("op", "s").agg(F.count("*").alias("n_rows")).where("n_rows > 100")


@q(f"{OL} SELECT op, s, c % 3 AS g, count(*) AS n_rows FROM orders_log GROUP BY GROUPING SETS ((op, s), (c % 3), ())")
def agg_sets(spark, d):
    o = log(spark, d, "orders_log").withColumn("g", F.col("c") % 3)
    return o.groupingSets([["op", "s"], ["g"], []], "op", "s", "g").agg(F.count("*").alias("n_rows"))


_ROW = "concat_ws(',', CAST(k AS VARCHAR), name, CAST(bal AS VARCHAR), coalesce(seg, ''))"
_SUM = lambda t: f"SELECT k // 1000 AS chunk, bit_xor({crc32_sql(text_bytes_sql(_ROW))}) AS {t}, count(*) AS {t}_rows FROM {t} GROUP BY 1"


@q(f"WITH {ctes('pair_left', 'pair_right')}, a AS ({_SUM('pair_left')}), b AS ({_SUM('pair_right')}) SELECT coalesce(a.chunk, b.chunk) AS chunk, pair_left, pair_left_rows, pair_right, pair_right_rows, pair_left IS NOT DISTINCT FROM pair_right AS equal FROM a FULL JOIN b ON a.chunk = b.chunk")
def agg_checksum(spark, d):
    """Chunk checksums: XOR of the rows' CRC32."""
    row = F.crc32(F.encode(F.concat_ws(",", "k", "name", "bal", F.coalesce("seg", F.lit(""))), "UTF-8"))
    side = lambda n: log(spark, d, n).groupBy(F.expr("k div 1000").alias("chunk")).agg(F.bit_xor(row).alias(n), F.count("*").alias(f"{n}_rows"))
    return side("pair_left").join(side("pair_right"), "chunk", "full_outer").withColumn("equal", F.col("pair_left").eqNullSafe(F.col("pair_right")))


@q(f"WITH {ctes('pair_right')} SELECT nat, count(*) AS n, bit_xor(k) AS x, sum(k) AS total FROM pair_right GROUP BY nat")
def agg_setsum(spark, d):
    return log(spark, d, "pair_right").groupBy("nat").agg(F.count("*").alias("n"), F.bit_xor("k").alias("x"), F.sum("k").alias("total"))


@q("SELECT schema_name, table_name, count(*) AS total, count(*) FILTER (state = 'success') AS success, count(*) FILTER (state = 'failed') AS failed, count(*) FILTER (state = 'ignore') AS ignored FROM chunk GROUP BY 1, 2")
def agg_diff_summary(spark, d):
    c = spark.read.parquet(f"{d}/chunk.parquet")
    n = lambda s: F.count_if(F.col("state") == s)
    return c.groupBy("schema_name", "table_name").agg(F.count("*").alias("total"), n("success").alias("success"), n("failed").alias("failed"), n("ignore").alias("ignored"))


@q(f"""WITH {ctes('ev')} SELECT ms // 30000 AS win, count(*) AS n, sum(v) AS total, max(v) AS hi, arg_min(v, event_id) AS first_v, arg_max(v, event_id) AS last_v FROM ev GROUP BY 1""")
def agg_memstats(spark, d):
    return log(spark, d, "ev").groupBy(F.expr("ms div 30000").alias("win")).agg(F.count("*").alias("n"), F.sum("v").alias("total"), F.max("v").alias("hi"), F.min_by("v", "event_id").alias("first_v"), F.max_by("v", "event_id").alias("last_v"))


@q("SELECT DISTINCT topic FROM sink_message UNION SELECT 'default'")
def agg_topics(spark, d):
    t = spark.read.parquet(f"{d}/sink_message.parquet").select("topic")
    return t.union(spark.createDataFrame([("default",)], "topic string")).distinct()


@q(f"{OL} SELECT s AS topic, c % 6 AS part, count(*) AS n, min(commit_ts) AS first_ts FROM orders_log GROUP BY 1, 2")
def agg_group(spark, d):
    o = log(spark, d, "orders_log").select(F.col("s").alias("topic"), (F.col("c") % 6).alias("part"), "commit_ts")
    return salted_aggregate(o, ["topic", "part"], [Agg("n", "count"), Agg("first_ts", "min", "commit_ts")])


# ordering with limits


@q(f"{OL} SELECT k, op, commit_ts, rank() OVER (ORDER BY commit_ts DESC, k DESC) AS pos FROM orders_log")
def srt_kv(spark, d):
    o = log(spark, d, "orders_log").select("k", "op", "commit_ts")
    return O.row_numbers(o, [-F.col("commit_ts"), -F.col("k")], "pos")


@q(f"WITH {ctes('orders_log', 'history_log')}, x AS (SELECT 'orders' AS src, commit_ts, k FROM orders_log UNION ALL SELECT 'events', commit_ts, event_id FROM history_log) SELECT src, k, commit_ts, row_number() OVER (ORDER BY commit_ts, src, k) AS pos FROM x")
def srt_heap(spark, d):
    a = log(spark, d, "orders_log").select(F.lit("orders").alias("src"), "commit_ts", "k")
    b = log(spark, d, "history_log").select(F.lit("events").alias("src"), "commit_ts", F.col("event_id").alias("k"))
    return O.row_numbers(a.unionByName(b), [F.col("commit_ts"), F.col("src"), F.col("k")], "pos")


@q(f"{RG} SELECT region_id, min(node % 3) AS task, max(resolved_ts) AS ts FROM regions GROUP BY region_id ORDER BY task, ts, region_id LIMIT 20")
def srt_pq(spark, d):
    """The twenty most urgent regions: by kind of task, then the farthest behind."""
    return log(spark, d, "regions").groupBy("region_id").agg(F.min(F.col("node") % 3).alias("task"), F.max("resolved_ts").alias("ts")).orderBy("task", "ts", "region_id").limit(20)


@q(f"{DD} SELECT job, finished_ts, kind FROM ddl_log WHERE finished_ts > 26214400 ORDER BY finished_ts LIMIT 100")
def lim_ddl(spark, d):
    return log(spark, d, "ddl_log").where("finished_ts > 26214400").select("job", "finished_ts", "kind").orderBy("finished_ts").limit(100)


@q(f"{RG} SELECT region_id, min(resolved_ts) AS slowest FROM regions GROUP BY region_id ORDER BY slowest, region_id LIMIT 10")
def top_slow(spark, d):
    return log(spark, d, "regions").groupBy("region_id").agg(F.min("resolved_ts").alias("slowest")).orderBy("slowest", "region_id").limit(10)


@q("SELECT msg_id, topic, file_seq, row_number() OVER (ORDER BY file_seq, topic, msg_id) AS pos FROM sink_message")
def srt_path(spark, d):
    m = spark.read.parquet(f"{d}/sink_message.parquet").select("msg_id", "topic", "file_seq")
    return O.row_numbers(m, [F.col("file_seq"), F.col("topic"), F.col("msg_id")], "pos")


# sets


@q(f"WITH {ctes('pair_left', 'pair_right')} SELECT k, name, bal FROM pair_left EXCEPT SELECT k, name, bal FROM pair_right")
def set_except(spark, d):
    cols = ["k", "name", "bal"]
    return log(spark, d, "pair_left").select(*cols).subtract(log(spark, d, "pair_right").select(*cols))


@q(f"WITH {ctes('pair_left', 'pair_right')} SELECT k, bal FROM pair_left INTERSECT SELECT k, bal FROM pair_right")
def set_intersect(spark, d):
    return log(spark, d, "pair_left").select("k", "bal").intersect(log(spark, d, "pair_right").select("k", "bal"))


@q(f"WITH {ctes('pair_left', 'pair_right')} SELECT k, seg FROM pair_left UNION SELECT k, seg FROM pair_right")
def set_union(spark, d):
    return log(spark, d, "pair_left").select("k", "seg").union(log(spark, d, "pair_right").select("k", "seg")).distinct()


# schema changes


_J = f"WITH {ctes('ddl_jobs')}"
_WIDE = "('drop schema', 'modify schema charset', 'create view')"
# every job with the ids of its table before and after it
_STATE = "b AS (SELECT *, coalesce(lag(ids) OVER (PARTITION BY table_id ORDER BY finished_ts, job), []) AS before, coalesce(ids, []) AS after FROM ddl_jobs)"
_EFFECT = f"{_STATE}, f AS (SELECT *, list_filter(after, lambda x: NOT list_contains(before, x)) AS created, list_filter(before, lambda x: NOT list_contains(after, x)) AS dropped FROM b)"
_TEXT = "array_to_string(list_sort({0}), ',')"


def _text(spans):
    return F.array_join(F.transform(F.array_sort(D.listed(spans)), lambda x: x.cast("string")), ",")


@q(f"""{_J}, {_EFFECT}, h AS (SELECT unnest(after) AS target, finished_ts, job, false AS e FROM f WHERE kind NOT IN {_WIDE} AND kind <> 'lock table' UNION ALL SELECT unnest(dropped), finished_ts, job, true FROM f WHERE kind NOT IN {_WIDE} AND kind <> 'lock table'),
l AS (SELECT *, lead(finished_ts) OVER (PARTITION BY target ORDER BY finished_ts, job) AS to_ts FROM h) SELECT target, finished_ts AS from_ts, to_ts, row_number() OVER (PARTITION BY target ORDER BY finished_ts, job) AS version FROM l WHERE NOT e""")
def ddl_versions(spark, d):
    """Lifetimes of the schema versions of every physical table."""
    return D.versions(log(spark, d, "ddl_jobs"))


_VER = "SELECT table_id, finished_ts AS from_ts, lead(finished_ts) OVER (PARTITION BY table_id ORDER BY finished_ts) AS to_ts, row_number() OVER (PARTITION BY table_id ORDER BY finished_ts) AS version, kind FROM ddl_log"


@q(f"{_J}, {_EFFECT} SELECT job, kind, {_TEXT.format('created')} AS created, {_TEXT.format('dropped')} AS dropped, CASE WHEN kind IN {_WIDE} THEN 'schema' WHEN kind <> 'lock table' THEN 'single' END AS scope, CASE WHEN kind <> 'lock table' THEN kind NOT IN ('create table', 'modify schema charset', 'drop column', 'add column', 'modify column', 'add index') END AS blocks FROM f")
def ddl_handlers(spark, d):
    """Physical tables that each job creates and drops, its scope, whether it blocks."""
    e = D.effects(log(spark, d, "ddl_jobs"))
    scope, blocks, _ = D.classify(F.col("kind"))
    return e.select("job", "kind", _text(F.col("created")).alias("created"), _text(F.col("dropped")).alias("dropped"), scope.alias("scope"), blocks.alias("blocks"))


@q(f"WITH {ctes('ddl_log', 'ddl_dml')}, v AS ({_VER}) SELECT event_id, ddl_dml.table_id, commit_ts, version, from_ts AS schema_ts FROM ddl_dml JOIN v ON v.table_id = ddl_dml.table_id AND commit_ts >= from_ts AND (to_ts IS NULL OR commit_ts < to_ts) WHERE kind <> 'drop table'")
def jn_schema_asof(spark, d):
    return S.asof_join(log(spark, d, "ddl_dml"), S.versions(log(spark, d, "ddl_log")), "table_id", "commit_ts")


@q(f"""WITH {ctes('ddl_log', 'ddl_dml')}, v AS ({_VER}), m AS (SELECT event_id, ddl_dml.table_id, commit_ts, version FROM ddl_dml JOIN v ON v.table_id = ddl_dml.table_id AND commit_ts >= from_ts AND (to_ts IS NULL OR commit_ts < to_ts) WHERE kind <> 'drop table'),
c AS (SELECT *, CASE WHEN lag(version) OVER (PARTITION BY table_id ORDER BY commit_ts, event_id) IS NOT DISTINCT FROM version THEN 0 ELSE 1 END AS new FROM m) SELECT event_id, table_id, version, CAST(sum(new) OVER (PARTITION BY table_id ORDER BY commit_ts, event_id) AS BIGINT) AS batch FROM c""")
def txn_batch(spark, d):
    rows = S.asof_join(log(spark, d, "ddl_dml"), S.versions(log(spark, d, "ddl_log")), "table_id", "commit_ts")
    rows = rows.withColumn("start_ts", F.col("commit_ts") - 1).withColumn("ref", F.col("event_id"))
    return O.schema_batches(rows, "version").select("event_id", "table_id", "version", "batch")


@q(f"{DD}, l AS (SELECT table_id, arg_max(kind, finished_ts) AS kind, max(finished_ts) AS schema_ts FROM ddl_log WHERE finished_ts <= 393216000 GROUP BY table_id) SELECT table_id, schema_ts FROM l WHERE kind <> 'drop table'")
def src_snapshot(spark, d):
    return S.snapshot(log(spark, d, "ddl_log"), 393216000)


_LIVES = """a AS (SELECT schema_id, table_id, unnest(after) AS target, finished_ts FROM f), x AS (SELECT table_id, unnest(dropped) AS target, finished_ts FROM f), l AS (SELECT a.schema_id, a.target, min(a.finished_ts) AS from_ts, min(x.finished_ts) AS to_ts FROM a LEFT JOIN x ON x.table_id = a.table_id AND x.target = a.target GROUP BY a.schema_id, a.table_id, a.target)"""


@q(f"""{_J}, {_EFFECT}, {_LIVES} SELECT -1 AS target, finished_ts, job FROM f WHERE kind NOT IN ('drop column', 'modify column', 'add index', 'add column', 'lock table')
UNION SELECT unnest(before), finished_ts, job FROM f WHERE kind IN ('drop table', 'rename table', 'truncate table', 'drop column', 'modify column', 'add index', 'add column', 'truncate partition', 'reorganize partition')
UNION SELECT unnest(after), finished_ts, job FROM f WHERE kind IN ('create table', 'truncate table', 'add partition', 'truncate partition', 'reorganize partition')
UNION SELECT unnest(dropped), finished_ts, job FROM f WHERE kind = 'exchange partition' UNION SELECT table_id, finished_ts, job FROM f WHERE kind = 'exchange partition'
UNION SELECT l.target, f.finished_ts, f.job FROM f JOIN l ON l.from_ts <= f.finished_ts AND (l.to_ts IS NULL OR l.to_ts >= f.finished_ts) AND (f.kind = 'create view' OR (f.kind = 'modify schema charset' AND l.schema_id = f.schema_id))""")
def ddl_hist(spark, d):
    """The trigger's and the tables' histories that each job enters."""
    return D.history(log(spark, d, "ddl_jobs"))


@q(f"""{_J}, r AS (SELECT job, renames % 2 = 1 AS old_kept, table_id % 2 = 0 AS new_kept, 's' || CAST(schema_id AS VARCHAR) AS os, 's' || CAST((schema_id + job % 2) % 5 AS VARCHAR) AS ns FROM ddl_jobs WHERE kind = 'rename table')
SELECT job, CASE WHEN old_kept AND new_kept THEN 'rename' WHEN old_kept THEN 'rename and drop' WHEN new_kept THEN 'error' ELSE 'ignored' END AS outcome, CASE WHEN old_kept AND new_kept THEN os <> ns ELSE false END AS moves, CASE WHEN old_kept THEN os = 's3' ELSE true END AS not_sync FROM r""")
def ddl_rename(spark, d):
    """Renames under table rules on the old and on the new name."""
    r = log(spark, d, "ddl_jobs").where("kind = 'rename table'").select(
        "job", F.concat(F.lit("s"), F.col("schema_id").cast("string")).alias("os"), F.concat(F.lit("s"), ((F.col("schema_id") + F.col("job") % 2) % 5).cast("string")).alias("ns"),
        F.concat(F.lit("old_"), (F.col("renames") % 2).cast("string")).alias("ot"), F.concat(F.lit("new_"), (F.col("table_id") % 2).cast("string")).alias("nt"))
    kept = lambda s, t: U.table_filter(F.col(s), F.col(t), ["*.old_1", "*.new_0"])
    outcome, moves, not_sync = D.rename_effect(kept("os", "ot"), kept("ns", "nt"), F.col("os"), F.col("ns"), F.col("os") == "s3")
    return r.select("job", outcome.alias("outcome"), moves.alias("moves"), not_sync.alias("not_sync"))


@q("SELECT p_partkey AS id, array_to_string(list_filter([1, 2, 3, 4], lambda x: x > 2 + p_size % 3 OR x <= p_size % 2), ',') AS dropped, CASE WHEN p_size % 3 = 2 THEN '' ELSE '' END || array_to_string(list_filter([9, 10], lambda x: x <= 9 + p_size % 2), ',') AS created FROM part")
def ddl_partition(spark, d):
    before = F.array(*[F.lit(i) for i in (1, 2, 3, 4)])
    p = spark.read.parquet(f"{d}/part.parquet").withColumn("after", F.concat(F.filter(before, lambda x: (x <= 2 + F.col("p_size") % 3) & (x > F.col("p_size") % 2)), F.filter(F.array(F.lit(9), F.lit(10)), lambda x: x <= 9 + F.col("p_size") % 2)))
    dropped, created = S.partition_changes(before, F.col("after"))
    text = lambda a: F.array_join(F.transform(a, lambda x: x.cast("string")), ",")
    return p.select(F.col("p_partkey").alias("id"), text(dropped).alias("dropped"), text(created).alias("created"))


@q(f"""{_J}, j AS (SELECT job, schema_version, kind, table_id, finished_ts, ids, 0 AS again FROM ddl_jobs UNION ALL SELECT job, schema_version, kind, table_id, finished_ts, ids, 1 FROM ddl_jobs WHERE job % 5 = 0
UNION ALL SELECT job + 1000000, schema_version + 1000000, 'create table', table_id, finished_ts + 1000000000, ids, 0 FROM ddl_jobs WHERE job % 7 = 0),
s AS (SELECT *, coalesce(schema_version <= max(schema_version) OVER (ORDER BY finished_ts, job, again ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), false) AS repeated FROM j),
b AS (SELECT *, coalesce(len(lag(ids) OVER (PARTITION BY table_id ORDER BY finished_ts, job)), 0) AS had FROM s WHERE NOT repeated)
SELECT job, kind, CASE WHEN kind = 'lock table' THEN 'unknown' WHEN kind = 'create table' AND had > 0 THEN 'exists' WHEN kind = 'drop table' AND had = 0 THEN 'missing' END AS reason FROM b
UNION ALL SELECT job, kind, CASE WHEN kind = 'lock table' THEN 'unknown' ELSE 'repeated' END FROM s WHERE repeated""")
def ddl_skip(spark, d):
    """Jobs fetched twice and tables created once more."""
    j = log(spark, d, "ddl_jobs").select("job", "schema_version", "kind", "table_id", "finished_ts", "ids")
    more = j.where("job % 7 = 0").select((F.col("job") + 1_000_000).alias("job"), (F.col("schema_version") + 1_000_000).alias("schema_version"), F.lit("create table").alias("kind"), "table_id", (F.col("finished_ts") + 1_000_000_000).alias("finished_ts"), "ids")
    return D.skip_reason(j.unionByName(j.where("job % 5 = 0")).unionByName(more)).select("job", "kind", "reason")


@q(f"{DD}, v AS ({_VER}) SELECT table_id, version, from_ts FROM v WHERE kind <> 'drop table' AND (to_ts IS NULL OR to_ts > 393216000)")
def ddl_gc(spark, d):
    return S.gc_versions(S.versions(log(spark, d, "ddl_log")), 393216000).select("table_id", "version", "from_ts")


@q(f"{_J}, l AS (SELECT table_id, arg_max(schema_id, finished_ts) AS schema_id, arg_max(name, finished_ts) AS name, arg_max(kind, finished_ts) AS kind FROM ddl_jobs WHERE finished_ts <= 393216000 GROUP BY table_id) SELECT table_id, schema_id, name FROM l WHERE kind <> 'drop table'")
def ddl_tablenames(spark, d):
    return D.names_at(log(spark, d, "ddl_jobs"), 393216000)


@q(f"{DD}, x AS (SELECT job, 'RENAME TABLE a' || CAST(job AS VARCHAR) || ' TO b' AS part FROM ddl_log WHERE kind = 'rename table' UNION ALL SELECT job, 'RENAME TABLE c TO d' || CAST(job AS VARCHAR) FROM ddl_log WHERE kind = 'rename table') SELECT job, part FROM x")
def ddl_split_events(spark, d):
    r = log(spark, d, "ddl_log").where("kind = 'rename table'")
    text = F.concat(F.lit("RENAME TABLE a"), F.col("job").cast("string"), F.lit(" TO b; RENAME TABLE c TO d"), F.col("job").cast("string"), F.lit(";"))
    return S.split_multi(r.withColumn("query", text), "query").select("job", "part")


@q("""WITH t AS (SELECT p_partkey AS id, p_size FROM part) SELECT id AS table_id, p_size % 5 <> 0 AND p_size % 3 <> 0 AS splittable,
CASE WHEN p_size % 7 = 0 THEN 'no origin_ts' WHEN p_size % 11 = 0 THEN 'no softdelete_time' WHEN p_size % 2 = 0 OR p_size % 13 = 0 THEN 'softdelete_time is no timestamp(6) null' END AS active_active FROM t""")
def ddl_verify(spark, d):
    """Tables that can be split and that can take part in active-active replication."""
    t = spark.read.parquet(f"{d}/part.parquet").select(F.col("p_partkey").alias("table_id"), "p_size")
    col = lambda n, kind, null, cond: F.when(cond, F.struct(F.lit(n).alias("column"), kind.alias("type"), null.alias("nullable")))
    columns = t.select("table_id", F.inline(F.array_compact(F.array(
        col("id", F.lit("bigint"), F.lit(False), F.lit(True)), col("origin_ts", F.lit("bigint"), F.lit(True), F.col("p_size") % 7 != 0),
        col("softdelete_time", F.when(F.col("p_size") % 2 == 0, "timestamp").otherwise("timestamp(6)"), F.col("p_size") % 13 != 0, F.col("p_size") % 11 != 0)))))
    index = lambda n, primary, unique, cond: F.when(cond, F.struct(F.lit(n).alias("index"), F.lit(primary).alias("is_primary"), F.lit(unique).alias("is_unique")))
    indexes = t.select("table_id", F.inline(F.array_compact(F.array(
        index("pk", True, True, F.col("p_size") % 5 != 0), index("uk", False, True, F.col("p_size") % 3 == 0), index("k", False, False, F.lit(True))))))
    return D.verify_tables(columns, indexes, "origin_ts", "softdelete_time")


@q(f"{DD} SELECT job, finished_ts, kind FROM ddl_log WHERE n % 3 <> 0")
def src_ddl(spark, d):
    jobs = log(spark, d, "ddl_log").select("job", "finished_ts", F.to_json(F.struct("kind", F.when(F.col("n") % 3 != 0, "done").otherwise("queueing").alias("state"))).alias("body"))
    return jobs.withColumn("b", F.from_json("body", "kind string, state string")).where("b.state = 'done'").select("job", "finished_ts", "b.kind")


@q(f"{DD} SELECT finished_ts, job, row_number() OVER (ORDER BY finished_ts, job) AS pos FROM ddl_log WHERE finished_ts <= 393216000")
def src_ddlsort(spark, d):
    jobs = log(spark, d, "ddl_log").select("finished_ts", "job")
    again = jobs.unionByName(jobs.where("job % 3 = 0"))
    return O.row_numbers(S.unsorted_cache(again, 393216000), [F.col("finished_ts"), F.col("job")], "pos")


# spans


_SP = f"WITH {ctes('spans')}"


@q(f"""{_SP}, w AS (SELECT *, max(hi) OVER (PARTITION BY tbl ORDER BY lo, hi ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS b FROM spans)
SELECT tbl, min(lo) AS lo, max(hi) AS hi, count(*) FILTER (lo > b) AS holes, sum(CASE WHEN lo > b THEN lo - b ELSE 0 END) AS missing FROM w GROUP BY tbl""")
def jn_spancover(spark, d):
    return P.coverage(log(spark, d, "spans"), ["tbl"])


@q(f"""{_SP}, w AS (SELECT *, max(hi) OVER (PARTITION BY tbl ORDER BY lo, hi, ts, id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS b FROM spans),
g AS (SELECT *, sum(CASE WHEN b IS NULL OR lo > b THEN 1 ELSE 0 END) OVER (PARTITION BY tbl ORDER BY lo, hi, ts, id ROWS UNBOUNDED PRECEDING) AS grp FROM w) SELECT tbl, min(lo) AS lo, max(hi) AS hi, min(ts) AS ts, count(*) AS n_spans FROM g GROUP BY tbl, grp""")
def sp_merge(spark, d):
    return P.merge_spans(log(spark, d, "spans"), ["tbl"])


_AB = "a AS (SELECT DISTINCT p_partkey AS id, p_partkey * 7 AS lo, p_partkey * 7 + 10 + p_size AS hi FROM part), b AS (SELECT s_suppkey AS id, s_suppkey * 130 AS lo, s_suppkey * 130 + 60 AS hi FROM supplier)"


@q(f"WITH {_AB} SELECT a.id AS a_id, b.id AS b_id, greatest(a.lo, b.lo) AS lo, least(a.hi, b.hi) AS hi FROM a JOIN b ON a.lo < b.hi AND b.lo < a.hi")
def jn_spanintersect(spark, d):
    p, s = spark.read.parquet(f"{d}/part.parquet"), spark.read.parquet(f"{d}/supplier.parquet")
    a = p.select(F.col("p_partkey").alias("id"), (F.col("p_partkey") * 7).alias("lo"), (F.col("p_partkey") * 7 + 10 + F.col("p_size")).alias("hi"))
    b = s.select(F.col("s_suppkey").alias("id"), (F.col("s_suppkey") * 130).alias("lo"), (F.col("s_suppkey") * 130 + 60).alias("hi"))
    return P.intersect_spans(a, b, 64)


@q(f"{_SP}, n AS (SELECT tbl, count(*) AS n FROM spans GROUP BY tbl) SELECT tbl, i, n // 7 + CASE WHEN i < n % 7 THEN 1 ELSE 0 END AS regions FROM n, (VALUES (0), (1), (2), (3), (4), (5), (6)) t(i)")
def sp_split_count(spark, d):
    n = log(spark, d, "spans").groupBy("tbl").agg(F.count("*").alias("n"))
    return n.select("tbl", F.explode(F.sequence(F.lit(0), F.lit(6))).alias("i"), "n").select("tbl", "i", P.split_evenly(F.col("n"), 7, F.col("i")).alias("regions"))


@q(f"{_SP}, x AS (SELECT tbl, id, lo, hi, sum(hi - lo) OVER (PARTITION BY tbl ORDER BY lo, id, hi ROWS UNBOUNDED PRECEDING) AS run, sum(hi - lo) OVER (PARTITION BY tbl) AS total FROM spans) SELECT tbl, id, lo, hi, least(3, (run - 1) * 4 // total) AS part FROM x")
def sp_split_bytes(spark, d):
    weight = F.col("hi") - F.col("lo")
    x = O.sum_before(log(spark, d, "spans"), ["tbl"], [F.col("lo"), F.col("id"), F.col("hi")], weight, "before")
    totals = x.groupBy("tbl").agg(F.sum(weight).alias("total"))
    return x.join(totals, "tbl").select("tbl", "id", "lo", "hi", F.expr("least(3, (before + hi - lo - 1) * 4 div total)").alias("part"))


@q(f"{RG}, n AS (SELECT node, count(*) AS n FROM regions GROUP BY node) SELECT node, n, n - (SELECT min(n) FROM n) AS over_min, n = (SELECT max(n) FROM n) AS busiest FROM n")
def sp_balance(spark, d):
    n = log(spark, d, "regions").groupBy("node").agg(F.count("*").alias("n"))
    ends = n.agg(F.min("n").alias("lo"), F.max("n").alias("hi"))
    # one row
    return n.join(F.broadcast(ends)).select("node", "n", (F.col("n") - F.col("lo")).alias("over_min"), (F.col("n") == F.col("hi")).alias("busiest"))


@q(f"{RG}, n AS (SELECT node, sum(region_id) AS w FROM regions GROUP BY node), m AS (SELECT sum(w) AS t, count(*) AS c FROM n) SELECT node, w, w * c * 4 > 5 * t AS too_high, w * c * 5 < 4 * t AS too_low FROM n, m")
def sp_balance_traffic(spark, d):
    n = log(spark, d, "regions").groupBy("node").agg(F.sum("region_id").alias("w"))
    m = n.agg(F.sum("w").alias("t"), F.count("*").alias("c"))
    # one row
    return n.join(F.broadcast(m)).select("node", "w", (F.col("w") * F.col("c") * 4 > 5 * F.col("t")).alias("too_high"), (F.col("w") * F.col("c") * 5 < 4 * F.col("t")).alias("too_low"))


QUERIES, SQL = R.queries, R.sql
