"""Sources, ordering, splitting and compaction."""

from __future__ import annotations

from pyspark.sql import functions as F

from changeloom.operators import compaction as C
from changeloom.operators import matching as M
from changeloom.operators import ordering as O
from changeloom.plans.logs import ctes, log
from changeloom.queries.registry import Registry

R = Registry()
_ORD = "CASE op WHEN 'D' THEN 0 WHEN 'U' THEN 1 ELSE 2 END"


@R.query(f"""WITH {ctes('prewrites', 'commits', 'rollbacks')}, w AS (SELECT *, row_number() OVER (PARTITION BY k, start_ts ORDER BY value IS NOT NULL DESC, generation DESC, arrival DESC) AS rn FROM prewrites)
SELECT w.k, w.start_ts, commit_ts, value FROM w JOIN commits USING (k, start_ts) WHERE rn = 1 AND NOT EXISTS (SELECT 1 FROM rollbacks r WHERE r.k = w.k AND r.start_ts = w.start_ts)""")
def src_match(spark, d):
    return M.match(log(spark, d, "prewrites"), log(spark, d, "commits"), log(spark, d, "rollbacks"), ["k", "start_ts"])


@R.query(f"WITH {ctes('commits')} SELECT k, start_ts, commit_ts FROM commits WHERE commit_ts > 222298112000000000")
def src_stale(spark, d):
    return M.drop_stale(log(spark, d, "commits"), 222298112000000000)


@R.query(f"WITH {ctes('orders_log')} SELECT op, count(*) AS n, min(commit_ts) AS first_ts, max(commit_ts) AS last_ts, CAST(sum(k) AS BIGINT) AS keys FROM orders_log WHERE commit_ts > 222298112000000000 AND commit_ts <= 230000000000000000 GROUP BY op")
def src_store(spark, d):
    """Events stored in order above a resolved ts, and a range read back."""
    stored = M.store_events(log(spark, d, "orders_log").select("k", "op", "commit_ts", "start_ts"), O.txn_order(["k"]), 222298112000000000)
    return stored.where("commit_ts <= 230000000000000000").groupBy("op").agg(F.count("*").alias("n"), F.min("commit_ts").alias("first_ts"), F.max("commit_ts").alias("last_ts"), F.sum("k").alias("keys"))


@R.query(f"WITH {ctes('orders_log')} SELECT k, op, commit_ts FROM orders_log WHERE commit_ts <= 230000000000000000 AND (commit_ts > 222298112000000000 OR (commit_ts = 222298112000000000 AND start_ts > 0))")
def src_scan(spark, d):
    return M.resume_scan(log(spark, d, "orders_log"), 222298112000000000, 230000000000000000, 0).select("k", "op", "commit_ts")


@R.query(f"WITH {ctes('orders_log')} SELECT k, op, commit_ts FROM orders_log WHERE k BETWEEN 100 AND 5000")
def src_spanfilter(spark, d):
    return log(spark, d, "orders_log").where(F.col("k").between(100, 5000)).select("k", "op", "commit_ts")


@R.query(f"WITH {ctes('orders_log')} SELECT k, op, commit_ts, start_ts, row_number() OVER (PARTITION BY commit_ts, start_ts ORDER BY {_ORD}, k) = 1 AS new_txn FROM orders_log")
def src_newtxn(spark, d):
    rows = O.place_in_key(log(spark, d, "orders_log").select("k", "op", *O.TXN), O.TXN, [O.op_order(), F.col("k")], "place")
    return rows.select("k", "op", *O.TXN, (F.col("place") == 0).alias("new_txn"))


@R.query(f"""WITH {ctes('orders_log')}, b AS (SELECT (commit_ts >> 18) // 86400000 AS day, count(*) AS n_rows FROM orders_log WHERE commit_ts <= 230000000000000000 GROUP BY 1),
g AS (SELECT day, n_rows, day - row_number() OVER (ORDER BY day) AS grp FROM b) SELECT min(day) AS first_day, max(day) AS last_day, CAST(sum(n_rows) AS BIGINT) AS n_rows FROM g GROUP BY grp""")
def src_gc(spark, d):
    return M.gc_ranges(log(spark, d, "orders_log"), 230000000000000000)


@R.query(f"WITH {ctes('orders_log')} SELECT k, op, commit_ts, start_ts, row_number() OVER (ORDER BY commit_ts, start_ts, {_ORD}, k) AS seq FROM orders_log")
def txn_order(spark, d):
    return O.row_numbers(log(spark, d, "orders_log").select("k", "op", "commit_ts", "start_ts"), O.txn_order(["k"]), "seq")


@R.query(f"WITH {ctes('orders_log')} SELECT commit_ts, start_ts, count(*) AS n_rows, row_number() OVER (ORDER BY commit_ts, start_ts) AS txn_no FROM orders_log GROUP BY 1, 2")
def txn_number(spark, d):
    return O.transactions(log(spark, d, "orders_log"))


@R.query(f"WITH {ctes('orders_log')} SELECT commit_ts, start_ts, k, op, (row_number() OVER (PARTITION BY commit_ts, start_ts ORDER BY {_ORD}, k) - 1) // 4 AS part FROM orders_log")
def txn_split(spark, d):
    return O.split_transactions(log(spark, d, "orders_log"), ["k"], 4).select("commit_ts", "start_ts", "k", "op", "part")


_DDL = "SELECT DISTINCT (ms // 86400000) * 86400000 * 262144 AS ts, CAST(ms // 86400000 AS VARCHAR) AS ref FROM base"


@R.query(f"""WITH {ctes('orders_log')}, m AS (SELECT commit_ts AS ts, 0 AS kind_no, 'dml' AS kind, CAST(k AS VARCHAR) AS ref FROM orders_log
UNION ALL SELECT ts, 1, 'ddl', ref FROM ({_DDL}) UNION ALL SELECT ts, 2, 'resolved', ref FROM ({_DDL}))
SELECT ts, kind, ref, rank() OVER (ORDER BY ts, kind_no) AS pos FROM m""")
def txn_merge_ddl(spark, d):
    day = F.expr("ms div 86400000")
    ddl = log(spark, d, "base").select((day * 86400000 * 262144).alias("ts"), day.cast("string").alias("ref")).distinct()
    dml = log(spark, d, "orders_log").select(F.col("commit_ts").alias("ts"), F.col("k").alias("ref"))
    merged = O.merge_ddl(dml, ddl, ddl)
    groups = merged.groupBy("ts", "kind_no").agg(F.count("*").alias("n"))
    # rank = rows of all earlier (ts, kind) groups + 1, counted over groups only
    numbered = M.running_before(groups, ["ts", "kind_no"], "n", "before")
    return merged.join(numbered.select("ts", "kind_no", "before"), ["ts", "kind_no"]).select("ts", "kind", "ref", (F.col("before") + 1).alias("pos"))


@R.query(f"""WITH {ctes('orders_log')}, t AS (SELECT commit_ts, sum(100 + length(s)) AS b FROM orders_log WHERE commit_ts > 0 GROUP BY 1), r AS (SELECT commit_ts, sum(b) OVER (ORDER BY commit_ts) AS run FROM t),
cut AS (SELECT coalesce(min(CASE WHEN run >= 50000 THEN commit_ts END), max(commit_ts)) AS ts FROM r) SELECT k, op, commit_ts FROM orders_log, cut WHERE commit_ts <= cut.ts AND commit_ts > 0""")
def txn_interrupt(spark, d):
    rows = O.bounded_scan(log(spark, d, "orders_log"), 0, 1 << 62, 50_000, F.length("s") + 100)
    return rows.select("k", "op", "commit_ts")


_SPLIT = f"""WITH {ctes('orders_log')} SELECT k, commit_ts, start_ts, c, s, 'D' AS op, 0 AS deferred, pre_p, CAST(NULL AS BIGINT) AS post_p FROM orders_log WHERE op = 'U' AND pre_p % 2 = 0
UNION ALL SELECT k, commit_ts, start_ts, c, s, 'I', 1, NULL, post_p FROM orders_log WHERE op = 'U' AND pre_p % 2 = 0
UNION ALL SELECT k, commit_ts, start_ts, c, s, op, 0, pre_p, post_p FROM orders_log WHERE NOT (op = 'U' AND pre_p % 2 = 0)"""


@R.query(_SPLIT)
def txn_uksplit(spark, d):
    return C.split_updates(log(spark, d, "orders_log"), F.col("pre_p") % 2 == 0, ["pre_p"], ["post_p"])


@R.query(f"SELECT commit_ts, start_ts, deferred, {_ORD} AS op_no, k, post_p FROM ({_SPLIT}) WHERE commit_ts > 225000000000000000")
def txn_redosplit(spark, d):
    rows = C.split_updates(log(spark, d, "orders_log").where("commit_ts > 225000000000000000"), F.col("pre_p") % 2 == 0, ["pre_p"], ["post_p"])
    return rows.select("commit_ts", "start_ts", "deferred", O.op_order().alias("op_no"), "k", "post_p")


_RUNS = f"""WITH {ctes('history_log')}, a AS (SELECT *, CASE WHEN lag(op) OVER (PARTITION BY k ORDER BY commit_ts, n) = 'D' THEN 1 ELSE 0 END AS ad FROM history_log),
r AS (SELECT *, CAST(sum(ad) OVER (PARTITION BY k ORDER BY commit_ts, n) AS BIGINT) AS run FROM a),
g AS (SELECT k, run, arg_min(op, n) AS f, arg_max(op, n) AS l, max(n) AS n, arg_max(commit_ts, n) AS commit_ts, max(CASE WHEN op = 'U' THEN n END) AS un FROM r GROUP BY k, run)
SELECT g.k, g.run, CASE WHEN l = 'D' THEN 'D' WHEN f = 'I' THEN 'I' ELSE 'U' END AS op, g.commit_ts, g.n,
  CASE WHEN l = 'D' AND f = 'U' THEN u.pre_v WHEN l <> 'D' AND f = 'I' THEN NULL ELSE x.pre_v END AS pre_v, x.post_v
FROM g JOIN history_log x ON x.k = g.k AND x.n = g.n LEFT JOIN history_log u ON u.k = g.k AND u.n = g.un"""


@R.query(_RUNS)
def cmp_unsafe(spark, d):
    return C.fold_runs(log(spark, d, "history_log"), ["k"], ["commit_ts", "n"], "pre_v", "post_v").drop("bad")


@R.query(f"""WITH {ctes('history_log')}, l AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY commit_ts DESC, n DESC) AS rn FROM history_log)
SELECT k, commit_ts, n, CASE WHEN op = 'U' THEN 'I' ELSE op END AS op, coalesce(post_v, pre_v) AS image FROM l WHERE rn = 1""")
def cmp_safe(spark, d):
    return C.keep_last(log(spark, d, "history_log"), ["k"], ["commit_ts", "n"], "pre_v", "post_v")


@R.query(f"WITH {ctes('history_log')} SELECT k % 16 AS table_id, n % 3 AS version, count(*) AS n_rows, min(commit_ts) AS first_ts, max(commit_ts) AS last_ts FROM history_log GROUP BY 1, 2")
def cmp_group(spark, d):
    return log(spark, d, "history_log").groupBy((F.col("k") % 16).alias("table_id"), (F.col("n") % 3).alias("version")).agg(
        F.count("*").alias("n_rows"), F.min("commit_ts").alias("first_ts"), F.max("commit_ts").alias("last_ts"))


@R.query(f"WITH {ctes('orders_log')} SELECT commit_ts, op, k, {_ORD} AS op_no, (row_number() OVER (PARTITION BY op, commit_ts ORDER BY k) - 1) // 2 AS chunk FROM orders_log")
def cmp_emit(spark, d):
    return C.emit_order(log(spark, d, "orders_log"), 2, ["commit_ts", "k"]).select("commit_ts", "op", "k", "op_no", "chunk")


@R.query(f"""WITH {ctes('orders_log')} SELECT commit_ts, start_ts, count(*) AS n_rows, count(*) > 1 AND min(CASE WHEN commit_ts < 225000000000000000 THEN 1 ELSE 0 END) = max(CASE WHEN commit_ts < 225000000000000000 THEN 1 ELSE 0 END) AS batchable FROM orders_log GROUP BY 1, 2""")
def cmp_should(spark, d):
    safe = F.col("commit_ts") < 225000000000000000
    return log(spark, d, "orders_log").groupBy(*O.TXN).agg(F.count("*").alias("n_rows"), ((F.count("*") > 1) & (F.bool_and(safe) == F.bool_or(safe))).alias("batchable"))


@R.query(f"WITH {ctes('orders_log')} SELECT k, op, commit_ts, commit_ts < 225000000000000000 OR k % 10 = 0 AS safe_mode FROM orders_log")
def cmp_safemode(spark, d):
    flag = (F.col("commit_ts") < 225000000000000000) | (F.col("k") % 10 == 0)
    return log(spark, d, "orders_log").select("k", "op", "commit_ts", flag.alias("safe_mode"))


_LAST = f"SELECT *, row_number() OVER (PARTITION BY k ORDER BY commit_ts DESC, start_ts DESC, {_ORD} DESC) AS rn FROM orders_log"


@R.query(f"WITH {ctes('orders_log')}, l AS ({_LAST}) SELECT k, post_p, c, s FROM l WHERE rn = 1 AND op <> 'D'")
def cmp_apply(spark, d):
    return C.apply_log(log(spark, d, "orders_log"), ["k"], [F.col("commit_ts"), F.col("start_ts"), O.op_order()], ["post_p", "c", "s"])


@R.query(f"""WITH {ctes('history_log')}, t AS (SELECT k, n, post_v AS v, commit_ts, CASE WHEN n % 3 = 0 THEN commit_ts + 1 END AS origin_ts FROM history_log WHERE op <> 'D'),
s AS (SELECT k, n, coalesce(post_v, 0) + 1 AS v, commit_ts - CASE WHEN n % 8 = 1 THEN 1 ELSE 0 END AS commit_ts FROM history_log WHERE op <> 'I')
SELECT k, n, CASE WHEN w THEN sv ELSE tv END AS v, CASE WHEN w THEN sts ELSE tor END AS origin_ts FROM (
SELECT coalesce(t.k, s.k) AS k, coalesce(t.n, s.n) AS n, t.v AS tv, s.v AS sv, s.commit_ts AS sts, t.origin_ts AS tor,
  s.commit_ts IS NOT NULL AND (t.k IS NULL OR coalesce(t.origin_ts, t.commit_ts) <= s.commit_ts) AS w FROM t FULL JOIN s ON t.k = s.k AND t.n = s.n)""")
def cmp_lww(spark, d):
    h = log(spark, d, "history_log")
    t = h.where("op <> 'D'").select("k", "n", F.col("post_v").alias("v"), "commit_ts", F.when(F.col("n") % 3 == 0, F.col("commit_ts") + 1).alias("origin_ts"))
    s = h.where("op <> 'I'").select("k", "n", (F.coalesce("post_v", F.lit(0)) + 1).alias("v"), (F.col("commit_ts") - F.when(F.col("n") % 8 == 1, 1).otherwise(0)).alias("commit_ts"))
    return C.last_writer_wins(t, s, ["k", "n"], "v")


@R.query(f"""WITH {ctes('lines')}, e AS (SELECT DISTINCT ok AS txn, 'pk|' || CAST(ok AS VARCHAR) || '|' || CAST(ln AS VARCHAR) AS key FROM lines UNION SELECT DISTINCT ok, 'uk|' || CAST(supp AS VARCHAR) || '|' || CAST(qty AS VARCHAR) FROM lines WHERE qty % 2 = 0),
l AS (SELECT txn, lag(txn) OVER (PARTITION BY key ORDER BY txn) AS depends_on FROM e) SELECT DISTINCT txn, depends_on FROM l WHERE depends_on IS NOT NULL""")
def cmp_conflict(spark, d):
    rows = log(spark, d, "lines").select(F.col("ok").alias("txn"), "ok", "ln", "supp", F.when(F.col("qty") % 2 == 0, F.col("qty")).alias("q"))
    return C.conflict_edges(rows, {"pk": ["ok", "ln"], "uk": ["supp", "q"]}, F.lit("table"))


@R.query(f"WITH {ctes('pair_left', 'pair_right')} SELECT coalesce(a.k, b.k) AS k, CASE WHEN b.k IS NULL THEN 'left_only' WHEN a.k IS NULL THEN 'right_only' WHEN a.name IS NOT DISTINCT FROM b.name AND a.bal IS NOT DISTINCT FROM b.bal AND a.seg IS NOT DISTINCT FROM b.seg THEN 'equal' ELSE 'different' END AS status, CASE WHEN b.k IS NULL THEN 'insert' WHEN a.k IS NULL THEN 'delete' WHEN a.name IS NOT DISTINCT FROM b.name AND a.bal IS NOT DISTINCT FROM b.bal AND a.seg IS NOT DISTINCT FROM b.seg THEN NULL ELSE 'replace' END AS fix FROM pair_left a FULL JOIN pair_right b ON a.k = b.k")
def jn_diff(spark, d):
    return C.diff_rows(log(spark, d, "pair_left"), log(spark, d, "pair_right"), ["k"], ["name", "bal", "seg"])


@R.query(f"WITH {ctes('prewrites', 'commits')} SELECT p.k, p.start_ts, p.generation, c.commit_ts FROM prewrites p JOIN commits c ON p.k = c.k AND p.start_ts = c.start_ts")
def jn_prewrite(spark, d):
    return log(spark, d, "prewrites").join(log(spark, d, "commits"), ["k", "start_ts"]).select("k", "start_ts", "generation", "commit_ts")


@R.query(f"WITH {ctes('prewrites', 'rollbacks')} SELECT k, start_ts, generation FROM prewrites p WHERE NOT EXISTS (SELECT 1 FROM rollbacks r WHERE r.k = p.k AND r.start_ts = p.start_ts)")
def jn_rollback(spark, d):
    return log(spark, d, "prewrites").join(log(spark, d, "rollbacks"), ["k", "start_ts"], "left_anti").select("k", "start_ts", "generation")


QUERIES, SQL = R.queries, R.sql
