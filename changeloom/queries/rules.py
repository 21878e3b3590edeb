"""Decoding, filters, joins, routing and scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from changeloom.functions import scalars as S
from changeloom.functions import tso
from changeloom.operators import ddl as D
from changeloom.operators import ordering as O
from changeloom.operators import rules as U
from changeloom.operators.sequence import verify_sequence
from changeloom.plans.logs import ctes, log
from changeloom.queries.registry import Registry, crc32_sql, text_bytes_sql

R = Registry()
q = R.query
OL = f"WITH {ctes('orders_log')}"


def _orders(spark, d):
    return log(spark, d, "orders_log")


# tables of the log: schema and table names by key
_SCH = "CASE k % 4 WHEN 0 THEN 'shop' WHEN 1 THEN 'Bank' WHEN 2 THEN 'test' ELSE 'mysql' END"
_TBL = "CASE k % 3 WHEN 0 THEN 'orders' WHEN 1 THEN 'Orders_tmp' ELSE 'log_2024' END"


def _named(spark, d):
    return _orders(spark, d).withColumns({"sch": F.expr(_SCH), "tbl": F.expr(_TBL)})


_NAMED = f"SELECT *, {_SCH} AS sch, {_TBL} AS tbl FROM orders_log"


@q(f"{OL} SELECT k, commit_ts, op, pre_p, post_p FROM orders_log WHERE NOT (pre_p IS NULL AND post_p IS NULL)")
def dec_rows(spark, d):
    return _orders(spark, d).where("not (pre_p is null and post_p is null)").select("k", "commit_ts", "op", "pre_p", "post_p")


@q(f"{OL} SELECT k, commit_ts, CASE WHEN pre_p IS NOT NULL AND post_p IS NOT NULL THEN 'update' WHEN post_p IS NOT NULL THEN 'insert' ELSE 'delete' END AS kind FROM orders_log")
def dec_type(spark, d):
    return _orders(spark, d).select("k", "commit_ts", F.when(F.col("pre_p").isNotNull() & F.col("post_p").isNotNull(), "update").when(F.col("post_p").isNotNull(), "insert").otherwise("delete").alias("kind"))


@q(f"{OL} SELECT commit_ts, start_ts, CAST(sum(CASE WHEN op = 'U' THEN 2 ELSE 1 END) AS BIGINT) AS physical_rows, count(*) AS logical_rows FROM orders_log GROUP BY 1, 2")
def dec_explode(spark, d):
    rows = _orders(spark, d).select("commit_ts", "start_ts", "op", F.explode(F.array_compact(F.array("pre_p", "post_p"))).alias("image"))
    return rows.groupBy("commit_ts", "start_ts").agg(F.count("*").alias("physical_rows"), (F.count("*") - F.count_if(F.col("op") == "U") / 2).cast("bigint").alias("logical_rows"))


_LE = "list_transform(range(0, {1}), lambda i: ({0} >> (8 * i)) & 255)"
_ROW_BYTES = f"list_concat({_LE.format('k', 8)}, {_LE.format('post_p', 8)}, {_LE.format('length(s)', 4)}, {text_bytes_sql('s')})"
_CRC = lambda text: crc32_sql(text_bytes_sql(text))


@q(f"{OL} SELECT k, commit_ts, {crc32_sql(_ROW_BYTES)} AS checksum, k % 97 = 0 AS corrupted FROM orders_log WHERE post_p IS NOT NULL")
def dec_checksum(spark, d):
    """Row checksums over typed bytes, verified against a stored copy of which
    every 97th is damaged."""
    row = S.row_checksum([("bigint", F.col("k")), ("bigint", F.col("post_p")), ("string", F.col("s"))])
    rows = _orders(spark, d).where("post_p is not null").withColumn("stored", row + F.when(F.col("k") % 97 == 0, 1).otherwise(0))
    return rows.select("k", "commit_ts", row.alias("checksum"), (row != F.col("stored")).alias("corrupted"))


@q(f"{OL} SELECT k, commit_ts, post_p, s FROM orders_log WHERE op <> 'D'")
def dec_visible(spark, d):
    columns = {"k": False, "commit_ts": False, "post_p": False, "s": False, "c": True}  # true: virtual generated
    return _orders(spark, d).where("op <> 'D'").select(*[c for c, virtual in columns.items() if not virtual])


@q(f"{OL} SELECT k, op, post_p, pre_p FROM orders_log")
def prj_cols(spark, d):
    df = _orders(spark, d)
    return df.select(*U.select_columns(df.columns, ["*", "!c", "!s", "!*_ts"], [["c", "s"], ["k"]], ["k"]))


@q(f"{OL} SELECT k, commit_ts, post_p, post_p * 2 + 1 AS total, post_p > 10000000 AS big FROM orders_log WHERE op <> 'D' AND NOT (post_p * 2 + 1 > 40000000)")
def prj_gen(spark, d):
    rows = _orders(spark, d).where("op <> 'D'").withColumn("total", F.col("post_p") * 2 + 1).withColumn("big", F.col("post_p") > 10_000_000)
    return rows.where(~(F.col("total") > 40_000_000)).select("k", "commit_ts", "post_p", "total", "big")


@q(f"WITH {ctes('lines')} SELECT ok, ln, '`ok` = ' || CAST(ok AS VARCHAR) || ' AND `ln` = ' || CAST(ln AS VARCHAR) AS condition FROM lines")
def prj_wherecols(spark, d):
    return log(spark, d, "lines").select("ok", "ln", S.where_clause(["ok", "ln"]).alias("condition"))


@q(f"WITH {ctes('lines')} SELECT ok, ln, CASE WHEN qty % 2 = 0 THEN 'uk_not_null' WHEN rf = 'R' THEN 'uk_by_data' ELSE 'none' END AS chosen FROM lines")
def prj_whereidx(spark, d):
    rows = log(spark, d, "lines").withColumn("a", F.when(F.col("qty") % 2 == 0, F.col("qty"))).withColumn("b", F.when(F.col("rf") == "R", F.col("supp")))
    return rows.select("ok", "ln", S.choose_key([("uk_not_null", [F.col("a")]), ("uk_by_data", [F.col("b"), F.col("supp")])]).alias("chosen"))


@q(f"{OL} SELECT k, op, commit_ts FROM ({_NAMED}) WHERE (lower(sch) = 'shop' AND lower(tbl) NOT LIKE '%tmp') OR (lower(sch) = 'bank' AND lower(tbl) = 'log_2024')")
def flt_table(spark, d):
    rows = _named(spark, d)
    return rows.where(U.table_filter(F.col("sch"), F.col("tbl"), ["shop.*", "!*.*_tmp", "bank.log_20[12]?"])).select("k", "op", "commit_ts")


@q(f"{OL} SELECT k, op, sch FROM ({_NAMED}) WHERE lower(sch) NOT IN ('mysql')")
def flt_sys(spark, d):
    return _named(spark, d).where(U.not_system(F.col("sch"))).select("k", "op", "sch")


@q(f"{OL} SELECT k, op, start_ts FROM orders_log WHERE start_ts NOT IN (SELECT start_ts FROM orders_log WHERE k % 1000 = 1)")
def flt_startts(spark, d):
    df = _orders(spark, d)
    ignored = df.where("k % 1000 = 1").select("start_ts").distinct()
    return df.join(ignored, "start_ts", "left_anti").select("k", "op", "start_ts")


@q(f"{OL} SELECT k, op, sch, tbl FROM ({_NAMED}) WHERE NOT (sch = 'shop' AND op IN ('D', 'U')) AND NOT (tbl = 'orders' AND op = 'I')")
def flt_event(spark, d):
    rules = [U.EventRule(["shop.*"], ["delete", "update"]), U.EventRule(["*.orders"], ["insert"]), U.EventRule(["bank.*"], ["none"])]
    return _named(spark, d).where(U.keep_event(F.col("sch"), F.col("tbl"), F.col("op"), rules)).select("k", "op", "sch", "tbl")


_DDLS = """SELECT k, CASE k % 5 WHEN 0 THEN 'create table' WHEN 1 THEN 'drop table' WHEN 2 THEN 'add column' WHEN 3 THEN 'truncate table' ELSE 'rename table' END AS kind,
  CASE k % 5 WHEN 0 THEN 'CREATE TABLE t (id INT)' WHEN 1 THEN 'DROP TABLE t' WHEN 2 THEN 'ALTER TABLE t ADD COLUMN c INT' WHEN 3 THEN 'TRUNCATE TABLE t' ELSE 'RENAME TABLE t TO tmp_t' END AS query, 'shop' AS sch, 't' AS tbl, ms FROM base"""


def _ddls(spark, d):
    base = log(spark, d, "base")
    base.createOrReplaceTempView("__ddl_base")
    return spark.sql(_DDLS.replace("FROM base", "FROM {b}"), b=base)


@q(f"WITH {ctes('base')}, x AS ({_DDLS}) SELECT k, kind FROM x WHERE NOT (kind = 'drop table' OR lower(query) LIKE 'alter table%' OR query LIKE '%tmp_%')")
def flt_ddltype(spark, d):
    rules = [U.EventRule(["shop.*"], ["drop table", "alter table"], [r"TO\s+tmp_"])]
    return _ddls(spark, d).where(U.keep_ddl(F.col("sch"), F.col("tbl"), F.col("kind"), F.col("query"), rules)).select("k", "kind")


@q(f"""{OL} SELECT k, op, commit_ts FROM orders_log WHERE NOT coalesce(CASE op WHEN 'I' THEN post_p > 20000000 AND s = 'F' WHEN 'U' THEN pre_p < 5000000 OR post_p > 30000000 ELSE pre_p % 2 = 0 END, false)""")
def flt_expr(spark, d):
    rows = _orders(spark, d).withColumnsRenamed({"pre_p": "pre_price", "post_p": "post_price"}).withColumns({"pre_state": F.col("s"), "post_state": F.col("s")})
    keep = U.keep_row(F.col("op"), ["price", "state"], "price > 20000000 and state = 'F'", "price < 5000000", "price > 30000000", "price % 2 = 0")
    return rows.where(keep).select("k", "op", "commit_ts")


@q(f"{OL} SELECT k, op, commit_ts FROM ({_NAMED}) WHERE start_ts % 7 <> 1 AND sch = 'shop' AND NOT op = 'D' AND NOT (op = 'I' AND post_p > 20000000)")
def flt_row_order(spark, d):
    keep = (
        (F.col("start_ts") % 7 != 1) & U.table_filter(F.col("sch"), F.col("tbl"), ["shop.*"])
        & U.keep_event(F.col("sch"), F.col("tbl"), F.col("op"), [U.EventRule(["*.*"], ["delete"])])
        & U.keep_row(F.col("op"), ["p"], insert="p > 20000000")
    )
    return _named(spark, d).where(keep).select("k", "op", "commit_ts")


@q(f"WITH {ctes('ddl_jobs')} SELECT job, kind, kind = 'lock table' OR kind LIKE '%column' OR schema_id = 3 AS discarded FROM ddl_jobs")
def flt_discard_ddl(spark, d):
    """Jobs of unknown kinds, of ignored kinds or of tables left out go no further."""
    schema = F.concat(F.lit("s"), F.col("schema_id").cast("string"))
    rules = [U.EventRule(["*.*"], ["add column", "drop column", "modify column"])]
    keep = F.col("kind").isin(list(D.KINDS)) & U.table_filter(schema, F.col("name"), ["*.*", "!s3.*"]) & U.keep_ddl(schema, F.col("name"), F.col("kind"), F.lit(""), rules)
    return log(spark, d, "ddl_jobs").select("job", "kind", (~keep).alias("discarded"))


@q(f"""WITH {ctes('ddl_jobs')} SELECT kind, count(*) AS n, CASE WHEN kind IN ('create view', 'modify schema charset') THEN 'schema' WHEN kind <> 'lock table' THEN 'single' END AS scope,
CASE WHEN kind <> 'lock table' THEN kind IN ('drop table', 'truncate table', 'rename table', 'create view') OR kind LIKE '%partition' END AS blocks, CASE WHEN kind <> 'lock table' THEN kind NOT LIKE '%column' AND kind <> 'add index' END AS for_trigger FROM ddl_jobs GROUP BY kind""")
def flt_ddlclass(spark, d):
    scope, blocks, trigger = D.classify(F.col("kind"))
    return log(spark, d, "ddl_jobs").groupBy("kind").agg(F.count("*").alias("n")).select("kind", "n", scope.alias("scope"), blocks.alias("blocks"), trigger.alias("for_trigger"))


@q("WITH x AS (SELECT p_partkey AS id, p_size % 3 = 0 AS has_pk, p_size % 5 = 0 AS has_uk, p_size % 7 = 0 AS is_view, p_size % 11 = 0 AS is_sequence FROM part) SELECT id, NOT is_sequence AND (is_view OR has_pk OR has_uk) AS eligible FROM x")
def flt_eligible(spark, d):
    x = spark.read.parquet(f"{d}/part.parquet").select(F.col("p_partkey").alias("id"), *[(F.col("p_size") % m == 0).alias(n) for n, m in (("pk", 3), ("uk", 5), ("view", 7), ("sequence", 11))])
    return x.select("id", S.eligible(F.col("pk"), F.col("uk"), F.col("view"), F.col("sequence")).alias("eligible"))


@q(f"WITH {ctes('softdelete_log')} SELECT k, n, CASE WHEN op = 'U' AND pre_deleted IS NULL AND post_deleted IS NOT NULL THEN 'D' ELSE op END AS op FROM softdelete_log WHERE op <> 'D'")
def flt_policy(spark, d):
    df = log(spark, d, "softdelete_log")
    return df.select("k", "n", U.soft_delete_policy(F.col("op"), F.col("pre_deleted"), F.col("post_deleted"), "soft").alias("op")).where("op is not null")


@q(f"WITH {ctes('softdelete_log')} SELECT k, n, op FROM softdelete_log WHERE origin_ts IS NULL OR op = 'D'")
def flt_origin(spark, d):
    return log(spark, d, "softdelete_log").where("origin_ts is null or op = 'D'").select("k", "n", "op")


@q(f"WITH {ctes('orders_log')}, s AS (SELECT c AS t, min(commit_ts) AS start_ts FROM orders_log WHERE c % 2 = 0 GROUP BY c) SELECT k, op, commit_ts FROM orders_log o WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.t = o.c AND s.start_ts = o.commit_ts)")
def flt_skipdml(spark, d):
    df = _orders(spark, d)
    starts = df.where("c % 2 = 0").groupBy("c").agg(F.min("commit_ts").alias("commit_ts"))
    return df.join(starts, ["c", "commit_ts"], "left_anti").select("k", "op", "commit_ts")


# two epochs per dispatcher; some events lost, some repeated, some of the first epoch late
_EVENTS = """SELECT k AS dispatcher, n * 10 AS arrival, CASE WHEN n < 12 THEN 1 ELSE 2 END AS epoch, CASE WHEN n = 1 OR n = 12 THEN 'handshake' WHEN n % 6 = 0 THEN 'ddl' WHEN n % 5 = 0 THEN 'syncpoint' ELSE 'dml' END AS kind,
    CASE WHEN n < 12 THEN n ELSE n - 11 END AS seq, commit_ts FROM history_log WHERE NOT (k % 7 = 3 AND n = 5) AND NOT (k % 11 = 4 AND n IN (12, 20))
  UNION ALL SELECT k, n * 10 + 5, CASE WHEN n < 12 THEN 1 ELSE 2 END, 'resolved', CASE WHEN n < 12 THEN n ELSE n - 11 END, commit_ts FROM history_log WHERE n % 4 = 0
  UNION ALL SELECT k, n * 10 + 127, 1, 'dml', n, commit_ts FROM history_log WHERE n = 3 AND k % 2 = 0
  UNION ALL SELECT k, 103, 1, 'ddl', 11, commit_ts - 1 FROM history_log WHERE n = 10 AND k % 5 = 1"""
_CHECKED = f"""e AS ({_EVENTS}), s AS (SELECT *, coalesce(epoch < max(epoch) OVER (PARTITION BY dispatcher ORDER BY arrival ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), false) AS stale FROM e),
c AS (SELECT *, coalesce(sum(CASE WHEN kind <> 'resolved' THEN 1 ELSE 0 END) OVER (PARTITION BY dispatcher, epoch ORDER BY arrival ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS n FROM s WHERE NOT stale),
r AS (SELECT *, CASE WHEN n = 0 THEN kind = 'handshake' AND seq = 1 WHEN kind = 'resolved' THEN seq = n ELSE seq = n + 1 END AS good FROM c),
w AS (SELECT *, coalesce(sum(CASE WHEN good THEN 0 ELSE 1 END) OVER (PARTITION BY dispatcher, epoch ORDER BY arrival ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS wrong FROM r),
p AS (SELECT *, max(commit_ts) OVER (PARTITION BY dispatcher ORDER BY arrival ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS top, row_number() OVER (PARTITION BY dispatcher, kind, commit_ts ORDER BY arrival) AS again FROM w WHERE wrong = 0 AND good)"""


@q(f"""WITH {ctes('history_log')}, {_CHECKED} SELECT dispatcher, arrival, kind, seq, CASE WHEN coalesce(commit_ts < top OR (kind IN ('ddl', 'syncpoint') AND again > 1), false) THEN 'repeated' ELSE 'forward' END AS outcome FROM p
UNION ALL SELECT dispatcher, arrival, kind, seq, CASE WHEN wrong = 0 THEN 'reset' ELSE 'dropped' END FROM w WHERE wrong > 0 OR NOT good UNION ALL SELECT dispatcher, arrival, kind, seq, 'stale' FROM s WHERE stale""")
def flt_dupseq(spark, d):
    history = log(spark, d, "history_log")
    events = spark.sql(_EVENTS.replace("FROM history_log", "FROM {h}"), h=history)
    return verify_sequence(events).select("dispatcher", "arrival", "kind", "seq", "outcome")


@q(f"{OL} SELECT s, count(*) AS n, n_name FROM orders_log JOIN nation ON n_nationkey = c % 25 GROUP BY s, n_name")
def jn_tableinfo(spark, d):
    # the 25 rows of a metadata table
    info = spark.read.parquet(f"{d}/nation.parquet").select("n_name", "n_nationkey")
    return _orders(spark, d).join(info, F.col("n_nationkey") == F.col("c") % 25).groupBy("s", "n_name").agg(F.count("*").alias("n"))


@q(f"{OL} SELECT o.k, o.op, o.commit_ts, substr(o_orderpriority, 1, 1) AS body FROM orders_log o JOIN orders ON o_orderkey = o.k WHERE o.post_p > 20000000")
def jn_claimcheck(spark, d):
    store = spark.read.parquet(f"{d}/orders.parquet").select(F.concat(F.lit("msg-"), F.col("o_orderkey").cast("string")).alias("location"), F.substring("o_orderpriority", 1, 1).alias("body"))
    large = _orders(spark, d).where("post_p > 20000000").withColumn("location", F.concat(F.lit("msg-"), F.col("k").cast("string")))
    return large.join(store, "location").select("k", "op", "commit_ts", "body")


@q(f"{OL}, w AS (SELECT k, commit_ts, op, last_value(post_p IGNORE NULLS) OVER (PARTITION BY k ORDER BY commit_ts ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS filled FROM orders_log) SELECT k, commit_ts, filled FROM w WHERE op = 'D'")
def jn_handlekey(spark, d):
    """Deletes that hold their key only get the newest image before them; one
    without an earlier image comes out with null."""
    filled = O.last_known(_orders(spark, d).select("k", "commit_ts", "op", "post_p"), ["k"], [F.col("commit_ts")], F.col("post_p"), "filled")
    return filled.where("op = 'D'").select("k", "commit_ts", "filled")


# scalar functions


@q(f"{OL} SELECT k, op, commit_ts >> 18 AS ms, commit_ts & 262143 AS logical, ((commit_ts >> 18) << 18) + 5 AS composed FROM orders_log")
def fn_tso(spark, d):
    ts = F.col("commit_ts")
    return _orders(spark, d).select("k", "op", tso.physical_ms(ts).alias("ms"), tso.logical(ts).alias("logical"), tso.compose(tso.physical_ms(ts), 5).alias("composed"))


_TABLE_CRC, _OK_CRC, _LN_CRC = _CRC("'shoplines'"), _CRC("'ok' || CAST(ok AS VARCHAR)"), _CRC("'ln' || CAST(ln AS VARCHAR)")


@q(f"WITH {ctes('lines')} SELECT ok, ln, xor(xor({_TABLE_CRC}, {_OK_CRC}), {_LN_CRC}) AS hash FROM lines")
def fn_poshash(spark, d):
    """Hash of the key parts."""
    return log(spark, d, "lines").select("ok", "ln", U.key_hash(F.lit("shop"), F.lit("lines"), [("ok", F.col("ok")), ("ln", F.col("ln"))]).alias("hash"))


@q(f"WITH {ctes('lines')} SELECT ok, ln, CAST(qty AS VARCHAR) AS i, CASE WHEN qty % 2 = 0 THEN '1' ELSE '0' END AS b, CAST(price // 100 AS VARCHAR) || CASE WHEN price % 100 = 0 THEN '' WHEN price % 10 = 0 THEN '.' || CAST(price % 100 // 10 AS VARCHAR) ELSE '.' || lpad(CAST(price % 100 AS VARCHAR), 2, '0') END AS f FROM lines")
def fn_valstr(spark, d):
    return log(spark, d, "lines").select("ok", "ln", F.col("qty").cast("string").alias("i"), S.value_string(F.col("qty") % 2 == 0, "boolean").alias("b"), S.value_string(F.col("price").cast("double") / 100, "double").alias("f"))


@q("SELECT p_partkey AS id, '`' || replace(p_name || '`x', '`', '``') || '`' AS quoted FROM part")
def fn_quote(spark, d):
    return spark.read.parquet(f"{d}/part.parquet").select(F.col("p_partkey").alias("id"), S.quote_name(F.concat("p_name", F.lit("`x"))).alias("quoted"))


@q("SELECT c_custkey AS id, CASE WHEN c_custkey % 2 = 0 THEN lower(c_name) ELSE c_name END AS key FROM customer")
def fn_ciLower(spark, d):
    c = spark.read.parquet(f"{d}/customer.parquet").withColumn("coll", F.when(F.col("c_custkey") % 2 == 0, "utf8mb4_general_ci").otherwise("utf8mb4_bin"))
    return c.select(F.col("c_custkey").alias("id"), S.collated_key(F.col("c_name"), F.col("coll")).alias("key"))


@q("SELECT p_partkey AS id, substr('cdc_' || regexp_replace(p_brand, '[^a-zA-Z0-9._-]', '_', 'g') || '.' || regexp_replace(p_type, '[^a-zA-Z0-9._-]', '_', 'g'), 1, 249) AS topic FROM part")
def fn_topic(spark, d):
    return spark.read.parquet(f"{d}/part.parquet").select(F.col("p_partkey").alias("id"), U.topic(F.col("p_brand"), F.col("p_type"), "cdc_{schema}.{table}").alias("topic"))


@q("SELECT * FROM (VALUES ('a_{schema}_{table}', true, true), ('{table}{schema}', false, false), ('plain', true, false), ('a b', false, false), ('{schema}', true, false)) t(template, valid, valid_both)")
def fn_topicvalid(spark, d):
    rows = [(t, U.topic_valid(t), U.topic_valid(t, True)) for t in ("a_{schema}_{table}", "{table}{schema}", "plain", "a b", "{schema}")]
    return spark.createDataFrame(rows, "template string, valid boolean, valid_both boolean")


@q("SELECT p_partkey AS id, 'dw_' || p_brand AS s, p_type || '_copy' AS t FROM part")
def fn_route(spark, d):
    s, t = U.route_table(F.col("p_brand"), F.col("p_type"), [("*.*", "dw_{schema}", "{table}_copy")])
    return spark.read.parquet(f"{d}/part.parquet").select(F.col("p_partkey").alias("id"), s.alias("s"), t.alias("t"))


@q("SELECT p_partkey AS id, regexp_replace(regexp_replace(p_type, '[^A-Za-z0-9_]', '_', 'g'), '^([0-9])', '_\\1') AS name FROM part")
def fn_sanitize(spark, d):
    return spark.read.parquet(f"{d}/part.parquet").select(F.col("p_partkey").alias("id"), S.record_name(F.col("p_type")).alias("name"))


def _typed(spark, d):
    return spark.read.parquet(f"{d}/part.parquet").select(F.col("p_partkey").alias("id"), F.expr("CASE p_size % 4 WHEN 0 THEN 'int' WHEN 1 THEN 'bigint' WHEN 2 THEN 'varchar' ELSE 'decimal' END").alias("base"), (F.col("p_size") % 4 == 0).alias("uns"), F.expr("CASE p_size % 4 WHEN 2 THEN '10' WHEN 3 THEN '10,2' END").alias("arg"))


@q("SELECT p_partkey AS id, CASE p_size % 4 WHEN 0 THEN 'int unsigned' WHEN 1 THEN 'bigint' WHEN 2 THEN 'varchar(10)' ELSE 'decimal(10,2)' END AS full_type, CASE p_size % 4 WHEN 0 THEN 'int unsigned' WHEN 1 THEN 'bigint' WHEN 2 THEN 'varchar' ELSE 'decimal' END AS short_type FROM part")
def fn_mysqltype(spark, d):
    return _typed(spark, d).select("id", S.type_name(F.col("base"), F.col("uns"), F.col("arg")).alias("full_type"), S.type_name(F.col("base"), F.col("uns")).alias("short_type"))


@q("SELECT p_partkey AS id, CASE p_size % 4 WHEN 0 THEN -5 WHEN 1 THEN -5 WHEN 2 THEN 12 ELSE 3 END AS java_type FROM part")
def fn_javatype(spark, d):
    return _typed(spark, d).select("id", S.java_type(F.col("base"), F.col("uns")).alias("java_type"))


@q("SELECT p_partkey AS id, CASE WHEN p_size % 2 = 0 THEN CAST(p_size * 256 + 7 AS DECIMAL(20,0)) ELSE CAST(18446744073709551615 AS DECIMAL(20,0)) END AS bits FROM part")
def fn_binlit(spark, d):
    raw = F.when(F.col("p_size") % 2 == 0, F.unhex(F.concat(F.hex("p_size"), F.lit("07")))).otherwise(F.unhex(F.repeat(F.lit("F"), 16)))
    return spark.read.parquet(f"{d}/part.parquet").select(F.col("p_partkey").alias("id"), S.bits_to_int(raw).alias("bits"))


@q("SELECT p_partkey AS id, '\"' || replace(p_name || '\"q,', '\"', '\"\"') || '\"' AS quoted, replace(replace(p_name || ',' || chr(10), ',', chr(92) || ','), chr(10), chr(92) || 'n') AS escaped, chr(92) || 'N' AS missing FROM part")
def fn_csvesc(spark, d):
    p = spark.read.parquet(f"{d}/part.parquet")
    return p.select(F.col("p_partkey").alias("id"), S.csv_quote(F.concat("p_name", F.lit('"q,'))).alias("quoted"), S.csv_escape(F.concat("p_name", F.lit(",\n"))).alias("escaped"), S.csv_quote(F.lit(None).cast("string")).alias("missing"))


@q("SELECT p_partkey AS id, CASE p_size % 4 WHEN 1 THEN 'a' WHEN 2 THEN 'b' WHEN 3 THEN 'c' ELSE '' END AS e, array_to_string(list_filter([CASE WHEN p_size & 1 > 0 THEN 'a' END, CASE WHEN p_size & 2 > 0 THEN 'b' END, CASE WHEN p_size & 4 > 0 THEN 'c' END], lambda x: x IS NOT NULL), ',') AS s FROM part")
def fn_enumset(spark, d):
    names = ["a", "b", "c"]
    return spark.read.parquet(f"{d}/part.parquet").select(F.col("p_partkey").alias("id"), S.enum_name(F.col("p_size") % 4, names).alias("e"), S.set_names(F.col("p_size"), names).alias("s"))


@q("SELECT p_partkey AS id, base64(encode(p_name)) AS b64, hex(encode(p_name)) AS hx FROM part")
def fn_hexb64(spark, d):
    return spark.read.parquet(f"{d}/part.parquet").select(F.col("p_partkey").alias("id"), F.base64(F.encode("p_name", "UTF-8")).alias("b64"), F.hex("p_name").alias("hx"))


@q("SELECT o_orderkey AS id, strftime(o_orderdate, '%Y') AS y, strftime(o_orderdate, '%Y-%m') AS m, strftime(o_orderdate, '%Y-%m-%d') AS d FROM orders")
def fn_datepath(spark, d):
    o = spark.read.parquet(f"{d}/orders.parquet")
    return o.select(F.col("o_orderkey").alias("id"), *[S.date_path(F.col("o_orderdate"), u).alias(u[0]) for u in ("year", "month", "day")])


@q("SELECT c_custkey AS id, '?' AS hidden, '<' || c_name || '>' AS marked, c_name AS off FROM customer")
def fn_redact(spark, d):
    c = spark.read.parquet(f"{d}/customer.parquet")
    return c.select(F.col("c_custkey").alias("id"), S.redact(F.col("c_name"), "on").alias("hidden"), S.redact(F.col("c_name"), "marker").alias("marked"), S.redact(F.col("c_name"), "off").alias("off"))


@q("SELECT c_custkey AS id, CASE WHEN c_custkey % 3 = 0 THEN 0.0 WHEN c_custkey % 3 = 1 THEN 0.0 ELSE 1.5 END AS v FROM customer")
def fn_naninf(spark, d):
    v = F.when(F.col("c_custkey") % 3 == 0, F.lit(float("nan"))).when(F.col("c_custkey") % 3 == 1, F.lit(float("-inf"))).otherwise(F.lit(1.5))
    return spark.read.parquet(f"{d}/customer.parquet").select(F.col("c_custkey").alias("id"), S.finite(v).alias("v"))


@q("SELECT c_custkey AS id, c_name AS restored FROM customer")
def fn_compress(spark, d):
    """Payload compression and its inverse: the round trip gives the input."""
    c = spark.read.parquet(f"{d}/customer.parquet")
    packed = c.select(F.col("c_custkey").alias("id"), S.compress("zstd")(F.encode("c_name", "UTF-8")).alias("z"))
    return packed.select("id", F.decode(S.decompress("zstd")(F.col("z")), "UTF-8").alias("restored"))


@q("SELECT c_custkey AS id, c_name AS restored, 20 + length(c_name) AS n_bytes FROM customer")
def fn_encrypt(spark, d):
    """AES-256-CTR payloads in their frame, and their inverse."""
    key, iv = F.unhex(F.sha2(F.lit("key"), 256)), F.substring(F.unhex(F.sha2(F.col("id").cast("string"), 256)), 1, 16)
    c = spark.read.parquet(f"{d}/customer.parquet").select(F.col("c_custkey").alias("id"), F.encode("c_name", "UTF-8").alias("plain"))
    framed = c.select("id", S.encrypt(F.col("plain"), key, iv, 1, b"k01").alias("frame"))
    return framed.select("id", F.decode(S.decrypt(F.col("frame"), key), "UTF-8").alias("restored"), F.length("frame").alias("n_bytes"))


@q("SELECT o_orderkey AS id, strftime(o_orderdate + INTERVAL 8 HOUR, '%Y-%m-%d %H:%M:%S') AS shown FROM orders")
def fn_defaultts(spark, d):
    """A default that is stored in UTC, as a session in another zone shows it."""
    return spark.read.parquet(f"{d}/orders.parquet").select(F.col("o_orderkey").alias("id"), S.default_timestamp(F.col("o_orderdate"), "Asia/Shanghai").alias("shown"))


# routing


@q(f"{OL} SELECT k, op, CASE WHEN sch = 'shop' THEN 'dw' ELSE lower(sch) || '_copy' END AS ts, CASE WHEN sch = 'shop' THEN 'shop_' || tbl ELSE tbl END AS tt FROM ({_NAMED}) WHERE sch IN ('shop', 'test')")
def rt_table(spark, d):
    rows = _named(spark, d).where("sch in ('shop', 'test')")
    s, t = U.route_table(F.col("sch"), F.col("tbl"), [("shop.*", "dw", "{schema}_{table}"), ("*.*", "{schema}_copy", "")])
    return rows.select("k", "op", s.alias("ts"), t.alias("tt"))


@q(f"WITH {ctes('base')}, x AS ({_DDLS}) SELECT k, replace(replace(query, ' t ', ' `dw`.`shop_t` '), 'TABLE t', 'TABLE `dw`.`shop_t`') AS query FROM x WHERE kind <> 'rename table'")
def rt_ddl(spark, d):
    rows = _ddls(spark, d).where("kind <> 'rename table'")
    return rows.select("k", S.rewrite_ddl(F.col("query"), F.lit("dw"), F.concat("sch", F.lit("_"), "tbl")).alias("query"))


@q(f"{OL} SELECT k, op, CASE WHEN sch = 'shop' THEN 'shop_' || tbl WHEN lower(tbl) = 'orders' THEN 'all_orders' ELSE 'default' END AS topic FROM ({_NAMED})")
def rt_topic(spark, d):
    return _named(spark, d).select("k", "op", U.dispatch_topic(F.col("sch"), F.col("tbl"), [("shop.*", "{schema}_{table}"), ("*.orders", "all_orders")], "default").alias("topic"))


_NAME_CRC, _K_CRC, _C_CRC, _S_CRC = _CRC("sch || tbl"), _CRC("'k' || CAST(k AS VARCHAR)"), _CRC("'c' || CAST(c AS VARCHAR)"), _CRC("'s' || s")


@q(f"{OL}, h AS (SELECT sch, tbl, {_NAME_CRC} AS h FROM (SELECT DISTINCT sch, tbl FROM ({_NAMED}))) SELECT k, op, CAST(h % 6 AS INTEGER) AS part, '`' || sch || '`.`' || tbl || '`' AS key FROM ({_NAMED}) JOIN h USING (sch, tbl)")
def rt_part_table(spark, d):
    return _named(spark, d).select("k", "op", F.pmod(U.key_hash(F.col("sch"), F.col("tbl"), []), F.lit(6)).cast("int").alias("part"), F.concat(S.quote_name(F.col("sch")), F.lit("."), S.quote_name(F.col("tbl"))).alias("key"))


@q(f"{OL} SELECT k, op, commit_ts % 6 AS part, CAST(commit_ts AS VARCHAR) AS key FROM orders_log")
def rt_part_ts(spark, d):
    return _orders(spark, d).select("k", "op", (F.col("commit_ts") % 6).alias("part"), F.col("commit_ts").cast("string").alias("key"))


@q(f"{OL}, h AS (SELECT k, op, xor({_NAME_CRC}, {_K_CRC}) AS h FROM ({_NAMED})) SELECT k, op, CAST(h % 6 AS INTEGER) AS part, CAST(h AS VARCHAR) AS key FROM h")
def rt_part_index(spark, d):
    h = U.key_hash(F.col("sch"), F.col("tbl"), [("k", F.col("k"))])
    return _named(spark, d).select("k", "op", F.pmod(h, F.lit(6)).cast("int").alias("part"), h.cast("string").alias("key"))


@q(f"{OL}, h AS (SELECT k, op, xor(xor({_NAME_CRC}, {_C_CRC}), {_S_CRC}) AS h FROM ({_NAMED})) SELECT k, op, CAST(h % 6 AS INTEGER) AS part, CAST(h AS VARCHAR) AS key FROM h")
def rt_part_cols(spark, d):
    h = U.key_hash(F.col("sch"), F.col("tbl"), [("c", F.col("c")), ("s", F.col("s"))])
    return _named(spark, d).select("k", "op", F.pmod(h, F.lit(6)).cast("int").alias("part"), h.cast("string").alias("key"))


@q(f"{OL} SELECT k, op, 0 AS part, 'fixed' AS key FROM orders_log")
def rt_part_key(spark, d):
    return _orders(spark, d).select("k", "op", F.lit(0).alias("part"), F.lit("fixed").alias("key"))


@q("SELECT * FROM (VALUES ('uk', true), ('plain', false), ('none', false)) t(index_name, usable)")
def rt_verify(spark, d):
    indexes = {"uk": True, "plain": False}
    return spark.createDataFrame([(n, S.index_usable(indexes, n)) for n in ("uk", "plain", "none")], "index_name string, usable boolean")


@q(f"WITH {ctes('ddl_jobs')} SELECT job, kind, unnest(CASE WHEN kind = 'create view' OR kind LIKE '%table' THEN generate_series(0, CAST(schema_id AS BIGINT)) ELSE generate_series(0, 0) END)::INTEGER AS part FROM ddl_jobs")
def rt_ddl_bcast(spark, d):
    """Changes of tables go to every partition of their topic, others to the first."""
    every = F.col("kind").endswith("table") | (F.col("kind") == "create view")
    return U.to_partitions(log(spark, d, "ddl_jobs"), F.col("schema_id") + 1, every).select("job", "kind", "part")


QUERIES, SQL = R.queries, R.sql
