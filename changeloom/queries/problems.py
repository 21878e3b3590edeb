"""Queries of the five general problems and their SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from changeloom.functions import rowimage as R
from changeloom.operators import copy_diff, heavy_keys, redelivery, schema_drift
from changeloom.session import materialize
from changeloom.streaming import upsert


def _read(spark: SparkSession, d: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{table}.parquet")


def _redo(spark: SparkSession, d: str) -> DataFrame:
    path = f"{d}/redo_dml.parquet"
    return spark.read.schema(R.scan_schema(spark.read.parquet(path).schema)).parquet(path)


def _message_ids() -> dict:
    row, pre = F.col("row_columns"), F.col("pre_columns")
    return {
        "start_ts": F.col("start_ts"), "commit_ts": F.col("commit_ts"), "tbl_id": F.col("tbl.tbl_id"),
        "row_key": R.row_key(row, pre), "op": R.op_code(row, pre),
    }


_TS_MS = lambda: F.shiftright(F.col("commit_ts"), 18)


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return redelivery.repeated_messages(_redo(spark, d), _message_ids(), _TS_MS()).drop("copies")


def _image_text(image: str) -> Column:
    """All fields of an image as one text."""
    field = lambda v: F.coalesce(v.cast("string"), F.lit("~"))
    parts = F.transform(image, lambda c: F.concat_ws(" ", *[field(c[f]) for f in ("col_name", "col_type", "charset", "collation_name", "col_value", "flag")]))
    return F.array_join(parts, ";").alias(image)


def p1_messages(spark: SparkSession, d: str) -> DataFrame:
    """The messages themselves, the copy of smallest log_id of each, whole."""
    ids = _message_ids()
    whole = [c for c in ids if c not in ("start_ts", "commit_ts", "tbl_id")]
    # images as text before they are shuffled: a nested row is several times as wide
    rows = _read(spark, d, "redo_dml").select(
        "log_id", "log_file", "delivered_at", "start_ts", "commit_ts", "tbl.db_name", "tbl.tbl_name", "tbl.tbl_id", _image_text("row_columns"), _image_text("pre_columns"), *[ids[c].alias(c) for c in whole])
    return redelivery.exactly_once(rows, {c: F.col(c) for c in ids}, _TS_MS(), "log_id").drop(*whole)


def p1_batches(spark: SparkSession, d: str) -> DataFrame:
    """The same over batches: log files come in four turns by their number, and
    each batch is held against the stored identifiers of the batches before."""
    ids = _message_ids()
    names = {n: f"__{n}" for n in ids}
    log = _redo(spark, d).select("log_id", "log_file", *[c.alias(names[n]) for n, c in ids.items()], _TS_MS().alias("ms"), _LOG_NUMBER().alias("turn"))
    store = redelivery.RedeliveryStore(spark, list(names.values()), "ms", bucket_ms=86_400_000)
    accepted = [store.process(log.where(F.col("turn") == k), k, "log_id") for k in range(4)]
    out = accepted[0]
    for a in accepted[1:]:
        out = out.unionByName(a)
    return out.select("log_id", *[F.col(v).alias(k) for k, v in names.items()], "turn")


def _LOG_NUMBER() -> Column:
    return (F.regexp_extract("log_file", r"_(\d+)\.log$", 1).cast("bigint") % 4).cast("int")


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    log = schema_drift.changes(schema_drift.drift_rows(_read(spark, d, "sink_message")))
    return log.select("topic", F.col("file_seq").cast("int").alias("file_seq"), "change_kind", "field_name", "old_name")


def p2_catalogue(spark: SparkSession, d: str) -> DataFrame:
    return schema_drift.catalogue(schema_drift.drift_rows(_read(spark, d, "sink_message")))


def p2_schema(spark: SparkSession, d: str) -> DataFrame:
    rows = schema_drift.drift_rows(_read(spark, d, "sink_message"))
    return schema_drift.unified_schema(rows, schema_drift.column_names(rows, schema_drift.changes(rows)))


def _p2_parts(spark: SparkSession, d: str) -> tuple[DataFrame, ...]:
    messages = _read(spark, d, "sink_message")
    rows = schema_drift.drift_rows(messages)
    names = schema_drift.column_names(rows, schema_drift.changes(rows))
    return messages, rows, names, schema_drift.unified_schema(rows, names)


def p2_table(spark: SparkSession, d: str) -> DataFrame:
    return schema_drift.unified_rows(*_p2_parts(spark, d))


def p2_leftover(spark: SparkSession, d: str) -> DataFrame:
    """Per topic: fields and values of its messages that p2_table has no room for."""
    parts = _p2_parts(spark, d)
    topics = parts[0].select("topic", F.lit(None).cast("string").alias("reason"))
    every = topics.unionByName(schema_drift.left_over(*parts).select("topic", "reason"))
    return every.groupBy("topic").agg(F.count_if(F.col("reason") == "undeclared").alias("undeclared"), F.count_if(F.col("reason") == "not cast").alias("not_cast"))


def p2_reports(spark: SparkSession, d: str) -> DataFrame:
    """Per topic: messages, those that give no fields, fields of several types
    within one file, schema versions that do not stand for one field list."""
    messages = _read(spark, d, "sink_message")
    counts = {"unread": schema_drift.unread(messages), "conflicts": schema_drift.conflicts(messages), "version_mismatches": schema_drift.version_mismatches(messages)}
    out = messages.groupBy("topic").agg(F.count("*").alias("messages"))
    for name, rows in counts.items():
        n = rows.groupBy(F.col("topic").alias("t")).agg(F.count("*").alias(name))
        out = out.join(n, F.col("topic").eqNullSafe(F.col("t")), "left").drop("t")
    return out.na.fill(0, list(counts))


def p2_footers(spark: SparkSession, d: str) -> DataFrame:
    """Changes between the stored files of the change-stream tables, from their
    footers only: the files of a table in order, then those of its copy. A footer
    that cannot be read is an error."""
    tables = {"redo_dml": "redo", "sink_message": "messages", "sbtest_upstream": "sbtest", "sbtest_downstream": "sbtest"}
    files = [(topic, n, path) for topic in sorted(set(tables.values())) for n, path in enumerate(p for t, x in tables.items() if x == topic for p in sorted(_read(spark, d, t).inputFiles()))]
    return schema_drift.catalogue(schema_drift.drift_of(_all_footers(spark.createDataFrame(files, "topic string, file_seq int, path string"))))


def _all_footers(files: DataFrame) -> DataFrame:
    read = materialize(schema_drift.read_footers(files), "footers")
    bad = read.where("reason is not null")
    if not bad.isEmpty():
        raise ValueError(f"{bad.count()} footers cannot be read, among them {[tuple(r) for r in bad.select('path', 'reason').take(10)]}")
    return read.drop("path", "reason")


DIFF = copy_diff.DiffPlan(
    fields=("k", "c", "pad", "balance", "score", "attrs", "updated_at"), trim=("c", "pad"), json=("attrs",), tolerance={"score": 1e-6}
)


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return copy_diff.diff(_read(spark, d, "sbtest_upstream"), _read(spark, d, "sbtest_downstream"), DIFF)


def p3_recheck(spark: SparkSession, d: str) -> DataFrame:
    """Per table: differences now, beside what the earlier check recorded."""
    now = p3_found(spark, d).groupBy("schema_name", "table_name").agg(
        F.count_if(F.col("diff_kind") == "missing_upstream").alias("missing_upstream"),
        F.count_if(F.col("diff_kind") == "missing_downstream").alias("missing_downstream"),
        F.count_if(F.col("diff_kind") == "differs").alias("differing_fields"),
    )
    then = _read(spark, d, "summary").groupBy("schema_name", "table_name").agg(F.max("check_failed_num").alias("failed_chunks_then"))
    states = (
        _read(spark, d, "chunk").groupBy("schema_name", "table_name")
        .agg(F.count_distinct(F.when(F.col("state") == "failed", F.col("chunk_id"))).alias("failed_states_then"))
    )
    return then.join(states, ["schema_name", "table_name"], "left").join(now, ["schema_name", "table_name"], "left").na.fill(0)


def p3_chunks(spark: SparkSession, d: str) -> DataFrame:
    """Every chunk of the earlier check: what its checksums and state recorded,
    and the rows and differing keys in its range now."""
    up, down = _read(spark, d, "sbtest_upstream"), _read(spark, d, "sbtest_downstream")
    recorded = copy_diff.recorded_chunks(_read(spark, d, "chunk"), "source-1", "target-1")
    return copy_diff.recheck(p3_found(spark, d), recorded, up, down, "id")


def _table_name() -> list:
    return [R.clean_name(F.col("tbl.db_name")).alias("db_name"), R.clean_name(F.col("tbl.tbl_name")).alias("tbl_name"), "commit_ts"]


def p4_tables(spark: SparkSession, d: str) -> DataFrame:
    rows = _read(spark, d, "redo_dml").select(*_table_name())
    A = heavy_keys.Agg
    return heavy_keys.salted_aggregate(
        rows, ["db_name", "tbl_name"], [A("n_rows", "count"), A("first_commit_ts", "min", "commit_ts"), A("last_commit_ts", "max", "commit_ts")]
    )


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    tables = p4_tables(spark, d)
    total = tables.agg(F.sum("n_rows").alias("total"))
    # one row
    return tables.join(F.broadcast(total), F.col("n_rows") >= F.col("total") * F.lit(0.03)).select("db_name", "tbl_name")


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return p5_rows(spark, d).drop("payload")


def p5_rows(spark: SparkSession, d: str) -> DataFrame:
    """The rows that exist at the end, with their last image, whole."""
    path = f"{d}/redo_dml.parquet"
    return upsert.rebuild(spark, path, spark.read.parquet(path).schema)


QUERIES = {
    "p1_found": p1_found, "p1_messages": p1_messages, "p1_batches": p1_batches, "p2_found": p2_found, "p2_catalogue": p2_catalogue, "p2_schema": p2_schema,
    "p2_table": p2_table, "p2_leftover": p2_leftover, "p2_reports": p2_reports, "p2_footers": p2_footers, "p3_found": p3_found, "p3_recheck": p3_recheck, "p3_chunks": p3_chunks, "p4_found": p4_found, "p4_tables": p4_tables,
    "p5_found": p5_found, "p5_rows": p5_rows,
}

_KEY = """array_to_string(list_transform(list_sort(list_transform(list_filter({0}, lambda c: c.flag & 2 <> 0),
    lambda c: {{'n': c.col_name, 'v': c.col_value}})), lambda p: coalesce(p.v, '')), '|')"""
_ROW, _PRE = "coalesce(len(row_columns), 0) > 0", "coalesce(len(pre_columns), 0) > 0"
_IMAGE = """array_to_string(list_transform({0}, lambda c: array_to_string([coalesce(CAST(c.col_name AS VARCHAR), '~'), coalesce(CAST(c.col_type AS VARCHAR), '~'), coalesce(c.charset, '~'),
    coalesce(c.collation_name, '~'), coalesce(c.col_value, '~'), coalesce(CAST(c.flag AS VARCHAR), '~')], ' ')), ';') AS {0}"""
_MESSAGES = f"""SELECT * EXCLUDE (tbl), tbl.db_name AS db_name, tbl.tbl_name AS tbl_name, tbl.tbl_id AS tbl_id,
    CASE WHEN {_ROW} THEN {_KEY.format('row_columns')} ELSE {_KEY.format('pre_columns')} END AS row_key,
    CASE WHEN {_ROW} AND {_PRE} THEN 'U' WHEN {_ROW} THEN 'I' WHEN {_PRE} THEN 'D' END AS op FROM redo_dml"""
_NAMES = """SELECT lower(trim(replace(trim(tbl.db_name), '`', ''))) AS db_name, lower(trim(replace(trim(tbl.tbl_name), '`', ''))) AS tbl_name,
    count(*) AS n_rows, min(commit_ts) AS first_commit_ts, max(commit_ts) AS last_commit_ts FROM redo_dml GROUP BY 1, 2"""
_SIDE = """SELECT DISTINCT schema_name, table_name, id, k, rtrim(c) AS c, rtrim(pad) AS pad, balance, score, updated_at,
    CASE WHEN attrs IS NOT NULL THEN array_to_string(list_transform(list_sort(json_keys(attrs)), lambda x: x || '=' || CAST(json_extract(attrs, '$.' || x) AS VARCHAR)), ';') END AS attrs
    FROM {}"""
_P3 = f"""WITH a AS ({_SIDE.format('sbtest_upstream')}), b AS ({_SIDE.format('sbtest_downstream')}),
  j AS (SELECT a.*, b.k AS k2, b.c AS c2, b.pad AS pad2, b.balance AS balance2, b.score AS score2, b.attrs AS attrs2, b.updated_at AS updated_at2
    FROM a JOIN b USING (schema_name, table_name, id))
SELECT schema_name, table_name, id, 'missing_downstream' AS diff_kind, '' AS field_name FROM a ANTI JOIN b USING (schema_name, table_name, id)
UNION ALL SELECT schema_name, table_name, id, 'missing_upstream', '' FROM b ANTI JOIN a USING (schema_name, table_name, id)
""" + "".join(
    f"UNION ALL SELECT schema_name, table_name, id, 'differs', '{f}' FROM j WHERE "
    + (f"{f} IS DISTINCT FROM {f}2" if f != "score" else "(score IS NULL) <> (score2 IS NULL) OR abs(score - score2) > 1.000000001e-6")
    + "\n"
    for f in DIFF.fields
)
_P5 = f"""WITH m AS (SELECT tbl.tbl_id AS tbl_id, commit_ts, start_ts, {_ROW} AS has_row, {_PRE} AS has_pre,
    {_KEY.format('row_columns')} AS rk, {_KEY.format('pre_columns')} AS pk, row_columns FROM redo_dml),
  c AS (SELECT tbl_id, rk AS row_key, commit_ts, CASE WHEN has_pre THEN 2 ELSE 3 END AS rnk, start_ts, true AS alive FROM m WHERE has_row
    UNION ALL SELECT tbl_id, pk, commit_ts, CASE WHEN has_row THEN 1 ELSE 0 END, start_ts, false FROM m WHERE has_pre AND (NOT has_row OR rk <> pk)),
  l AS (SELECT *, row_number() OVER (PARTITION BY tbl_id, row_key ORDER BY commit_ts DESC, rnk DESC, start_ts DESC) AS rn FROM c)
SELECT tbl_id, row_key, commit_ts FROM l WHERE rn = 1 AND alive"""

_LAST_CHUNK = "SELECT *, row_number() OVER (PARTITION BY schema_name, table_name, chunk_id, instance_id ORDER BY update_time DESC NULLS LAST, state DESC NULLS LAST, checksum DESC NULLS LAST) AS rn FROM chunk"
_READINGS = """list_filter([CASE WHEN regexp_full_match(t, '[0-9]+') THEN CAST(t AS HUGEINT) END, CASE WHEN regexp_full_match(t, '[0-9a-f]{1,16}') THEN CAST(CAST('0x' || t AS UBIGINT) AS HUGEINT) END], lambda x: x IS NOT NULL)"""
_P3_CHUNKS = f"""WITH l AS ({_LAST_CHUNK}), c AS (SELECT *, lower(trim(checksum)) AS t, TRY_CAST(nullif(regexp_extract(chunk_range, '`\\w+` >= (-?\\d+)', 1), '') AS BIGINT) AS lo, TRY_CAST(nullif(regexp_extract(chunk_range, '`\\w+` < (-?\\d+)', 1), '') AS BIGINT) AS hi FROM l WHERE rn = 1),
  s AS (SELECT schema_name, table_name, chunk_id, max(lo) AS lo, min(hi) AS hi, coalesce(max(state) FILTER (instance_id = 'source-1'), max(state) FILTER (instance_id = 'target-1')) AS state,
    max(t) FILTER (instance_id = 'source-1') AS ta, max(t) FILTER (instance_id = 'target-1') AS tb FROM c GROUP BY 1, 2, 3),
  r AS (SELECT *, {_READINGS.replace('t ', 'ta ').replace('(t,', '(ta,').replace('|| t ', '|| ta ')} AS a, {_READINGS.replace('t ', 'tb ').replace('(t,', '(tb,').replace('|| t ', '|| tb ')} AS b FROM s),
  f AS (SELECT DISTINCT schema_name, table_name, id FROM ({_P3})), u AS (SELECT schema_name, table_name, id, count(*) AS n FROM sbtest_upstream GROUP BY 1, 2, 3), w AS (SELECT schema_name, table_name, id, count(*) AS n FROM sbtest_downstream GROUP BY 1, 2, 3),
  q AS (SELECT schema_name, table_name, chunk_id, state, CASE WHEN len(a) > 0 AND len(b) > 0 THEN list_has_any(a, b) END AS recorded_equal,
  coalesce((SELECT sum(n) FROM u WHERE u.schema_name = r.schema_name AND u.table_name = r.table_name AND (lo IS NULL OR id >= lo) AND (hi IS NULL OR id < hi)), 0)::BIGINT AS rows_upstream,
  coalesce((SELECT sum(n) FROM w WHERE w.schema_name = r.schema_name AND w.table_name = r.table_name AND (lo IS NULL OR id >= lo) AND (hi IS NULL OR id < hi)), 0)::BIGINT AS rows_downstream,
  (SELECT count(*) FROM f WHERE f.schema_name = r.schema_name AND f.table_name = r.table_name AND (lo IS NULL OR id >= lo) AND (hi IS NULL OR id < hi)) AS keys_differ FROM r)
SELECT *, CASE WHEN state IN ('success', 'failed') THEN (state = 'success') = (keys_differ = 0) END AS state_holds FROM q"""

SQL = {
    "p1_found": f"SELECT start_ts, commit_ts, tbl_id, row_key, op FROM ({_MESSAGES}) GROUP BY ALL HAVING count(*) > 1",
    "p1_messages": f"""WITH r AS (SELECT *, row_number() OVER w AS rn, count(*) OVER (PARTITION BY start_ts, commit_ts, tbl_id, row_key, op) AS copies FROM ({_MESSAGES}) WINDOW w AS (PARTITION BY start_ts, commit_ts, tbl_id, row_key, op ORDER BY log_id))
SELECT log_id, log_file, delivered_at, start_ts, commit_ts, db_name, tbl_name, tbl_id, {_IMAGE.format("row_columns")}, {_IMAGE.format("pre_columns")}, copies FROM r WHERE rn = 1""",
    "p1_batches": f"""WITH m AS (SELECT *, CAST(CAST(regexp_extract(log_file, '_(\\d+)\\.log$', 1) AS BIGINT) % 4 AS INTEGER) AS turn FROM ({_MESSAGES})),
r AS (SELECT *, row_number() OVER (PARTITION BY start_ts, commit_ts, tbl_id, row_key, op ORDER BY turn, log_id) AS rn FROM m)
SELECT log_id, start_ts, commit_ts, tbl_id, row_key, op, turn FROM r WHERE rn = 1""",
    "p3_found": _P3,
    "p3_chunks": _P3_CHUNKS,
    "p3_recheck": f"""WITH d AS ({_P3}), n AS (SELECT schema_name, table_name, count(*) FILTER (diff_kind = 'missing_upstream') AS missing_upstream, count(*) FILTER (diff_kind = 'missing_downstream') AS missing_downstream,
    count(*) FILTER (diff_kind = 'differs') AS differing_fields FROM d GROUP BY 1, 2), t AS (SELECT schema_name, table_name, max(check_failed_num) AS failed_chunks_then FROM summary GROUP BY 1, 2),
  c AS (SELECT schema_name, table_name, count(DISTINCT CASE WHEN state = 'failed' THEN chunk_id END) AS failed_states_then FROM chunk GROUP BY 1, 2)
SELECT t.schema_name, t.table_name, coalesce(failed_chunks_then, 0) AS failed_chunks_then, coalesce(failed_states_then, 0) AS failed_states_then, coalesce(missing_upstream, 0) AS missing_upstream, coalesce(missing_downstream, 0) AS missing_downstream,
  coalesce(differing_fields, 0) AS differing_fields FROM t LEFT JOIN c USING (schema_name, table_name) LEFT JOIN n USING (schema_name, table_name)""",
    "p4_found": f"WITH t AS ({_NAMES}) SELECT db_name, tbl_name FROM t WHERE n_rows >= 0.03 * (SELECT sum(n_rows) FROM t)",
    "p4_tables": _NAMES,
    "p5_found": _P5,
}
