"""Wire formats: encoders against SQL text, decoders as exact round trips."""

from __future__ import annotations

from pyspark.sql import functions as F

from changeloom.functions.codecs import formats as E
from changeloom.functions.codecs.model import Col, Table
from changeloom.operators import ordering as O
from changeloom.plans.logs import ctes, log
from changeloom.queries.registry import Registry, crc32_sql, text_bytes_sql

R = Registry()
q = R.query
T = Table("shop", "orders", (Col("k", "bigint", True, False), Col("p", "bigint"), Col("s", "varchar")), table_id=7, version=3)
NOW = 1_700_000_000_000

_IMG = f"""WITH {ctes('orders_log')}, r AS (SELECT op, commit_ts, CASE WHEN op <> 'I' THEN k END AS pre_k, pre_p, CASE WHEN op <> 'I' THEN s END AS pre_s,
 CASE WHEN op <> 'D' THEN k END AS post_k, post_p, CASE WHEN op <> 'D' AND k % 5 <> 0 THEN s END AS post_s, k AS id FROM orders_log)"""


def _rows(spark, d):
    o = log(spark, d, "orders_log")
    return o.select(
        "op", "commit_ts", F.when(F.col("op") != "I", F.col("k")).alias("pre_k"), "pre_p", F.when(F.col("op") != "I", F.col("s")).alias("pre_s"),
        F.when(F.col("op") != "D", F.col("k")).alias("post_k"), "post_p", F.when((F.col("op") != "D") & (F.col("k") % 5 != 0), F.col("s")).alias("post_s"), F.col("k").alias("id"))


_BACK = f"{_IMG} SELECT id, op, commit_ts, pre_k, pre_p, pre_s, post_k, post_p, post_s FROM r"


def _qs(c: str) -> str:
    return f"coalesce('\"' || CAST({c} AS VARCHAR) || '\"', 'null')"


def _n(c: str) -> str:
    return f"coalesce(CAST({c} AS VARCHAR), 'null')"


def _obj(p: str, f, g=None) -> str:
    return f"""'{{"k":' || {f(p + '_k')} || ',"p":' || {f(p + '_p')} || ',"s":' || {(g or f)(p + '_s')} || '}}'"""


_KIND = "CASE op WHEN 'I' THEN 'INSERT' WHEN 'U' THEN 'UPDATE' ELSE 'DELETE' END"
_CANAL = f"""'{{"id":0,"database":"shop","table":"orders","pkNames":["k"],"isDdl":false,"type":"' || {_KIND} || '","es":' || CAST(commit_ts >> 18 AS VARCHAR) || ',"ts":{NOW},"sql":"","sqlType":{{"k":-5,"p":-5,"s":12}},"mysqlType":{{"k":"bigint","p":"bigint","s":"varchar"}},"old":' || CASE WHEN op = 'U' THEN '[' || {_obj('pre', _qs)} || ']' ELSE 'null' END || ',"data":[' || CASE WHEN op = 'D' THEN {_obj('pre', _qs)} ELSE {_obj('post', _qs)} END || '],"_ext":{{"commitTs":' || CAST(commit_ts AS VARCHAR) || '}}}}'"""


@q(f"{_IMG} SELECT id, op, {_CANAL} AS body FROM r")
def cd_canal(spark, d):
    return _rows(spark, d).select("id", "op", E.canal_json(T, NOW, extension="_ext").alias("body"))


@q(_BACK)
def cd_canal_decode(spark, d):
    m = _rows(spark, d).select("id", E.canal_json(T, NOW, extension="_ext").alias("body"))
    return E.canal_decode(m, T, "body")


@q(f"{_IMG}, l AS (SELECT commit_ts, id, {_CANAL} || chr(10) AS line FROM r) SELECT commit_ts, CAST(0 AS BIGINT) AS part, string_agg(line, '' ORDER BY id) AS message, count(*) AS n_lines FROM l GROUP BY commit_ts")
def cd_canal_txn(spark, d):
    """The newline-ended rows of a transaction in one message."""
    rows = _rows(spark, d).select("commit_ts", "id", E.canal_json(T, NOW, extension="_ext").alias("line"))
    return E.transaction_messages(rows, ["commit_ts"], [F.col("id")], F.col("line"), 1 << 20)


@q(f"{_IMG} SELECT id, CAST(CASE op WHEN 'D' THEN 3 WHEN 'U' THEN 2 ELSE 1 END AS INTEGER) AS kind, 1 AS version, op || '|' || CAST(id AS VARCHAR) AS payload, 16 + length(op || '|' || CAST(id AS VARCHAR)) AS n_bytes FROM r")
def cd_wire(spark, d):
    """Frames between processes, and back."""
    body = F.encode(F.concat_ws("|", "op", "id"), "UTF-8")
    frames = _rows(spark, d).select("id", E.wire_frame(F.when(F.col("op") == "D", 3).when(F.col("op") == "U", 2).otherwise(1), F.lit(1), body).alias("frame"))
    x = frames.withColumn("x", E.wire_parts(F.col("frame")))
    return x.select("id", "x.kind", "x.version", F.decode("x.payload", "UTF-8").alias("payload"), F.length("frame").alias("n_bytes"))


def _oc(t: int, h: str, f: int):
    return lambda v: f"""'{{"t":{t},{h}"f":{f},"v":' || {v} || '}}'"""


def _open(p: str) -> str:
    k, n, s = _oc(8, '"h":true,', 10), _oc(8, "", 64), _oc(15, "", 64)
    return f"""'{{"k":' || {k(_n(p + '_k'))} || ',"p":' || {n(_n(p + '_p'))} || ',"s":' || {s(_qs(p + '_s'))} || '}}'"""


@q(f"""{_IMG} SELECT id, op, '{{"ts":' || CAST(commit_ts AS VARCHAR) || ',"scm":"shop","tbl":"orders","t":1}}' AS key,
CASE op WHEN 'D' THEN '{{"d":' || {_open('pre')} || '}}' WHEN 'U' THEN '{{"u":' || {_open('post')} || ',"p":' || {_open('pre')} || '}}' ELSE '{{"u":' || {_open('post')} || '}}' END AS value FROM r""")
def cd_open(spark, d):
    return _rows(spark, d).select("id", "op", E.open_key(T).alias("key"), E.open_value(T).alias("value"))


@q(_BACK)
def cd_open_decode(spark, d):
    m = _rows(spark, d).select("id", E.open_key(T).alias("key"), E.open_value(T).alias("value"))
    return E.open_decode(m, T, "key", "value")


@q(f"{_IMG} SELECT id, op, length('{{\"ts\":' || CAST(commit_ts AS VARCHAR) || ',\"scm\":\"shop\",\"tbl\":\"orders\",\"t\":1}}') AS key_size FROM r")
def cd_open_frame(spark, d):
    """Length framing, read back from the frame's first 8 bytes."""
    frame = E.framed(E.open_key(T), E.open_value(T))
    size = F.conv(F.hex(F.substring(frame, F.lit(1), F.lit(8))), 16, 10).cast("bigint")
    return _rows(spark, d).select("id", "op", size.alias("key_size"))


_CSVQ = "coalesce('\"' || {0} || '\"', chr(92) || 'N')"
_CSVN = "coalesce(CAST({0} AS VARCHAR), chr(92) || 'N')"


def _csv(p: str, op: str) -> str:
    return f"""'"' || {op} || '","orders","shop",' || CAST(commit_ts AS VARCHAR) || ',' || {_CSVN.format(p + '_k')} || ',' || {_CSVN.format(p + '_p')} || ',' || {_CSVQ.format(p + '_s')}"""


@q(f"{_IMG} SELECT id, op, CASE WHEN op = 'D' THEN {_csv('pre', 'op')} ELSE {_csv('post', 'op')} END AS line FROM r")
def cd_csv(spark, d):
    return E.csv_lines(_rows(spark, d), T).select("id", "op", "line")


@q(f"{_IMG} SELECT id, op, commit_ts, coalesce(post_k, pre_k) AS k, CASE WHEN op = 'D' THEN pre_p ELSE post_p END AS p, CASE WHEN op = 'D' THEN pre_s ELSE post_s END AS s FROM r")
def cd_csv_decode(spark, d):
    return E.csv_decode(E.csv_lines(_rows(spark, d), T).select("id", "line"), T)


@q(f"{_IMG} SELECT id, op, 0 AS line_no, CASE WHEN op = 'I' THEN 'I' ELSE 'D' END AS kind FROM r UNION ALL SELECT id, op, 1, 'I' FROM r WHERE op = 'U'")
def cd_csv_old(spark, d):
    return E.csv_lines(_rows(spark, d), T, output_old=True).select("id", "op", F.col("line_no"), F.substring("line", 2, 1).alias("kind"))


_DBZ = f"""'{{"payload":{{"source":{{"version":"2.4.0.Final","connector":"changeloom","name":"default","ts_ms":' || CAST(commit_ts >> 18 AS VARCHAR) || ',"snapshot":"false","db":"shop","table":"orders","commit_ts":' || CAST(commit_ts AS VARCHAR) || '}},"ts_ms":' || CAST(commit_ts >> 18 AS VARCHAR) || ',"transaction":null,"op":"' || CASE op WHEN 'I' THEN 'c' WHEN 'U' THEN 'u' ELSE 'd' END || '","before":' || CASE WHEN op = 'I' THEN 'null' ELSE {_obj('pre', _n, _qs)} END || ',"after":' || CASE WHEN op = 'D' THEN 'null' ELSE {_obj('post', _n, _qs)} END || '}}}}'"""


@q(f"{_IMG} SELECT id, op, {_DBZ} AS body FROM r")
def cd_debezium(spark, d):
    return _rows(spark, d).select("id", "op", E.debezium(T).alias("body"))


@q(_BACK)
def cd_debezium_decode(spark, d):
    return E.debezium_decode(_rows(spark, d).select("id", E.debezium(T, with_schema=True).alias("body")), T, "body")


@q(f"""{_IMG} SELECT id, op, CASE WHEN op <> 'D' THEN '{{"k":' || post_k || ',"p":' || coalesce('{{"long":' || post_p || '}}', 'null') || ',"s":' || coalesce('{{"string":"' || post_s || '"}}', 'null') || ',"_op":"' || CASE op WHEN 'I' THEN 'c' ELSE 'u' END || '","_commit_ts":' || CAST(commit_ts AS VARCHAR) || ',"_commit_physical_time":' || CAST(commit_ts >> 18 AS VARCHAR) || '}}' END AS record FROM r""")
def cd_avro(spark, d):
    return _rows(spark, d).select("id", "op", E.avro_record(T, extension=True).alias("record"))


@q(f"""{_IMG} SELECT id, op, CASE WHEN op <> 'D' THEN 77 END AS schema_id, CASE WHEN op <> 'D' THEN '{{"k":' || post_k || ',"p":' || coalesce(CAST(post_p AS VARCHAR), 'null') || ',"s":' || coalesce('"' || post_s || '"', 'null') || ',"_op":"' || CASE op WHEN 'I' THEN 'c' ELSE 'u' END || '","_commit_ts":' || CAST(commit_ts AS VARCHAR) || ',"_commit_physical_time":' || CAST(commit_ts >> 18 AS VARCHAR) || '}}' END AS record FROM r""")
def cd_avro_binary(spark, d):
    """Binary records in their frames, and back."""
    framed = _rows(spark, d).select("id", "op", E.avro_frame(F.lit(77), E.avro_binary(T, extension=True)).alias("frame"))
    return framed.withColumn("x", E.avro_decode(E.avro_schema(T), extension=True)(F.col("frame"))).select("id", "op", "x.schema_id", "x.record")


_SIMPLE = f"""'{{"version":1,"database":"shop","table":"orders","tableID":7,"type":"' || {_KIND} || '","commitTs":' || CAST(commit_ts AS VARCHAR) || ',"buildTs":{NOW},"schemaVersion":3' || CASE WHEN op <> 'D' THEN ',"data":' || {_obj('post', _qs)} ELSE '' END || CASE WHEN op <> 'I' THEN ',"old":' || {_obj('pre', _qs)} ELSE '' END || '}}'"""


@q(f"{_IMG} SELECT id, op, {_SIMPLE} AS body FROM r")
def cd_simple(spark, d):
    return _rows(spark, d).select("id", "op", E.simple_json(T, NOW).alias("body"))


@q(_BACK)
def cd_simple_decode(spark, d):
    return E.simple_decode(_rows(spark, d).select("id", E.simple_json(T, NOW).alias("body")), T, "body")


@q(f"{_IMG} SELECT id, commit_ts, CASE WHEN pre_p IS DISTINCT FROM post_p THEN 'p' ELSE '' END || CASE WHEN pre_s IS DISTINCT FROM post_s THEN 's' ELSE '' END AS changed FROM r WHERE op = 'U'")
def cd_updatedonly(spark, d):
    m = E.changed_only(T, "pre", E.text)
    return _rows(spark, d).where("op = 'U'").select("id", "commit_ts", F.array_join(F.array_sort(F.map_keys(m)), "").alias("changed"))


@q(f"""{_IMG} SELECT id, '{{"d":{{"k":' || {_oc(8, '"h":true,', 10)(_n('pre_k'))} || '}}}}' AS value FROM r WHERE op = 'D'""")
def cd_handleonly(spark, d):
    return _rows(spark, d).where("op = 'D'").select("id", E.open_value(T, delete_keys_only=True).alias("value"))


@q(f"{_IMG} SELECT id, op, length({_SIMPLE}) > 240 AS aside, CASE WHEN length({_SIMPLE}) > 240 THEN 'file-' || CAST(id AS VARCHAR) || '-' || CAST(commit_ts AS VARCHAR) ELSE '' END AS location FROM r")
def cd_claim(spark, d):
    large = E.split_oversize(E.simple_json(T, NOW), 240)
    return _rows(spark, d).select("id", "op", large.alias("aside"), F.when(large, F.concat_ws("-", F.lit("file"), "id", "commit_ts")).otherwise("").alias("location"))


@q(f"""WITH RECURSIVE {ctes('lines')}, x AS (SELECT ok, ln, rf || CAST(supp % 50 AS VARCHAR) AS g, 60 + price % 90 AS size, row_number() OVER (PARTITION BY rf || CAST(supp % 50 AS VARCHAR) ORDER BY ok, ln, price) AS rn FROM lines),
p AS (SELECT g, rn, size, 0 AS batch, size AS used, 1 AS n FROM x WHERE rn = 1 UNION ALL SELECT x.g, x.rn, x.size, CASE WHEN used + x.size > 900 OR n = 10 THEN batch + 1 ELSE batch END,
CASE WHEN used + x.size > 900 OR n = 10 THEN x.size ELSE used + x.size END, CASE WHEN used + x.size > 900 OR n = 10 THEN 1 ELSE n + 1 END FROM p JOIN x ON x.g = p.g AND x.rn = p.rn + 1)
SELECT ok, ln, CAST(batch AS BIGINT) AS batch FROM p JOIN x USING (g, rn)""")
def cd_batchlen(spark, d):
    """Greedy packing of messages of 60 to 149 bytes into at most 900 bytes and ten rows."""
    rows = log(spark, d, "lines").select("ok", "ln", F.concat("rf", (F.col("supp") % 50).cast("string")).alias("g"), "price", (F.col("price") % 90 + 60).alias("size"))
    return E.batch_messages(rows, ["g"], [F.col("ok"), F.col("ln"), F.col("price")], F.col("size"), 900, 10).select("ok", "ln", "batch")


@q(f"WITH {ctes('history_log')} SELECT k, n, (row_number() OVER (PARTITION BY k ORDER BY commit_ts, n) - 1) % 20 = 0 AS bootstrap FROM history_log")
def cd_bootstrap(spark, d):
    return E.bootstrap_due(log(spark, d, "history_log"), ["k"], [F.col("commit_ts"), F.col("n")], 20).select("k", "n", "bootstrap")


@q(f"WITH {ctes('orders_log')} SELECT c % 4 AS part, k, op, row_number() OVER (PARTITION BY c % 4 ORDER BY commit_ts, start_ts, CASE op WHEN 'D' THEN 0 WHEN 'U' THEN 1 ELSE 2 END, k) AS pos FROM orders_log")
def cd_txnmsg(spark, d):
    """Order per partition: the position of each message in its partition."""
    rows = log(spark, d, "orders_log").withColumn("part", F.col("c") % 4)
    numbered = O.row_numbers(rows, [F.col("part"), *O.txn_order(["k"])], "all_pos")
    first = numbered.groupBy("part").agg(F.min("all_pos").alias("first"))
    return numbered.join(F.broadcast(first), "part").select("part", "k", "op", (F.col("all_pos") - F.col("first") + 1).alias("pos"))


_B = "SELECT o_orderkey AS id, o_orderdate AS moment, CAST(1 + o_orderkey % 3 AS INTEGER) AS e, CAST(o_orderkey % 8 AS INTEGER) AS st, o_orderpriority AS pr FROM orders"
_EN = "CASE e WHEN 1 THEN 'a' WHEN 2 THEN 'b' ELSE 'c' END"
_SN = "array_to_string(list_filter([CASE WHEN st & 1 > 0 THEN 'a' END, CASE WHEN st & 2 > 0 THEN 'b' END, CASE WHEN st & 4 > 0 THEN 'c' END], lambda x: x IS NOT NULL), ',')"


@q(f"""WITH x AS ({_B}) SELECT id, strftime(moment, '%Y-%m-%d') || '|' || strftime(moment, '%Y-%m-%d %H:%M:%S') || '|' || CAST(e AS VARCHAR) || '|' || CAST(st AS VARCHAR) || '|' || pr AS canal,
'"' || strftime(moment, '%Y-%m-%d') || '"|"' || strftime(moment, '%Y-%m-%d %H:%M:%S') || '"|"' || {_EN} || '"|"' || {_SN} || '"|"' || base64(encode(pr)) || '"' AS csv,
'{{"d":' || CAST(epoch_us(moment) // 86400000000 AS VARCHAR) || ',"dt":' || CAST(epoch_us(moment) // 1000 AS VARCHAR) || ',"e":"' || {_EN} || '","st":"' || {_SN} || '","b":"' || base64(encode(pr)) || '"}}' AS dbz FROM x""")
def cd_types(spark, d):
    """Dates, times, enums, sets and bytes as each format writes them."""
    o = spark.read.parquet(f"{d}/orders.parquet").select(
        F.col("o_orderkey").alias("id"), F.col("o_orderdate").cast("date").alias("d"), F.col("o_orderdate").cast("timestamp").alias("dt"),
        (1 + F.col("o_orderkey") % 3).cast("int").alias("e"), (F.col("o_orderkey") % 8).cast("int").alias("st"), F.encode("o_orderpriority", "UTF-8").alias("b"))
    cols = [Col("d", "date"), Col("dt", "datetime"), Col("e", "enum", elements=("a", "b", "c")), Col("st", "set", elements=("a", "b", "c")), Col("b", "blob")]
    return o.select(
        "id", F.concat_ws("|", *[E.text(c, F.col(c.name)) for c in cols]).alias("canal"), F.concat_ws("|", *[E.csv_cell(c, F.col(c.name)) for c in cols]).alias("csv"),
        F.to_json(F.struct(*[E.debezium_value(c, F.col(c.name)).alias(c.name) for c in cols])).alias("dbz"))


def _definition_sql(name: str, columns: list[tuple[str, str, bool]]) -> str:
    """The text that a schema file's checksum covers, with its CRC32."""
    pad = "\n" + " " * 12
    each = []
    for n, t, key in columns:
        lines = [f'"ColumnName": "{n}"', f'"ColumnType": "{t}"', *(['"ColumnNullable": "false"', '"ColumnIsPk": "true"'] if key else [])]
        each.append("\n        {" + pad + ("," + pad).join(lines) + "\n        }")
    text = f'{{\n    "Table": "{name}",\n    "Schema": "shop",\n    "Version": 0,\n    "TableColumns": [{",".join(each)}\n    ],\n    "TableColumnsTotal": {len(columns)}\n}}'
    literal = "'" + text + "'"
    return f"SELECT '{name}' AS \"table\", {len(columns)} AS columns, {crc32_sql(text_bytes_sql(literal))} AS checksum"


_KEY_COL = ("k", "BIGINT", True)


@q(" UNION ALL ".join([_definition_sql("orders", [_KEY_COL, ("p", "BIGINT", False), ("s", "VARCHAR", False)]), _definition_sql("keys", [_KEY_COL])]))
def cd_tabledef(spark, d):
    """Schema files of the tables with their checksums."""
    rows = []
    for name, cols in {"orders": T.columns, "keys": T.columns[:1]}.items():
        t = E.table_definition(Table("shop", name, tuple(cols)), f"CREATE TABLE {name}", 3, 100)
        rows.append((name, t["TableColumnsTotal"], E.definition_checksum(t)))
    return spark.createDataFrame(rows, "table string, columns int, checksum bigint")


QUERIES, SQL = R.queries, R.sql
