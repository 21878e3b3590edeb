"""Encoders and decoders.

Every encoder takes rows with ``op, commit_ts`` and the columns ``pre_<name>``
and ``post_<name>`` and returns the message as text; every decoder gives these
back. All are built-in expressions, so a codec is one projection.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import pandas_udf

from changeloom.functions import scalars as S
from changeloom.functions.codecs.model import TYPE_CODES, Col, Table, flags, image, json
from changeloom.operators.ordering import BLOCK_ROWS, place_in_key, same_keys, split_hot
from changeloom.session import materialize


def _is(op: str) -> Column:
    return F.col("op") == op


def _moment(c: Col, v: Column) -> Column:
    return F.date_format(v, "yyyy-MM-dd HH:mm:ss" + ("." + "S" * c.digits if c.digits else ""))


def text(c: Col, v: Column) -> Column:
    """Value text of the JSON formats with string values: enums and sets by
    number, bytes as Latin-1, floats without an exponent."""
    if c.type == "double":
        return S.value_string(v, "double")
    if c.type == "blob":
        return F.decode(v, "ISO-8859-1")
    if c.type in ("datetime", "timestamp"):
        return _moment(c, v)
    return v.cast("string")


def csv_cell(c: Col, v: Column, binary: str = "base64") -> Column:
    """Value text of a CSV cell: enums and sets by name, bytes in base64 or hex;
    texts are quoted."""
    null = F.lit(S.NULL_TEXT)
    if c.type in ("varchar", "char", "text", "json"):
        return S.csv_quote(v.cast("string"))
    if c.type == "enum":
        return S.csv_quote(F.when(v.isNotNull(), S.enum_name(v, list(c.elements))))
    if c.type == "set":
        return S.csv_quote(F.when(v.isNotNull(), S.set_names(v, list(c.elements))))
    if c.type == "blob":
        return S.csv_quote(F.base64(v) if binary == "base64" else F.hex(v))
    if c.type in ("date", "datetime", "timestamp", "time"):
        return S.csv_quote(_moment(c, v) if c.type in ("datetime", "timestamp") else v.cast("string"))
    return F.coalesce(text(c, v), null)


def debezium_value(c: Col, v: Column) -> Column:
    """Value of a Debezium image: days for dates, milliseconds (microseconds
    beyond three digits) for datetimes, ISO text in UTC for timestamps, names for
    enums and sets, bytes in base64 and decimals as doubles."""
    if c.type == "date":
        return F.unix_date(v.cast("date"))
    if c.type == "datetime":
        at = v.cast("timestamp")
        return F.unix_millis(at) if c.digits <= 3 else F.unix_micros(at)
    if c.type == "timestamp":
        return F.date_format(v.cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss" + ("." + "S" * c.digits if c.digits else "") + "'Z'")
    if c.type == "enum":
        return F.when(v.isNotNull(), S.enum_name(v, list(c.elements)))
    if c.type == "set":
        return F.when(v.isNotNull(), S.set_names(v, list(c.elements)))
    if c.type == "bit":
        return v == 1 if c.bits == 1 else F.base64(F.substring(S.little_endian(v.cast("bigint")), F.lit(1), F.lit((c.bits + 7) // 8)))
    if c.type == "blob":
        return F.base64(v)
    return v.cast("double") if c.type == "decimal" else v


def changed_only(t: Table, prefix: str, value) -> Column:
    """Columns whose old and new values differ, as a map."""
    pairs = [F.when(~F.col(f"pre_{c.name}").eqNullSafe(F.col(f"post_{c.name}")), F.struct(F.lit(c.name).alias("key"), value(c, F.col(f"{prefix}_{c.name}")).alias("value"))) for c in t.columns]
    return F.map_from_entries(F.array_compact(F.array(*pairs)))


# canal-json


def canal_json(t: Table, now_ms: int, only_changed: bool = False, delete_keys_only: bool = False, extension: str | None = None) -> Column:
    """All values are strings; ``old`` and ``data`` are lists of one object.
    ``extension`` names the object that carries commitTs, none without it."""
    cols = list(t.columns)
    cols_of_delete = t.handle if delete_keys_only else cols
    data = F.when(_is("D"), json(image("pre", cols_of_delete, text))).otherwise(json(image("post", cols, text)))
    old = json(changed_only(t, "pre", text)) if only_changed else json(image("pre", cols, text))
    one = lambda x: F.concat(F.lit("["), x, F.lit("]"))
    codes = lambda cs: json(F.struct(*[F.lit(S.JAVA_TYPES[c.type]).alias(c.name) for c in cs]))
    types = lambda cs: json(F.struct(*[F.lit(c.type).alias(c.name) for c in cs]))
    q = lambda s: F.lit('"' + s + '"')
    keys = F.lit("[" + ",".join(f'"{c.name}"' for c in t.handle) + "]")
    kind = F.when(_is("I"), "INSERT").when(_is("U"), "UPDATE").otherwise("DELETE")
    by_op = lambda f: F.when(_is("D"), f(cols_of_delete)).otherwise(f(cols))
    parts = [
        F.lit('{"id":0,"database":'), q(t.schema), F.lit(',"table":'), q(t.name), F.lit(',"pkNames":'), keys, F.lit(',"isDdl":false,"type":"'), kind,
        F.lit('","es":'), F.shiftright("commit_ts", 18).cast("string"), F.lit(f',"ts":{now_ms},"sql":"","sqlType":'), by_op(codes), F.lit(',"mysqlType":'), by_op(types),
        F.lit(',"old":'), F.when(_is("U"), one(old)).otherwise("null"), F.lit(',"data":'), one(data),
    ]
    if extension:
        parts += [F.lit(f',"{extension}":{{"commitTs":'), F.col("commit_ts").cast("string"), F.lit("}")]
    return F.concat(*parts, F.lit("}"))


def canal_decode(df: DataFrame, t: Table, body: str, extension: str = "_ext") -> DataFrame:
    """``op, commit_ts`` and images. Columns that ``old`` leaves out kept their
    value."""
    m = "array<map<string,string>>"
    schema = f"type string, es bigint, old {m}, data {m}, `{extension}` struct<commitTs: bigint>"
    p = df.select("*", F.from_json(body, schema).alias("m"))
    op = F.when(F.col("m.type") == "INSERT", "I").when(F.col("m.type") == "UPDATE", "U").otherwise("D")
    p = p.withColumn("op", op).withColumn("commit_ts", F.col(f"m.{extension}.commitTs"))
    data, old = F.col("m.data")[0], F.col("m.old")[0]
    out = []
    for c in t.columns:
        new = F.try_element_at(data, F.lit(c.name))
        before = F.when(F.map_contains_key(old, F.lit(c.name)), F.try_element_at(old, F.lit(c.name))).otherwise(new)
        out += [F.when(op == "D", new).when(op == "U", before).cast(c.type.replace("varchar", "string")).alias(f"pre_{c.name}"),
                F.when(op != "D", new).cast(c.type.replace("varchar", "string")).alias(f"post_{c.name}")]
    keep = [x for x in df.columns if x != body]
    return p.select(*keep, "op", "commit_ts", *out)


# open protocol


def open_key(t: Table) -> Column:
    return F.concat(F.lit('{"ts":'), F.col("commit_ts").cast("string"), F.lit(f',"scm":"{t.schema}","tbl":"{t.name}","t":1}}'))


def _open_column(c: Col, v: Column) -> Column:
    return F.struct(F.lit(TYPE_CODES[c.type]).alias("t"), *([F.lit(True).alias("h")] if c.key else []), F.lit(flags(c)).alias("f"), v.alias("v"))


def open_value(t: Table, delete_keys_only: bool = False) -> Column:
    """``u`` and ``p`` for inserts and updates, ``d`` for deletes."""
    img = lambda p, cols: json(image(p, cols, _open_column))
    gone = t.handle if delete_keys_only else t.columns
    return (
        F.when(_is("D"), F.concat(F.lit('{"d":'), img("pre", gone), F.lit("}")))
        .when(_is("U"), F.concat(F.lit('{"u":'), img("post", t.columns), F.lit(',"p":'), img("pre", t.columns), F.lit("}")))
        .otherwise(F.concat(F.lit('{"u":'), img("post", t.columns), F.lit("}")))
    )


def framed(key: Column, value: Column) -> Column:
    """Length framing: 8 bytes big-endian before each of key and value."""
    size = lambda x: F.unhex(F.lpad(F.hex(F.octet_length(x)), 16, "0"))
    k, v = F.encode(key, "UTF-8"), F.encode(value, "UTF-8")
    return F.concat(size(key), k, size(value), v)


def open_decode(df: DataFrame, t: Table, key: str, value: str) -> DataFrame:
    spark_type = lambda c: c.type.replace("varchar", "string")
    img = "struct<" + ",".join(f"`{c.name}`: struct<v: {spark_type(c)}>" for c in t.columns) + ">"
    p = df.select("*", F.from_json(value, f"u {img}, p {img}, d {img}").alias("m"), F.from_json(key, "ts bigint").alias("kk"))
    op = F.when(F.col("m.d").isNotNull(), "D").when(F.col("m.p").isNotNull(), "U").otherwise("I")
    before = F.coalesce(F.col("m.p"), F.col("m.d"))
    cols = [x for c in t.columns for x in (before[c.name]["v"].alias(f"pre_{c.name}"), F.col("m.u")[c.name]["v"].alias(f"post_{c.name}"))]
    return p.select(*[x for x in df.columns if x not in (key, value)], op.alias("op"), F.col("kk.ts").alias("commit_ts"), *cols)


# CSV


def csv_row(t: Table, prefix: str, op: Column, with_commit_ts: bool = True, is_update: bool | None = None) -> Column:
    cell = lambda c: csv_cell(c, F.col(f"{prefix}_{c.name}"))
    quoted = lambda s: F.lit('"' + s.replace('"', '""') + '"')
    head = [F.concat(F.lit('"'), op, F.lit('"')), quoted(t.name), quoted(t.schema)]
    if with_commit_ts:
        head.append(F.col("commit_ts").cast("string"))
    if is_update is not None:
        head.append((_is("U") if is_update else F.lit(False)).cast("string"))
    return F.concat_ws(",", *head, *[cell(c) for c in t.columns])


def csv_lines(df: DataFrame, t: Table, output_old: bool = False) -> DataFrame:
    """``commit_ts, line_no, line``; with old values an update is a D line and an
    I line."""
    new, old = csv_row(t, "post", F.lit("I") if output_old else F.col("op"), is_update=True if output_old else None), csv_row(t, "pre", F.lit("D"), is_update=True if output_old else None)
    lines = F.when(_is("D"), F.array(old))
    lines = lines.when(_is("U"), F.array(old, new)) if output_old else lines
    return df.select("*", F.posexplode(lines.otherwise(F.array(new))).alias("line_no", "line"))


def csv_decode(df: DataFrame, t: Table, line: str = "line") -> DataFrame:
    types = {"bigint": "bigint", "int": "int", "varchar": "string", "double": "double"}
    schema = "op string, tbl string, sch string, commit_ts bigint, " + ", ".join(f"`{c.name}` {types[c.type]}" for c in t.columns)
    p = df.select("*", F.from_csv(F.col(line), schema, {"nullValue": S.NULL_TEXT, "escape": '"'}).alias("m"))
    return p.select(*[x for x in df.columns if x not in (line, "op", "commit_ts", *[c.name for c in t.columns])], "m.op", "m.commit_ts", *[F.col(f"m.{c.name}").alias(c.name) for c in t.columns])


# Debezium


#: Connect types of source types, fixed values: (type, semantic name).
CONNECT = {"bigint": ("int64", None), "int": ("int32", None), "smallint": ("int16", None), "varchar": ("string", None), "double": ("double", None),
           "date": ("int32", "io.debezium.time.Date"), "datetime": ("int64", "io.debezium.time.Timestamp"), "timestamp": ("string", "io.debezium.time.ZonedTimestamp"), "json": ("string", "io.debezium.data.Json"),
           "enum": ("string", "io.debezium.data.Enum"), "set": ("string", "io.debezium.data.EnumSet"), "bit": ("bytes", "io.debezium.data.Bits"), "blob": ("bytes", None), "decimal": ("double", None)}


def debezium(t: Table, cluster: str = "default", connector: str = "changeloom", with_schema: bool = False) -> Column:
    img = lambda p: json(image(p, t.columns, debezium_value))
    op = F.when(_is("I"), "c").when(_is("U"), "u").otherwise("d")
    ms = F.shiftright("commit_ts", 18).cast("string")
    source = f'"source":{{"version":"2.4.0.Final","connector":"{connector}","name":"{cluster}","ts_ms":'
    payload = F.concat(
        F.lit("{" + source), ms, F.lit(f',"snapshot":"false","db":"{t.schema}","table":"{t.name}","commit_ts":'), F.col("commit_ts").cast("string"), F.lit('},"ts_ms":'), ms,
        F.lit(',"transaction":null,"op":"'), op, F.lit('","before":'), F.when(_is("I"), "null").otherwise(img("pre")), F.lit(',"after":'), F.when(_is("D"), "null").otherwise(img("post")), F.lit("}"))
    tail = F.lit(',"schema":' + debezium_schema(t, cluster) + "}") if with_schema else F.lit("}")
    return F.concat(F.lit('{"payload":'), payload, tail)


def debezium_schema(t: Table, cluster: str) -> str:
    """The static part of a table's messages."""
    import json as j

    def one(c: Col) -> dict:
        kind, name = CONNECT[c.type]
        return {"type": kind, "optional": c.nullable and not c.key, **({"name": name, "version": 1} if name else {}), "field": c.name}

    base = f"{cluster}.{t.schema}.{t.name}"
    rows = [{"type": "struct", "optional": True, "name": f"{base}.Value", "field": f, "fields": [one(c) for c in t.columns]} for f in ("before", "after")]
    rest = [{"type": "string", "optional": False, "field": "op"}, {"type": "int64", "optional": True, "field": "ts_ms"}]
    return j.dumps({"type": "struct", "optional": False, "name": f"{base}.Envelope", "version": 1, "fields": rows + rest}, separators=(",", ":"))


def debezium_decode(df: DataFrame, t: Table, body: str) -> DataFrame:
    img = "struct<" + ",".join(f"`{c.name}`: {c.type.replace('varchar', 'string')}" for c in t.columns) + ">"
    p = df.select("*", F.from_json(body, f"payload struct<op: string, source: struct<commit_ts: bigint>, before: {img}, after: {img}>").alias("m"))
    op = F.when(F.col("m.payload.op") == "c", "I").when(F.col("m.payload.op") == "u", "U").otherwise("D")
    cols = [x for c in t.columns for x in (F.col("m.payload.before")[c.name].alias(f"pre_{c.name}"), F.col("m.payload.after")[c.name].alias(f"post_{c.name}"))]
    return p.select(*[x for x in df.columns if x != body], op.alias("op"), F.col("m.payload.source.commit_ts").alias("commit_ts"), *cols)


# Avro-shaped records


#: Avro types of source types, fixed values.
AVRO = {"int": "int", "smallint": "int", "bigint": "long", "double": "double", "varchar": "string", "date": "string", "datetime": "string", "timestamp": "string", "decimal": "string", "enum": "string", "set": "string", "json": "string", "blob": "bytes", "bit": "bytes"}


def avro_schema(t: Table, namespace: str = "default", key: bool = False) -> str:
    import json as j

    cols = t.handle if key else list(t.columns)
    fields = [{"name": c.name, "type": AVRO[c.type] if c.key or not c.nullable else ["null", AVRO[c.type]], **({} if c.key or not c.nullable else {"default": None})} for c in cols]
    return j.dumps({"type": "record", "name": t.name, "namespace": f"{namespace}.{t.schema}", "fields": fields}, separators=(",", ":"))


def avro_record(t: Table, extension: bool = False) -> Column:
    """JSON encoding of the value record: unions of null carry their type."""

    def value(c: Col, v: Column) -> Column:
        return v if c.key or not c.nullable else F.when(v.isNotNull(), F.struct(v.alias(AVRO[c.type])))

    extra = [F.when(_is("I"), "c").when(_is("U"), "u").otherwise("d").alias("_op"), F.col("commit_ts").alias("_commit_ts"), F.shiftright("commit_ts", 18).alias("_commit_physical_time")] if extension else []
    build = lambda p: json(F.struct(*[value(c, F.col(f"{p}_{c.name}")).alias(c.name) for c in t.columns], *extra))
    return F.when(_is("D"), F.lit(None).cast("string")).otherwise(build("post"))


def _varint(v: Column) -> Column:
    """Hexadecimal text of a zigzag number in groups of seven bits."""
    zigzag = F.shiftleft(v, 1).bitwiseXOR(F.shiftright(v, 63))
    rest = lambda i: F.call_function("shiftrightunsigned", zigzag, (i * 7).cast("int"))
    used = F.filter(F.sequence(F.lit(0), F.lit(9)), lambda i: (i == 0) | (rest(i) != 0))
    more = lambda i: F.when((i < 9) & (rest(i + 1) != 0), 128).otherwise(0)
    return F.array_join(F.transform(used, lambda i: F.lpad(F.hex(rest(i).bitwiseAND(127) + more(i)), 2, "0")), "")


def _avro_bytes(kind: str, v: Column) -> Column:
    if kind in ("int", "long"):
        return _varint(v.cast("bigint"))
    if kind == "boolean":
        return F.when(v, "01").otherwise("00")
    if kind in ("string", "bytes"):
        raw = F.encode(v, "UTF-8") if kind == "string" else v
        return F.concat(_varint(F.length(raw).cast("bigint")), F.hex(raw))
    raise ValueError(f"no binary form of {kind}")


def avro_binary(t: Table, extension: bool = False) -> Column:
    """Binary encoding of the value record; null for a delete."""
    parts = []
    for c in t.columns:
        v, kind = F.col(f"post_{c.name}"), AVRO[c.type]
        parts.append(_avro_bytes(kind, v) if c.key or not c.nullable else F.when(v.isNull(), "00").otherwise(F.concat(F.lit("02"), _avro_bytes(kind, v))))
    if extension:
        op = F.when(_is("I"), "c").otherwise("u")
        parts += [_avro_bytes("string", op), _varint(F.col("commit_ts")), _varint(F.shiftright("commit_ts", 18))]
    return F.when(~_is("D"), F.unhex(F.concat(*parts)))


def avro_frame(schema_id: Column, record: Column) -> Column:
    """Magic byte 0 and the 4-byte schema id before the binary record."""
    return F.concat(F.unhex(F.lit("00")), F.unhex(F.lpad(F.hex(schema_id), 8, "0")), record)


def avro_decode(schema: str, extension: bool = False):
    """``(schema id, JSON of the record)`` of frames, in Arrow batches; null for
    null and for frames that are cut off or of another magic."""
    import json as j

    fields = [(f["name"], f["type"]) for f in j.loads(schema)["fields"]]
    fields += [("_op", "string"), ("_commit_ts", "long"), ("_commit_physical_time", "long")] if extension else []

    def number(b: bytes, at: int) -> tuple[int, int]:
        shift = value = 0
        while True:
            value |= (b[at] & 127) << shift
            at, shift = at + 1, shift + 7
            if b[at - 1] < 128:
                return (value >> 1) ^ -(value & 1), at

    def read(kind, b: bytes, at: int):
        if isinstance(kind, list):
            n, at = number(b, at)
            return read(kind[n], b, at)
        if kind == "null":
            return None, at
        if kind in ("int", "long"):
            return number(b, at)
        if kind == "boolean":
            return b[at] == 1, at + 1
        n, at = number(b, at)
        if at + n > len(b):
            raise IndexError
        return b[at : at + n].decode("utf-8" if kind == "string" else "latin-1"), at + n

    def one(b) -> tuple[int | None, str | None]:
        if b is None or len(b) < 5 or b[0]:
            return None, None
        at, row = 5, {}
        try:
            for name, kind in fields:
                row[name], at = read(kind, b, at)
        except IndexError:
            return None, None
        return int.from_bytes(b[1:5], "big"), j.dumps(row, separators=(",", ":"), ensure_ascii=False)

    @pandas_udf("schema_id int, record string")
    def run(v: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([one(b) for b in v], columns=["schema_id", "record"]).astype({"schema_id": "Int32"})

    return run


# simple JSON


def simple_json(t: Table, build_ts: int) -> Column:
    img = lambda p: json(image(p, t.columns, text))
    kind = F.when(_is("I"), "INSERT").when(_is("U"), "UPDATE").otherwise("DELETE")
    head = F.concat(F.lit(f'{{"version":1,"database":"{t.schema}","table":"{t.name}","tableID":{t.table_id},"type":"'), kind, F.lit('","commitTs":'), F.col("commit_ts").cast("string"), F.lit(f',"buildTs":{build_ts},"schemaVersion":{t.version}'))
    new, old = F.concat(F.lit(',"data":'), img("post")), F.concat(F.lit(',"old":'), img("pre"))
    return F.concat(head, F.when(_is("I"), new).when(_is("U"), F.concat(new, old)).otherwise(old), F.lit("}"))


def simple_decode(df: DataFrame, t: Table, body: str) -> DataFrame:
    p = df.select("*", F.from_json(body, "type string, commitTs bigint, data map<string,string>, old map<string,string>, schemaVersion bigint").alias("m"))
    op = F.when(F.col("m.type") == "INSERT", "I").when(F.col("m.type") == "UPDATE", "U").otherwise("D")
    get = lambda part, c: F.try_element_at(F.col(f"m.{part}"), F.lit(c.name)).cast(c.type.replace("varchar", "string"))
    cols = [x for c in t.columns for x in (get("old", c).alias(f"pre_{c.name}"), get("data", c).alias(f"post_{c.name}"))]
    return p.select(*[x for x in df.columns if x != body], op.alias("op"), F.col("m.commitTs").alias("commit_ts"), *cols)


# schema files


def table_definition(t: Table, query: str, kind: int, table_version: int) -> dict:
    """The schema file of a table as a dictionary in its order of fields."""
    cols = [{"ColumnName": c.name, "ColumnType": c.type.upper(), **({"ColumnNullable": "false"} if not c.nullable or c.key else {}), **({"ColumnIsPk": "true"} if c.key else {})} for c in t.columns]
    return {"Table": t.name, "Schema": t.schema, "Version": 1, "TableVersion": table_version, "Query": query, "Type": kind, "TableColumns": cols, "TableColumnsTotal": len(cols)}


def definition_checksum(d: dict) -> int:
    """CRC32 of table, schema, version 0, the columns by name and their number, as
    JSON with an indent of four; query, type and table version do not count."""
    import json as j
    import zlib

    same = {"Table": d["Table"], "Schema": d["Schema"], "Version": 0, "TableColumns": sorted(d["TableColumns"], key=lambda c: c["ColumnName"]), "TableColumnsTotal": d["TableColumnsTotal"]}
    text = j.dumps(same, indent=4, ensure_ascii=False)
    for plain, code in (("&", "\\u0026"), ("<", "\\u003c"), (">", "\\u003e")):
        text = text.replace(plain, code)
    return zlib.crc32(text.encode())


# frames between processes

#: Magic of a frame, a fixed value.
WIRE_MAGIC = "DA7A6A6A"


def wire_frame(kind: Column, version: Column, payload: Column) -> Column:
    """Magic (4 bytes), kind (2), version (2), length (8) and the payload; numbers
    are big-endian."""
    number = lambda v, size: F.lpad(F.hex(v.cast("bigint")), size * 2, "0")
    return F.concat(F.unhex(F.concat(F.lit(WIRE_MAGIC), number(kind, 2), number(version, 2), number(F.length(payload), 8))), payload)


def wire_parts(frame: Column) -> Column:
    """``kind, version, payload`` of a frame; null for a frame of another magic or
    whose payload is not as long as it says."""
    number = lambda at, size: F.conv(F.hex(F.substring(frame, at, size)), 16, 10).cast("bigint")
    good = (F.length(frame) >= 16) & (F.hex(F.substring(frame, 1, 4)) == WIRE_MAGIC) & (number(9, 8) == F.length(frame) - 16)
    return F.when(good, F.struct(number(5, 2).cast("int").alias("kind"), number(7, 2).cast("int").alias("version"), F.substring(frame, F.lit(17), F.length(frame)).alias("payload")))


def transaction_messages(df: DataFrame, txn: list[str], order: list[Column], line: Column, max_bytes: int) -> DataFrame:
    """One message per transaction, its lines in order and each ended by a
    newline; a transaction above ``max_bytes`` becomes several, numbered ``part``."""
    rows = df.withColumn("__line", F.concat(line, F.lit("\n")))
    names = [f"__t{i}" for i in range(len(order))]
    rows = rows.withColumns(dict(zip(names, order)))
    cut = batch_messages(rows, txn, [F.col(n) for n in names], F.octet_length("__line"), max_bytes, 100_000)
    lines = F.array_sort(F.collect_list(F.struct(*names, "__line")))
    return cut.groupBy(*txn, F.col("batch").alias("part")).agg(F.array_join(F.transform(lines, lambda x: x["__line"]), "").alias("message"), F.count("*").alias("n_lines"))


# message shapes


def batch_messages(df: DataFrame, keys: list[str], order: list[Column], size: Column, max_bytes: int, max_rows: int) -> DataFrame:
    """Adds ``batch``, from 0 per key: greedy packing in order; a batch ends before
    it would exceed the limits. The order decides each batch, so the rows of a key
    stream through one task in Arrow batches; hot keys are cut in blocks."""
    rows, hot = split_hot(df.withColumn("__size", F.coalesce(size, F.lit(0)).cast("bigint")), keys)
    names = [f"__b{i}" for i in range(len(order))]
    placed = rows.withColumns(dict(zip(names, order))).repartition(*keys).sortWithinPartitions(*keys, *names).drop(*names)
    at = [df.columns.index(k) for k in keys]

    def fold(batches):
        key, batch, used, n = None, 0, 0, 0
        for b in batches:
            out = []
            for *now, s in zip(*(b.column(i).to_pylist() for i in at), b.column("__size").to_pylist()):
                if now != key:
                    key, batch, used, n = now, 0, 0, 0
                elif n and (used + s > max_bytes or n == max_rows):
                    batch, used, n = batch + 1, 0, 0
                used, n = used + s, n + 1
                out.append(batch)
            yield b.drop_columns(["__size"]).append_column("batch", pa.array(out, pa.int64()))

    out = placed.mapInArrow(fold, T.StructType([*df.schema.fields, T.StructField("batch", T.LongType())]))
    return out if hot is None else out.unionByName(_batches_in_blocks(hot, keys, order, max_bytes, max_rows))


def _batches_in_blocks(df: DataFrame, keys: list[str], order: list[Column], max_bytes: int, max_rows: int) -> DataFrame:
    """:func:`batch_messages` of hot keys.

    Where a batch ends depends only on where it started, so every row points to
    the first row of the batch after one that starts there. Rows are numbered by a
    range sort and cut into blocks, each with the next ``max_rows`` rows as a halo,
    in which the pointers are found by binary search over running sizes. From them
    each block tells, for any start in its first ``max_rows`` rows, at which row
    the block after it is entered and how many batches that takes: a table of
    ``max_rows`` rows a block. The tables are followed in order per key (one short
    step a block), then every block is cut by itself."""
    block = max(BLOCK_ROWS, 4 * max_rows)
    rows = place_in_key(df, keys, order, "__rn")
    rows = materialize(rows.withColumn("__own", F.floor(F.col("__rn") / F.lit(block))), "sized")
    halo = F.when((F.col("__rn") % block < max_rows) & (F.col("__own") > 0), F.array(F.col("__own"), F.col("__own") - 1)).otherwise(F.array(F.col("__own")))
    spread = rows.select(*keys, "__rn", "__size", F.explode(halo).alias("__blk"))

    def following(pdf):
        """Row numbers, sizes and, for each row, the place of the next batch's start."""
        pdf = pdf.sort_values("__rn")
        at, sizes = pdf["__rn"].to_numpy(), pdf["__size"].fillna(0).to_numpy(np.int64)
        total = np.concatenate([[0], np.cumsum(sizes)])
        full = np.searchsorted(total, total[:-1] + max_bytes, "right") - 1
        start = np.arange(len(at))
        return pdf, at, np.maximum(start + 1, np.minimum(full, start + max_rows))

    def jumps(pdf):
        pdf, at, nxt = following(pdf)
        end = (pdf["__blk"].iloc[0] + 1) * block
        inside = int((at < end).sum())
        own = min(max_rows, inside)
        leave, count = np.arange(len(at)), np.zeros(len(at), np.int64)
        for i in range(inside - 1, -1, -1):  # from the end: where a start leaves the block
            j = nxt[i]
            leave[i], count[i] = (leave[j], count[j] + 1) if j < inside else (j, 1)
        out = pdf.iloc[:own][[*keys, "__blk"]].copy()
        out["enter"], out["leave"], out["batches"] = at[:own], at[0] + leave[:own], count[:own]
        return out

    key_fields = [rows.schema[k] for k in keys]
    table = T.StructType([*key_fields, *[T.StructField(n, T.LongType()) for n in ("__blk", "enter", "leave", "batches")]])
    steps = materialize(spread.groupBy(*keys, "__blk").applyInPandas(jumps, table), "jumps")

    def follow(pdf):
        """The entry row and first batch number of each block of a key."""
        nxt = {(e, b): (x, n) for e, b, x, n in pdf[["enter", "__blk", "leave", "batches"]].itertuples(index=False)}
        at, batch, found = 0, 0, []
        for b in range(int(pdf["__blk"].max()) + 1):
            found.append((b, at, batch))
            at, n = nxt.get((at, b), (at, 0))
            batch += n
        out = pdf.iloc[[0] * len(found)][keys].reset_index(drop=True)
        out["__blk"], out["__enter"], out["__first"] = zip(*found)
        return out

    many = steps.where("__blk > 0").select(*keys).distinct()
    entry = T.StructType([*key_fields, *[T.StructField(n, T.LongType()) for n in ("__blk", "__enter", "__first")]])
    same = lambda d: _renamed_keys(d, keys)
    long_keys = steps.join(same(many), same_keys(keys, "__k_"), "left_semi")
    entries = long_keys.groupBy(*keys).applyInPandas(follow, entry)

    def cut(pdf):
        pdf, at, nxt = following(pdf)
        enter, first = pdf["__enter"].iloc[0], pdf["__first"].iloc[0]
        batch, i, b = np.full(len(at), first - 1), int(enter - at[0]), int(first)
        while i < len(at):
            batch[i : nxt[i]] = b
            i, b = int(nxt[i]), b + 1
        pdf["batch"] = batch
        return pdf.drop(columns=["__size", "__enter", "__first"])

    numbered = rows.withColumnRenamed("__own", "__blk")
    placed = numbered.join(_renamed_keys(entries.withColumnRenamed("__blk", "__b"), keys), same_keys(keys, "__k_") & (F.col("__blk") == F.col("__b")), "left")
    placed = placed.withColumn("__enter", F.coalesce("__enter", F.lit(0))).withColumn("__first", F.coalesce("__first", F.lit(0))).drop("__b", *[f"__k_{k}" for k in keys])
    kept = [f for f in placed.schema.fields if f.name not in ("__size", "__enter", "__first")]
    out = placed.groupBy(*keys, "__blk").applyInPandas(cut, T.StructType([*kept, T.StructField("batch", T.LongType())]))
    return out.drop("__rn", "__blk")


def _renamed_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.withColumnsRenamed({k: f"__k_{k}" for k in keys})


def split_oversize(body: Column, limit: int) -> Column:
    """True where a message is stored aside and only its location is sent."""
    return F.octet_length(body) > limit


def bootstrap_due(df: DataFrame, keys: list[str], order: list[Column], every: int) -> DataFrame:
    """Adds ``bootstrap``: before the first row of a table and then every
    ``every`` rows its schema is sent."""
    return place_in_key(df, keys, order, "__rn").withColumn("bootstrap", F.col("__rn") % every == 0).drop("__rn")
