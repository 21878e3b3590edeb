"""Schemas that drift between the files of a topic.

Method: a column lifespan catalogue. The field list of each file is exploded to
(topic, file ordinal, field, type, position); per topic, field and type, ``lag``
and ``lead`` over the ordinals find where an unbroken run (an island) starts and
ends. Starts and ends are the log of changes: an end and a start of one name at
one file is a retyping, an end and a start at one position with one type a
renaming, the others are additions and removals. Renamings form the alias table
that leads every older name to the column's newest name, and the types that a
column had decide the cast of the one consistent table.

Scale: messages are reduced to distinct field lists per file before anything is
sorted. Windows hold at most ``block`` files of one topic: ordinals are counted
within blocks of file numbers and offset by the blocks' sizes, and islands get
the last file of the block before as a halo.

Defined results: a body that is null or no JSON of its codec gives no fields and
no file; a field whose values are all null in a file keeps its last known type;
if messages of one file disagree, a field has its first position and its
greatest type name and is listed by :func:`conflicts`; messages without fields
are listed by :func:`unread`; one file per topic gives no changes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from changeloom.operators.ordering import last_known
from changeloom.session import materialize

_FIELD = "array<struct<name: string, type: string>>"


def _connect_fields(body: Column) -> Column:
    """Row fields of the schema part: type is ``type`` with ``name``."""
    schema = "struct<schema: struct<fields: array<struct<field: string, fields: array<struct<field: string, type: string, name: string>>>>>>"
    envelope = F.from_json(body, schema)["schema"]["fields"]

    def part(which: str) -> Column:
        return F.element_at(F.filter(envelope, lambda f: (f["field"] == which) & f["fields"].isNotNull()), 1)["fields"]

    fields = F.coalesce(F.when(F.size(F.filter(envelope, lambda f: (f["field"] == "after") & f["fields"].isNotNull())) > 0, part("after")),
                        F.when(F.size(F.filter(envelope, lambda f: (f["field"] == "before") & f["fields"].isNotNull())) > 0, part("before")))
    return F.transform(fields, lambda f: F.struct(f["field"].alias("name"), F.concat_ws(":", f["type"], f["name"]).alias("type")))


def _plain_type(t: Column) -> Column:
    """A record type without null and parameters."""
    bare = lambda x: F.when(x.startswith("{"), F.get_json_object(x, "$.type")).otherwise(x)
    union = F.array_join(F.transform(F.filter(F.from_json(t, "array<string>"), lambda x: x != "null"), bare), ",")
    return F.when(t.startswith("["), union).otherwise(bare(t))


def _record_fields(body: Column) -> Column:
    fields = F.from_json(body, "struct<schema: struct<fields: array<struct<name: string, type: string>>>>")["schema"]["fields"]
    return F.transform(fields, lambda f: F.struct(f["name"].alias("name"), _plain_type(f["type"]).alias("type")))


def _json_kind(v: Column) -> Column:
    t = F.schema_of_variant(v)
    return (
        F.when(t.isin("BIGINT", "INT", "SMALLINT", "TINYINT") | t.rlike(r"^DECIMAL\(\d+,0\)$"), "integer")
        .when(t.isin("DOUBLE", "FLOAT") | t.startswith("DECIMAL"), "double")
        .when(t == "VOID", F.lit(None).cast("string"))
        .otherwise(F.lower(t))
    )


def _payload_image(body: Column) -> Column:
    parsed = F.from_json(body, "struct<payload: struct<before: map<string, variant>, after: map<string, variant>>>")["payload"]
    return F.coalesce(parsed["after"], parsed["before"])


def _bare_fields(body: Column) -> Column:
    return F.transform(F.map_entries(_payload_image(body)), lambda e: F.struct(e["key"].alias("name"), _json_kind(e["value"]).alias("type")))


def _declared() -> Column:
    """The row fields that a message declares."""
    body = F.col("body")
    return (
        F.when(F.col("codec") == "debezium", _connect_fields(body).cast(_FIELD))
        .when(F.col("codec") == "avro", _record_fields(body).cast(_FIELD))
        .when(F.col("codec") == "bare", _bare_fields(body).cast(_FIELD))
    )


def message_fields(messages: DataFrame) -> DataFrame:
    """``topic, file_seq, pos, field, type`` of every message."""
    return (
        messages.where("topic is not null and file_seq is not null")
        .select("topic", "file_seq", F.posexplode(_declared()).alias("pos", "f"))
        .select("topic", "file_seq", "pos", F.col("f.name").alias("field"), F.col("f.type").alias("type"))
    )


def conflicts(messages: DataFrame) -> DataFrame:
    """``topic, file_seq, field, types``: fields that have several types within
    one file, as :func:`changes` compares files by one type each."""
    kinds = message_fields(messages).where("type is not null").groupBy("topic", "file_seq", "field").agg(F.array_sort(F.collect_set("type")).alias("types"))
    return kinds.where(F.size("types") > 1)


def unread(messages: DataFrame) -> DataFrame:
    """``msg_id, topic, file_seq, reason``: messages that give no fields."""
    json = F.try_parse_json("body")
    reason = (
        F.when(F.col("topic").isNull() | F.col("file_seq").isNull(), "no file").when(F.col("body").isNull(), "no body").when(json.isNull(), "no json")
        .when(~F.coalesce(F.col("codec").isin("debezium", "avro", "bare"), F.lit(False)), "unknown codec")
        .when(F.coalesce(F.size(_declared()), F.lit(-1)) < 1, "no fields")
    )
    return messages.select("msg_id", "topic", "file_seq", reason.alias("reason")).where("reason is not null")


def version_mismatches(messages: DataFrame) -> DataFrame:
    """``topic, version, n_schemas, n_versions``: version numbers of messages that
    stand for several field lists, or whose field lists stand under several
    numbers. Field lists are compared by their hash."""
    number = F.coalesce(F.get_json_object("body", "$.schema.version"), F.get_json_object("body", "$.version")).try_cast("bigint")
    rows = messages.where("topic is not null").select("topic", number.alias("version"), F.xxhash64(_declared()).alias("fields"), (F.size(_declared()) > 0).alias("any")).where("any and version is not null")
    pairs = rows.groupBy("topic", "version", "fields").agg(F.count("*").alias("n"))
    lists = pairs.groupBy("topic", "fields").agg(F.count("*").alias("n_versions"))
    seen = pairs.join(lists, ["topic", "fields"]).groupBy("topic", "version").agg(F.count("*").alias("n_schemas"), F.max("n_versions").alias("n_versions"))
    return seen.where("n_schemas > 1 or n_versions > 1")


def read_footers(files: DataFrame) -> DataFrame:
    """:func:`message_fields` of Parquet files with ``path`` and ``reason``:
    ``files`` has ``topic, file_seq, path``. Only footers are read, each by the
    task that holds its path. A file without path, that is not there or is no
    Parquet file gives one row with a reason and no field; any other error (no
    right to read, no connection) fails the task. Nested fields count as one, with
    their full type."""
    import pandas as pd

    def run(batches):
        import pyarrow as pa
        import pyarrow.fs as fs
        import pyarrow.parquet as pq

        for pdf in batches:
            out = []
            for topic, seq, path in pdf.itertuples(index=False):
                reason = None
                if pd.isna(path):
                    out.append((topic, seq, None, None, None, None, "no path"))
                    continue
                system, at = fs.FileSystem.from_uri(path if "://" in path else "file://" + path)
                try:
                    schema = pq.read_schema(at, filesystem=system)
                except FileNotFoundError:
                    reason = "no file"
                except pa.ArrowInvalid:
                    reason = "no parquet"
                if reason:
                    out.append((topic, seq, None, None, None, path, reason))
                else:
                    out += [(topic, seq, k, f.name, str(f.type), path, None) for k, f in enumerate(schema)]
            yield pd.DataFrame(out, columns=["topic", "file_seq", "pos", "field", "type", "path", "reason"]).astype({"pos": "Int32"})

    slim = files.select("topic", F.col("file_seq").cast("int").alias("file_seq"), "path")
    return slim.mapInPandas(run, "topic string, file_seq int, pos int, field string, type string, path string, reason string")


def footer_fields(files: DataFrame) -> DataFrame:
    """:func:`message_fields` of the Parquet files that can be read; the others
    are listed by :func:`unread_footers`."""
    return read_footers(files).where("reason is null").select("topic", "file_seq", "pos", "field", "type")


def unread_footers(files: DataFrame) -> DataFrame:
    """``topic, file_seq, path, reason``: files that :func:`footer_fields` leaves out."""
    return read_footers(files).where("reason is not null").select("topic", "file_seq", "path", "reason")


def file_fields(fields: DataFrame) -> DataFrame:
    """One row per file and field."""
    return fields.groupBy("topic", "file_seq", "field").agg(F.min("pos").alias("pos"), F.max("type").alias("type"))


def with_ordinals(files: DataFrame, block: int = 1024) -> DataFrame:
    """Adds ``ord``: the number of the file within its topic, from 1."""
    each = files.select("topic", "file_seq").distinct().withColumn("blk", F.floor(F.col("file_seq") / F.lit(block)))
    sizes = each.groupBy("topic", "blk").agg(F.count("*").alias("n"))
    before = Window.partitionBy("topic").orderBy("blk").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.withColumn("offset", F.coalesce(F.sum("n").over(before), F.lit(0)))
    inside = F.row_number().over(Window.partitionBy("topic", "blk").orderBy("file_seq"))
    numbered = each.withColumn("r", inside).join(sizes, ["topic", "blk"])
    return files.join(numbered.select("topic", "file_seq", (F.col("r") + F.col("offset")).alias("ord")), ["topic", "file_seq"])


def fill_types(rows: DataFrame) -> DataFrame:
    """Gives fields of unknown type their last known (else next known) one. Only
    fields that are of unknown type in some file are sorted; one with very many
    files is ordered in blocks."""
    keys = ["topic", "field"]
    open_ = rows.where("type is null").select(*keys).distinct()
    rest = rows.join(open_, keys, "left_anti")
    part = last_known(rows.join(open_, keys, "left_semi"), keys, [F.col("ord")], F.col("type"), "__last")
    part = last_known(part, keys, [-F.col("ord")], F.col("type"), "__next")
    known = F.coalesce("type", "__last", "__next", F.lit("null"))
    return rest.unionByName(part.withColumn("type", known).select(*rest.columns))


def lifespan_edges(rows: DataFrame, keys: list[str], block: int = 1024) -> DataFrame:
    """Rows at which an island of consecutive ordinals starts or ends."""
    own = F.floor(F.col("ord") / F.lit(block))
    halo = (F.when(F.pmod("ord", F.lit(block)) == block - 1, F.array(own, own + 1))
            .when(F.pmod("ord", F.lit(block)) == 0, F.array(own, own - 1)).otherwise(F.array(own)))
    w = Window.partitionBy(*keys, "blk").orderBy("ord")
    return (
        rows.withColumn("own", own).withColumn("blk", F.explode(halo))
        .withColumn("starts", F.coalesce(F.lag("ord").over(w) != F.col("ord") - 1, F.lit(True)))
        .withColumn("ends", F.coalesce(F.lead("ord").over(w) != F.col("ord") + 1, F.lit(True)))
        .where("blk = own and (starts or ends)").drop("blk", "own")
    )


def drift_rows(messages: DataFrame) -> DataFrame:
    """The fields of every file, in order, with their types."""
    return drift_of(message_fields(messages))


def drift_of(fields: DataFrame) -> DataFrame:
    """:func:`drift_rows` from the fields of messages or of footers."""
    # bodies and footers are read once; what follows reads the distinct fields per file
    files = materialize(file_fields(fields), "fields")
    return materialize(fill_types(with_ordinals(files)), "drift")


def catalogue(rows: DataFrame) -> DataFrame:
    """Lifespans: ``topic, field, type, first_seq, last_seq, open`` (open: still
    present in the last file of the topic)."""
    edges = lifespan_edges(rows, ["topic", "field", "type"])
    w = Window.partitionBy("topic", "field", "type").orderBy("ord")
    last = rows.groupBy("topic").agg(F.max("file_seq").alias("topic_last"))
    paired = edges.withColumn("last_seq", F.when(F.col("ends"), F.col("file_seq")).otherwise(F.lead("file_seq").over(w)))
    return (
        paired.where("starts").join(last, "topic")
        .select("topic", "field", "type", F.col("file_seq").alias("first_seq"), "last_seq", (F.col("last_seq") == F.col("topic_last")).alias("open"))
    )


def changes(rows: DataFrame) -> DataFrame:
    """Each change against the previous file: ``topic, file_seq, ord,
    change_kind, field_name, old_name, old_type, new_type, pos``."""
    edges = materialize(lifespan_edges(rows, ["topic", "field", "type"]), "edges")
    seqs = rows.select("topic", "ord", "file_seq").distinct()
    starts = edges.where("starts and ord > 1").select("topic", "ord", "field", F.col("type").alias("new_type"), F.col("pos").alias("new_pos"))
    ends = edges.where("ends").select("topic", (F.col("ord") + 1).alias("ord"), "field", F.col("type").alias("old_type"), F.col("pos").alias("old_pos"))
    ends = ends.join(seqs.select("topic", "ord"), ["topic", "ord"], "left_semi")  # not those of the topic's last file
    both = materialize(starts.join(ends, ["topic", "ord", "field"], "full_outer"), "retyped")
    retyped = both.where("new_type is not null and old_type is not null").select(
        "topic", "ord", F.lit("retyped").alias("change_kind"), F.col("field").alias("field_name"), F.lit("").alias("old_name"), "old_type", "new_type", F.col("new_pos").alias("pos"))
    new = both.where("old_type is null").select("topic", "ord", F.col("field").alias("new_field"), F.col("new_type").alias("type"), F.col("new_pos").alias("pos"))
    gone = both.where("new_type is null").select("topic", "ord", F.col("field").alias("old_field"), F.col("old_type").alias("type"), F.col("old_pos").alias("pos"))
    # several fields of one file may share a position only if its messages disagree
    number = lambda d, c: d.withColumn("nr", F.row_number().over(Window.partitionBy("topic", "ord", "pos", "type").orderBy(c)))
    pairs = number(new, "new_field").join(number(gone, "old_field"), ["topic", "ord", "type", "pos", "nr"], "full_outer")
    renamed = F.col("new_field").isNotNull() & F.col("old_field").isNotNull()
    others = pairs.select(
        "topic", "ord",
        F.when(renamed, "renamed").when(F.col("new_field").isNotNull(), "added").otherwise("removed").alias("change_kind"),
        F.coalesce("new_field", "old_field").alias("field_name"),
        F.when(renamed, F.col("old_field")).otherwise(F.lit("")).alias("old_name"),
        F.when(F.col("old_field").isNotNull(), F.col("type")).alias("old_type"),
        F.when(F.col("new_field").isNotNull(), F.col("type")).alias("new_type"), "pos",
    )
    return retyped.unionByName(others).join(seqs, ["topic", "ord"])


def column_names(rows: DataFrame, log: DataFrame) -> DataFrame:
    """The alias table by file: ``topic, ord_from, ord_to, field, column, type``:
    which column of the consistent table a field name means from one file to
    another. A chain of renamings is followed by pointer doubling."""
    runs = lifespan_edges(rows.select("topic", "field", "ord", "file_seq"), ["topic", "field"])
    w = Window.partitionBy("topic", "field").orderBy("ord")
    runs = runs.withColumn("ord_to", F.when(F.col("ends"), F.col("ord")).otherwise(F.lead("ord").over(w))).where("starts")
    runs = runs.select("topic", "field", F.col("ord").alias("ord_from"), "ord_to")
    link = log.where("change_kind = 'renamed'").select(
        "topic", F.col("old_name").alias("field"), (F.col("ord") - 1).alias("ord_to"), F.col("field_name").alias("next"), F.col("ord").alias("next_from"))
    state = materialize(
        runs.join(link, ["topic", "field", "ord_to"], "left")
        .select("topic", "field", "ord_from", "ord_to", F.coalesce("next", "field").alias("last"), F.coalesce("next_from", "ord_from").alias("last_from")), "alias")
    while True:
        step = state.alias("s").join(
            state.select("topic", F.col("field").alias("last"), F.col("ord_from").alias("last_from"), F.col("last").alias("l2"), F.col("last_from").alias("f2")),
            ["topic", "last", "last_from"], "left",
        ).select("topic", "field", "ord_from", "ord_to", F.coalesce("l2", "last").alias("last"), F.coalesce("f2", "last_from").alias("last_from"),
                 (~(F.col("f2").eqNullSafe(F.col("last_from")))).alias("moved"))
        step = materialize(step, "alias")
        moved = step.where("moved").limit(1).count()
        state = step.drop("moved")
        if not moved:
            break
    # a name that was dropped and later given to another column gets its first file as a suffix
    lasts = state.select("topic", "last", "last_from").distinct()
    newest = Window.partitionBy("topic", "last").orderBy(F.desc("last_from"))
    named = lasts.withColumn("column", F.when(F.row_number().over(newest) == 1, F.col("last")).otherwise(F.concat_ws("@", "last", F.col("last_from").cast("string"))))
    return state.join(named, ["topic", "last", "last_from"]).select("topic", "field", "ord_from", "ord_to", "column")


#: From narrow to wide; a column that had several types of one semantic name gets
#: the widest, and a mixture of groups becomes a string.
_WIDTH = ["boolean", "int16", "int32", "int", "int64", "long", "integer", "float", "float32", "double", "float64"]
_DATE, _MILLIS, _MICROS = "int32:io.debezium.time.Date", "int64:io.debezium.time.Timestamp", "int64:io.debezium.time.MicroTimestamp"
_TIME = "int64:io.debezium.time.MicroTime"
#: Microseconds in a unit of the types that count from 1970; a mixture of them
#: gets the finest timestamp among them.
_UNIT = {_DATE: 86_400_000_000, _MILLIS: 1000, _MICROS: 1}


def _semantic(t: Column) -> Column:
    """The ``name`` of a ``type:name``, empty if it has none."""
    return F.regexp_extract(t, r"^\w+:(.+)$", 1)


def _base(t: Column) -> Column:
    return F.regexp_replace(t, r"^(\w+):.+$", "$1")


def _unified(types: Column) -> Column:
    plain, names = F.array_distinct(F.transform(types, _base)), F.array_distinct(F.transform(types, _semantic))
    wide = F.array_max(F.transform(plain, lambda t: F.array_position(F.array(*map(F.lit, _WIDTH)), t)))
    number = (F.size(names) == 1) & F.forall(plain, lambda t: t.isin(*_WIDTH[1:]))
    widest = F.concat_ws(":", F.element_at(F.array(*map(F.lit, _WIDTH)), wide.cast("int")), F.nullif(F.element_at(names, 1), F.lit("")))
    return (
        F.when(F.size(types) == 1, F.element_at(types, 1))
        .when(F.forall(types, lambda t: t.isin(*_UNIT)), F.when(F.array_contains(types, _MICROS), _MICROS).otherwise(_MILLIS))
        .when(number, widest).otherwise(F.lit("string"))
    )


def _as_text(value: Column, own: Column) -> Column:
    """The value in a string column: counts of days or (micro)seconds are written
    out, as their unit would be lost."""
    n = value.try_cast("bigint")
    micros = F.when(own == _MILLIS, F.try_multiply(n, F.lit(1000))).otherwise(n)
    rest = F.when(own == _TIME, F.abs(n)).otherwise(F.pmod(micros, F.lit(_UNIT[_DATE])))
    days = F.when(own == _DATE, n).otherwise(F.floor((micros - rest) / F.lit(_UNIT[_DATE]))).try_cast("int")
    whole = lambda per: F.floor(rest / F.lit(per))
    part = lambda x, size: F.lpad(x.cast("string"), size, "0")
    hours = whole(3_600_000_000)
    clock = F.concat(
        F.when(hours < 100, part(hours, 2)).otherwise(hours.cast("string")), F.lit(":"), part(whole(60_000_000) % 60, 2), F.lit(":"), part(whole(1_000_000) % 60, 2), F.lit("."),
        F.when(own == _MILLIS, part(whole(1000) % 1000, 3)).otherwise(part(rest % 1_000_000, 6)),
    )
    date = F.date_from_unix_date(days).cast("string")
    text = (
        F.when(own == _DATE, date).when(own.isin(_MILLIS, _MICROS), F.concat(date, F.lit("T"), clock))
        .when(own == _TIME, F.concat(F.when(n < 0, "-").otherwise(""), clock))
    )
    return F.coalesce(text, value)


def _converted(value: Column, own: Column, to: Column) -> Column:
    """The value of a field of type ``own`` in a column of type ``to``; null if
    it cannot be cast or the types count in units that do not convert."""
    base = _base(to)
    # a whole number beyond 2^53 is no exact double
    whole = value.try_cast("bigint")
    exact = ~F.coalesce(_base(own).isin(*_WIDTH[1:7]) & (F.abs(whole) > 1 << 53), F.lit(False))
    cast = (
        F.when(base.isin("int16", "int32", "int", "int64", "long", "integer"), value.try_cast("bigint").cast("string"))
        .when(base.isin("float", "double", "float32", "float64"), F.when(exact, value.try_cast("double").cast("string")))
        .when(base == "boolean", value.try_cast("boolean").cast("string"))
        .otherwise(value)
    )
    units = F.create_map(*[F.lit(x) for kv in _UNIT.items() for x in kv])
    times = F.try_element_at(units, own) / F.try_element_at(units, to)
    return (
        F.when(to == "string", _as_text(value, own)).when(_semantic(own) == _semantic(to), cast)
        .when(times >= 1, F.try_multiply(value.try_cast("bigint"), times.cast("bigint")).cast("string"))
    )


def unified_schema(rows: DataFrame, names: DataFrame) -> DataFrame:
    """``topic, column, type``: the one consistent table of each topic."""
    n = names.withColumnRenamed("field", "f").withColumnRenamed("topic", "t")
    cols = rows.join(n, (F.col("topic") == F.col("t")) & (F.col("field") == F.col("f")) & F.col("ord").between(F.col("ord_from"), F.col("ord_to")))
    seen = cols.groupBy("topic", "column").agg(F.array_sort(F.collect_set("type")).alias("types"))
    return seen.select("topic", "column", _unified(F.col("types")).alias("type"))


def _values(messages: DataFrame) -> DataFrame:
    """Messages with ``vals``: name, value and declared type of each field of
    the image; no fields without an image."""
    body = F.col("body")
    image = F.coalesce(
        F.from_json(body, "struct<message: map<string, string>>")["message"],
        F.from_json(body, "struct<payload: struct<after: map<string, string>>>")["payload"]["after"],
        F.from_json(body, "struct<payload: struct<before: map<string, string>>>")["payload"]["before"],
    )
    own = lambda m, e: F.try_element_at(F.filter(m["declared"], lambda f: f["name"] == e["key"]), F.lit(1))["type"]
    # an array of one binds both parts, else the declared fields are parsed again for every value
    parts = F.array(F.struct(_declared().alias("declared"), image.alias("image")))
    vals = F.transform(parts, lambda m: F.transform(F.map_entries(m["image"]), lambda e: F.struct(e["key"], e["value"], own(m, e))))[0]
    return messages.select("msg_id", "topic", "file_seq", F.coalesce(vals.cast("array<struct<field: string, value: string, own: string>>"), F.array()).alias("vals"))


def _file_columns(rows: DataFrame, names: DataFrame) -> DataFrame:
    """``topic, file_seq, field, listed, column``: the column of each field that a
    file lists, with the type it has there."""
    n = names.withColumnRenamed("topic", "t").withColumnRenamed("field", "f")
    placed = rows.join(n, (F.col("topic") == F.col("t")) & (F.col("field") == F.col("f")) & F.col("ord").between(F.col("ord_from"), F.col("ord_to")))
    return placed.select("topic", "file_seq", "field", F.col("type").alias("listed"), "column")


def unified_rows(messages: DataFrame, rows: DataFrame, names: DataFrame, schema: DataFrame) -> DataFrame:
    """The consistent tables, all topics in one: a row per message and column of
    its topic, the value as text after the conversion from the type that the
    message declares (without one, that of its file) to the column's type (null
    where the message has none or it cannot be converted, see
    :func:`left_over`). A message without a file has nulls only."""
    # per file all columns of the topic, then every message finds its values in place
    files = rows.select("topic", "file_seq").distinct().join(schema, "topic").join(_file_columns(rows, names), ["topic", "file_seq", "column"], "left")
    entry = lambda *cols: F.collect_list(F.struct("column", "type", *cols)).alias("cols")
    files = files.groupBy("topic", "file_seq").agg(entry("field", "listed"))
    bare = schema.groupBy("topic").agg(F.collect_list(F.struct("column", "type")).alias("all"))
    found = _values(messages).join(files, ["topic", "file_seq"], "left").join(bare, "topic")
    none = F.transform("all", lambda c: F.struct(c["column"], c["type"], F.lit(None).cast("string"), F.lit(None).cast("string")))
    shape = "array<struct<column: string, type: string, field: string, listed: string>>"
    each = found.select("topic", "msg_id", "vals", F.explode(F.coalesce(F.col("cols").cast(shape), none.cast(shape))).alias("c"))
    each = each.withColumn("v", F.try_element_at(F.filter("vals", lambda v: v["field"] == F.col("c.field")), F.lit(1)))
    value = _converted(F.col("v.value"), F.coalesce("v.own", "c.listed"), F.col("c.type"))
    return each.select("topic", "msg_id", F.col("c.column").alias("column"), F.col("c.type").alias("type"), value.alias("value"))


def left_over(messages: DataFrame, rows: DataFrame, names: DataFrame, schema: DataFrame) -> DataFrame:
    """``topic, msg_id, field, value, reason``: what :func:`unified_rows` has no
    room for. Fields of an image that their file does not list (or whose message
    has no file) are undeclared; values that do not convert to the column's type
    are not cast."""
    values = _values(messages).select("topic", "msg_id", "file_seq", F.inline("vals"))
    placed = values.join(_file_columns(rows, names), ["topic", "file_seq", "field"], "left").join(schema, ["topic", "column"], "left")
    lost = F.col("value").isNotNull() & _converted(F.col("value"), F.coalesce("own", "listed"), F.col("type")).isNull()
    reason = F.when(F.col("column").isNull(), "undeclared").when(lost, "not cast")
    return placed.select("topic", "msg_id", "field", "value", reason.alias("reason")).where("reason is not null")
