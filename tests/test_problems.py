"""The five general problem operators against brute force and edge cases."""

import dataclasses
import json
import random

import pytest
from pyspark.sql import functions as F

from changeloom.operators import copy_diff, heavy_keys, redelivery, schema_drift
from changeloom.queries import problems as Q
from changeloom.streaming import upsert

IMG = "array<struct<col_name: string, col_value: string, flag: bigint>>"
REDO = f"log_id bigint, start_ts bigint, commit_ts bigint, tbl struct<db_name: string, tbl_name: string, tbl_id: bigint>, row_columns {IMG}, pre_columns {IMG}, copies int, kept string, op string"


def img(key, val=None):
    return None if key is None else [("v", val, 0), ("id", key, 10)]


def redo(spark, rows):
    """rows: (start, commit, table, new key, new value, old key)."""
    data = [(i, s, c, ("d", "t", t), img(k, v), img(o, "old"), 0, "x", "y") for i, (s, c, t, k, v, o) in enumerate(rows)]
    return spark.createDataFrame(data, REDO)



@pytest.fixture
def ids(spark):
    return Q._message_ids()


def test_p1_edges(spark, ids):
    ms = 1_700_000_000_000
    ts = ms << 18
    hot = [(ts, ts + 1, 7, str(i % 500), "a", None) for i in range(1500)]  # one bucket, one commit
    rows = hot + [(None, None, 1, "k", "a", None)] * 2 + [(1, 2 << 18, 1, "k", "a", None), (1, 2 << 18, 1, None, None, "k")] + [(5, 90_000_000 << 18, 1, None, None, None)] * 2
    df = redo(spark, rows)
    plan = redelivery.BloomPlan(bits_per_key=4)
    got = redelivery.repeated_messages(df, ids, F.shiftright("commit_ts", 18), plan).collect()
    copies = {(r["commit_ts"], r["row_key"], r["op"]): r["copies"] for r in got}
    want = {(ts + 1, str(i), "I"): 3 for i in range(500)} | {(None, "k", "I"): 2, (90_000_000 << 18, None, None): 2}
    assert copies == want
    ms_of = F.shiftright("commit_ts", 18)
    once = redelivery.exactly_once(df, ids, ms_of, "log_id", plan)
    assert once.columns == [*df.columns, "_copies"]  # the kept rows whole, clashing names too
    kept = once.collect()
    assert len(kept) == 500 + 1 + 2 + 1 and min(r["log_id"] for r in kept) == 0
    whole = {r["log_id"]: r for r in df.withColumn("c", F.lit(0)).drop("c").collect()}
    assert all(r["row_columns"] == whole[r["log_id"]]["row_columns"] for r in kept)
    assert redelivery.repeated_messages(df.limit(0), ids, ms_of).count() == 0
    assert redelivery.exactly_once(df.limit(0), ids, ms_of, "log_id").count() == 0


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_p1_one_plan(spark, ids, data):
    """No filter is broadcast, and a hot identifier is spread over salts."""
    hot = [(5, 1_700_000_000_000 << 18, 7, "k", "a", None)] * 3000 + [(5, (1_700_000_000_000 << 18) + i, 7, str(i), "a", None) for i in range(300)]
    df, plan = redo(spark, hot), redelivery.BloomPlan(bits_per_key=1024, full=2)
    screen = redelivery.Screen(df, ids, F.shiftright("commit_ts", 18), plan)
    assert screen.full.agg(F.max("__salts")).first()[0] > 10
    marked = screen.mark(screen.store)
    assert "SortMergeJoin [__bucket" in physical(marked)
    assert marked.groupBy("__maybe").count().where("__maybe").first()[1] >= 3000
    assert [tuple(r) for r in redelivery.repeated_messages(df, ids, F.shiftright("commit_ts", 18), plan).select("row_key", "copies").collect()] == [("k", 3000)]


def test_p1_store_over_batches(spark):
    rng = random.Random(5)
    schema = "a int, b string, ms bigint, batch int, bucket int"
    store = redelivery.RedeliveryStore(spark, ["a", "b"], "ms", plan=redelivery.BloomPlan(bits_per_key=1024))
    seen, grew = set(), 0
    for n in range(5):
        rows = [(rng.randint(0, 60 * (n + 1)), rng.choice([None, "x", "y"]), n) for _ in range(150)]
        rows = [(a, b, None if a == 0 else a * 100_000, p, 7) for a, b, p in rows]
        kept = store.process(spark.createDataFrame(rows, schema), n, "batch").collect()
        keys = [(r["a"], r["b"]) for r in kept]
        assert len(keys) == len(set(keys)) and set(keys) == {(a, b) for a, b, *_ in rows} - seen and all(r["checked"] for r in kept)
        if n == 2:  # the same batch once more
            again = store.process(spark.createDataFrame(rows, schema), n).collect()
            assert {(r["a"], r["b"]) for r in again} == set(keys)
        seen |= set(keys)
        grew = max(grew, *(x[2] for x in store._meta(n).values()))
    assert grew > 1  # a filter was made again with more blocks
    read = physical(store.stored([0, 3], 50, "a int, b string"))
    assert "bucket=0" in read or "InMemoryFileIndex(2 paths)" in read  # only these folders are listed


def test_p1_store_forgets(spark):
    store = redelivery.RedeliveryStore(spark, ["a"], "ms", bucket_ms=10, keep_buckets=2)
    run = lambda rows, n: {tuple(r) for r in store.process(spark.createDataFrame(rows, "a int, ms bigint"), n).collect()}
    assert run([(1, 5), (1, 5), (2, 15)], 0) == {(1, 5, True), (2, 15, True)}
    assert run([], 1) == set()
    assert run([(3, 25), (2, 15)], 2) == {(3, 25, True)}
    # bucket 0 is two behind: its rows are not held against the store
    assert run([(1, 5), (2, 15), (4, None)], 3) == {(1, 5, False), (4, None, True)}
    with pytest.raises(ValueError):
        redelivery.RedeliveryStore(spark, ["a"], "ms", keep_buckets=5000)


def debezium(fields):
    f = [{"field": n, "type": t, "optional": True} for n, t in fields]
    return json.dumps({"payload": {"after": {n: None for n, _ in fields}}, "schema": {"fields": [{"field": "after", "fields": f}, {"field": "op", "type": "string"}]}})


def avro(fields):
    f = [{"name": n, "type": ["null", {"type": t, "parameters": {"x": n}}] if k % 2 else t} for k, (n, t) in enumerate(fields)]
    return json.dumps({"schema": {"type": "record", "fields": f}, "message": {}})


def bare(row):
    return json.dumps({"payload": {"op": "c", "before": None, "after": row}})


def drift(spark, rows):
    return spark.createDataFrame([(i, t, s, c, b, 9) for i, (t, s, c, b) in enumerate(rows)], "msg_id bigint, topic string, file_seq int, codec string, body string, ord int")


def log_of(spark, rows):
    r = schema_drift.changes(schema_drift.drift_rows(drift(spark, rows)))
    return {(x["topic"], x["file_seq"], x["change_kind"], x["field_name"], x["old_name"]) for x in r.collect()}


def test_p2_changes(spark):
    a = [("id", "int64"), ("x", "int32"), ("y", "string")]
    rows = [("t", 1, "debezium", debezium(a)), ("t", 1, "debezium", debezium(a)),
            ("t", 4, "debezium", debezium([("id", "int64"), ("z", "int32"), ("y", "string")])),
            ("t", 2000, "debezium", debezium([("z", "int32"), ("id", "string"), ("w", "string")])),
            ("t", 3000, "debezium", debezium([("z", "int32"), ("id", "string"), ("w", "string"), ("x", "int32")])),
            ("u", 5, "avro", avro(a)), ("u", 6, "avro", avro([("id", "int64"), ("y", "string"), ("x", "long")])),
            ("b", 1, "bare", bare({"p": 1, "q": None, "s": True})), ("b", 2, "bare", bare({"p": 1.5, "q": "x", "s": None})), ("b", 3, "bare", bare({"p": 2.25, "q": 7, "r": False})),
            ("n", 1, "bare", None), ("n", 2, "bare", "no json"), ("n", 3, "other", "{}"), ("one", 3, "avro", avro(a))]
    assert log_of(spark, rows) == {
        ("t", 4, "renamed", "z", "x"), ("t", 2000, "retyped", "id", ""), ("t", 2000, "renamed", "w", "y"), ("t", 3000, "added", "x", ""),
        ("u", 6, "retyped", "x", ""), ("b", 2, "retyped", "p", ""), ("b", 3, "retyped", "q", ""), ("b", 3, "renamed", "r", "s"),
    }
    assert log_of(spark, rows[:0]) == set()


def test_p2_odd_bodies(spark):
    rows = [("t", 1, "bare", '{"payload": {"before": null, "after": {"a": 1, "a": "x", "o": {"k": 1}, "l": [1], "n": 1e400, "s": "%s"}}}' % ("y" * 200_000)),
            ("t", 2, "bare", '{"payload": {"before": {"a": 1}, "after": null}}'), ("t", 3, "bare", '{"payload": {"after": {}}}'), ("t", 4, None, "{}"), (None, 5, "bare", bare({"z": 1})), ("t", None, "bare", bare({"z": 1})),
            ("t", 6, "debezium", '{"schema": {"fields": [{"field": "after"}, {"field": "before", "fields": [{"field": "a", "type": "int64"}]}]}}'), ("t", 7, "avro", '{"schema": {"fields": []}}'),
            ("t", 8, "avro", '{"schema": {"fields": [{"name": "a", "type": {"type": "array", "items": "long"}}]}}')]
    r = schema_drift.drift_rows(drift(spark, rows))
    assert {x["file_seq"] for x in r.collect()} >= {2, 6, 8}
    schema_drift.changes(r).collect()
    names = schema_drift.column_names(r, schema_drift.changes(r))
    schema_drift.unified_rows(drift(spark, rows), r, names, schema_drift.unified_schema(r, names)).collect()


def test_p2_blocks_and_table(spark):
    rows = [("t", s, "bare", bare({"id": s, ("old" if s < 1500 else "new"): s})) for s in range(1000, 2100)]
    msgs = drift(spark, rows)
    r = schema_drift.drift_rows(msgs)
    log = schema_drift.changes(r)
    assert [(x["file_seq"], x["field_name"], x["old_name"]) for x in log.collect()] == [(1500, "new", "old")]
    spans = {(x["field"], x["first_seq"], x["last_seq"], x["open"]) for x in schema_drift.catalogue(r).collect()}
    assert spans == {("id", 1000, 2099, True), ("old", 1000, 1499, False), ("new", 1500, 2099, True)}
    names = schema_drift.column_names(r, log)
    schema = schema_drift.unified_schema(r, names)
    assert {(x["column"], x["type"]) for x in schema.collect()} == {("id", "integer"), ("new", "integer")}
    table = schema_drift.unified_rows(msgs, r, names, schema)
    assert table.where("column = 'new'").count() == 1100 and table.where("value is null").count() == 0


def connect(fields):
    """fields: name, type, semantic name, value."""
    f = [{"field": n, "type": t} | ({"name": f"io.debezium.time.{s}"} if s else {}) for n, t, s, _ in fields]
    return json.dumps({"payload": {"after": {n: v for n, _, _, v in fields}}, "schema": {"fields": [{"field": "after", "fields": f}]}})


def test_p2_units_are_not_mixed(spark):
    one = [("a", "int64", "Timestamp", 1772353086139), ("b", "int32", "Date", 20659), ("c", "int32", "Date", 20659), ("d", "int64", "Timestamp", -1), ("e", "int32", "", 3), ("f", "int32", "Date", -1), ("g", "int64", "MicroTime", -3_723_000_004), ("h", "int32", "Year", 2020)]
    two = [("a", "int64", "MicroTimestamp", 1772353086139541), ("b", "int32", "Year", 2019), ("c", "int64", "Timestamp", 5), ("d", "int64", "", 7), ("e", "int64", "", 4), ("f", "int64", "MicroTimestamp", 6), ("g", "string", "", "x"), ("h", "int64", "Year", 2021)]
    msgs = drift(spark, [("t", 1, "debezium", connect(one)), ("t", 2, "debezium", connect(two))])
    r = schema_drift.drift_rows(msgs)
    names = schema_drift.column_names(r, schema_drift.changes(r))
    schema = schema_drift.unified_schema(r, names)
    time = "int64:io.debezium.time."
    assert {x["column"]: x["type"] for x in schema.collect()} == {
        "a": time + "MicroTimestamp", "b": "string", "c": time + "Timestamp", "d": "string", "e": "int64", "f": time + "MicroTimestamp", "g": "string", "h": time + "Year"}
    got = {(x["column"], x["msg_id"]): x["value"] for x in schema_drift.unified_rows(msgs, r, names, schema).collect()}
    assert got == {
        ("a", 0): "1772353086139000", ("a", 1): "1772353086139541", ("b", 0): "2026-07-25", ("b", 1): "2019", ("c", 0): "1784937600000", ("c", 1): "5",
        ("d", 0): "1969-12-31T23:59:59.999", ("d", 1): "7", ("e", 0): "3", ("e", 1): "4", ("f", 0): "-86400000000", ("f", 1): "6", ("g", 0): "-01:02:03.000004", ("g", 1): "x", ("h", 0): "2020", ("h", 1): "2021"}


def test_p2_every_message_and_column(spark):
    image = lambda body, row: json.dumps(json.loads(body) | {"payload": {"after": row}})
    first = connect([("a", "int32", "", 1), ("b", "int32", "", 2)])
    rows = [("t", 1, "debezium", first), ("t", 1, "debezium", image(first, {"a": 5, "u": "x"})), ("t", 1, "debezium", image(first, None)),
            ("t", 2, "debezium", connect([("a", "int32", "", "no number"), ("c", "string", "", "y")])), ("t", None, "debezium", first), (None, 1, "debezium", first), ("t", 3, "debezium", "no json")]
    msgs = drift(spark, rows)
    r = schema_drift.drift_rows(msgs)
    names = schema_drift.column_names(r, schema_drift.changes(r))
    parts = (msgs, r, names, schema_drift.unified_schema(r, names))
    got = {(x["msg_id"], x["column"]): x["value"] for x in schema_drift.unified_rows(*parts).collect()}
    set_ = {(0, "a"): "1", (0, "b"): "2", (1, "a"): "5", (3, "c"): "y"}
    assert got == {(i, c): set_.get((i, c)) for i in (0, 1, 2, 3, 4, 6) for c in "abc"}
    left = {(x["msg_id"], x["field"], x["value"], x["reason"]) for x in schema_drift.left_over(*parts).collect()}
    assert left == {(1, "u", "x", "undeclared"), (3, "a", "no number", "not cast")} | {(i, f, v, "undeclared") for i in (4, 5) for f, v in (("a", "1"), ("b", "2"))}


def test_p2_reports(spark, tmp_path):
    a, b = [("a", "int32"), ("b", "string")], [("a", "int64"), ("b", "string")]
    version = lambda body, n: json.dumps((x := json.loads(body)) | {"schema": x["schema"] | {"version": n}})
    msgs = drift(spark, [("t", 1, "debezium", version(debezium(a), 1)), ("t", 1, "debezium", version(debezium(b), 1)), ("t", 2, "debezium", version(debezium(b), 2)), ("u", 1, "avro", version(avro(a), 7)),
                         ("t", 3, "bare", None), ("t", 3, "bare", "no json"), ("t", 3, "other", "{}"), ("t", 3, "bare", "{}"), (None, 3, "bare", bare({"x": 1}))])
    assert [tuple(r) for r in schema_drift.conflicts(msgs).collect()] == [("t", 1, "a", ["int32", "int64"])]
    assert {(r["msg_id"], r["reason"]) for r in schema_drift.unread(msgs).collect()} == {(4, "no body"), (5, "no json"), (6, "unknown codec"), (7, "no fields"), (8, "no file")}
    assert {tuple(r) for r in schema_drift.version_mismatches(msgs).collect()} == {("t", 1, 2, 2), ("t", 2, 1, 2)}
    # Parquet footers
    for n, cols in enumerate(("1 AS a, 'x' AS b", "1 AS a, 'x' AS c", "2L AS a, 'x' AS c")):
        spark.sql(f"SELECT {cols}").coalesce(1).write.parquet(str(tmp_path / str(n)))
    paths = [(n, spark.read.parquet(str(tmp_path / str(n))).inputFiles()[0]) for n in range(3)]
    files = spark.createDataFrame([("t", n, p) for n, p in paths] + [("t", 9, "file:///nowhere"), ("t", 9, None)], "topic string, file_seq int, path string")
    log = schema_drift.changes(schema_drift.drift_of(schema_drift.footer_fields(files)))
    assert {(r["file_seq"], r["change_kind"], r["field_name"], r["old_name"]) for r in log.collect()} == {(1, "renamed", "c", "b"), (2, "retyped", "a", "")}


def test_p2_inexact_numbers_are_reported(spark):
    msgs = drift(spark, [("t", 1, "bare", bare({"a": 2**60 + 1})), ("t", 2, "bare", bare({"a": 1.5})), ("t", 3, "bare", bare({"a": 7}))])
    r = schema_drift.drift_rows(msgs)
    names = schema_drift.column_names(r, schema_drift.changes(r))
    parts = (msgs, r, names, schema_drift.unified_schema(r, names))
    assert {x["msg_id"]: x["value"] for x in schema_drift.unified_rows(*parts).collect()} == {0: None, 1: "1.5", 2: "7.0"}
    assert [(x["msg_id"], x["reason"]) for x in schema_drift.left_over(*parts).collect()] == [(0, "not cast")]


def test_p2_chain_of_names(spark):
    names = ["a", "b", "c", "d", "e", "f"]
    rows = [("t", i, "bare", bare({n: 1})) for i, n in enumerate(names)] + [("t", 6, "bare", bare({"f": 1, "a": "s"}))]
    r = schema_drift.drift_rows(drift(spark, rows))
    got = {(x["field"], x["ord_from"], x["column"]) for x in schema_drift.column_names(r, schema_drift.changes(r)).collect()}
    assert got == {(n, i + 1, "f") for i, n in enumerate(names)} | {("a", 7, "a")}


COPY = "schema_name string, table_name string, id bigint, k bigint, c string, pad string, balance decimal(15,2), score double, attrs string, updated_at timestamp, h1 int, blk string"


def copy(spark, rows):
    base = dict(schema_name="s", table_name="t", id=0, k=1, c="c", pad="p", balance=None, score=1.0, attrs='{"a": 1, "b": [1, 2]}', updated_at=None, h1=1, blk="b")
    return spark.createDataFrame([tuple((base | r).values()) for r in rows], COPY)


def test_p3_edges(spark):
    many = [dict(id=i, k=i) for i in range(300)]
    up = many + [dict(id=1000, c=None), dict(id=1001, pad="x  "), dict(id=1002, score=2.0), dict(id=1003, score=None), dict(id=1004, attrs='{"b":[1,2],"a":1}'),
                 dict(id=1005), dict(id=1005), dict(id=1006), dict(id=None), dict(id=1008, k=None, c="1"), dict(id=1009, attrs="no json"), dict(id=1010, c="x" * 100_000), dict(id=1011, score=1e-7),
                 dict(id=1012, score=float("nan")), dict(id=1013, score=1.1e308), dict(id=1014, score=float("inf")), dict(id=1015, score=1e17), dict(id=1016, schema_name=None)]
    down = many + [dict(id=1000, c=""), dict(id=1001, pad="x"), dict(id=1002, score=2.0000005), dict(id=1003, score=0.0), dict(id=1004),
                   dict(id=1005), dict(id=1007), dict(id=None, k=2), dict(id=1008, k=1, c=None), dict(id=1009, attrs=None), dict(id=1010, c="x" * 100_000 + "y"), dict(id=1011, score=-1e-7),
                   dict(id=1012, score=float("nan")), dict(id=1013, score=1.2e308), dict(id=1014, score=float("-inf")), dict(id=1015, score=1e17), dict(id=1016, schema_name=None, k=3)]
    down[17] = dict(id=17, k=99, c="other")
    del down[40]
    got = {(r["id"], r["diff_kind"], r["field_name"]) for r in copy_diff.diff(copy(spark, up), copy(spark, down), Q.DIFF).collect()}
    assert got == {
        (17, "differs", "k"), (17, "differs", "c"), (40, "missing_downstream", ""), (1000, "differs", "c"), (1003, "differs", "score"),
        (1006, "missing_downstream", ""), (1007, "missing_upstream", ""), (None, "differs", "k"), (1008, "differs", "k"), (1008, "differs", "c"),
        (1009, "differs", "attrs"), (1010, "differs", "c"), (1013, "differs", "score"), (1014, "differs", "score"), (1016, "differs", "k"),
    }
    assert copy_diff.diff(copy(spark, up[:0]), copy(spark, down[:0]), Q.DIFF).count() == 0
    assert copy_diff.diff(copy(spark, many), copy(spark, down[:0]), Q.DIFF).count() == 300


def test_p3_one_shuffle(spark, data):
    """Without any broadcast the rows are shuffled once."""
    before = {k: spark.conf.get(k, None) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")}
    try:
        for k in before:
            spark.conf.set(k, "-1")
        plan = physical(Q.p3_found(spark, data))
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert plan.count("Exchange ") == 1 and "Join" not in plan


def test_p3_over_full_block(spark):
    """Many rows of one key: repeats count once, versions are paired in hash order."""
    plan = dataclasses.replace(Q.DIFF, block=8, full=2)
    some = [dict(id=i) for i in range(100, 120)]
    up = some + [dict(id=1)] * 300 + [dict(id=2, k=i) for i in range(60)] + [dict(id=None, k=i) for i in range(40)]
    down = some + [dict(id=1)] * 2 + [dict(id=2, k=i) for i in range(5, 63)] + [dict(id=None, k=i) for i in range(1, 41)]
    got = sorted((r["id"] or 0, r["diff_kind"], r["field_name"]) for r in copy_diff.diff(copy(spark, up), copy(spark, down), plan).collect())
    assert got == [(0, "differs", "k"), *[(2, "differs", "k")] * 3, *[(2, "missing_downstream", "")] * 2]


def test_p3_other_keys(spark):
    """A text key, a composite key."""
    rows = [("s", "t", f"k{i}", i % 7, f"v{i}") for i in range(500)]
    schema = "schema_name string, table_name string, name string, no int, c string"
    a, b = spark.createDataFrame(rows, schema), spark.createDataFrame([r if r[2] != "k77" else (*r[:4], "w") for r in rows if r[2] != "k5"], schema)
    for key in (("name",), ("no", "name")):
        got = {tuple(r) for r in copy_diff.diff(a, b, copy_diff.DiffPlan(key=key, fields=("c",), block=64)).select("name", "diff_kind", "field_name").collect()}
        assert got == {("k77", "differs", "c"), ("k5", "missing_downstream", "")}


def test_p3_cuts_follow_the_content(spark):
    rows = [dict(id=i, k=i * 7) for i in range(0, 2000, 2)]
    placed, _ = copy_diff.place(copy(spark, rows), copy(spark, [dict(id=1), *rows]), Q.DIFF)
    chunked = copy_diff.chunks(placed, Q.DIFF)
    bad = {r["__side"]: r["n"] for r in copy_diff.unmatched(chunked).groupBy("__side").agg(F.sum("n_rows").alias("n")).collect()}
    assert chunked.count() > 40 and bad[0] < 150 and bad[1] == bad[0] + 1


def test_p4_against_plain(spark):
    rng = random.Random(1)
    rows = [(rng.choice([None, "hot", "hot", "hot", "cold"]), rng.randint(0, 20), rng.choice([None, 1, 2, 3]), 5) for _ in range(3000)]
    df = spark.createDataFrame(rows, "k string, j int, v int, n int")
    A = heavy_keys.Agg
    aggs = [A("rows", "count"), A("s", "sum", "v"), A("lo", "min", "v"), A("hi", "max", "v"), A("a", "avg", "v"), A("d", "distinct", "v"), A("e", "approx_distinct", "v")]
    got = heavy_keys.salted_aggregate(df, ["k"], aggs, heavy_keys.SaltPlan(heavy_share=0.3, salts=4))
    want = df.groupBy("k").agg(F.count("*").alias("rows"), F.sum("v").alias("s"), F.min("v").alias("lo"), F.max("v").alias("hi"), F.avg("v").alias("a"), F.count_distinct("v").alias("d"), F.count_distinct("v").alias("e"))
    key = lambda rows: sorted((tuple(r) for r in rows), key=repr)
    assert key(got.collect()) == key(want.collect())
    assert heavy_keys.salted_aggregate(df.limit(0), ["k", "j"], aggs).count() == 0


def brute_rebuild(rows):
    changes = []
    for s, c, t, k, v, o in rows:
        if c is None or (k is None and o is None):
            continue
        if k is None:
            changes.append((c, 0, s or 0, t, o, None))
        elif o is None:
            changes.append((c, 3, s or 0, t, k, v))
        else:
            if o != k:
                changes.append((c, 1, s or 0, t, o, None))
            changes.append((c, 2, s or 0, t, k, v))
    table = {}
    for c, _, _, t, k, v in sorted(changes, key=lambda x: x[:3]):
        table.pop((t, k), None)
        if v is not None:
            table[t, k] = (c, v)
    return table


def test_p5_out_of_order_and_repeated(spark, tmp_path):
    rng = random.Random(9)
    rows = []
    for c in range(1, 200):
        k, o = str(rng.randint(0, 15)), str(rng.randint(0, 15))
        kind = rng.choice("IUUMD")
        rows.append((c, c * 10, rng.randint(1, 2), None if kind == "D" else k, f"v{c}", {"I": None, "U": k, "M": o, "D": o}[kind]))
    rows += [(1, 5000, 1, "1", "ins", None), (1, 5000, 1, None, None, "1"), (2, 6000, 1, "2", "moved", "3"), (2, 6000, 1, "3", "chain", "4"), (None, None, 1, "9", "x", None), (3, 7000, 1, None, None, None)]
    feed = rows + rng.sample(rows, 80)
    rng.shuffle(feed)
    for n in range(4):
        redo(spark, feed[n::4]).coalesce(1).write.mode("append").parquet(str(tmp_path / "redo"))
    path = str(tmp_path / "redo")
    schema = spark.read.parquet(path).schema
    want = brute_rebuild(rows)
    for files in (None, 1):
        got = upsert.rebuild(spark, path, schema, max_files=files).collect()
        assert {(r["tbl_id"], r["row_key"]): (r["commit_ts"], json.loads(r["payload"])[0]["col_value"]) for r in got} == want
    # a second run goes on from the stored state
    stream = lambda: upsert.stream_files(spark, spark.readStream.schema(schema), path)
    out = upsert.apply_feed(spark, stream(), ["tbl_id", "row_key"], path=str(tmp_path / "job"))
    redo(spark, [(9, 9000, 1, None, None, "1"), (9, 10, 2, "1", "late", None)]).coalesce(1).write.mode("append").parquet(path)
    upsert.apply_feed(spark, stream(), ["tbl_id", "row_key"], path=str(tmp_path / "job"))
    now = {(r["tbl_id"], r["row_key"]) for r in upsert.current_rows(spark, out, {"tbl_id": "bigint", "row_key": "string"}).collect()}
    late = brute_rebuild([*rows, (9, 9000, 1, None, None, "1"), (9, 10, 2, "1", "late", None)])
    assert now == set(late)


def test_p5_empty(spark, tmp_path):
    redo(spark, []).write.parquet(str(tmp_path / "e"))
    assert upsert.rebuild(spark, str(tmp_path / "e"), spark.read.parquet(str(tmp_path / "e")).schema).count() == 0


def brute_drift(messages):
    """The changes by the plain definition, file by file."""
    files = {}
    for m in messages:
        body, fields = json.loads(m["body"]), []
        if m["codec"] == "debezium":
            image = next(f for f in body["schema"]["fields"] if f["field"] == "after")
            fields = [(f["field"], (f["type"], f.get("name"))) for f in image["fields"]]
        elif m["codec"] == "avro":
            def plain(t):
                if isinstance(t, list):
                    return plain(next(x for x in t if x != "null"))
                return t["type"] if isinstance(t, dict) else t

            fields = [(f["name"], plain(f["type"])) for f in body["schema"]["fields"]]
        else:
            row = body["payload"]["after"] or body["payload"]["before"]
            kind = {bool: "boolean", int: "integer", float: "double", str: "string"}
            fields = [(k, kind.get(type(v))) for k, v in row.items()]
        old = files.setdefault((m["topic"], m["file_seq"]), [])
        for p, (n, t) in enumerate(fields):
            if p < len(old) and old[p][0] == n:
                old[p] = (n, old[p][1] or t)
            elif p == len(old):
                old.append((n, t))
            else:
                raise AssertionError("messages of one file disagree")
    out, last = set(), {}
    for (topic, seq), now in sorted(files.items()):
        before = last.get(topic)
        last[topic] = now
        if before is None:
            continue
        a, b = dict(before), dict(now)
        out |= {(topic, seq, "retyped", n, "") for n in a.keys() & b.keys() if a[n] != b[n]}
        gone, new = {n for n in a if n not in b}, {n for n in b if n not in a}
        for (n1, t1), (n2, t2) in zip(before, now):
            if n1 in gone and n2 in new and t1 == t2:
                out.add((topic, seq, "renamed", n2, n1))
                gone.discard(n1)
                new.discard(n2)
        out |= {(topic, seq, "added", n, "") for n in new} | {(topic, seq, "removed", n, "") for n in gone}
    return out


def test_p2_against_the_definition(spark, data):
    got = {tuple(r) for r in Q.p2_found(spark, data).select("topic", "file_seq", "change_kind", "field_name", "old_name").collect()}
    want = brute_drift(spark.read.parquet(f"{data}/sink_message.parquet").collect())
    assert got == want and {w[2] for w in want} == {"added", "removed", "renamed", "retyped"}
