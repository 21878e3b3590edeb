"""Rules of the change-stream operators on small hand-made inputs."""

import json
import random
import zlib

import pytest
from pyspark.sql import functions as F

from changeloom.functions import scalars as S
from changeloom.functions.codecs import formats as E
from changeloom.functions.codecs.model import Col, Table
from changeloom.operators import compaction as C
from changeloom.operators import matching as M
from changeloom.operators import ordering as O
from changeloom.operators import progress as P
from changeloom.operators import rules as U
from changeloom.operators import schemas as SC
from changeloom.plans.changefeed import Changefeed, ChangefeedConfig
from changeloom.sinks import writers as W
from changeloom.streaming import pipelines as ST


def one(spark, c):
    return spark.range(1).select(c).first()[0]


def fold(spark, ops):
    """ops: string of I, U, D; images are numbered by position."""
    rows = [(1, i, o, None if o == "I" else i * 10, None if o == "D" else i * 10 + 1) for i, o in enumerate(ops)]
    df = spark.createDataFrame(rows, "k int, n int, op string, pre int, post int")
    return [(r["op"], r["pre"], r["post"], r["n"], r["bad"]) for r in C.fold_runs(df, ["k"], ["n"], "pre", "post").orderBy("n").collect()]


@pytest.mark.parametrize(
    "ops,want",
    [
        ("D", [("D", 0, None, 0, False)]),
        ("I", [("I", None, 1, 0, False)]),
        ("IUU", [("I", None, 21, 2, False)]),
        ("IUD", [("D", 20, None, 2, False)]),
        ("ID", [("D", 10, None, 1, False)]),
        ("UUU", [("U", 20, 21, 2, False)]),
        ("UUD", [("D", 10, None, 2, False)]),
        ("DID", [("D", 0, None, 0, False), ("D", 20, None, 2, False)]),
        ("DI", [("D", 0, None, 0, False), ("I", None, 11, 1, False)]),
        ("II", [("I", None, 11, 1, True)]),
        ("UI", [("U", None, 11, 1, True)]),
    ],
)
def test_fold_rules(spark, ops, want):
    assert fold(spark, ops) == want


def test_order_of_arrival_has_no_effect(spark):
    rng = random.Random(2)
    rows = [(k, n, rng.choice("UUD") if n else "I", n * 10, n) for k in range(20) for n in range(12)]
    a = spark.createDataFrame(rows, "k int, n int, op string, pre int, post int")
    rng.shuffle(rows)
    b = spark.createDataFrame(rows, "k int, n int, op string, pre int, post int").repartition(7)
    for f in (lambda d: C.fold_runs(d, ["k"], ["n"], "pre", "post").drop("bad"), lambda d: C.keep_last(d, ["k"], ["n"], "pre", "post"), lambda d: C.apply_log(d, ["k"], [F.col("n")], ["post"])):
        assert sorted(map(tuple, f(a).collect()), key=repr) == sorted(map(tuple, f(b).collect()), key=repr)


def test_row_numbers(spark):
    rng = random.Random(4)
    rows = [(rng.randint(0, 50), i) for i in range(2000)]
    got = O.row_numbers(spark.createDataFrame(rows, "a int, b int").repartition(9), [F.col("a"), F.col("b")]).collect()
    want = {r: i + 1 for i, r in enumerate(sorted(rows))}
    assert {(r["a"], r["b"]): r["row_no"] for r in got} == want
    assert O.row_numbers(spark.createDataFrame([], "a int"), [F.col("a")]).count() == 0


def test_running_before(spark):
    rows = [(i, i % 7) for i in range(1000)]
    got = M.running_before(spark.createDataFrame(rows, "i int, v int"), ["i"], "v", "s").collect()
    total = 0
    for r in sorted(got, key=lambda r: r["i"]):
        assert r["s"] == total
        total += r["v"]


def test_two_phase_match(spark):
    pre = [(1, 10, 1, 1, 5), (1, 10, 2, 2, 6), (1, 10, 3, 3, None), (2, 10, 1, 1, 7), (3, 10, 1, 1, 8), (4, 10, 1, 1, None)]
    p = spark.createDataFrame(pre, "k int, start_ts int, generation int, arrival int, value int")
    c = spark.createDataFrame([(1, 10, 20), (2, 10, 20), (4, 10, 20), (9, 10, 20)], "k int, start_ts int, commit_ts int")
    r = spark.createDataFrame([(2, 10)], "k int, start_ts int")
    assert sorted(map(tuple, M.match(p, c, r, ["k", "start_ts"]).collect())) == [(1, 10, 20, 6), (4, 10, 20, None)]


def test_table_filter(spark):
    rows = spark.createDataFrame([("shop", "t1"), ("Shop", "T1_TMP"), ("bank", "a"), ("x", "y"), (None, "y")], "s string, t string")
    keep = lambda rules, cs=False: [r[0] for r in rows.select(F.coalesce(U.table_filter(F.col("s"), F.col("t"), rules, cs), F.lit(False))).collect()]
    assert keep(["*.*"]) == [True] * 5
    assert keep(["shop.*", "!*.*_tmp"]) == [True, False, False, False, False]
    assert keep(["!*.*_tmp", "shop.*"]) == [True, True, False, False, False]
    assert keep(["shop.*"], True) == [True, False, False, False, False]
    assert keep(["[ab]ank.?"]) == [False, False, True, False, False]


def test_row_predicates_and_literals(spark):
    rows = spark.createDataFrame([("I", None, 2, "price"), ("I", None, None, "x"), ("U", 1, 5, "x"), ("D", 9, None, "x")], "op string, pre_price int, post_price int, post_name string").withColumn("pre_name", F.col("post_name"))
    keep = U.keep_row(F.col("op"), ["price", "name"], insert="price = 2 and name = 'price'", update_new="price > 4", delete="price = 1")
    assert [r[0] for r in rows.select(keep).collect()] == [False, True, False, True]


def test_topics_and_selectors(spark):
    assert one(spark, U.topic(F.lit("A b"), F.lit("ü"), "{schema}_{table}")) == "A_b__"
    assert one(spark, U.topic(F.lit("."), F.lit(""), "{schema}{table}")) == "_" and one(spark, U.topic(F.lit("x" * 300), F.lit(""), "{schema}")) == "x" * 249
    # a placeholder inside a name is not filled again
    assert one(spark, U.topic(F.lit("{table}"), F.lit("T"), "{schema}.{table}")) == "_table_.T"
    assert [U.topic_valid(t) for t in ("", "a.{schema}-b_{table}.c", "{table}", "{schema}{schema}", "{table}_{schema}", "a{b")] == [True, True, True, False, False, False]
    assert U.select_columns(["id", "a", "b"], ["*", "!b"], [["id"]]) == ["id", "a"]
    assert U.select_columns(["id", "a", "b"], ["*", "!id"], [["id"], ["a", "b"]]) == ["a", "b"]  # a unique key is enough
    for keys, used in (([["id"]], None), ([["a"]], ["id"])):
        with pytest.raises(ValueError):
            U.select_columns(["id", "a"], ["a"], keys, used)


def test_hashes_are_pinned(spark):
    crc = zlib.crc32(b"shopt") ^ zlib.crc32(b"id7") ^ zlib.crc32(b"nameq")
    assert one(spark, U.key_hash(F.lit("shop"), F.lit("t"), [("id", F.lit(7)), ("name", F.lit("q")), ("gone", F.lit(None).cast("string"))])) == crc
    want = zlib.crc32((7).to_bytes(8, "little") + (2).to_bytes(4, "little") + b"ab" + (-1).to_bytes(8, "little", signed=True))
    assert one(spark, S.row_checksum([("bigint", F.lit(7).cast("bigint")), ("string", F.lit("ab")), ("bigint", F.lit(-1).cast("bigint"))])) == want


def test_scalars(spark):
    assert one(spark, S.value_string(F.lit(1.5e-7), "double")) == "0.00000015" and one(spark, S.value_string(F.lit(1e10), "double")) == "10000000000"
    for v, text in ((1e-20, "0.00000000000000000001"), (1e30, "1" + "0" * 30), (-1.25e-9, "-0.00000000125"), (-0.0, "0"), (12345678.25, "12345678.25"), (1.5, "1.5"), (3.0, "3"), (123456789012345680.0, "123456789012345680")):
        assert one(spark, S.value_string(F.lit(v), "double")) == text
    assert one(spark, S.bits_to_int(F.unhex(F.lit("F" * 16)))) == 2**64 - 1
    assert one(spark, S.enum_name(F.lit(9), ["a"])) == "" and one(spark, S.set_names(F.lit(5), ["a", "b", "c"])) == "a,c"
    assert one(spark, S.rewrite_ddl(F.lit("alter table `a`.`t` add column x int"), F.lit("n"), F.lit("m"))) == "alter table `n`.`m` add column x int"
    assert one(spark, S.csv_quote(F.lit(None).cast("string"))) == "\\N"
    for codec in ("zstd", "lz4", "snappy", "gzip", "none"):
        df = spark.createDataFrame([(b"",), (b"abc" * 100,), (None,)], "b binary")
        assert [r[0] for r in df.select(S.decompress(codec)(S.compress(codec)("b"))).collect()] == [b"", b"abc" * 100, None]


T = Table("d", "t", (Col("id", "bigint", True, False), Col("s", "varchar"), Col("x", "bigint")))


def test_codecs_round_trip(spark):
    tricky = ['a"b', "c,d", "line\nend", "\\N\\", "", None, "日本", "'q'"]
    rows = [("I", 100 << 18, None, None, None, i, s, i * 7) for i, s in enumerate(tricky)] + [("U", 101 << 18, 1, "old", None, 1, "new", 5), ("D", 102 << 18, 2, 'x"', 3, None, None, None)]
    df = spark.createDataFrame(rows, "op string, commit_ts bigint, pre_id bigint, pre_s string, pre_x bigint, post_id bigint, post_s string, post_x bigint")
    want = sorted(map(tuple, df.collect()), key=repr)
    same = lambda d: sorted((tuple(r[c] for c in df.columns) for r in d.collect()), key=repr)
    assert same(E.canal_decode(df.select(E.canal_json(T, 1, extension="_ext").alias("b")), T, "b")) == want
    assert same(E.canal_decode(df.select(E.canal_json(T, 1, only_changed=True, extension="_ext").alias("b")), T, "b")) == want
    assert same(E.debezium_decode(df.select(E.debezium(T, with_schema=True).alias("b")), T, "b")) == want
    assert same(E.open_decode(df.select(E.open_key(T).alias("k"), E.open_value(T).alias("v")), T, "k", "v")) == want
    assert same(E.simple_decode(df.select(E.simple_json(T, 1).alias("b")), T, "b")) == want
    for c in (E.canal_json(T, 1), E.debezium(T, with_schema=True), E.simple_json(T, 1), E.open_value(T)):
        for r in df.select(c).collect():
            json.loads(r[0])


def test_batching(spark):
    df = spark.createDataFrame([(1, i, s) for i, s in enumerate([5, 5, 5, 100, 1, 1, 1, 1])], "k int, i int, s int")
    got = [r["batch"] for r in E.batch_messages(df, ["k"], [F.col("i")], F.col("s"), 12, 3).orderBy("i").collect()]
    assert got == [0, 0, 1, 2, 3, 3, 3, 4]


def test_schema_asof_and_drop(spark):
    ddl = spark.createDataFrame([(1, 10, "create table"), (1, 20, "add column"), (1, 30, "drop table"), (2, 5, "create table")], "table_id int, finished_ts bigint, kind string")
    rows = spark.createDataFrame([(1, 9), (1, 10), (1, 19), (1, 20), (1, 29), (1, 30), (1, 99), (2, 1000), (3, 1)], "table_id int, commit_ts bigint")
    v = SC.versions(ddl)
    for cells in (1, 4, 1000):
        got = sorted((r["table_id"], r["commit_ts"], r["version"]) for r in SC.asof_join(rows, v, "table_id", "commit_ts", cells).collect())
        assert got == [(1, 10, 1), (1, 19, 1), (1, 20, 2), (1, 29, 2), (2, 1000, 1)]
    assert [r["table_id"] for r in SC.snapshot(ddl, 25).orderBy("table_id").collect()] == [1, 2] and [r["table_id"] for r in SC.snapshot(ddl, 30).collect()] == [2]
    assert SC.asof_join(rows, v.limit(0), "table_id", "commit_ts").count() == 0


def test_spans(spark):
    a = spark.createDataFrame([(1, 0, 10), (2, 10, 20), (3, 500, 900)], "id int, lo bigint, hi bigint")
    b = spark.createDataFrame([(7, 5, 15), (8, 600, 601), (9, 20, 30)], "id int, lo bigint, hi bigint")
    for width in (3, 100, 10_000):
        assert sorted(map(tuple, P.intersect_spans(a, b, width).collect())) == [(1, 7, 5, 10), (2, 7, 10, 15), (3, 8, 600, 601)]
    s = a.withColumn("t", F.lit(1)).withColumn("ts", F.col("id"))
    assert [tuple(r) for r in P.coverage(s, ["t"]).collect()] == [(1, 0, 900, 1, 480)]
    assert sorted((r["lo"], r["hi"], r["ts"], r["n_spans"]) for r in P.merge_spans(s, ["t"]).collect()) == [(0, 20, 1, 2), (500, 900, 3, 1)]


@pytest.mark.parametrize("block", [2, 65_536])
def test_spans_over_blocks(spark, monkeypatch, block):
    monkeypatch.setattr(O, "BLOCK_ROWS", block)
    rng = random.Random(8)
    rows = [(rng.choice([None, 1, 2]), lo, lo + rng.randint(1, 9), i) for i, lo in enumerate(rng.sample(range(300), 90))]
    want, holes = [], []
    for t in (None, 1, 2):
        own, top = sorted(r[1:] for r in rows if r[0] == t), None
        n = 0
        for lo, hi, ts in own:
            if top is None or lo > top:
                n += top is not None
                want.append([t, lo, hi, ts, 1])
                top = hi
            else:
                w = want[-1]
                top = max(top, hi)
                w[2], w[3], w[4] = top, min(w[3], ts), w[4] + 1
        holes.append((t, n))
    df = spark.createDataFrame(rows, "t int, lo int, hi int, ts int").repartition(3)
    assert sorted(map(tuple, P.merge_spans(df, ["t"]).collect()), key=repr) == sorted(map(tuple, want), key=repr)
    assert sorted(((r["t"], r["holes"]) for r in P.coverage(df, ["t"]).collect()), key=repr) == sorted(holes, key=repr)


def test_resolved_buffer_over_batches(spark):
    buffer = ST.ResolvedBuffer(spark, "k int, commit_ts bigint")
    batch = lambda rows: spark.createDataFrame(rows, "kind string, k int, commit_ts bigint")
    buffer(batch([("row", 1, 10), ("row", 2, 30), ("resolved", 0, 15)]), 0)
    buffer(batch([("row", 3, 12), ("row", 4, 20)]), 1)  # 12 is late
    buffer(batch([("resolved", 0, 5), ("row", 5, 40)]), 2)
    buffer(batch([("resolved", 0, 30)]), 3)
    buffer(batch([("resolved", 0, 30)]), 3)  # once more
    got = sorted((r["version"], r["k"]) for r in buffer.released().collect())
    assert got == [(0, 1), (3, 2), (3, 4)]


def test_resolved_buffer_goes_on_after_a_restart(spark, tmp_path):
    batch = lambda rows: spark.createDataFrame(rows, "kind string, k int, commit_ts bigint")
    new = lambda: ST.ResolvedBuffer(spark, "k int, commit_ts bigint", str(tmp_path / "b"))
    new()(batch([("row", 1, 10), ("row", 2, 30), ("resolved", 0, 15)]), 0)
    new()(batch([("row", 3, 12), ("resolved", 0, 40)]), 1)
    assert sorted((r["version"], r["k"]) for r in new().released().collect()) == [(0, 1), (1, 2)]
    assert [r["k"] for r in new().late().collect()] == [3] and new().last_batch() == 1


def test_table_sink_over_batches(spark, tmp_path):
    """Batches out of order, one of them twice; then all versions in one."""
    from changeloom.streaming import upsert

    schema = "k int, commit_ts bigint, start_ts bigint, op string, v int"
    path, job = str(tmp_path / "in"), str(tmp_path / "job")
    put = lambda rows: spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)
    run = lambda: W.apply_to_table(spark, spark.readStream.schema(schema).parquet(path), {"k": "int"}, {"v": "int"}, O.op_order(), job)
    put([(1, 20, 1, "U", 11), (2, 20, 1, "D", None), (3, 20, 1, "I", 30)])
    run()
    put([(1, 10, 1, "I", 10), (2, 10, 1, "I", 20), (1, 20, 1, "U", 11)])
    assert sorted(map(tuple, run().collect())) == [(1, 11), (3, 30)]
    shape = "struct<v: int>"
    upsert.compact(spark, f"{job}/versions", {"k": "int"}, shape)
    upsert.compact(spark, f"{job}/versions", {"k": "int"}, shape)
    now = upsert.current_rows(spark, f"{job}/versions", {"k": "int"}, shape)
    assert sorted((r["k"], r["payload"]["v"]) for r in now.collect()) == [(1, 11), (3, 30)]
    put([(3, 30, 1, "D", None), (4, 30, 1, "I", 40)])
    assert sorted(map(tuple, run().collect())) == [(1, 11), (4, 40)]


def test_changefeed_state_is_kept(spark, data, tmp_path):
    redo = spark.read.parquet(f"{data}/redo_dml.parquet")
    root, mid = str(tmp_path / "feed"), redo.agg(F.percentile_approx("commit_ts", 0.5)).first()[0]
    new = lambda: Changefeed.create(spark, ChangefeedConfig("file:///x"), root)
    assert new().run(redo, resolved_ts=mid) == mid
    again = new()
    assert again.checkpoint_ts == mid and again.batch == 1
    again.batch = 0  # a run that was cut off before its state was kept
    again.checkpoint_ts = 0
    again.run(redo, resolved_ts=mid)
    new().run(redo)
    assert spark.read.parquet(root).count() == redo.count() and new().batch == 2


def test_scan_window_rules():
    from changeloom.operators.sequence import START_MS, ScanWindow

    w = ScanWindow()
    assert w.add(0, 95) == START_MS // 4 and w.add(1000, 5) == 1000  # the largest of the window counts
    w = ScanWindow()
    for t in range(0, 30_000, 1000):
        last = w.add(t, 5)
    assert last == START_MS * 3 // 2 and w.add(30_000, 5) == last  # grew once, then waits
    w = ScanWindow()
    got = [w.add(t * 1000, 31 + 4 * t) for t in range(9)]
    assert got[:3] == [START_MS] * 3 and got[3:8] == [4500] * 5 and got[8] == 4050  # a rising usage damps every 5 s
    w = ScanWindow(most_ms=5_500)
    assert [w.add(t, 15) for t in range(0, 90_000, 1000)][-1] == 5_500


def test_changefeed(spark, data, tmp_path):
    redo = spark.read.parquet(f"{data}/redo_dml.parquet")
    with pytest.raises(ValueError):
        Changefeed.create(spark, ChangefeedConfig("ftp://x"))
    with pytest.raises(ValueError):
        Changefeed.create(spark, ChangefeedConfig("file:///x", start_ts=5, target_ts=5))
    feed = Changefeed.create(spark, ChangefeedConfig("kafka://x/y", topics=(("bank.*", "{schema}_{table}"),)))
    root = str(tmp_path / "out")
    feed.run(redo, root)
    assert spark.read.json(root).count() == redo.count()
    feed.run(redo, root)
    assert spark.read.json(root).count() == redo.count()
    feed.pause()
    with pytest.raises(RuntimeError):
        feed.run(redo, root)
    feed.resume()
    s = feed.status()
    assert s["state"] == "normal" and s["checkpoint_ts"] == redo.agg(F.max("commit_ts")).first()[0]
    assert feed.synced(s["checkpoint_ms"] + 1000) == "still writing"
    assert feed.verify_table(redo).where("not has_key").count() == 0


def test_storage_layout(spark):
    from changeloom.sources import files as SF

    paths = ["a/b/12/CDC000001.json", "x/a/b/12/3/2024-01-02/CDC000007.csv", "a/b/12/2024-01/CDC000002.json", "a/b/meta/schema_1.json"]
    got = [tuple(r) for r in spark.createDataFrame([(p,) for p in paths], "p string").select(*SF.path_columns(F.col("p"))).collect()]
    assert [tuple(r) for r in spark.createDataFrame([("a/b/12/2024/CDC000002.csv",)], "p string").select(*SF.path_columns(F.col("p"), False)).collect()] == [("a", "b", 12, None, "2024", 2, "csv")]
    assert got == [("a", "b", 12, None, None, 1, "json"), ("a", "b", 12, 3, "2024-01-02", 7, "csv"), ("a", "b", 12, None, "2024-01", 2, "json"), (None,) * 7]


def brute_fold(rows):
    """The fold of one key's rows by the rules, one run at a time."""
    out, run = [], []
    for r in rows:
        run.append(r)
        if r[2] == "D":
            out.append(run)
            run = []
    if run:
        out.append(run)
    got = []
    for i, run in enumerate(out):
        first, last = run[0], run[-1]
        op = "D" if last[2] == "D" else "I" if first[2] == "I" else "U"
        updates = [r for r in run if r[2] == "U"]
        pre = updates[-1][3] if op == "D" and first[2] == "U" else None if op == "I" else last[3]
        got.append((last[0], i, op, last[1], pre, last[4]))
    return got


@pytest.mark.parametrize("block", [1, 4, 65_536])
def test_fold_over_blocks(spark, monkeypatch, block):
    monkeypatch.setattr(O, "BLOCK_ROWS", block)
    rng = random.Random(block)
    rows, want = [], []
    for k in [None, 1, 2, 3]:
        own, alive = [], rng.random() < 0.5
        for n in range(rng.choice([1, 5, 40])):
            op = rng.choice("UUD") if alive else "I"
            alive = op != "D"
            own.append((k, n, op, None if op == "I" else n * 10, None if op == "D" else n * 10 + 1))
        rows += own
        want += brute_fold(own)
    df = spark.createDataFrame(rows, "k int, n int, op string, pre int, post int").repartition(3)
    got = [tuple(r)[:6] for r in C.fold_runs(df, ["k"], ["n"], "pre", "post").collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_split_of_a_hot_transaction(spark):
    rows = [(1, 0, "I", i) for i in range(1000)] + [(2, 0, "D", 5), (None, 0, "U", 1)]
    df = spark.createDataFrame(rows, "commit_ts bigint, start_ts bigint, op string, k int").repartition(5)
    got = {(r["commit_ts"], r["k"]): r["part"] for r in O.split_transactions(df, ["k"], 256).collect()}
    assert got == {(1, i): i // 256 for i in range(1000)} | {(2, 5): 0, (None, 1): 0}


def test_codec_values_of_odd_types(spark):
    one_of = lambda kind, value, **kw: one(spark, E.debezium_value(Col("x", kind, **kw), value))
    assert one_of("bit", F.lit(1), bits=1) is True and one_of("bit", F.lit(258), bits=16) == "AgE="
    assert one_of("timestamp", F.lit("2024-01-02 03:04:05.678").cast("timestamp"), digits=3) == "2024-01-02T03:04:05.678Z"
    assert one_of("datetime", F.lit("1970-01-01 00:00:01.000002").cast("timestamp"), digits=6) == 1_000_002
    assert one_of("date", F.lit("1969-12-31").cast("date")) == -1 and one_of("enum", F.lit(9), elements=("a",)) == ""
    assert one_of("enum", F.lit(None).cast("int"), elements=("a",)) is None
    assert one(spark, E.csv_cell(Col("x", "set", elements=("a", "b")), F.lit(None).cast("int"))) == "\\N"
    assert one(spark, E.text(Col("x", "blob"), F.unhex(F.lit("E9")))) == "é"


def test_table_checksums_are_pinned(spark):
    d = E.table_definition(T, "CREATE TABLE t", 3, 100)
    text = """{
    "Table": "t",
    "Schema": "d",
    "Version": 0,
    "TableColumns": [
        {
            "ColumnName": "id",
            "ColumnType": "BIGINT",
            "ColumnNullable": "false",
            "ColumnIsPk": "true"
        },
        {
            "ColumnName": "s",
            "ColumnType": "VARCHAR"
        },
        {
            "ColumnName": "x",
            "ColumnType": "BIGINT"
        }
    ],
    "TableColumnsTotal": 3
}"""
    assert E.definition_checksum(d) == zlib.crc32(text.encode()) == E.definition_checksum(d | {"TableVersion": 7, "Query": "x", "TableColumns": d["TableColumns"][::-1]})
    rows = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "k int, s string")
    got = rows.agg(F.bit_xor(F.crc32(F.encode(F.concat_ws(",", "k", F.coalesce("s", F.lit(""))), "UTF-8")))).first()[0]
    assert got == zlib.crc32(b"1,a") ^ zlib.crc32(b"2,b") ^ zlib.crc32(b"3,")


def test_batches_of_hot_keys(spark, monkeypatch):
    """Blocks and the plain fold give the same greedy batches."""
    rng = random.Random(8)
    rows = [(rng.choice(["a", "a", "b", None]), i, rng.choice([1, 5, 9, 40, None])) for i in range(700)]
    df = spark.createDataFrame(rows, "k string, i int, s int")
    run = lambda: {(r["k"], r["i"], r["batch"]) for r in E.batch_messages(df, ["k"], [F.col("i")], F.col("s"), 30, 7).collect()}
    want, state = set(), {}
    for k, i, s in rows:
        batch, used, n = state.get(k, (0, 0, 0))
        if n and (used + (s or 0) > 30 or n == 7):
            batch, used, n = batch + 1, 0, 0
        state[k] = batch, used + (s or 0), n + 1
        want.add((k, i, batch))
    assert run() == want
    monkeypatch.setattr(O, "HOT_ROWS", 1)
    monkeypatch.setattr(E, "BLOCK_ROWS", 28)
    assert run() == want


def test_counter_mode_known_answer(spark):
    """The published example of AES-256 in counter mode (SP 800-38A, F.5.5)."""
    key, iv = "603deb1015ca71be2b73aef0857d77811f352c073b6108d72d9810a30914dff4", "f0f1f2f3f4f5f6f7f8f9fafbfcfdfeff"
    text = "6bc1bee22e409f96e93d7e117393172aae2d8a571e03ac9c9eb76fac45af8e5130c81c46a35ce411e5fbc1191a0a52eff69f2445df4f9b17ad2b417be66c3710"
    want = "601ec313775789a5b7a7f504bbf3d228f443e3ca4d62b59aca84e990cacaf5c52b0930daa23de94ce87017ba2d84988ddfc9c58db67aada613c2dd08457941a6"
    b = lambda h: F.unhex(F.lit(h))
    frame = S.encrypt(b(text), b(key), b(iv), 1, b"abc")
    assert bytes(one(spark, frame)).hex() == "01616263" + iv + want
    assert bytes(one(spark, S.decrypt(frame, b(key)))).hex() == text
    for n in (0, 1, 15, 16, 17):
        data = bytes(range(n))
        assert bytes(one(spark, S.decrypt(S.encrypt(F.lit(data), b(key), b("f" * 32), 2, b"xyz"), b(key)))) == data
    assert bytes(one(spark, S.decrypt(F.lit(b"\0abcplain"), b(key)))) == b"plain" and one(spark, S.decrypt(F.lit(b"x"), b(key))) is None


def test_hot_keys_are_ordered_in_blocks(spark, monkeypatch):
    """The block form of every ordered pass equals the window form."""
    rng = random.Random(4)
    rows = [(rng.choice([None, 1, 1, 1, 2, 3]), i, rng.choice("IUD"), rng.choice([None, 1, 2, 3])) for i in range(400)]
    df = spark.createDataFrame(rows, "k int, n int, op string, v int")
    order = [F.col("n")]

    def results():
        yield O.place_in_key(df, ["k"], order, "p")
        yield O.with_previous(df, ["k"], order, ["op"])
        yield O.last_known(df, ["k"], order, F.col("v"), "p")
        yield O.sum_before(df, ["k"], order, F.col("v"), "p")
        yield C.fold_runs(df.withColumn("w", F.col("v") + 1), ["k"], ["n"], "v", "w")
        yield O.schema_batches(df.select(F.col("k").alias("table_id"), F.col("n").alias("commit_ts"), F.lit(1).alias("start_ts"), F.col("n").alias("ref"), "v"), "v")

    plain = [sorted(map(repr, map(tuple, x.select(*sorted(x.columns)).collect()))) for x in results()]
    monkeypatch.setattr(O, "HOT_ROWS", 100)
    monkeypatch.setattr(O, "BLOCK_ROWS", 16)
    assert [sorted(map(repr, map(tuple, x.select(*sorted(x.columns)).collect()))) for x in results()] == plain


def test_storage_files(spark, tmp_path):
    from changeloom.sources import files as SF

    root = str(tmp_path / "out")
    rows = spark.createDataFrame([(f"r{i}", "d b", "t", 7, i) for i in range(25)], "line string, schema string, table string, version int, n int")
    d = E.table_definition(T, "CREATE TABLE t", 3, 7)
    assert W.write_storage(rows.where("n < 20"), root, "line", ["schema", "table", "version"], [F.col("n")], 10, "csv", 99, {("d b", "t", 7): d}) >= 2
    W.write_storage(rows.where("n >= 20"), root, "line", ["schema", "table", "version"], [F.col("n")], 10, "csv")
    names = sorted(p.name for p in (tmp_path / "out/d b/t/7").glob("CDC*"))
    assert names == [f"CDC{i + 1:06d}.csv" for i in range(len(names))]
    assert (tmp_path / "out/d b/t/7/meta/CDC.index").read_text() == names[-1] + "\n"
    assert json.loads((tmp_path / "out/metadata").read_text()) == {"checkpoint-ts": 99}
    schema = tmp_path / f"out/d b/t/meta/schema_7_{E.definition_checksum(d):010d}.json"
    assert json.loads(schema.read_text()) == d and not list((tmp_path / "out").glob("_staging*"))
    lines = [(tmp_path / "out/d b/t/7" / n).read_text().split() for n in names]
    assert [x for part in lines for x in part] == [f"r{i}" for i in range(25)]
    back = SF.read_storage(spark, root)
    assert back.count() == 25 and {tuple(r) for r in back.select("schema", "table", "version").distinct().collect()} in ({("d b", "t", 7)}, {("d%20b", "t", 7)})


def test_avro_binary_edges(spark):
    table = Table("d", "t", (Col("id", "bigint", True, False), Col("s", "varchar"), Col("x", "bigint")))
    values = [(0, "", None), (-1, "é𝄞" * 100, 1), (2**63 - 1, None, -(2**63)), (-(2**63), "a", 63), (64, "b", -64)]
    df = spark.createDataFrame([("I", *v) for v in values] + [("D", 1, None, None)], "op string, post_id bigint, post_s string, post_x bigint")
    frames = df.select(E.avro_frame(F.lit(5), E.avro_binary(table)).alias("f"))
    got = frames.select(E.avro_decode(E.avro_schema(table))(F.col("f")).alias("x")).select("x.*").collect()
    assert [(r["schema_id"], r["record"] and tuple(json.loads(r["record"]).values())) for r in got] == [(5, v) for v in values] + [(None, None)]
    first = bytes(frames.first()["f"])
    assert first.hex() == "0000000005" + "00" + "0200" + "00"
    cut = spark.createDataFrame([(first[:6],), (b"\1" + first[1:],), (b"",)], "f binary").select(E.avro_decode(E.avro_schema(table))(F.col("f")).alias("x"))
    assert [r["x"]["record"] for r in cut.collect()] == [None] * 3


def test_ddl_kinds_and_multi_table_jobs(spark):
    from changeloom.operators import ddl

    assert len(ddl.KINDS) == 40
    schema = "job int, finished_ts bigint, schema_version int, kind string, schema_id int, table_id int, ids array<bigint>"
    jobs = spark.createDataFrame([
        (1, 10, 1, "create table", 1, 7, [70, 71]), (2, 20, 2, "exchange partition", 1, 7, [71, 90]), (3, 30, 3, "create table", 2, 8, [8]),
        (4, 40, 4, "drop schema", 1, 7, None), (5, 50, 5, "create view", 2, 8, [8]), (6, 60, 6, "add column", 2, 8, [8]), (7, 70, 7, "no such kind", 2, 8, [8])], schema)
    got = {(r["target"], r["job"]) for r in ddl.history(jobs).collect()}
    assert got == {(-1, 1), (70, 1), (71, 1), (-1, 2), (70, 2), (7, 2), (-1, 3), (8, 3), (-1, 4), (71, 4), (90, 4), (-1, 5), (8, 5), (8, 6)}
    assert {(r["job"], r["reason"]) for r in ddl.skip_reason(jobs.unionByName(jobs.where("job = 3"))).where("reason is not null").collect()} == {(3, "repeated"), (7, "unknown")}
    assert ddl.history(jobs.limit(0)).count() == ddl.versions(jobs.limit(0)).count() == 0
