"""Schema changes of tables with very many physical ids."""

import os
import random

import pytest

from changeloom import session
from changeloom.operators import ddl

SCHEMA = "job int, finished_ts bigint, schema_version int, kind string, schema_id int, table_id int, ids array<bigint>"


@pytest.fixture
def stored(spark):
    """Bytes stored below the shared folder since the test began."""
    root = session.work_path(spark, "").removeprefix("file:")
    size = lambda: sum(os.path.getsize(os.path.join(at, f)) for at, _, fs in os.walk(os.path.dirname(root)) for f in fs)
    before = size()
    return lambda: size() - before


def large(spark):
    """100 jobs on a table of 20,000 to 20,099 partitions."""
    kind = "CASE WHEN id = 0 THEN 'create table' WHEN id % 2 = 0 THEN 'add column' ELSE 'add partition' END"
    return spark.sql(f"SELECT int(id) AS job, id * 10 AS finished_ts, int(id) AS schema_version, {kind} AS kind, 1 AS schema_id, 7 AS table_id, sequence(1L, 20000L + id) AS ids FROM range(100)")


def odd_jobs(spark):
    """Ids with gaps, in any order, kept by several tables, gone and back."""
    r = random.Random(5)
    kinds = ["create table", "drop table", "truncate table", "add partition", "exchange partition", "rename table", "add column", "create view", "modify schema charset", "lock table", None]
    rows = []
    for j in range(150):
        ids = r.choice([None, [], r.sample(range(30), r.randrange(1, 12)), list(range(r.randrange(20), 25)), [40, 42, 44]])
        rows.append((j, j // 2, j if j % 5 else j - 3, r.choice(kinds), r.randrange(2), r.choice([1, 2, 2, 3]), ids))
    return spark.createDataFrame(rows, SCHEMA), rows


def states(rows):
    """(row, ids before, ids after) in the order of jobs."""
    last = {}
    for x in sorted(rows, key=lambda x: (x[1], x[0])):
        yield x, set(last.get(x[5]) or []), set(x[6] or [])
        last[x[5]] = x[6]


def in_kind(x, test):
    return x[3] in ddl.KINDS and test(ddl.KINDS[x[3]])


def test_skip_reason_stores_spans(spark, stored):
    assert ddl.skip_reason(large(spark)).where("reason is null").count() == 100
    assert stored() < 1_000_000


def test_skip_reason_of_odd_ids(spark):
    jobs, rows = odd_jobs(spark)
    seen, first, want = None, [], {}
    for x in sorted(rows, key=lambda x: (x[1], x[0], x[2])):
        if seen is not None and x[2] <= seen:
            want[x[0]] = "repeated" if x[3] is None or x[3] in ddl.KINDS else "unknown"
        else:
            first.append(x)
        seen = x[2] if seen is None else max(seen, x[2])
    for x, before, _ in states(first):
        want[x[0]] = "unknown" if x[3] and x[3] not in ddl.KINDS else "exists" if x[3] == "create table" and before else "missing" if x[3] == "drop table" and not before else None
    got = ddl.skip_reason(jobs).collect()
    assert {r["job"]: r["reason"] for r in got} == want and len(got) == len(rows)
    # the ids come back as they were
    assert {r["job"]: r["ids"] for r in got} == {x[0]: x[6] for x in rows}


def test_effects_store_spans(spark, stored):
    rows = ddl.effects(large(spark)).select("job", ddl.listed("created").alias("created"), ddl.listed("dropped").alias("dropped")).collect()
    assert {(r["job"], len(r["created"]), len(r["dropped"])) for r in rows} == {(0, 20000, 0)} | {(j, 1, 0) for j in range(1, 100)}
    assert stored() < 1_000_000


def test_effects_of_odd_ids(spark):
    jobs, rows = odd_jobs(spark)
    got = ddl.effects(jobs).select("job", *[ddl.listed(c).alias(c) for c in ("before", "after", "created", "dropped")]).collect()
    assert {r["job"]: [set(r[c]) for c in ("before", "after", "created", "dropped")] for r in got} == {x[0]: [b, a, a - b, b - a] for x, b, a in states(rows)}
    assert all(len(set(r[c])) == len(r[c]) for r in got for c in ("before", "after", "created", "dropped"))


def test_without_many_spans(spark):
    a, b = list(range(0, 200, 2)), list(range(0, 200, 3))
    r = spark.createDataFrame([(a, b)], "a array<bigint>, b array<bigint>").select(ddl.listed(ddl.without(ddl.spans("a"), ddl.spans("b"))).alias("x"), ddl.listed(ddl.spans("b")).alias("b")).first()
    assert r["x"] == [i for i in a if i % 3] and r["b"] == b


def test_versions_store_spans(spark, stored):
    v = ddl.versions(large(spark))
    # 1 + 2 + ... of each of the ids
    assert v.agg({"*": "count", "version": "sum"}).first()[:] == (sum(20000 + j for j in range(100)), 20000 * 5050 + sum((100 - j) * (101 - j) // 2 for j in range(1, 100)))
    assert stored() < 5_000_000


@pytest.mark.parametrize("block", [4, 1024])
def test_versions_of_odd_ids(spark, monkeypatch, block):
    monkeypatch.setattr(ddl, "BLOCK_JOBS", block)
    jobs, rows = odd_jobs(spark)
    events = {}
    for x, before, after in states(rows):
        if in_kind(x, lambda k: k.versions):
            for t in after | (before - after):
                events.setdefault(t, []).append((x[1], x[0], t not in after))
    want = set()
    for t, es in events.items():
        n = 0
        for k, (ts, _, end) in enumerate(es):
            n += not end
            if not end:
                want.add((t, ts, es[k + 1][0] if k + 1 < len(es) else None, n))
    got = [tuple(r) for r in ddl.versions(jobs).select("target", "from_ts", "to_ts", "version").collect()]
    assert set(got) == want and len(got) == len(want)


def test_history_stores_spans(spark, stored):
    h = ddl.history(large(spark))
    # the trigger's of 51 jobs, before of 49 and after of 51
    assert h.count() == 51 + sum(20000 + j - 1 for j in range(2, 100, 2)) + sum(20000 + j for j in (0, *range(1, 100, 2)))
    assert stored() < 1_000_000


def test_history_of_odd_ids(spark):
    jobs, rows = odd_jobs(spark)
    want, lives, ends = set(), {}, {}
    for x, before, after in states(rows):
        enters = lambda name: in_kind(x, lambda k: name in k.targets)
        parts = (("trigger", {ddl.TRIGGER}), ("before", before), ("after", after), ("gone", before - after), ("table", {x[5]}))
        want |= {(t, x[1], x[0]) for name, ids in parts if enters(name) for t in ids}
        for t in after:
            lives.setdefault((x[4], x[5], t), x[1])
        for t in before - after:
            ends.setdefault((x[5], t), x[1])
    for x in rows:
        for (schema, table, t), at in lives.items():
            to = ends.get((table, t))
            if at <= x[1] and (to is None or to >= x[1]) and (in_kind(x, lambda k: "all" in k.targets) or in_kind(x, lambda k: "schema" in k.targets) and schema == x[4]):
                want.add((t, x[1], x[0]))
    got = [tuple(r) for r in ddl.history(jobs).select("target", "finished_ts", "job").collect()]
    assert set(got) == want and len(got) == len(want)
    # a job that is there twice enters once
    assert {tuple(r) for r in ddl.history(jobs.where("table_id = 3").union(jobs.where("table_id = 3"))).select("target", "finished_ts", "job").groupBy("target", "finished_ts", "job").count().where("count > 1").collect()} == set()
