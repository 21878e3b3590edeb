import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from changeloom.llm import packing as P
from changeloom.llm import queries as Q


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 100), min_size=0, max_size=300), st.integers(2, 40))
def test_capacity_holds(sizes, classes):
    z = np.array(sizes, np.int64)
    b = P.harmonic_pack(z, 100, classes)
    used = np.bincount(b, z) if len(z) else np.zeros(0)
    assert len(b) == len(z) and (used <= 100).all() and (used > 0).all()
    if len(z):
        # harmonic packing needs at most 1.7 times the least number and a few open ones
        assert len(used) <= 1.7 * -(-int(z.sum()) // 100) + classes + 1


def test_little_room_unused():
    rng = np.random.default_rng(1)
    z = np.minimum(8192, np.exp(rng.normal(6.2, 1.0, 20_000)).astype(np.int64) + 1)
    b = P.harmonic_pack(z, 8192, 64)
    assert z.sum() / (8192 * (b.max() + 1)) > 0.97


def test_edges(spark):
    long = "word " * 500
    rows = [(1, None, 9), (2, "", 9), (3, "one two", 9), (3, "one two", 9), (4, long, 9), (None, "three", 9), (5, "é𝄞" * 40, 9)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, container int")
    plan = P.PackPlan(capacity=64, classes=8, group_rows=3)
    out = P.pack(df, plan).collect()
    enc = P.encoding(plan.tokenizer)
    want = sorted((d or -1, len(enc.encode_ordinary(t))) for d, _, t in [(r[0], r[2], r[1] or "") for r in rows])
    ids = [(r["doc_id"] or -1) for r in out if r["piece"] == 0]
    assert sorted(ids) == [d for d, _ in want]
    total = {}
    for r in out:
        total[r["doc_id"] or -1] = total.get(r["doc_id"] or -1, 0) + r["n_tokens"]
    assert total[4] == len(enc.encode_ordinary(long)) and total[3] == 2 * len(enc.encode_ordinary("one two"))
    assert {r["doc_id"] for r in out if r["piece"] > 0} == {d for d, n in want if n > 64}
    used = {}
    for r in out:
        used[r["worker"], r["container"]] = used.get((r["worker"], r["container"]), 0) + r["n_tokens"]
    assert max(used.values()) <= 64
    assert all(r["first_token"] == 64 * r["piece"] for r in out)
    assert {(r["n_tokens"], r["container"]) for r in out if r["doc_id"] in (1, 2)} == {(0, 0)}
    assert P.pack(df.limit(0), plan).count() == 0


def test_test_data(spark, data):
    r = Q.p6_fill(spark, data).first()
    assert r["fullest"] <= 8192 and r["fill"] > 0.9
