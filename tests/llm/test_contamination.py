import random

import pytest
from pyspark.sql import functions as F

from changeloom.llm import contamination as C
from changeloom.llm import queries as Q


def brute(docs, items, n=12):
    out = set()
    for d, text in docs:
        words = C.WORD.findall((text or "").lower())
        for i, t in items:
            w = C.WORD.findall((t or "").lower())
            if not w:
                continue
            k = min(n, len(w))
            grams = {tuple(w[a : a + k]) for a in range(len(w) - k + 1)}
            if any(tuple(words[a : a + k]) in grams for a in range(len(words) - k + 1)):
                out.add((d, i))
    return out


def pairs(df):
    return {(r["doc_id"], r["item_id"]) for r in df.select("doc_id", "item_id").collect()}


DOC, ITEM = "doc_id bigint, text string, item_id bigint", "item_id bigint, item_text string, doc_id string"


def frames(spark, docs, items):
    # clashing extra columns on both sides
    return (
        spark.createDataFrame([(d, t, 1) for d, t in docs], DOC),
        spark.createDataFrame([(i, t, "x") for i, t in items], ITEM),
    )


def test_random_texts(spark):
    rng = random.Random(3)
    words = ["a", "b", "c", "dd"]
    docs = [(i, " ".join(rng.choice(words) for _ in range(rng.randint(0, 80)))) for i in range(60)]
    items = [(i, " ".join(rng.choice(words) for _ in range(rng.randint(0, 20)))) for i in range(40)]
    d, i = frames(spark, docs, items)
    for n in (3, 5, 12):
        for shard in (40, 1_000_000):
            assert pairs(C.leaked(d, i, C.LeakPlan(min_words=n, shard_words=shard))) == brute(docs, items, n)
    assert pairs(C.longest_matches(d, i, C.LeakPlan(min_words=5))) == brute(docs, items, 5)
    # many blocks of items: one scan of the documents, or a scan for every two blocks
    many = C.leaked(d, i, C.LeakPlan(min_words=5, block_bytes=100))
    assert pairs(many) == brute(docs, items, 5) and many._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
    few = C.LeakPlan(min_words=5, block_bytes=300, scan_blocks=2, shard_words=50)
    assert pairs(C.leaked(d, i, few)) == brute(docs, items, 5)
    bad = {x for x, _ in brute(docs, items, 5)}
    assert {r["doc_id"] for r in C.without_leaks(d, i, few).collect()} == {x for x, _ in docs} - bad


def test_edges(spark):
    passage = " ".join(f"w{k}" for k in range(15))
    docs = [(1, None), (2, ""), (3, "?!"), (4, f"x {passage.upper().replace(' ', '--')} y"), (4, f"{passage}"), (5, "w0 " * 30),
            (None, passage), (6, "deep question here"), (7, "deep question"), (8, ("z " * 200_000) + passage)]
    items = [(1, passage), (2, None), (3, ""), (4, "Deep question, here?"), (1, passage), (5, "...")]
    d, i = frames(spark, docs, items)
    assert pairs(C.leaked(d, i)) == {(4, 1), (6, 4), (8, 1), (None, 1)}
    rows = {(r["doc_id"], r["n_words"], r["doc_word"], r["item_word"]) for r in C.longest_matches(d, i).collect() if r["item_id"] == 1}
    assert rows == {(4, 15, 1, 0), (4, 15, 0, 0), (8, 15, 200_000, 0), (None, 15, 0, 0)}
    assert C.leaked(d.limit(0), i).count() == 0 and C.leaked(d, i.limit(0)).count() == 0
    clean = C.without_leaks(d, i)
    assert clean.schema == d.schema and [tuple(r)[:2] for r in clean.collect()] == [x for x in docs if x[0] in (1, 2, 3, 5, 7)]
    assert pairs(C.leaked(d, spark.createDataFrame([(None, passage, "x")], ITEM))) == {(4, None), (8, None), (None, None)}


def test_longest_match(spark):
    item = " ".join(f"v{k}" for k in range(40))
    doc = "q " + " ".join(f"v{k}" for k in range(5, 30)) + " r " + " ".join(f"v{k}" for k in range(20, 40))
    d, i = frames(spark, [(1, doc)], [(9, item)])
    r = C.longest_matches(d, i).first()
    assert (r["n_words"], r["doc_word"], r["item_word"]) == (25, 1, 5)


def test_test_data(spark, data):
    docs = [(r[0], r[1]) for r in spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text").collect()]
    items = [(r[0], r[1]) for r in spark.read.parquet(f"{data}/eval_item.parquet").select("item_id", "item_text").collect()]
    found = pairs(Q.p7_found(spark, data))
    assert found == brute(docs, items) and found
