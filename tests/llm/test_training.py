import numpy as np

from changeloom.llm import ngram
from changeloom.llm import reading_level as R


def test_all_passages_train(spark, monkeypatch):
    monkeypatch.setattr(R, "LevelScorer", lambda texts, levels, plan: (texts, levels))
    n = 20_500
    rows = spark.range(n).selectExpr(f"{n} - 1 - id AS passage_id", f"concat('p', {n} - 1 - id) AS passage", f"CASE WHEN {n} - 1 - id < 20000 THEN 1 ELSE 2 END AS grade")
    texts, levels = R.train(rows.repartition(7))
    assert texts == [f"p{i}" for i in range(n)] and levels == [1] * 20_000 + [2] * (n - 20_000)


def test_models_are_counts():
    texts = [ngram.tokens(t) for t in ("we see the red cat", "the cat sees the dog.", "", "a dog sees the cat", "the")]
    levels = [1, 1, 1, 3, 2]
    m = ngram.LevelModels(texts, levels, 2)
    for n, ((keys, full), (heads, context)) in enumerate(m.tables, 1):
        want, pairs = {}, {}
        for t, g in zip(texts, levels):
            ids = m.vocab.encode(t)
            for x, h in zip(ngram._grams(ids, n).tolist(), m._contexts(ids, n).tolist()):
                want.setdefault(x, np.zeros(3))[g - 1] += 1
                pairs.setdefault(h, [np.zeros(3), [set(), set(), set()]])
                pairs[h][0][g - 1] += 1
                pairs[h][1][g - 1].add(x)
        assert keys.tolist() == sorted(want) and heads.tolist() == sorted(pairs)
        assert (full == [*(want[x] for x in keys.tolist()), np.zeros(3)]).all()
        assert (context == [*(np.r_[pairs[h][0], [len(s) for s in pairs[h][1]]] for h in heads.tolist()), np.zeros(6)]).all()
