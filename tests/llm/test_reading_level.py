import numpy as np

from changeloom.llm import ngram
from changeloom.llm import queries as Q
from changeloom.llm import reading_level as R


def test_isotonic_is_monotone_and_least_squares():
    x, y = np.array([1.0, 2, 3, 4, 5]), np.array([1.0, 3, 2, 4, 3])
    kx, ky = ngram.isotonic(x, y)
    assert np.allclose(np.interp(x, kx, ky), [1, 2.5, 2.5, 3.5, 3.5]) and (np.diff(ky) >= 0).all()


def test_probabilities_sum_to_one():
    texts = [ngram.tokens(t) for t in ("we see the red cat", "the cat sees the dog.", "a dog")]
    m = ngram.LevelModels(texts, [1, 1, 2])
    words = [*m.vocab.ids, "\x00unseen"]
    for head in (["the"], ["see", "the"], ["nothing", "known"]):
        p = sum(2 ** -m.surprisal(m.vocab.encode([*head, w]))[-1] for w in words)
        assert np.allclose(p, 1)


def test_held_out_accuracy(spark, data):
    scorer = R.train(spark.read.parquet(f"{data}/graded_passage.parquet"))
    assert scorer.held_out_accuracy >= 0.95


BODY = "We use the old disk. It shows the page and the job.\n\nThe path is big!"


def test_language_by_letters(spark, data):
    texts = [r[0] for r in spark.read.parquet(f"{data}/graded_passage.parquet").select("passage").collect() if r[0]]
    m = ngram.LetterModel(texts)
    english = ["The tab has a red flag.", "We fix the reader when the list is empty.", "However, the scheduler retries each job."]
    others = ["Der alte Ablauf ist nicht schnell und die Liste ist leer.", "Corrige le lecteur quand la liste est vide.", "El lector ya no se cae cuando la lista está vacía."]
    assert max(map(m.bits, english)) < R.LevelPlan().max_letter_bits < min(map(m.bits, others))
    assert m.bits("") == m.bits("12 !") == float("inf")


def test_prose_of_each_layout(spark, data):
    R_prose = R.train(spark.read.parquet(f"{data}/graded_passage.parquet")).prose
    want = "We use the old disk. It shows the page and the job.\nThe path is big!"
    git = "commit ab\nAuthor: A <a@b>\nDate:   now\n\n    Subject\n\n" + "\n".join("    " + x for x in BODY.split("\n")) + "\n\n    Signed-off-by: A <a@b>\n\ndiff --git a/x b/x\n+we use the cat"
    mail = "From ab\nFrom: A <a@b>\nDate: now\nSubject: [PATCH] long\n subject\n\n" + BODY + "\n\n    panic: the code is here\n\nSigned-off-by: A <a@b>\n---\n 1 files changed\n\ndiff --git a/x b/x\n+the cat is it"
    web = "repo: a/b\nsha: 1\nauthor: A\nmessage:\n  Subject\n  \n" + "\n".join("  " + x for x in BODY.split("\n")) + "\n  \n  > the quoted line is out\npatch:\ndiff --git a/x b/x\n+the cat is it"
    for t in (git, mail, web, git.replace("\n", "\r\n")):
        assert R_prose(t) == want
    assert R_prose("") == "" and R_prose(" \n") == "" and R_prose("free text is no commit") == ""
    de = web.replace("We use the old disk. It shows the page and the job.", "Der alte Ablauf ist nicht schnell und die Liste ist leer.")
    assert R_prose(de) == "The path is big!"
    wrapped = "commit a\nAuthor: A\n\n    Subject\n\n    We see it (see\n    #12). It is the end.\n    # Conflicts:\n    #\ta/the/x.py\n"
    assert R_prose(wrapped).split() == "We see it . It is the end.".split()
    bot = "commit a\nAuthor: A\n\n    Bump x\n\n    ---\n    updated-dependencies:\n    - dependency-name: the a\n    ...\n\n    We see it in the log.\n"
    assert R_prose(bot) == "We see it in the log."


def test_edges(spark, data):
    passages = spark.read.parquet(f"{data}/graded_passage.parquet")
    easy = "commit a\nAuthor: A\n\n    Subject\n\n    " + "We see the red test. It finds the path. " * 12 + "\n"
    rows = [(1, None, 3), (2, "", 3), (3, easy, 3), (3, easy, 3), (4, easy * 1, 3), (None, easy, 3), (5, "commit a\n\n    s\n\n    too short is it\n", 3), (6, easy + "x" * 500_000, 3)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, grade int")
    got = sorted((r["doc_id"] or -1, r["grade"]) for r in R.reading_levels(docs, passages).collect())
    assert got == [(-1, 1), (3, 1), (3, 1), (4, 1), (6, 1)]
    assert R.reading_levels(docs.limit(0), passages).count() == 0
    assert R.reading_levels(docs, passages.limit(0)).count() == 0
    assert R.reading_levels(docs, passages.limit(3)).count() == 5


def test_test_data(spark, data):
    rows = Q.p8_found(spark, data).collect()
    assert rows and {r["grade"] for r in rows} <= {1, 2, 3, 4, 5}
