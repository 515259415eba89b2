import tracemalloc

import numpy as np

from orderflow.llm import classifier as c

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    """The model never sees the gold labels, so all of them are held out."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    rows = c.classified(docs).join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id").toPandas()
    clean, junk = rows[rows.quality == 1], rows[rows.quality == 0]
    assert clean.good.mean() > 0.995 and (~junk.good).mean() > 0.9


def test_em_finds_accuracies():
    rng = np.random.default_rng(1)
    truth = rng.random(20000) < 0.8
    right = np.array([0.95, 0.9, 0.85, 0.7, 0.9])
    votes = np.where((rng.random((20000, 5)) < right) == truth[:, None], 1, -1) * (rng.random((20000, 5)) < 0.8)
    patterns, counts = np.unique(votes, axis=0, return_counts=True)
    model = c.fit_labels(patterns, counts.astype(float))
    assert abs(model.prior - 0.8) < 0.03 and np.abs(model.accuracy.mean(axis=1) - right).max() < 0.05


def test_cases(spark, docs):
    junk, prose = "BUY!! " * 60, "The cat sat, as cats do, on one of many mats. " * 3 + " ".join(f"word{chr(97 + i % 26)}{chr(97 + i % 7)}e" for i in range(120)) + "."
    rows = [(1, junk), (2, prose), (3, None), (4, ""), (5, " \n "), (2, prose), (None, prose), (6, prose * 2000)] + [(100 + i, f"{prose} {i}") for i in range(40)]
    out = c.classified(docs(rows, good="clash", quality_score="clash"))
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars", "quality_score", "good"]
    got = {}
    for r in out.collect():
        got.setdefault(r.doc_id, set()).add(r.good)
    assert out.count() == len(rows) and got[2] == {True} and got[None] == {True} and got[1] == {False}
    again = {(r.doc_id, r.quality_score) for r in c.classified(docs(rows).repartition(7)).collect()}
    assert again == {(r.doc_id, r.quality_score) for r in out.collect()}


def test_scores_equal_a_plain_fit(spark, docs):
    """All rows in one process: votes counted row by row, every row in the fit, scores from whole feature vectors."""
    rng = np.random.default_rng(4)
    rows = [(i, " ".join(rng.choice(["Cats", "sat,", "on", "mats.", "!!", "BUY", "x" * 30, "green"], rng.integers(0, 200)))) for i in range(120)]
    rows += [(7, rows[7][1])] * 30 + [(None, "SALE !! " * 70)] * 40
    bodies = [t.encode() for _, t in rows]
    patterns, counts = np.unique([c.votes(c.shape(t)) for t in bodies], axis=0, return_counts=True)
    labels = c.fit_labels(patterns, counts.astype(float))
    described = [c.features(t) for t in bodies]
    target = labels.posterior(np.array([c.votes(c.shape(t)) for t in bodies]))
    scorer = c.fit_scorer([d[0] for d in described], [d[1] for d in described], target, np.ones(len(rows)))
    got = {}
    for r in c.scored(docs(rows), c.fit(docs(rows), sample_rows=10**9)[1]).collect():
        got.setdefault((r.doc_id, r.text), set()).add(r.quality_score)
    for (i, t), (index, value) in zip(rows, described):
        z = scorer.bias + float((scorer.weights[index].astype(float) * value).sum())
        assert got[i, t] and all(abs(x - 1 / (1 + np.exp(-z))) < 1e-3 for x in got[i, t])


def test_equal_rows_reach_the_driver_once(spark, docs, monkeypatch):
    seen = []
    real = c.fit_scorer
    monkeypatch.setattr(c, "fit_scorer", lambda index, value, target, times: seen.append(times) or real(index, value, target, times))
    c.fit(docs([(None, None)] * 300 + [(1, "a b c")]), sample_rows=10**9)
    assert sorted(seen[0]) == [1, 300]


def test_the_fit_holds_numbers_not_objects(docs):
    """A Python object for each feature of the sample would take over 60 bytes of the driver; an index and a value take 8."""
    rng = np.random.default_rng(6)
    rows = [(i, rng.integers(33, 127, 3000, np.uint8).tobytes().decode()) for i in range(400)]
    n = sum(len(c.features(t.encode())[0]) for _, t in rows)
    tracemalloc.start()
    try:
        c.fit(docs(rows), sample_rows=10**9)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert n > 10**6 and peak < 30 * n


def test_rows_of_a_fit_go_by_in_runs(monkeypatch):
    """Any cut of the rows gives the same weights."""
    rng = np.random.default_rng(8)
    index = [rng.integers(0, c._DIMENSIONS, n).astype(np.int32) for n in (3, 500, 1, 90, 40)]
    value, target, times = [rng.random(len(x), np.float32) for x in index], rng.random(5), np.array([1.0, 2, 1, 5, 1])
    whole = c.fit_scorer(index, value, target, times)
    monkeypatch.setattr(c, "_RUN", 50)
    cut = c.fit_scorer(index, value, target, times)
    assert (whole.weights == cut.weights).all() and whole.bias == cut.bias and whole.weights.any()


def test_empty_table(docs):
    assert c.classified(docs([])).count() == 0


def test_scorer_is_linear_over_its_features():
    rng = np.random.default_rng(2)
    scorer = c.Scorer(rng.normal(size=c._DIMENSIONS).astype(np.float32), 0.1)
    for text in (b"", b"ab", b"Some text, some TEXT." * 40):
        index, value = c.features(text)
        z = scorer.bias + float((scorer.weights[index] * value).sum())
        assert abs(scorer.score(text) - 1 / (1 + np.exp(-np.clip(z, -50, 50)))) < 1e-4
