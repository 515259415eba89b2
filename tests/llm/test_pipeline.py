import numpy as np
import pytest

import corpus_pipeline
from orderflow.llm import contamination, simhash

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def kept(spark):
    """Rows after each stage but the last, with what went in."""
    from orderflow.llm.workers import importable
    from orderflow.sources.workdir import stored

    importable(spark)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    states = [docs]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        states.append(stored(stage(spark, states[-1], SF), "stage"))
    return states


def test_columns_and_shrinking(kept):
    names = corpus_pipeline.COLUMNS
    assert all(s.columns == names for s in kept)
    sizes = [s.count() for s in kept]
    assert sizes == sorted(sizes, reverse=True) and 0 < sizes[-1] < sizes[0]


def test_quality_keeps_clean_documents(spark, kept):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    before, after = (s.join(labels, "doc_id").groupBy("quality").count().collect() for s in kept[:2])
    before, after = ({r[0]: r[1] for r in x} for x in (before, after))
    assert after[1] >= 0.99 * before[1] and after.get(0, 0) <= 0.2 * before[0]


def test_near_copies_by_brute_force(kept):
    rows = {r.doc_id: simhash.fingerprint((r.text or "").encode()) for r in kept[1].collect()}
    ids = sorted(rows)
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    fps = np.array([rows[i] for i in ids], np.uint64)
    for k, i in enumerate(ids):
        for j in np.flatnonzero(np.bitwise_count(fps[:k] ^ fps[k]) <= 2):
            a, b = find(i), find(ids[j])
            root[max(a, b)] = min(a, b)
    assert sorted(r.doc_id for r in kept[2].collect()) == sorted({find(i) for i in ids})


def test_passages_by_brute_force(kept):
    seen, want = {}, {}
    rows = sorted((r.doc_id, r.text.encode()) for r in kept[2].collect())
    for i, raw in rows:
        gone = np.zeros(len(raw), bool)
        for p in range(len(raw) - 49):
            if seen.setdefault(raw[p : p + 50], i) < i:
                gone[p : p + 50] = True
        if not gone.all() or not len(raw):
            want[i] = bytes(b for b, g in zip(raw, gone) if not g).decode("utf-8", "ignore")
    got = {r.doc_id: (r.text, r.n_chars) for r in kept[3].collect()}
    assert got == {i: (t, len(t)) for i, t in want.items()}


def test_benchmark_by_brute_force(spark, kept):
    items = [contamination.shingles(r.text.encode(), 5) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    clean = []
    for r in kept[3].collect():
        own = contamination.shingles(r.text.encode(), 5)
        if not any(10 * len(own & i) >= 8 * len(i) for i in items):
            clean.append(r.doc_id)
    assert sorted(clean) == sorted(r.doc_id for r in kept[4].collect())


def test_run_is_the_stages(spark, kept):
    mix = corpus_pipeline.run(spark, SF)
    last = corpus_pipeline.STAGES[-1][1](spark, kept[-1], SF)
    key = lambda rows: sorted(map(str, rows))
    assert key(mix.collect()) == key(last.collect())
    by = {r.doc_id: r.text.split() for r in kept[-1].collect()}
    for r in last.collect():
        assert r.text.split() == by[r.doc_id][r.from_word : r.from_word + r.n_words]


def test_nulls_repeats_and_empty_tables(spark):
    text = " ".join(f"word{chr(97 + i % 26)}{chr(97 + i // 26)}o" for i in range(120)) + "."
    rows = [(1, text, "en", "a", 1), (1, text, "en", "a", 1), (2, text, None, None, None), (3, None, None, None, None), (None, text[40:] + " more words here.", "en", "b", 2), (None, None, None, None, None)]
    docs = spark.createDataFrame(rows, DOCS)
    for _, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF).collect()
        stage(spark, docs.limit(0), SF).collect()
    near = corpus_pipeline.near_copies(spark, docs, SF).collect()
    assert sorted((str(r.doc_id) for r in near)) == sorted(["1", "3", "None"]) 
