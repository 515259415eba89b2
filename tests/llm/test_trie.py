import math
import random
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from orderflow.llm import ngram_trie as t
from orderflow.llm import packing
from orderflow.llm.elias_fano import EliasFano
from orderflow.llm.queries import QUERIES


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 2**62), max_size=80), st.integers(0, 61), st.lists(st.integers(0, 2**62), max_size=20))
def test_elias_fano(values, shift, others):
    values = sorted({v >> shift for v in values})
    coded = EliasFano.coded(np.array(values, np.uint64))
    if values:
        assert coded.access(np.arange(len(values))).tolist() == values
    asked = [*values, *(o >> shift for o in others)]
    where = {v: i for i, v in enumerate(values)}
    assert coded.find(np.array(asked, np.uint64)).tolist() == [where.get(v, -1) for v in asked]


def test_elias_fano_of_repeated_values():
    values = sorted([0] * 100 + [5] * 3 + list(range(1000, 5000, 7)) * 2)
    assert EliasFano.coded(np.array(values, np.uint64)).access(np.arange(len(values))).tolist() == values


def test_a_run_of_a_million():
    """Dense values, then far ones that make the low parts wide: one high part holds them all."""
    values = np.concatenate([np.arange(0, 2_000_000, 2), 10**12 + np.arange(0, 10**9, 10**7)]).astype(np.uint64)
    coded = EliasFano.coded(values)
    some = np.arange(0, len(values), 997)
    assert (coded.find(values[some]) == some).all() and (coded.find(values[some] + np.uint64(1)) == -1).all()
    near = np.concatenate([np.arange(100_000), 300_000 + 70_000 * np.arange(20_000)]).astype(np.uint64)
    coded = EliasFano.coded(near)
    assert (coded.find(near) == np.arange(len(near))).all()


def texts(seed, n=140):
    rng = random.Random(seed)
    words = ["The", "a", "é", "x", "cat", "Ring", "of", "fire", "\\n"]
    rows = [(i, " ".join(rng.choice(words) + rng.choice(["", "", "s"]) for _ in range(rng.randint(0, 40)))) for i in range(n)]
    return rows + [(None, "a cat"), (900, None), (901, ""), (902, "\n\t"), (903, "never seen before"), (4, rows[4][1]), (905, "a " * 5000)]


def held(i):
    return i is not None and zlib.crc32(str(i).encode()) % 7 == 2


def by_hand(rows, order):
    tokens = {k: t.tokens((text or "").encode()) for k, (_, text) in enumerate(rows)}
    counts, after = Counter(), [defaultdict(Counter) for _ in range(order)]
    for k, (i, _) in enumerate(rows):
        if not held(i):
            own = [t.END, *tokens[k]]
            counts.update(own[1:])
            for level in range(1, order):
                for j in range(level, len(own)):
                    after[level][tuple(own[j - level : j])][own[j]] += 1
    total, distinct = sum(counts.values()), len(counts)

    def prob(context, w):
        if not context:
            return (counts[w] + 1) / (total + distinct + 1)
        lower, own = prob(context[1:], w), after[len(context)].get(context)
        return lower if not own else (own[w] + len(own) * lower) / (sum(own.values()) + len(own))

    out = []
    for k, (i, _) in enumerate(rows):
        own = [t.END, *tokens[k]]
        base = sum(math.log10((counts[w] + 1) / (total + distinct + 1)) for w in own[1:])
        score = 0.0
        for j in range(1, len(own)):
            reach = min(order - 1, j)
            score += math.log10(prob(tuple(own[j - reach : j]), own[j]))
        out.append((i, held(i), len(own) - 1, sum(counts[w] > 0 for w in own[1:]), total, base, score))
    return sorted(out, key=str)


@pytest.mark.parametrize("order", [1, 2, 3])
def test_scores_equal_formula_but_for_rounding(docs, order):
    rows = texts(1)
    frame = docs(rows, score="clash", held_out="clash")
    got = sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in t.evaluated(frame, order).collect()), key=str)
    want = by_hand(rows, order)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    for g, w in zip(got, want):
        assert g[5] == pytest.approx(w[5], abs=1e-8)
        assert abs(g[6] - w[6]) <= 0.05 * w[2]


def test_model_is_better_than_the_base_on_held_out_text(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = t.evaluated(docs).where("held_out").toPandas()
    assert rows.score.sum() > rows.base_score.sum() + 0.3 * rows.n_tokens.sum()


def test_nothing_to_learn_or_to_score(docs):
    assert t.evaluated(docs([])).count() == 0
    only = next(i for i in range(100) if held(i))
    (r,) = t.evaluated(docs([(only, "some words")])).collect()
    assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) == (True, 3, 0, 0, 0.0, 0.0)


def test_the_query_scores_by_three_words(docs, spark, tmp_path):
    rows = texts(2)
    docs(rows).write.parquet(str(tmp_path / "documents.parquet"))
    got = sorted(((r.doc_id, r.held_out, r.n_tokens, r.score) for r in QUERIES["op2_lm_scoring"](spark, str(tmp_path)).collect()), key=str)
    want, two = by_hand(rows, 3), by_hand(rows, 2)
    assert all(g[:3] == w[:3] and abs(g[3] - w[6]) <= 0.05 * w[2] for g, w in zip(got, want))
    assert sum(w[6] - x[6] for w, x in zip(want, two)) > 0.1 * sum(w[2] for w in want)  # two words would be off by more


def test_a_shard_of_a_level_is_one_file(docs):
    model = t.fit(docs(texts(3)))
    assert len(model.levels) == 3
    for level in model.levels:
        for stem in filter(None, level.stems):
            folder, _, name = stem.removeprefix("file:").rpartition("/")
            assert [p.name for p in Path(folder).glob(f"{name}*") if p.suffix != ".crc"] == [f"{name}-level"]


@pytest.mark.parametrize("values", [[0, 1], [3, 3, 3, 9], list(range(0, 4000, 7)), [1, 2, *range(10**9, 10**9 + 300, 3)], [5] * 500 + [2**40]])
def test_neighbours_are_read_together(values):
    coded = EliasFano.coded(np.array(values))
    own, after = coded.access_two(np.arange(len(values) - 1))
    assert own.tolist() == values[:-1] and after.tolist() == values[1:]


def test_small_batches_are_one_chunk():
    batches = [pa.RecordBatch.from_pydict({"text": [f"a b{i}", None, ""]}) for i in range(40)]
    (chunk,) = t.chunks(iter(batches))
    assert chunk[0].num_rows == 120 and chunk[4].tolist() == [3, 1, 1] * 40
    # a group ends before it gets too long, whatever the batches; no row is lost
    assert sum(len(c[4]) for c in t.chunks(iter(batches), size=5)) == 120
    assert max(b.num_rows for b in t.grouped(iter(batches), "text", 50)) == 6


def test_an_ask_looks_at_each_row_once():
    """Rows of a shard are cut out of the sorted ones, not picked from all rows shard by shard."""
    shard = np.repeat([0, 2, 5], [2, 1, 3])
    assert [(k, m.start, m.stop) for k, m in t._runs(shard)] == [(0, 0, 2), (2, 2, 3), (5, 3, 6)]
    assert [(k, m.tolist()) for k, m in t._scattered(np.array([5, 0, 5, 2]))] == [(0, [1]), (2, [3]), (5, [0, 2])]
    assert list(t._runs(np.zeros(0, np.int64))) == []


def test_rising_columns_go_as_differences():
    """What the counts send: contexts of a part rise, so that their differences are small, negative first ones included."""
    part = np.repeat([0, 3, 4], [5000, 1, 3000])
    first = np.sort(np.random.default_rng(5).integers(10**6, 10**9, len(part))) - 2 * 10**6
    other = np.arange(len(part)) % 7
    plain, rising = packing.dealt(part, first, other), packing.dealt(part, first, other, rising=True)
    assert rising.column("part").to_pylist() == plain.column("part").to_pylist() == [0, 3, 4]
    back = packing.unpacked(rising.column("blob").to_pylist(), 2, rising=True)
    assert (back[0] == first).all() and (back[1] == other).all()
    assert rising.nbytes < 0.9 * plain.nbytes
    assert [len(x) for x in packing.unpacked([], 2, rising=True)] == [0, 0]
    assert packing.dealt(part[:0], first[:0], other[:0], rising=True).num_rows == 0


def test_an_ask_has_rows_enough():
    """What an ask of a shard costs by itself is paid per chunk and shard: with 10 GB of text, two thousand tokens share it."""
    assert t.shard_bits(0) == 1
    assert 10 << 30 <= t._SHARD_BYTES << t.shard_bits(10 << 30)
    assert t._TOKENS >> t.shard_bits(10 << 30) >= 2048


def test_parts_over_the_end_of_a_word():
    """Low parts of 1 to 55 bits, in one word and over two."""
    for l in (1, 7, 31, 33, 50, 55):
        values = np.sort(np.random.default_rng(l).integers(0, 200 << l, 200)).astype(np.uint64)
        coded = EliasFano.coded(np.append(values, np.uint64(201 << l)))
        assert coded.l == l and (coded.access(np.arange(200)) == values).all()
