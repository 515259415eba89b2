from collections import Counter, defaultdict

import numpy as np
import pytest

from orderflow.llm import mixing

DOCS = "doc_id long, text string, lang string, source string, n_chars long, size string"


def made(spark, rows):
    return spark.createDataFrame([(i, t, "en", s, 0, "clash") for i, t, s in rows], DOCS)


def test_targets():
    assert mixing.targets([100, 100, 100], [1, 1, 1]) == pytest.approx([100, 100, 100])
    # 5 of 6 parts of 1010 are too much for the small source: 3 times its size, the rest for the other
    assert mixing.targets([10, 1000], [5, 1]) == pytest.approx([30, 980])
    # the excess lifts the second over its limit too
    assert mixing.targets([10, 20, 1000], [5, 5, 1]) == pytest.approx([30, 60, 940])
    assert mixing.targets([0, 0], [5, 2]) == pytest.approx([0, 0])
    assert mixing.targets([], []) == []


def test_permutation():
    for n in (1, 2, 3, 7, 64, 1000, 4097):
        for key in (0, 12345):
            assert sorted(mixing.permuted(np.arange(n), n, key).tolist()) == list(range(n))
    assert mixing.permuted(np.arange(1000), 1000, 1).tolist() != mixing.permuted(np.arange(1000), 1000, 2).tolist()


def test_multinomials_meet_quotas():
    quota = np.array([500, 0, 30, 970])
    rows = mixing.multinomials(quota, np.array([400, 400, 400, 300]), np.random.default_rng(1))
    assert rows.sum(axis=0).tolist() == quota.tolist() and rows.sum(axis=1).tolist() == [400, 400, 400, 300]


def rows_():
    rng = np.random.default_rng(3)
    rows = [(i, " ".join(f"{i}.{k}" for k in range(int(rng.integers(0, 300)))), ["a", "b", "c", None, "é"][i % 5]) for i in range(120)]
    rows += [(200, "x " * 4000, "c"), (201, None, "a"), (202, "", "d"), (203, " \n", "d"), (204, "lone", "e"), (None, "no id", "e"), (204, "lone", "e"), (205, "q " * 40, "")]
    return rows


def test_mix(spark):
    rows = rows_()
    mixed = mixing.mix(made(spark, rows), block_words=16, shard_blocks=64)
    sizes = defaultdict(int)
    for _, t, s in rows:
        sizes[s] += len((t or "").split())
    per = mixed.sources.toPandas()
    order = sorted((s for s in sizes if s is not None)) + [None]
    assert per["skey"].tolist() == ["" if s is None else f"={s}" for s in order]
    assert per["words"].tolist() == [sizes[s] for s in order]
    assert per["weight"].tolist() == [(5, 2, 1)[i % 3] for i in range(len(order))]
    assert per["target"].sum() == pytest.approx(sum(sizes.values())) and (per["target"] <= 3 * per["words"] + 1e-9).all()

    parts = mixed.parts().toPandas()
    taken = parts.groupby("skey")["n_words"].sum()
    for key, target in zip(per["skey"], per["target"]):
        assert abs(taken.get(key, 0) - target) <= 16
    # a slot is filled once, its block whole; no block comes a fourth time, and passes differ by one at most
    slots = mixed.slots.toPandas()
    assert not slots.duplicated(["shard", "slot"]).any()
    assert slots.groupby("shard").size().iloc[:-1].eq(64).all()
    times = slots.groupby(["skey", "block"]).size()
    assert times.max() <= 3
    for _, t in times.groupby("skey"):
        assert t.max() - t.min() <= 1
    # blocks cover each document once
    packed = mixing.pieces(mixed.packed, 16).toPandas()
    assert packed["n_words"].sum() == sum(sizes.values())
    assert packed.groupby(["skey", "block"])["n_words"].sum().le(16).all()


def test_texts_of_the_mix(spark):
    docs = made(spark, rows_())
    mixed = mixing.mix(docs, block_words=16, shard_blocks=64)
    texts = mixing.with_text(docs, mixed).toPandas()
    plain = mixed.parts().toPandas()
    key = ["shard", "slot", "epoch", "from_word", "n_words"]
    assert Counter(map(tuple, texts[key].to_numpy().tolist())) == Counter(map(tuple, plain[key].to_numpy().tolist()))
    by = defaultdict(set)
    for i, t, _ in rows_():
        by[i].add(" ".join((t or "").split()))
    for r in texts.itertuples():
        wanted = by[None if r.doc_id != r.doc_id else int(r.doc_id)]
        assert any(" ".join(t.split()[r.from_word : r.from_word + r.n_words]) == r.text for t in wanted)


def test_reruns_agree(spark):
    one, two = (mixing.mix(made(spark, rows_()).repartition(k), block_words=16).parts().toPandas() for k in (1, 5))
    key = ["shard", "slot", "from_word", "n_words", "skey", "block", "epoch"]
    assert one[key].sort_values(key).reset_index(drop=True).equals(two[key].sort_values(key).reset_index(drop=True))


def test_nothing_to_mix(spark):
    for rows in ([], [(1, None, "a"), (2, "", None)]):
        mixed = mixing.mix(made(spark, rows))
        assert mixed.parts().count() == 0 and mixed.packed.count() == len(rows)
        assert mixing.with_text(made(spark, rows), mixed).count() == 0
