import random

import numpy as np
import pytest

from orderflow.llm import substrings


def brute(rows, length):
    seen = {}
    for i, text in rows:
        raw = (text or "").encode()
        key = substrings._LAST_ID if i is None else i
        for p in range(len(raw) - length + 1):
            w = raw[p : p + length]
            seen[w] = min(key, seen.get(w, key))
    out = []
    for i, text in rows:
        raw = (text or "").encode()
        key = substrings._LAST_ID if i is None else i
        gone = np.zeros(len(raw), bool)
        for p in range(len(raw) - length + 1):
            if seen[raw[p : p + length]] < key:
                gone[p : p + length] = True
        edges = np.diff(np.concatenate(([0], gone.astype(int), [0])))
        out.append((i, len(raw), int(gone.sum()), int((edges == 1).sum()), bytes(b for b, g in zip(raw, gone) if not g)))
    return sorted(out, key=str)


def found(frame):
    return sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in frame.collect()), key=str)


def corpus(seed, n=60, alphabet="abcdé \n"):
    rng = random.Random(seed)
    parts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(5, 90))) for _ in range(25)]
    rows = []
    for i in range(n):
        text = "".join(rng.choice(parts) if rng.random() < 0.6 else "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 60))) for _ in range(rng.randint(0, 6)))
        rows.append((i, text))
    rows += [(100 + i, rows[i][1]) for i in range(10)] + [(7, rows[7][1]), (8, rows[9][1]), (None, rows[3][1]), (None, parts[0]), (300, None), (301, ""), (302, "x"), (303, "ab" * 400), (304, "ab" * 300)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(docs, seed):
    rows = corpus(seed)
    frame = docs(rows, n_removed="clash", tid="clash", first="clash", row="clash", seed="clash")
    out = substrings.removed(frame, 24)
    assert found(out) == brute(rows, 24)
    assert out.columns == ["doc_id", "lang", "source", "n_chars", "tid", "first", "row", "seed", "n_bytes", "n_removed", "n_spans", "kept"]


def test_crowded_seeds_are_dealt_by_content(docs, monkeypatch):
    monkeypatch.setattr(substrings, "MOST_CELLS", 2)
    rows = corpus(3)
    assert found(substrings.removed(docs(rows), 24)) == brute(rows, 24)


def test_long_texts_in_pieces_and_small_batches(spark, docs, monkeypatch):
    monkeypatch.setattr(substrings, "_PIECE", 256)
    monkeypatch.setattr(substrings, "_SLICE", 512)
    rng = random.Random(5)
    long = "".join(rng.choice("abcdefgh ") for _ in range(3000))
    rows = [(1, long), (2, "x" * 30 + long[700:1900] + "y" * 30), (3, long[2990:] + long[:300])]
    data = np.frombuffer("".join(t for _, t in rows).encode(), np.uint8)
    offsets = np.cumsum([0, *(len(t) for _, t in rows)])
    starts = [(int(d), int(s), int(h - l - 49)) for _, _, doc, start, low, high in substrings.cells(data, offsets, 50) for d, s, l, h in zip(doc, start, low, high)]
    for d, (_, text) in enumerate(rows):  # every window is in exactly one cell
        windows = sorted(w for doc, s, n in starts if doc == d for w in range(s, s + n))
        assert windows == list(range(len(text) - 49))
    assert found(substrings.removed(docs(rows), 50)) == brute(rows, 50)


def test_empty_table(docs):
    assert found(substrings.removed(docs([]), 50)) == []


def test_texts_stay_utf8(docs):
    passage = "é" * 60
    rows = [(1, passage), (2, "a" + passage), (3, passage), (4, None)]
    left = {r.doc_id: r.text for r in substrings.deduplicated(docs(rows), 50).collect()}
    assert left == {1: passage, 2: "a", 4: ""}
