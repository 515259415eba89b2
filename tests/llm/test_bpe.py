"""The automaton against the tokenizers library, text by text, and against merging by hand."""

import hashlib
import json
import random

import numpy as np
import public_tokenizers
import pytest
import tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st

from orderflow.llm import bpe, queries

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def ours():
    return bpe.Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def theirs():
    found = tokenizers.Tokenizer.from_file(PATH)
    found.no_truncation()
    found.no_padding()
    return found


def same(ours, theirs, texts):
    for text, ids in zip(texts, ours.encode([t.encode() for t in texts])):
        want = theirs.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(ids, "<u4").tolist() == want, text
        assert ours.decode(ids) == theirs.decode(want, skip_special_tokens=False)


@settings(max_examples=300, deadline=None)
@given(text=st.text(max_size=60))
def test_any_text(text):
    same(*_PAIR, [text])


@pytest.fixture(autouse=True, scope="module")
def pair(ours, theirs):
    global _PAIR
    _PAIR = ours, theirs


def test_letters_and_marks(ours, theirs):
    rnd = random.Random(7)
    for letters in ("abcdeinorst'", "ab aé'ß<|endoftext|> ñÅİΣ文字!!..--123 ́\t\n\x1c\x85　"):
        same(ours, theirs, ["".join(rnd.choices(letters, k=rnd.randint(0, 60))) for _ in range(3000)])


def test_special_tokens_runs_and_long_words(ours, theirs):
    same(ours, theirs, ["<|endoftext|>a<|startoftext|>", "<|ENDOFTEXT|>", "a" * 5000, "ab" * 400, "the" * 90, "'''s''ll'd don't I'VE", "", " \n"])


def test_a_long_word_alone_and_in_a_block(ours):
    rnd = random.Random(3)
    for _ in range(200):
        word = "".join(rnd.choices("abcdeinorst", k=rnd.randint(1, 200))).encode()
        assert ours.automaton._encode_long(word).tolist() == ours.automaton._encode_block([word])[0].tolist()


def toy(merges):
    letters = bpe.byte_letters().values()
    names = [*letters, *(x + "</w>" for x in letters), *(u + v for u, v in merges)]
    return {t: i for i, t in enumerate(names)}


@settings(max_examples=200, deadline=None)
@given(pairs=st.lists(st.tuples(st.integers(0, 99), st.integers(0, 99)), max_size=25), word=st.text("ab", min_size=1, max_size=14))
def test_any_proper_merges(pairs, word):
    """Merges over two letters, taken in order until none applies, against the automaton; dead merges included."""
    known, merges = ["a", "b", "a</w>", "b</w>"], []
    for i, j in pairs:
        u, v = known[i % len(known)], known[j % len(known)]
        if u.endswith("</w>") or u + v in known:
            continue
        merges.append((u, v))
        known.append(u + v)
    vocab = toy(merges)
    parts = [*word[:-1], word[-1] + "</w>"]
    rank = {m: r for r, m in enumerate(merges)}
    while True:
        steps = [(rank[p], i) for i, p in enumerate(zip(parts, parts[1:])) if p in rank]
        if not steps:
            break
        _, i = min(steps)
        parts[i : i + 2] = ["".join(parts[i : i + 2])]
    got = bpe.Automaton(vocab, merges, "</w>").encode([word.encode()])[0].tolist()
    assert got == [vocab[p] for p in parts]


def test_improper_merges_are_refused():
    with pytest.raises(ValueError, match="merge 0"):
        bpe.Automaton(toy([("ab", "a"), ("a", "b")]), [("ab", "a"), ("a", "b")], "</w>")


def test_other_kinds_of_tokenizers_are_refused():
    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as file, pytest.raises(ValueError):
        bpe.Tokenizer(json.dumps(json.load(file)))


def test_rows(spark, docs, ours, theirs):
    rows = [(1, "Two words."), (1, "Two words."), (None, None), (2, ""), (3, "x" * 9000 + " end " * 3000)]
    frame = docs(rows, ids="other", decoded=7, IDS_="x")
    got = bpe.decoded(bpe.encoded(frame, ours), ours)
    assert set(got.columns) == {*frame.columns}
    seen = sorted((r["doc_id"] or 0, bytes(r["ids"]), r["decoded"]) for r in got.collect())
    want = []
    for i, t in rows:
        ids = theirs.encode(t or "", add_special_tokens=False).ids
        want.append((i or 0, np.array(ids, "<u4").tobytes(), theirs.decode(ids, skip_special_tokens=False)))
    assert seen == sorted(want)
    assert bpe.encoded(docs([]), ours).collect() == []


def test_query(spark, theirs):
    sf_dir = "/root/testdata/sf0.001"
    want = {}
    for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect():
        ids = theirs.encode(r["text"] or "", add_special_tokens=False).ids
        decoded = theirs.decode(ids, skip_special_tokens=False)
        want[r["doc_id"]] = (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest())
    got = queries.QUERIES["op11_bpe"](spark, sf_dir)
    assert [c for c, _ in got.dtypes] == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert {r[0]: tuple(r[1:]) for r in got.collect()} == want
