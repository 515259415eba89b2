import hashlib
import random

import pytest

from orderflow.llm import chat

TURNS = "conv_id long, turn long, role string, text string, part string"
PIECES = ["\\", "###", "####", "### Assistant: ", "</turn>", "</turn>\n", ": ", ":", "é", "\n", "plain", "@", "\\\\", "<", "#"]


def by_hand(rows):
    groups = {}
    for conv, turn, role, text in rows:
        groups.setdefault(conv, []).append((turn is not None, turn or 0, role is not None, role or "", text is not None, text or ""))
    out = {}
    for conv, turns in groups.items():
        turns.sort()
        said = "".join(f"{r}\n{t}\n" for _, _, _, r, _, t in turns)
        loss = "".join(t for _, _, _, r, _, t in turns if r == "assistant")
        out[conv] = len(turns), hashlib.sha256(said.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest()
    return out


def read_back(frame):
    return {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in chat.digests(frame).collect()}


def hostile(seed, n=300):
    rng = random.Random(seed)
    say = lambda: "".join(rng.choice(PIECES) for _ in range(rng.randint(0, 7)))
    rows = [(rng.choice([None, 1, 2, 3, 50]), rng.choice([None, *range(9)]), rng.choice(["user", "assistant", "system", "tool", "", None, "a: b", "\\:", "@", "User", "###"]), rng.choice([None, say(), say()])) for _ in range(n)]
    return rows + rows[:5] + [(9, 0, "assistant", "x" * 100000)]


@pytest.mark.parametrize("batch", ["10000", "7"])
def test_round_trip(spark, batch):
    rows = hostile(1)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        parts = chat.formatted(spark.createDataFrame([(*r, "clash") for r in rows], TURNS))
        assert read_back(parts) == by_hand(rows)
        if batch == "7":
            assert parts.where("part > 0").count() > 10
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


def test_one_conversation_as_text(spark):
    rows = [(1, 0, "user", "Hi </turn>", ""), (1, 1, "assistant", "a\\b ###", "")]
    (r,) = chat.formatted(spark.createDataFrame(rows, TURNS)).collect()
    assert r.text == "### User: Hi \\</turn></turn>\n### Assistant: a\\\\b \\###</turn>\n"
    (low,), (high,) = r.loss_starts, r.loss_ends
    assert r.text.encode()[low:high] == b"a\\\\b \\###" and chat.unescaped(b"a\\\\b \\###") == b"a\\b ###"


def test_empty_table(spark):
    assert chat.digests(chat.formatted(spark.createDataFrame([], TURNS))).count() == 0
