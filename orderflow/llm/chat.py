"""Chat formatting: turns to one marked text per conversation, with the spans that carry loss."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderflow.llm.text import blobs

# The template: OPEN role MID content CLOSE. Inside contents and roles a backslash stands before control strings.
OPEN, MID, CLOSE = "### ", ": ", "</turn>\n"
TITLES = {"system": "System", "user": "User", "assistant": "Assistant"}
_CONTENT = r"(\\|###|</turn>)"
_ROLE = r"(\\|###|</turn>|:)"
_SCAN = re.compile(rb"\\(?:\\|###|</turn>|:)|</turn>\n|: ")
_UNESCAPE = re.compile(rb"\\(\\|###|</turn>|:)")


def escaped(values: pa.Array, pattern: str = _CONTENT) -> pa.Array:
    return pc.replace_substring_regex(values, pattern, r"\\\1")


def unescaped(raw: bytes) -> bytes:
    return _UNESCAPE.sub(rb"\1", raw)


def headers(roles: pa.Array) -> pa.Array:
    """``### User: `` for a known role, ``### @role: `` with the role as it is for any other."""
    names = {r: OPEN + TITLES[r] + MID for r in TITLES}
    others = [r for r in pc.unique(roles).to_pylist() if r not in names]
    if others:
        names |= {r: f"{OPEN}@{e}{MID}" for r, e in zip(others, escaped(pa.array(others, pa.string()), _ROLE).to_pylist())}
    keys = roles.dictionary_encode()
    return pa.array([names[r] for r in keys.dictionary.to_pylist()], pa.string()).take(keys.indices)


def assemble(segments: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, list[np.ndarray]]:
    """Rows' segments, column after column, copied into one buffer row by row. Returns it and each column's starts, the buffer's end last."""
    lengths = np.stack([np.diff(offsets) for _, offsets in segments], axis=1)
    ends = np.cumsum(lengths.ravel()).reshape(lengths.shape)
    starts = ends - lengths
    out = np.empty(int(ends[-1, -1]) if ends.size else 0, np.uint8)
    for k, (data, offsets) in enumerate(segments):
        scatter = np.repeat(starts[:, k] - offsets[:-1], lengths[:, k]) + np.arange(len(data))
        out[scatter] = data
    return out, [np.append(starts[:, k], len(out)) for k in range(len(segments))]


def formatted(turns: DataFrame) -> DataFrame:
    """conv_id, part, text, loss_starts, loss_ends of every conversation; loss offsets are bytes of the part's text.

    ``turns`` has conv_id, turn, role, text. Turns go by number (null first), ties by role and text; equal rows are
    equal turns. Null role or text is empty. Assistant contents carry loss. A conversation is one part, or more
    where it goes over several Arrow batches, so a very long one is streamed and never held whole. A null conv_id
    is a conversation of its own; an empty table gives no rows.
    """

    def run(batches) -> Iterator[pa.RecordBatch]:
        last, part = object(), 0
        for batch in batches:
            if not batch.num_rows:
                continue
            roles = batch.column("role").fill_null("")
            close = np.frombuffer(CLOSE.encode() * batch.num_rows, np.uint8), np.arange(batch.num_rows + 1) * len(CLOSE)
            content = escaped(batch.column("text").fill_null(""))
            out, starts = assemble([blobs(headers(roles)), blobs(content), close])
            ids = batch.column("conv_id")
            filled = ids.fill_null(0).to_numpy(zero_copy_only=False)
            null = ids.is_null().to_numpy(zero_copy_only=False)
            first = np.flatnonzero(np.append(True, (filled[1:] != filled[:-1]) | (null[1:] != null[:-1])))
            bounds = np.append(first, batch.num_rows)
            begins = starts[0][bounds]
            loss = np.flatnonzero((pc.equal(roles, "assistant")).to_numpy(zero_copy_only=False))
            owner = np.searchsorted(first, loss, side="right") - 1
            lists = np.searchsorted(loss, bounds).astype(np.int32)
            conv = ids.take(pa.array(first))
            parts = np.zeros(len(first), np.int64)
            if conv[0].as_py() == last:
                part += 1
                parts[0] = part
            if len(first) > 1 or conv[0].as_py() != last:
                part = 0
            last = conv[-1].as_py()
            text = pa.LargeStringArray.from_buffers(len(first), pa.py_buffer(begins.astype(np.int64)), pa.py_buffer(out))
            spans = [pa.ListArray.from_arrays(pa.array(lists), pa.array(x[loss] - begins[owner], pa.int64())) for x in (starts[1], starts[2])]
            yield pa.RecordBatch.from_arrays([conv, pa.array(parts), text.cast(pa.string()), *spans], ["conv_id", "part", "text", "loss_starts", "loss_ends"])

    rows = turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").alias("turn"), F.col("role").alias("role"), F.col("text").alias("text"))
    ordered = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return ordered.mapInArrow(run, "conv_id long, part long, text string, loss_starts array<long>, loss_ends array<long>")


def turns_of(raw: bytes) -> Iterator[tuple[bytes, bytes]]:
    """Role and text of each turn of a formatted part."""
    known = {TITLES[r].encode(): r.encode() for r in TITLES}
    at = 0
    while at < len(raw):
        start, mid = at + len(OPEN), None
        for token in _SCAN.finditer(raw, start):
            if token.group() == b": " and mid is None:
                mid = token.start()
            elif token.group() == CLOSE.encode():
                break
        else:
            raise ValueError("a turn has no end")
        role = raw[start:mid]
        yield known[role] if role in known else unescaped(role[1:]), unescaped(raw[mid + len(MID) : token.start()])
        at = token.end()


def digests(parts: DataFrame) -> DataFrame:
    """What formatted parts say when read back, a row per conversation.

    conv_id, n_turns, turns_sha256 (role, line end, text, line end of each turn), loss_chars and loss_sha256 (the
    text under the loss spans, unescaped), formatted_chars.
    """

    def run(batches) -> Iterator[pa.RecordBatch]:
        state, last = None, object()

        def row():
            return last, state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4]

        for batch in batches:
            rows = []
            for conv, text, low, high in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "text", "loss_starts", "loss_ends"))):
                if state is None or conv != last:
                    if state is not None:
                        rows.append(row())
                    state, last = [0, hashlib.sha256(), 0, hashlib.sha256(), 0], conv
                raw = text.encode()
                for role, content in turns_of(raw):
                    state[0] += 1
                    state[1].update(role + b"\n" + content + b"\n")
                for s, e in zip(low, high):
                    content = unescaped(raw[s:e])
                    state[2] += len(content.decode())
                    state[3].update(content)
                state[4] += len(text)
            yield made(rows)
        if state is not None:
            yield made([row()])

    def made(rows):
        types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        columns = zip(*rows) if rows else [[]] * 6
        return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types)], names)

    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    ordered = parts.repartition("conv_id").sortWithinPartitions("conv_id", "part")
    return ordered.mapInArrow(run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
