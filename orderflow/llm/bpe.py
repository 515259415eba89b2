"""Byte-pair encoding by an automaton over tokens, and decoding by the labels of its arcs.

The automaton's arcs are tokens and its paths are exactly the correct encodings of words. It starts as one state with an
arc for each base symbol and takes the merges in their order. The gadget of a merge (u, v) -> w: wherever u and then v
can be read, an arc w leads to where v led; and the state that u leads to is replaced by a copy without the arc v. So all
arcs of a token always lead to one state, and a copy is never written out: it is a reference to the state it was
copied from, with the time, and a table of the arcs taken out since. ``Automaton.missing`` asks for an arc by these tables.

A string has one path. It is found position by position: of the tokens that end at a position (a trie of arc labels) the
one whose arc leaves the state that the path so far leads to, which is one only, since each prefix has one encoding.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterable, Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderflow.llm.probing import IntTable
from orderflow.llm.text import texts

_NEVER = np.int64(1) << 40
_PAIR = 20
# Symbols: the 256 bytes inside a word, and again as a word's last.
_SYMBOLS = 512


def byte_letters() -> dict[int, str]:
    """The printable letter that byte-level vocabularies write for each byte: itself, or the next one from U+0100 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


class Automaton:
    """A vocabulary's merges, compiled."""

    def __init__(self, vocab: dict[str, int], merges: list[tuple[str, str]], end: str):
        letters = byte_letters()
        size = max(vocab.values(), default=-1) + 1
        # parts of a token, and the time of the merge that made it
        self.left, self.right = np.full(size, -1, np.int64), np.full(size, -1, np.int64)
        self.birth = np.full(size, -1, np.int64)
        spelled: dict[int, tuple[int, ...]] = {}
        for byte, letter in letters.items():
            spelled[vocab[letter]] = (byte,)
            spelled[vocab[letter + end]] = (256 + byte,)
        taken = []
        for time, (u, v) in enumerate(merges):
            u, v, w = vocab[u], vocab[v], vocab[u + v]
            if u not in spelled or v not in spelled or w in spelled:
                raise ValueError(f"merge {time} uses a token that no earlier merge makes, or makes one twice")
            self.left[w], self.right[w], self.birth[w] = u, v, time
            spelled[w] = spelled[u] + spelled[v]
            taken.append(u << _PAIR | v)
        self.taken = IntTable(np.array(taken, np.int64), np.arange(len(taken)))
        made = np.flatnonzero(self.birth >= 0)
        # a merge whose second part could no longer follow its first made no arc
        alive = np.ones(size, bool)
        alive[made] = ~self.missing(self.left[made], self.right[made], self.birth[made])
        for w in made[np.argsort(self.birth[made])].tolist():
            alive[w] &= alive[self.left[w]] and alive[self.right[w]]
        self._label([(s, w) for w, s in spelled.items() if alive[w]])
        self.size = np.zeros(size, np.int64)
        for w, s in spelled.items():
            self.size[w] = len(s)

    def _label(self, labels: list[tuple[tuple[int, ...], int]]) -> None:
        steps: dict[int, int] = {}
        token = [-1]
        for symbols, w in labels:
            node = 0
            for s in symbols:
                key = node * _SYMBOLS + s
                if key not in steps:
                    steps[key] = len(token)
                    token.append(-1)
                node = steps[key]
            token[node] = w
        self.steps = IntTable(np.fromiter(steps.keys(), np.int64), np.fromiter(steps.values(), np.int64))
        self.token = np.array(token, np.int64)
        self.longest = max((len(s) for s, _ in labels), default=1)

    def missing(self, t: np.ndarray, y: np.ndarray, before: np.ndarray | None = None) -> np.ndarray:
        """Whether the state that token t leads to has no arc y, at a time or at the end.

        The state of t is a copy of the state of t's right part, made at t's birth; the arc y exists where the arc of its
        left part did at y's birth. So y is missing if, for a part z down t's right side and a part x down y's left side, x was taken
        from the state of z before z's copy was made and not after the arc above x was.
        """
        out = np.zeros(len(t), bool)
        rows, z = np.arange(len(t)), t
        z_until = np.full(len(t), _NEVER) if before is None else before
        while len(rows):
            at, x, x_until = np.arange(len(rows)), y[rows], np.full(len(rows), _NEVER)
            while len(at):
                time = self.taken.find(z[at] << _PAIR | x)
                gone = (time >= 0) & (time < z_until[at]) & (time <= x_until)
                out[rows[at[gone]]] = True
                on = ~gone & (self.left[x] >= 0)
                at, x, x_until = at[on], self.left[x[on]], self.birth[x[on]]
            on = ~out[rows] & (self.right[z] >= 0)
            rows, z_until, z = rows[on], self.birth[z[on]], self.right[z[on]]
        return out

    def encode(self, words: list[bytes]) -> list[np.ndarray]:
        """The tokens of each word (bytes as they are, not empty)."""
        out: list[np.ndarray] = [np.zeros(0, np.int64)] * len(words)
        order = sorted(range(len(words)), key=lambda i: -len(words[i]))
        i = 0
        while i < len(order):
            longest = len(words[order[i]])
            if longest > _LONG:
                out[order[i]] = self._encode_long(words[order[i]])
                i += 1
                continue
            block = order[i : i + max(1, _BLOCK // longest)]
            for k, tokens in zip(block, self._encode_block([words[k] for k in block])):
                out[k] = tokens
            i += len(block)
        return out

    def _encode_block(self, words: list[bytes]) -> list[np.ndarray]:
        """Words from the longest to the shortest, a position of all of them at a time."""
        sizes = np.array([len(w) for w in words], np.int64)
        starts = np.cumsum(sizes) - sizes
        symbols = np.frombuffer(b"".join(words), np.uint8).astype(np.int64)
        symbols[starts + sizes - 1] += 256
        ends_at = np.repeat(starts + sizes, sizes)
        # tokens by length and start
        depth = min(self.longest, int(sizes[0]))
        arcs = np.full((depth, len(symbols)), -1, np.int32)
        at = np.arange(len(symbols))
        node = np.zeros(len(symbols), np.int64)
        for k in range(depth):
            node = self.steps.find(node * _SYMBOLS + symbols[at + k])
            on = node >= 0
            at, node = at[on], node[on]
            arcs[k, at] = self.token[node]
            on = at + k + 1 < ends_at[at]
            at, node = at[on], node[on]
        filled = [k for k in range(depth) if (arcs[k] >= 0).any()]
        last = np.zeros(len(symbols), np.int64)
        for j in range(1, int(sizes[0]) + 1):
            open_ = starts[: np.searchsorted(-sizes, -j, "right")] + j
            for k in reversed(filled):
                if k >= j or not len(open_):
                    continue
                token = arcs[k, open_ - k - 1].astype(np.int64)
                fits = token >= 0
                if k + 1 < j:
                    some = np.flatnonzero(fits)
                    fits[some] = ~self.missing(last[open_[some] - k - 2], token[some])
                last[open_[fits] - 1] = token[fits]
                open_ = open_[~fits]
        # from the ends back
        word, end = np.arange(len(words)), sizes.copy()
        found = []
        while len(word):
            token = last[starts[word] + end - 1]
            found.append((word, token))
            end = end - self.size[token]
            word, end = word[end > 0], end[end > 0]
        of = np.concatenate([w for w, _ in found])[::-1]
        tokens = np.concatenate([t for _, t in found])[::-1]
        order = np.argsort(of, kind="stable")
        return np.split(tokens[order], np.cumsum(np.bincount(of, minlength=len(words)))[:-1])

    @cached_property
    def _plain(self) -> tuple[dict, dict, list, list, list, list, list]:
        steps, taken = ({k: v for k, v in zip(t.keys.tolist(), t.values.tolist()) if k >= 0} for t in (self.steps, self.taken))
        return steps, taken, *(a.tolist() for a in (self.token, self.left, self.right, self.birth, self.size))

    def _encode_long(self, word: bytes) -> np.ndarray:
        """One word, its positions one by one: the same search where a position of a single word is no vector."""
        steps, taken, arc, left, right, birth, size = self._plain
        n = len(word)
        last = [-1] * (n + 1)
        known: dict[tuple[int, int], bool] = {}

        def missing(t: int, y: int) -> bool:
            z, z_until = t, _NEVER
            while z >= 0:
                x, x_until = y, _NEVER
                while x >= 0:
                    time = taken.get(z << _PAIR | x, -1)
                    if 0 <= time < z_until and time <= x_until:
                        return True
                    x, x_until = left[x], birth[x]
                z, z_until = right[z], birth[z]
            return False

        for start in range(n):
            node = 0
            for j in range(start, min(n, start + self.longest)):
                node = steps.get(node * _SYMBOLS + word[j] + (256 if j == n - 1 else 0), -1)
                if node < 0:
                    break
                y = arc[node]
                if y < 0 or last[j + 1] >= 0:
                    continue
                pair = (last[start], y)
                if start and pair not in known:
                    known[pair] = missing(*pair)
                if not start or not known[pair]:
                    last[j + 1] = y
        tokens = []
        while n:
            tokens.append(last[n])
            n -= size[last[n]]
        return np.array(tokens[::-1], np.int64)


# Positions of words that are searched at a time; a word of more symbols than _LONG is searched alone.
_BLOCK = 1 << 16
_LONG = 256
# Words whose tokens a task remembers.
_REMEMBERED = 1 << 19
# Rules under which words of ASCII letters and marks are lower-cased and cut by the file's pattern, and nothing else.
_USUAL_NORMAL = {"type": "Sequence", "normalizers": [
    {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]}
_USUAL_BYTES = [{"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]
_SHOWN = re.compile(rb"[!-~]+").fullmatch


class Tokenizer:
    """A tokenizer file with word ends: its word rules, its automaton, its labels. Some 9 MB, sent to tasks as compiled.

    Special tokens are cut out of a text first. What is left is normalised and split by the file's own rules, which never
    look across an ASCII white space; so texts are cut there, and each distinct piece is worked out once.
    """

    def __init__(self, spec: str):
        rules = json.loads(spec)
        model = rules["model"]
        if model["type"] != "BPE" or not model["end_of_word_suffix"] or rules["decoder"] is not None:
            raise ValueError("only byte-pair encodings with word ends and no decoder are known here")
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.automaton = Automaton(model["vocab"], merges, model["end_of_word_suffix"])
        special = {t["content"]: t["id"] for t in rules["added_tokens"]}
        labels = {i: t for t, i in (model["vocab"] | special).items()}
        self.labels = [labels.get(i, "").encode() for i in range(max(labels) + 1)]
        self.special = {t.encode(): i for t, i in special.items()}
        # the rules for words alone
        alphabet = {t: i for i, t in enumerate(byte_letters().values())}
        self.word_rules = json.dumps(rules | {"model": model | {"vocab": alphabet, "merges": []}, "added_tokens": []})
        cut, *rest = rules["pre_tokenizer"].get("pretokenizers", [{}])
        usual = rules["normalizer"] == _USUAL_NORMAL and rest == _USUAL_BYTES and (cut.get("behavior"), cut.get("invert")) == ("Removed", True)
        self.cut_ascii = cut["pattern"]["Regex"] if usual else None

    @classmethod
    def from_file(cls, path: str) -> Tokenizer:
        with open(path, encoding="utf-8") as file:
            return cls(file.read())

    def __getstate__(self):
        return {k: v for k, v in vars(self).items() if k not in ("words", "pieces", "_rules", "_ascii", "_bytes")}

    @cached_property
    def _rules(self):
        import tokenizers

        return tokenizers.Tokenizer.from_str(self.word_rules)

    @cached_property
    def _ascii(self):
        return regex.compile(self.cut_ascii).findall

    @cached_property
    def _bytes(self) -> dict[int, int]:
        return {ord(letter): byte for byte, letter in byte_letters().items()}

    @cached_property
    def words(self) -> dict[bytes, bytes]:
        return {}

    @cached_property
    def pieces(self) -> dict[bytes, bytes]:
        return {}

    def _split(self, word: bytes) -> list[bytes]:
        """Normalised pieces of a stretch without ASCII white space, as bytes."""
        if self.cut_ascii and (word.isalpha() or _SHOWN(word)):
            plain = word.lower()
            return [plain] if word.isalpha() else [p.encode() for p in self._ascii(plain.decode())]
        plain = self._rules.normalizer.normalize_str(word.decode())
        return [piece.translate(self._bytes).encode("latin-1") for piece, _ in self._rules.pre_tokenizer.pre_tokenize_str(plain)]

    def _learn(self, words: Iterable[bytes]) -> None:
        """The tokens of words not met before, as little-endian 32-bit numbers."""
        cut = re.compile(b"(" + b"|".join(map(re.escape, self.special)) + b")") if self.special else None
        if len(self.pieces) > _REMEMBERED:
            self.pieces.clear()
        # a space sets special tokens apart from pieces, which hold none
        self.pieces.update({b" " + s: i.to_bytes(4, "little") for s, i in self.special.items()})
        parts = {}
        for word in words:
            if cut and any(map(word.__contains__, self.special)):
                parts[word] = [p for s in cut.split(word) if s for p in ([b" " + s] if s in self.special else self._split(s))]
            else:
                parts[word] = self._split(word)
        listed = list(set().union(*parts.values()).difference(self.pieces))
        for piece, tokens in zip(listed, self.automaton.encode(listed)):
            self.pieces[piece] = tokens.astype("<u4").tobytes()
        for word, own in parts.items():
            self.words[word] = b"".join(map(self.pieces.__getitem__, own))

    def encode(self, batch: list[bytes]) -> list[bytes]:
        """Each text's tokens, as little-endian 32-bit numbers one after the other."""
        if len(self.words) > _REMEMBERED:
            self.words.clear()
        cut = [text.split() for text in batch]
        self._learn(set().union(*cut).difference(self.words))
        return [b"".join(map(self.words.__getitem__, words)) for words in cut]

    def decode(self, ids: bytes) -> str:
        """The labels of the arcs that the tokens are, with a space between two, as the file names no decoder."""
        labels = self.labels
        return b" ".join([labels[i] for i in np.frombuffer(ids, "<u4").tolist()]).decode()


def _slices(batch: pa.RecordBatch, column: str) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """A batch by runs of rows with some 4 MB in ``column``, a row at least."""
    values = texts(batch.column(column))
    low, held = 0, 0
    for i, value in enumerate(values):
        if held and held + len(value) > _SLICE:
            yield batch.slice(low, i - low), values[low:i]
            low, held = i, 0
        held += len(value)
    if low < len(values):
        yield batch.slice(low), values[low:]


_SLICE = 1 << 22


def _with(rows: pa.RecordBatch, shape: T.StructType, into: str, values: pa.Array) -> pa.RecordBatch:
    columns = [values if f.name.lower() == into.lower() else rows.column(f.name) for f in shape]
    return pa.RecordBatch.from_arrays(columns, [f.name for f in shape])


def encoded(docs: DataFrame, tokenizer: Tokenizer, text: str = "text", into: str = "ids") -> DataFrame:
    """``docs`` with ``into``, each text's tokens as little-endian unsigned 32-bit numbers one after the other.

    Null is encoded as the empty text: no token. A column of the name ``into`` is replaced; other columns, repeated rows and
    null ids pass. Special tokens in a text are taken as such. Rows stay in their partitions; a task holds one slice of some
    megabytes of text, or one text, and the tokens of the words it met lately. A word of any length has one linear search.
    """
    shape = docs.withColumn(into, F.lit(b"")).schema
    shared = docs.sparkSession.sparkContext.broadcast(tokenizer)

    def run(batches):
        own = shared.value
        for batch in batches:
            for rows, values in _slices(batch, text):
                ids = pa.array(own.encode(values), pa.binary())
                yield _with(rows, shape, into, ids)

    return docs.mapInArrow(run, shape)


def decoded(rows: DataFrame, tokenizer: Tokenizer, ids: str = "ids", into: str = "decoded") -> DataFrame:
    """``rows`` with ``into``, the text that their tokens spell. Null ids spell the empty text."""
    shape = rows.withColumn(into, F.lit("")).schema
    shared = rows.sparkSession.sparkContext.broadcast(tokenizer)

    def run(batches):
        own = shared.value
        for batch in batches:
            for part, values in _slices(batch, ids):
                spelled = pa.array([own.decode(v) for v in values], pa.string())
                yield _with(part, shape, into, spelled)

    return rows.mapInArrow(run, shape)
