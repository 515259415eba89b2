"""Language-model scoring with an n-gram trie in Elias-Fano coded, memory-mapped levels."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from orderflow.llm import arrays
from orderflow.llm.elias_fano import EliasFano
from orderflow.llm.packing import SCHEMA, by_part, dealt, unpacked
from orderflow.llm.text import words
from orderflow.sources.workdir import fresh_dir

# The end of a text as a token, and before its first word as context; no word holds a line end.
END = b"\n"
# Tokens that a task looks at together.
_TOKENS = 1 << 21
# Bytes of text per shard of a level. A chunk asks each shard, so an ask has to have enough rows to be worth its calls.
_SHARD_BYTES = 16 << 20
_EF = (("low", "uint64"), ("high", "uint64"), ("ones", "uint32"))


def tokens(text: bytes) -> list[bytes]:
    """Lower-cased words, then the end."""
    return [*words(text), END]


def grouped(batches, column: str, limit: int):
    """Batches put together as long as they have at most ``limit`` bytes of text, with six bytes a row more.

    A chunk asks every shard of every level, so what an ask costs by itself is paid per chunk.
    """
    held, size = [], 0
    for batch in batches:
        own = (pc.sum(pc.binary_length(batch.column(column))).as_py() or 0) + 6 * batch.num_rows
        if held and size + own > limit:
            whole, held, size = pa.concat_batches(held), [], 0
            yield whole
        held.append(batch)
        size += own
    if held:
        yield pa.concat_batches(held)


def chunks(batches, column: str = "text", size: int = _TOKENS):
    """(batch, first row, distinct token hashes in order, which of them each token is, tokens per row) over whole rows of
    about ``size`` tokens, taken as six bytes each."""
    for batch in grouped(batches, column, 6 * size):
        bodies = pc.ascii_lower(pc.fill_null(batch.column(column).cast(pa.large_string()), ""))
        ends = np.cumsum(pc.binary_length(bodies).to_numpy() + 6) // (6 * size)
        cuts = [0, *(np.flatnonzero(ends[1:] != ends[:-1]) + 1).tolist(), len(ends)]
        for low, high in zip(cuts[:-1], cuts[1:]):
            if low == high:
                continue
            yield batch, low, *_tokenised(bodies.slice(low, high - low))


def _tokenised(bodies: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct token hashes in order, which of them each token is, tokens per row. A function, so that nothing else is held
    while a chunk is looked at."""
    split = pc.ascii_split_whitespace(bodies)
    owner = np.repeat(np.arange(len(bodies)), np.diff(split.offsets.to_numpy()))
    found = split.flatten()
    # white space at either end leaves an empty string there
    full = pc.not_equal(found, "")
    owner, found = owner[full.to_numpy(zero_copy_only=False)], found.filter(full).dictionary_encode()
    hashes = np.array([*map(xxh64_intdigest, found.dictionary.to_pylist()), xxh64_intdigest(END)], np.uint64)
    sizes = np.bincount(owner, minlength=len(bodies)) + 1
    number = np.full(int(sizes.sum()), len(hashes) - 1)
    word = np.ones(len(number), bool)
    word[np.cumsum(sizes) - 1] = False
    number[word] = found.indices.to_numpy()
    order = np.argsort(hashes)
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    return hashes[order], rank[number], sizes


@dataclass(frozen=True)
class Level:
    """Shards of a level: stems by shard number ('' if it has none), nodes before each, their sequences' sizes (n, l)
    and code books. ``bits`` or ``width`` say which shard a key is in."""

    stems: tuple[str, ...]
    offsets: tuple[int, ...]
    shapes: tuple[tuple[tuple[int, int], ...], ...]
    firsts: tuple[int, ...] = ()


def _level(found: list, names: int, shards: int, firsts=()) -> Level:
    by = {r["shard"]: r for r in found}
    sizes = [by[k]["n"] if k in by else 0 for k in range(shards)]
    shapes = tuple(tuple((by[k]["shapes"][2 * j], by[k]["shapes"][2 * j + 1]) for j in range(names)) if k in by else () for k in range(shards))
    return Level(tuple(by[k]["stem"] if k in by else "" for k in range(shards)), tuple(int(x) for x in np.cumsum([0, *sizes])), shapes, tuple(firsts))


def _parts(ef: EliasFano) -> list[np.ndarray]:
    return [getattr(ef, part).astype(kind) for part, kind in _EF]


def _put(root: str, *columns: np.ndarray) -> str:
    """The stem of one file of all arrays of a shard: their lengths, then each filled up to eight bytes. A task opens every
    shard of every level, so a file an array would reach the limits of open files and mappings in a large corpus."""
    out = arrays.Out(root)
    out.append("level", np.array([len(c) for c in columns], np.uint64))
    for column in columns:
        out.append("level", column)
        out.append("level", np.zeros(-column.nbytes % 8, np.uint8))
    out.close()
    return out.stem


def _get(stem: str, kinds: list[str]) -> list[np.ndarray]:
    raw = arrays.mapped(f"{stem}-level", "uint8")
    at, out = 8 * len(kinds), []
    for n, kind in zip(raw[:at].view(np.uint64).tolist(), map(np.dtype, kinds)):
        out.append(raw[at : at + n * kind.itemsize].view(kind))
        at += -(-n * kind.itemsize // 8) * 8
    return out


def _summed(key: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rising keys without repeats, their sums, and a row that has each."""
    order = np.argsort(key, kind="stable")
    key, n = key[order], n[order]
    first = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, np.int64)
    return key[first], np.add.reduceat(n, first), order[first]


def quantised(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A byte per value and the code book: means of 256 steps of equal width, so that no value is off by over a step."""
    low = values.min(initial=0.0)
    step = max(float(values.max(initial=low) - low) / 255, 1e-12)
    code = np.rint((values - low) / step).astype(np.uint8)
    count = np.bincount(code, minlength=256)
    return code, (np.bincount(code, values, 256) / np.maximum(count, 1)).astype(np.float32)


_BUILT = "shard int, stem string, n long, tokens long, shapes array<long>"


def _built(rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [[]] * 5
    types = [pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.list_(pa.int64())]
    return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types)], ["shard", "stem", "n", "tokens", "shapes"])


def vocabulary(docs: DataFrame, bits: int) -> tuple[Level, int]:
    """First level: the sorted hashes of all tokens with their counts; a token's id is its rank. And the number of tokens."""
    root = fresh_dir(docs.sparkSession, "trie")

    def count(batches):
        held, size = [], 0
        for _, _, value, which, _ in chunks(batches):
            held.append((value, np.bincount(which, minlength=len(value))))
            size += len(held[-1][0])
            if size >= _TOKENS:
                yield from sent(held).to_batches()
                held, size = [], 0
        if held:
            yield from sent(held).to_batches()

    def sent(held):
        value, which = np.unique(np.concatenate([v for v, _ in held]), return_inverse=True)
        n = np.bincount(which, np.concatenate([c for _, c in held])).astype(np.int64)
        return dealt((value >> np.uint64(64 - bits)).astype(np.int64), value.view(np.int64), n)

    def build(batches):
        for shard, blobs in by_part(batches):
            value, n = unpacked(blobs, 2)
            value, n, _ = _summed(value, n)
            coded = EliasFano.coded(value.view(np.uint64) - np.uint64(shard << (64 - bits)))
            stem = _put(root, *_parts(coded), n.astype(np.uint64))
            yield _built([(shard, stem, len(n), int(n.sum()), [coded.n, coded.l])])

    seen = docs.select("text").mapInArrow(count, SCHEMA)
    found = seen.repartition("part").mapInArrow(build, _BUILT).collect()
    return _level(found, 1, 1 << bits), sum(r["tokens"] for r in found)


def _runs(shard: np.ndarray):
    """(shard, slice of its rows) of rising shard numbers: no look at all rows per shard."""
    cuts = [*np.flatnonzero(np.append(True, shard[1:] != shard[:-1])).tolist(), len(shard)] if len(shard) else [0]
    for a, b in zip(cuts[:-1], cuts[1:]):
        yield int(shard[a]), slice(a, b)


def _scattered(shard: np.ndarray):
    """(shard, its rows) of shard numbers in any order."""
    order = np.argsort(shard, kind="stable")
    for k, mine in _runs(shard[order]):
        yield k, order[mine]


class Trie:
    """Levels mapped when asked. Nodes of a level are numbered over all its shards."""

    def __init__(self, model: "Model"):
        self.model, self.open = model, {}
        first = model.levels[0]
        self.bits = (len(first.stems) - 1).bit_length()

    def _shard(self, level: int, k: int):
        if (level, k) not in self.open:
            spec = self.model.levels[level]
            stem, shapes = spec.stems[k], spec.shapes[k]
            kinds = [kind for _, kind in _EF]
            if level == 0:
                *words_, counts = _get(stem, [*kinds, "uint64"])
                self.open[level, k] = EliasFano(*shapes[0], *words_), counts
            else:
                columns = _get(stem, [*kinds, *kinds, "uint8", "float32", "uint8", "float32"])
                self.open[level, k] = EliasFano(*shapes[0], *columns[:3]), EliasFano(*shapes[1], *columns[3:6]), *columns[6:]
        return self.open[level, k]

    def ids(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Id (-1 if unknown) and count of each of rising hashes."""
        spec = self.model.levels[0]
        ids, counts = np.full(len(hashes), -1, np.int64), np.zeros(len(hashes), np.int64)
        for k, mine in _runs((hashes >> np.uint64(64 - self.bits)).astype(np.int64)):
            if not spec.stems[k]:
                continue
            sequence, own = self._shard(0, k)
            at = sequence.find(hashes[mine] - np.uint64(k << (64 - self.bits)))
            ids[mine] = np.where(at >= 0, at + spec.offsets[k], -1)
            counts[mine] = np.where(at >= 0, own[np.maximum(at, 0)], 0)
        return ids, counts

    def successors(self, level: int, parents: np.ndarray, words_: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Node (-1 if none), log10 probability and, where there is none, log10 back-off weight of the parent for (parent, word),
        sorted by both.

        A parent's pointers bound its successors; their words are stored as differences to what came before the
        parent, so the search is for the word relative to this context.
        """
        spec = self.model.levels[level]
        nodes, logs, backs = np.full(len(parents), -1, np.int64), np.zeros(len(parents)), np.zeros(len(parents))
        for k, mine in _runs(np.searchsorted(np.array(spec.firsts), parents, "right") - 1):
            if not spec.stems[k]:
                continue
            pointers, sequence, codes, book, back_codes, back_book = self._shard(level, k)
            parent = parents[mine] - spec.firsts[k]
            new = np.append(True, parent[1:] != parent[:-1])
            parent, which = parent[new], np.cumsum(new) - 1
            inside = np.flatnonzero(parent < pointers.n - 1)
            begin, end = np.zeros(len(parent), np.int64), np.zeros(len(parent), np.int64)
            begin[inside], end[inside] = (x.astype(np.int64) for x in pointers.access_two(parent[inside]))
            base, least = np.zeros(len(parent), np.uint64), np.zeros(len(parent), np.uint64)
            after = np.flatnonzero((begin > 0) & (end > begin))
            base[after], least[after] = sequence.access_two(begin[after] - 1)
            start = np.flatnonzero((begin == 0) & (end > begin))
            least[start] = sequence.access(begin[start])
            # the least successor is known from its parent; only words beyond it are searched
            key, at = base[which] + words_[mine].astype(np.uint64) + np.uint64(1), np.full(len(which), -1, np.int64)
            here = np.flatnonzero((end > begin)[which] & (key == least[which]))
            at[here] = begin[which[here]]
            beyond = np.flatnonzero((end > begin + 1)[which] & (key > least[which]))
            at[beyond] = sequence.find(key[beyond])
            ok = (at >= begin[which]) & (at < end[which])
            nodes[mine] = np.where(ok, at + spec.offsets[k], -1)
            logs[mine] = np.where(ok, book[codes[np.maximum(at, 0)]], 0.0)
            # without a successor the weight is 1
            none = np.flatnonzero(~ok & (end > begin)[which])
            backs[mine.start + none] = back_book[back_codes[parent[which[none]]]]
        return nodes, logs, backs

    def paths(self, value: np.ndarray, which: np.ndarray, sizes: np.ndarray, levels: int):
        """Per token of whole texts: id, count, log10 p of the first and of the last of ``levels``, and its node in the last."""
        id_, count = self.ids(value)
        total, distinct = self.model.tokens, self.model.levels[0].offsets[-1]
        ids, counts, log = id_[which], count[which], np.log10((count + 1) / (total + distinct + 1))[which]
        start = np.zeros(len(ids), bool)
        start[np.cumsum(sizes) - sizes] = True
        boundary = int(self.ids(np.array([xxh64_intdigest(END)], np.uint64))[0][0])
        base, before = log, ids
        for level in range(1, levels):
            parent = np.append(-1, before[:-1])
            parent[start] = boundary if level == 1 else -1
            ask = np.flatnonzero((parent >= 0) & (ids >= 0))
            key, back_at = self._distinct(parent[ask], ids[ask])
            found, logs, backs = self.successors(level, key[0], key[1])
            node, own = np.full(len(ids), -1, np.int64), log + 0.0
            at = found[back_at]
            node[ask] = at
            own[ask] = np.where(found >= 0, logs, backs)[back_at] + np.where(at >= 0, 0.0, log[ask])
            # a known context before an unknown word
            rest = np.flatnonzero((parent >= 0) & (ids < 0))
            if len(rest):
                p, at = np.unique(parent[rest], return_inverse=True)
                own[rest] += self.successors(level, p, np.full(len(p), self.model.levels[0].offsets[-1]))[2][at]
            log, before = own, node
        return ids, counts, base, log, before

    def unigram(self, ids: np.ndarray) -> np.ndarray:
        """log10 add-one probability of each id."""
        spec, out = self.model.levels[0], np.zeros(len(ids), np.int64)
        for k, mine in _scattered(np.searchsorted(np.array(spec.offsets), ids, "right") - 1):
            out[mine] = self._shard(0, k)[1][ids[mine] - spec.offsets[k]]
        return np.log10((out + 1) / (self.model.tokens + spec.offsets[-1] + 1))

    @staticmethod
    def _distinct(parent: np.ndarray, word: np.ndarray):
        """Distinct pairs in order, and which of them each is."""
        base = int(word.max(initial=0)) + 1
        if int(parent.max(initial=0)) < 2**62 // base:
            key, which = np.unique(parent * base + word, return_inverse=True)
            return (key // base, key % base), which
        order = np.lexsort((word, parent))
        p, w = parent[order], word[order]
        new = np.append(True, (p[1:] != p[:-1]) | (w[1:] != w[:-1])) if len(p) else np.zeros(0, bool)
        which = np.empty(len(p), np.int64)
        which[order] = np.cumsum(new) - 1
        return (p[new], w[new]), which


@dataclass(frozen=True)
class Model:
    tokens: int
    levels: tuple[Level, ...]


def extended(docs: DataFrame, model: Model, shards: int) -> Level:
    """The next level: every n-gram one longer, with Witten-Bell probabilities interpolated over the shorter ones.

    An n-gram is its context's node, found in the levels so far, and a word. Tasks count what they read; counts meet
    by ranges of context numbers, which are even because numbers follow hashes. The probability over the shorter ones goes
    along, since the task that counts has found it already. A shard holds the distinct successors of its contexts, at most
    the vocabulary for one context.
    """
    level = len(model.levels)
    contexts = model.levels[-1].offsets[-1]
    width = max(1, -(-contexts // shards))
    words_ = model.levels[0].offsets[-1]
    root = fresh_dir(docs.sparkSession, "trie")
    def count(batches):
        trie = Trie(model)
        for _, _, value, which, sizes in chunks(batches):
            if level == 1:
                before = ids = trie.ids(value)[0][which]
                log = None
            else:
                ids, _, _, log, before = trie.paths(value, which, sizes, level)
            parent = np.append(-1, before[:-1])
            start = np.cumsum(sizes) - sizes
            parent[start] = ids[-1] if level == 1 else -1  # each chunk ends with an end
            use = np.flatnonzero(parent >= 0)
            (p, w), pair = Trie._distinct(parent[use], ids[use])
            columns = [p, w]
            if level > 1:
                lower = np.zeros(len(p), np.float32)
                lower[pair] = log[use]
                columns.append(lower.view(np.int32))
            n = np.bincount(pair, minlength=len(p))
            del ids, log, before, parent, use, pair
            yield from dealt(p // width, *columns, n, rising=True).to_batches()

    def build(batches):
        trie = Trie(model)
        for shard, blobs in by_part(batches):
            columns, low = unpacked(blobs, 4 if level > 1 else 3, rising=True), shard * width
            key, n, row = _summed((columns[0] - low) * words_ + columns[1], columns[-1])
            parent, word = key // words_ + low, key % words_
            del key
            p_lower = columns[2][row].astype(np.int32).view(np.float32).astype(float) if level > 1 else trie.unigram(word)
            del columns, row
            first = np.flatnonzero(np.append(True, parent[1:] != parent[:-1]))
            sizes = np.diff(np.append(first, len(parent)))
            totals = np.add.reduceat(n, first)
            kinds, mass = np.repeat(sizes, sizes), np.repeat(totals, sizes)
            log = np.log10((n + kinds * 10.0**p_lower) / (mass + kinds))
            del p_lower, kinds, mass
            count_of = min(width, contexts - low)
            per = np.zeros(count_of, np.int64)
            per[parent[first] - low] = sizes
            back = np.zeros(count_of)
            back[parent[first] - low] = np.log10(sizes / (totals + sizes))
            last = word[first + sizes - 1] + 1
            base = np.repeat(np.cumsum(last) - last, sizes)
            pointers, nodes = EliasFano.coded(np.append(0, np.cumsum(per))), EliasFano.coded(base + word + 1)
            stem = _put(root, *_parts(pointers), *_parts(nodes), *quantised(log), *quantised(back))
            yield _built([(shard, stem, len(n), int(n.sum()), [pointers.n, pointers.l, nodes.n, nodes.l])])

    seen = docs.select("text").mapInArrow(count, SCHEMA)
    found = seen.repartition("part").mapInArrow(build, _BUILT).collect()
    return _level(found, 2, shards, [k * width for k in range(shards)])


def shard_bits(total_bytes: int) -> int:
    """Levels have 2 to the power of this number of shards."""
    return max(1, (total_bytes // _SHARD_BYTES).bit_length())


def fit(docs: DataFrame, order: int = 3) -> Model:
    """The trie of all texts of ``docs``. A level is one pass; what the driver holds is a row per shard."""
    total_bytes = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    bits = shard_bits(total_bytes)
    first, total = vocabulary(docs, bits)
    model = Model(total, (first,))
    while len(model.levels) < order and total:
        model = Model(total, (*model.levels, extended(docs, model, 1 << bits)))
    return model


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, base_score, score of each row of ``docs`` (doc_id, held_out, text)."""

    def run(batches):
        trie = Trie(model)
        for batch, first, value, which, sizes in chunks(batches):
            _, counts, base, log, _ = trie.paths(value, which, sizes, len(model.levels))
            starts = np.cumsum(sizes) - sizes
            rows = batch.slice(first, len(sizes))
            columns = [pa.array(sizes), pa.array(np.add.reduceat((counts > 0).astype(np.int64), starts)), pa.array(np.add.reduceat(base, starts)), pa.array(np.add.reduceat(log, starts))]
            yield pa.RecordBatch.from_arrays([rows.column("doc_id"), rows.column("held_out"), *columns], ["doc_id", "held_out", "n_tokens", "n_known", "base_score", "score"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "held_out", "text")
    return rows.mapInArrow(run, "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double")


def split(docs: DataFrame, folds: int = 7, fold: int = 2) -> DataFrame:
    """Adds held_out: the checksum of the id as text falls on ``fold``. A null id is not held out."""
    return docs.withColumn("held_out", F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % folds == fold, F.lit(False)))


def evaluated(docs: DataFrame, order: int = 3) -> DataFrame:
    """Scores of all rows of ``docs`` (doc_id, text) by a model of those that are not held out.

    Tokens are lower-cased words and an end. base_score is the add-one unigram model's log10 probability, score the
    trie's. Null text is empty and has the end alone; repeated rows train and are scored each; without training rows
    all tokens are unknown, and both scores are that of an empty model; an empty table gives no rows.
    """
    docs = split(docs.select("doc_id", "text"))
    model = fit(docs.where("not held_out"), order)
    return scored(docs, model).withColumn("train_tokens", F.lit(model.tokens).cast("long"))
