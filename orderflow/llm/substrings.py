"""Exact substring dedup over a corpus by suffix arrays of the places that can match at all."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from xxhash import xxh64_intdigest

from orderflow.llm.packing import SCHEMA, dealt, unpacked
from orderflow.llm.suffixes import suffix_array
from orderflow.llm.text import blobs, texts
from orderflow.sources.workdir import discard, fresh_dir, stored

# Bytes of a seed; a window's seed is its substring of this length with the least hash.
SEED = 24
_PIECE, _SLICE = 1 << 19, 1 << 18
# Distinct cells of one seed that a task takes together; windows of seeds with more are dealt by their content.
MOST_CELLS = 4096
# Bytes of cells per suffix array.
_BATCH = 1 << 16
# Bytes of documents per bucket, and homes per bucket.
_BUCKET_BYTES, _HOMES = 16 << 20, 2
# A cell's place and size as one number: first window start, and in the low bits how many windows.
_SIZE_BITS = 10
# Leading bits kept of seeds' and of cells' hashes: together 104, and fewer bytes to send.
_SEED_BITS, _HASH_BITS = np.uint64(2**64 - 2**16), np.uint64(2**64 - 2**8)
_CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_LAST_ID = 2**63 - 1

_rng = np.random.default_rng(6)
_BYTE = _rng.integers(0, 2**64, 256, np.uint64)
_BASE = 0x9E3779B97F4A7C15


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(29))


def substring_hashes(data: np.ndarray, length: int) -> np.ndarray:
    """A hash of each substring of a length, by doubling."""
    power, width, h, rest = _BASE, 1, _BYTE[data], None
    need, taken = length, 0
    while True:
        if need & 1:
            rest = h if rest is None else rest[: len(h) - taken] * np.uint64(power) + h[taken:]
            taken += width
        need >>= 1
        if not need:
            break
        h = h[:-width] * np.uint64(power) + h[width:]
        power, width = power * power % 2**64, 2 * width
    return _mixed(rest[: len(data) - length + 1])


def seeds(data: np.ndarray, valid: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Cells of a buffer: seed hash, first and last window start of each.

    A cell is a run of window starts whose windows have their least seed hash (the leftmost, if equal) at one place.
    Equal windows have equal seeds at equal offsets, wherever they are. ``valid`` says which starts are windows.
    """
    h = substring_hashes(data, SEED)
    width = length - SEED + 1
    key = (h & ~np.uint64((1 << 20) - 1)) | np.arange(len(h), dtype=np.uint64)
    least, span = key, 1
    while 2 * span <= width:
        least, span = np.minimum(least[:-span], least[span:]), 2 * span
    if span < width:
        least = np.minimum(least[: len(least) - (width - span)], least[width - span :])
    at = (least & np.uint64((1 << 20) - 1)).astype(np.int64)
    starts = np.flatnonzero(valid[: len(at)])
    if not len(starts):
        none = np.zeros(0, np.int64)
        return none, none, none
    at = at[starts]
    first = np.flatnonzero(np.append(True, (at[1:] != at[:-1]) | (starts[1:] != starts[:-1] + 1)))
    last = np.append(first[1:], len(starts)) - 1
    return (h[at[first]] & _SEED_BITS).view(np.int64), starts[first], starts[last]


def _pieces(data: np.ndarray, offsets: np.ndarray, length: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Slices of a batch of documents: bytes, document of each byte, position of each byte in it.

    Short documents go together, long ones in pieces of a fixed number of window starts, the same in every batch.
    """
    doc, n = 0, len(offsets) - 1
    while doc < n:
        size = offsets[doc + 1] - offsets[doc]
        if size > _SLICE:
            for low in range(0, max(1, int(size) - length + 1), _PIECE):
                part = data[offsets[doc] + low : min(offsets[doc + 1], offsets[doc] + low + _PIECE + length - 1)]
                yield part, np.full(len(part), doc), np.arange(low, low + len(part))
            doc += 1
            continue
        end = max(doc + 1, int(np.searchsorted(offsets, offsets[doc] + _SLICE, "right")) - 1)
        sizes = np.diff(offsets[doc : end + 1])
        owner = np.repeat(np.arange(doc, end), sizes)
        yield data[offsets[doc] : offsets[end]], owner, np.arange(offsets[doc], offsets[end]) - np.repeat(offsets[doc:end], sizes)
        doc = end


def cells(data: np.ndarray, offsets: np.ndarray, length: int) -> Iterator[tuple[np.ndarray, ...]]:
    """Slice by slice: bytes, and of each cell the seed, the document, its first window start there, and first and end byte in the slice."""
    for part, owner, position in _pieces(data, offsets, length):
        if len(part) < length:
            continue
        windows = len(part) - length + 1
        seed, first, last = seeds(part, owner[:windows] == owner[length - 1 :], length)
        yield part, seed, owner[first], position[first], first, last + length


def _seed_rows(length: int, parts: int):
    """Every cell's (seed, tid, place) of a home's documents but the copies, packed by part of the seed. Seeds that two
    documents of the home share need not meet others: their rows have place -place - 2 and any part, and one row with
    place -1 tells the seed's part."""

    def run(texts_: pa.Table, copies: pa.Table) -> pa.Table:
        own = texts_.filter(pc.invert(pc.is_in(texts_.column("tid"), copies.column("tid").combine_chunks()))).combine_chunks()
        held = []
        if own.num_rows:
            tids = own.column("tid").to_numpy()
            for _, seed, doc, start, low, high in cells(*blobs(own.column("text").combine_chunks()), length):
                held.append((seed, tids[doc], start << _SIZE_BITS | (high - low - length + 1)))
        if not held:
            return dealt(*[np.zeros(0, np.int64)] * 4)
        seed, tid, place = (np.concatenate(x) for x in zip(*held))
        order = np.argsort(seed, kind="stable")
        sorted_seed, sorted_tid = seed[order], tid[order]
        first = np.flatnonzero(np.append(True, sorted_seed[1:] != sorted_seed[:-1]))
        shared = np.minimum.reduceat(sorted_tid, first) != np.maximum.reduceat(sorted_tid, first)
        known = np.zeros(len(seed), bool)
        known[order] = np.repeat(shared, np.diff(np.append(first, len(seed))))
        told = sorted_seed[first[shared]]
        part = np.where(known, tid ^ (place << 20), seed)
        tid = np.concatenate((tid, np.zeros(len(told), np.int64)))
        place = np.concatenate((np.where(known, -place - 2, place), np.full(len(told), -1)))
        return dealt(np.concatenate((part, told)) % parts, np.concatenate((seed, told)), tid, place)

    return run


def shared_cells(seed: np.ndarray, tid: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(seed, tid, place) of the rows whose seed is in two documents, by what they or another row say."""
    if not len(seed):
        return seed, tid, place
    order = np.argsort(seed, kind="stable")
    seed, tid, place = seed[order], tid[order], place[order]
    first = np.flatnonzero(np.append(True, seed[1:] != seed[:-1]))
    told = np.minimum.reduceat(place, first) < 0
    many = (np.minimum.reduceat(tid, first) != np.maximum.reduceat(tid, first)) | told
    keep = np.repeat(many, np.diff(np.append(first, len(seed)))) & (place != -1)
    place = place[keep]
    return seed[keep], tid[keep], np.where(place < -1, -place - 2, place)


def _meet(homes: int):
    """Of a task's parts, the shared cells, packed by home of the document. A task's share of seeds is set by the number
    of parts, which grows with the bytes of the corpus."""

    def run(batches):
        held = [blob for batch in batches for blob in batch.column(0).to_pylist()]
        seed, tid, place = shared_cells(*unpacked(held, 3))
        if len(tid):
            yield from dealt(tid % homes, seed, tid, place).to_batches()

    return run


# A cell's occurrence; without seed and hash, a settled span of a document from start to end.
_PLACES = "seed long, hash long, id long, home int, doc int, start int, end int"


def _numbered(texts_: pa.Table) -> list[int]:
    """Each document's number in its home, by rank of its tid: shorter to send than the tid."""
    return np.unique(np.array(texts_.column("tid").to_pylist(), np.int64), return_inverse=True)[1].tolist()


def _merged(low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rising spans, those that overlap or touch made one."""
    new = np.append(True, low[1:] > np.maximum.accumulate(high)[:-1])
    return low[new], np.maximum.reduceat(high, np.flatnonzero(new))


def _find_places(length: int):
    """What a home's documents (tid, own_id, text) have of the packed shared cells.

    Of equal cells in the home those of the smallest id are open, a row each. All others are settled here, since an
    earlier document has their bytes; their spans are merged, a row each.
    """

    def run(key, texts_: pa.Table, found: pa.Table) -> pa.Table:
        seed, tid, place = unpacked(found.column("blob").to_pylist(), 3)
        order = np.lexsort((place, tid))
        seed, tid, place = seed[order], tid[order], place[order]
        start, windows = place >> _SIZE_BITS, place & ((1 << _SIZE_BITS) - 1)
        rows, numbers = [], iter(_numbered(texts_))
        for chunk in texts_.to_batches(max_chunksize=256):
            for t, i, text in zip(chunk.column("tid").to_pylist(), chunk.column("own_id").to_pylist(), texts(chunk.column("text"))):
                doc = next(numbers)
                a, b = np.searchsorted(tid, t, "left"), np.searchsorted(tid, t, "right")
                if a < b:
                    low = start[a:b]
                    high = low + windows[a:b] + (length - 1)
                    digest = np.fromiter((xxh64_intdigest(text[x:y]) for x, y in zip(low.tolist(), high.tolist())), np.uint64, b - a)
                    rows.append((seed[a:b], (digest & _HASH_BITS).view(np.int64), np.full(b - a, i), np.full(b - a, doc), low, high))
        if not rows:
            return _places([np.zeros(0, np.int64)] * 7, 0)
        seed, digest, i, doc, low, high = [np.concatenate(c) for c in zip(*rows)]
        order = np.lexsort((i, digest, seed))
        new = np.append(True, (seed[order][1:] != seed[order][:-1]) | (digest[order][1:] != digest[order][:-1]))
        chief = np.empty(len(i), np.int64)
        chief[order] = i[order][np.flatnonzero(new)][np.cumsum(new) - 1]
        open_, settled = np.flatnonzero(i == chief), np.flatnonzero(i > chief)
        columns = [c[open_] for c in (seed, digest, i, doc, low, high)]
        spans = []
        settled = settled[np.lexsort((low[settled], i[settled], doc[settled]))]
        cuts = np.append(np.flatnonzero(np.append(True, (doc[settled][1:] != doc[settled][:-1]) | (i[settled][1:] != i[settled][:-1]))), len(settled)) if len(settled) else np.zeros(1, np.int64)
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
            own = settled[a:b]
            begin, end = _merged(low[own], high[own])
            spans.append((np.full(len(begin), i[own[0]]), np.full(len(begin), doc[own[0]]), begin, end))
        more = [np.concatenate(c) for c in zip(*spans)] if spans else [np.zeros(0, np.int64)] * 4
        columns = columns[:2] + [np.concatenate(x) for x in zip(columns[2:], more)]
        return _places([*columns[:3], np.full(len(columns[2]), key[0].as_py()), *columns[3:]], len(more[0]))

    return run


def _places(columns: list[np.ndarray], settled: int) -> pa.Table:
    """Rows of _PLACES; the last ``settled`` have no seed and hash."""
    keys = [pa.concat_arrays([pa.array(c), pa.nulls(settled, pa.int64())]) for c in columns[:2]]
    return pa.table([*keys, pa.array(columns[2]), *(pa.array(c.astype(np.int32)) for c in columns[3:])], ["seed", "hash", "id", "home", "doc", "start", "end"])


def _cut_cells():
    """The bytes of cells (seed, hash, least, crowded, doc, start, end) of a home's documents."""

    def run(texts_: pa.Table, wanted: pa.Table) -> pa.Table:
        by = dict(zip(zip(_numbered(texts_), texts_.column("own_id").to_pylist()), texts(texts_.column("text").combine_chunks()))) if texts_.num_rows else {}
        cut = [by[d, i][s:e] for d, i, s, e in zip(*(wanted.column(c).to_pylist() for c in ("doc", "least", "start", "end")))]
        return pa.table({c: wanted.column(c) for c in ("seed", "hash", "least", "crowded")} | {"cell": pa.array(cut, pa.binary())})

    return run


def _twice(hashes: np.ndarray) -> np.ndarray:
    """Which hashes occur more than once."""
    order = np.argsort(hashes)
    same = hashes[order][1:] == hashes[order][:-1]
    twice = np.zeros(len(hashes), bool)
    twice[order[1:]] |= same
    twice[order[:-1]] |= same
    return twice


def _windows(sizes: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of strings one after the other: each window's string, its offset there, and its start in the whole."""
    counts = sizes - length + 1
    owner = np.repeat(np.arange(len(sizes)), counts)
    offset = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
    return owner, offset, (np.cumsum(sizes) - sizes)[owner] + offset


def _runs(picked: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First of each run of consecutive windows of one string among picked ones, and the runs' sizes."""
    first = np.flatnonzero(np.append(True, (owner[picked][1:] != owner[picked][:-1]) | (picked[1:] != picked[:-1] + 1)))
    return first, np.diff(np.append(first, len(picked)))


def window_classes(strings: list[bytes], least: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(string, offset, least) of every window: ``least`` is the smallest value among the strings that have the same window.

    Hashes leave out windows that occur once. The others form runs; equal runs are one segment with the least of their
    values. Windows that two segments have by their hashes, again in runs, make the text of a suffix array, in which
    equal windows are neighbours; neighbours are compared byte by byte.
    """
    data = b"".join(strings)
    owner, offset, at = _windows(np.array([len(s) for s in strings]), length)
    value = least[owner].copy()
    picked = np.flatnonzero(_twice(substring_hashes(np.frombuffer(data, np.uint8), length)[at]))
    if not len(picked):
        return owner, offset, value
    first, sizes = _runs(picked, owner)
    numbers: dict[bytes, int] = {}
    segment_of = np.array([numbers.setdefault(data[a : a + k + length - 1], len(numbers)) for a, k in zip(at[picked[first]].tolist(), sizes.tolist())])
    segments = list(numbers)
    best = np.full(len(segments), _LAST_ID)
    np.minimum.at(best, segment_of, value[picked[first]])
    _, per_window = _segment_classes(segments, best, length)
    counts = np.array([len(s) - length + 1 for s in segments])
    begin = (np.cumsum(counts) - counts)[segment_of]
    value[picked] = per_window[np.repeat(begin - first, sizes) + np.arange(len(picked))]
    return owner, offset, value


def _segment_classes(strings: list[bytes], least: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """String and least value of every window of distinct strings, by a suffix array of the windows that several have."""
    data = np.frombuffer(b"".join(strings), np.uint8)
    owner, _, at = _windows(np.array([len(s) for s in strings]), length)
    value = least[owner].copy()
    picked = np.flatnonzero(_twice(substring_hashes(data, length)[at]))
    if not len(picked):
        return owner, value
    first, sizes = _runs(picked, owner)
    # a separator less than any byte after each run
    text = np.concatenate([x for a, k in zip(at[picked[first]].tolist(), sizes.tolist()) for x in (data[a : a + k + length - 1].astype(np.int64) + 2, _SEPARATOR)])
    bases = np.cumsum(sizes + length) - (sizes + length)
    window_at = np.full(len(text), -1)
    window_at[np.repeat(bases - first, sizes) + np.arange(len(picked))] = picked
    suffixes = suffix_array(text)
    suffixes = suffixes[window_at[suffixes] >= 0]
    windows = np.lib.stride_tricks.sliding_window_view(text.astype(np.uint16), length)
    new = np.append(True, np.concatenate([(windows[suffixes[i + 1 : i + 8193]] != windows[suffixes[i : i + 8192][: len(suffixes[i + 1 : i + 8193])]]).any(axis=1)
                                          for i in range(0, len(suffixes) - 1, 8192)] or [np.zeros(0, bool)]))
    mine = window_at[suffixes]
    classes = np.minimum.reduceat(value[mine], np.flatnonzero(new))
    value[mine] = classes[np.cumsum(new) - 1]
    return owner, value


_SEPARATOR = np.ones(1, np.int64)


def _classes(length: int):
    """Of cells sorted by seed: (seed, cell hash, first and last window, least id) for runs of windows with one least id."""
    names = ["seed", "hash", "low", "high", "least"]

    def solve(seed, hashes, cells_, least) -> pa.RecordBatch:
        owner, offset, value = window_classes(cells_, least, length)
        first = np.flatnonzero(np.append(True, (owner[1:] != owner[:-1]) | (value[1:] != value[:-1])))
        last = np.append(first[1:], len(owner)) - 1
        low, high = offset[first].astype(np.int32), offset[last].astype(np.int32)
        return pa.RecordBatch.from_arrays([pa.array(x) for x in (seed[owner[first]], hashes[owner[first]], low, high, value[first])], names)

    def run(batches):
        held: list[tuple] = []
        size = 0
        for batch in batches:
            columns = (batch.column(0).to_numpy(), batch.column(1).to_numpy(), texts(batch.column(2)), batch.column(3).to_numpy())
            seed = columns[0]
            bounds = np.append(np.flatnonzero(np.append(True, seed[1:] != seed[:-1])), len(seed)) if len(seed) else np.zeros(1, int)
            for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
                # a seed's cells stay together, also over batches
                if size >= _BATCH and held[-1][0][-1] != seed[a]:
                    yield solved(held)
                    held, size = [], 0
                held.append(tuple(c[a:b] for c in columns))
                size += sum(map(len, columns[2][a:b]))
        if held:
            yield solved(held)

    def solved(held):
        seed, hashes, cells_, least = zip(*held)
        return solve(np.concatenate(seed), np.concatenate(hashes), [c for part in cells_ for c in part], np.concatenate(least))

    return run


def _remove(texts_: pa.Table, spans: pa.Table) -> pa.Table:
    """Of a home's documents (row, tid, own_id, text) and the spans that go: row, n_bytes, n_removed, n_spans, kept.

    A span names a document by its number in the home, or a copy by its tid.
    """
    found: dict[tuple[int, int], list[tuple[int, int]]] = {}
    for doc, own, low, high in zip(*(spans.column(c).to_pylist() for c in ("doc", "id", "low", "high"))):
        found.setdefault((doc, own), []).append((low, high))
    out, numbers = [], iter(_numbered(texts_))
    for chunk in texts_.to_batches(max_chunksize=512):
        for tid, own, text in zip(chunk.column("tid").to_pylist(), chunk.column("own_id").to_pylist(), texts(chunk.column("text"))):
            doc = next(numbers)
            runs: list[list[int]] = []
            for low, high in sorted([*found.get((doc, own), ()), *found.get((-1, tid), ())]):
                if runs and low <= runs[-1][1]:
                    runs[-1][1] = max(runs[-1][1], high)
                else:
                    runs.append([low, high])
            edges = [0, *(x for r in runs for x in r), len(text)]
            out.append((len(text), sum(b - a for a, b in runs), len(runs), b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2]))))
    columns = list(zip(*out)) if out else [[]] * 4
    types = [pa.int64(), pa.int64(), pa.int64(), pa.binary()]
    return pa.table({"row": texts_.column("row")} | {n: pa.array(list(c), t) for n, c, t in zip(("n_bytes", "n_removed", "n_spans", "kept"), columns, types)})


@contextmanager
def _cleaned(spark: SparkSession) -> Iterator[None]:
    """Jobs inside compress what they write well, and remove their shuffle files when they end: what they found is in a
    table by then."""
    settings = {_CLEAN_UP: "true", "spark.sql.parquet.compression.codec": "zstd"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def _settled(df: DataFrame, name: str) -> DataFrame:
    with _cleaned(df.sparkSession):
        return stored(df, name)


def _kept_for_now(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """``df`` stored, and where: the folder goes when what was made of it is stored too."""
    path = fresh_dir(df.sparkSession, name)
    with _cleaned(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def _own_id() -> Column:
    return F.coalesce(F.col("doc_id").cast("long"), F.lit(_LAST_ID))


def _bytes() -> Column:
    return F.coalesce(F.col("text"), F.lit("")).cast("binary")


def removed(docs: DataFrame, length: int = 50) -> DataFrame:
    """All columns of ``docs`` but the text, and n_bytes, n_removed, n_spans, kept: the bytes of the text that no earlier document has.

    A byte goes if a ``length``-byte string that covers it also starts in a document with a smaller doc_id; strings
    are those of the input and never cross documents. ``docs`` needs doc_id and text. Null text is empty; a null
    doc_id counts as larger than any other; rows of one doc_id, repeated ones too, take nothing from each other;
    texts shorter than ``length`` stay whole; an empty table gives no rows. Columns of the four names are replaced.

    1. Exact copies need no search: the first of each text (and its repetitions) goes on, a later copy loses all.
    2. Every window has a seed, its 24-byte substring of least hash; runs of windows with one seed are cells. Seeds
       found in one document only are left out.
    3. The other cells are told apart by hash. A seed with one distinct cell is settled by the least id that has it. The
       bytes of others meet by seed: suffix arrays put equal windows together, and each class gets its least id.
    4. Every occurrence of a cell loses the windows whose least id is smaller than its own. Occurrences that have an
       earlier equal one near them are settled on the spot.

    Texts move once, into a table bucketed by home, a part of some 8 MB of documents; all that is found about documents
    comes to their home. Numbers of homes and parts grow with the corpus, so what a task holds does not.
    """
    if not SEED <= length < SEED + (1 << _SIZE_BITS):
        raise ValueError(f"length must be {SEED} to {SEED + (1 << _SIZE_BITS) - 1}")
    spark = docs.sparkSession
    # Other columns travel as one, so that their names can't clash with those of the search.
    rest = [c for c in docs.columns if c not in ("text", "n_bytes", "n_removed", "n_spans", "kept")]
    docs = docs.select(F.struct(*rest).alias("row"), _own_id().alias("own_id"), "text")
    named = docs.withColumns({"digest": F.unhex(F.sha2(_bytes(), 256)), "n_bytes": F.octet_length(_bytes()).cast("long")})
    total = named.agg(F.coalesce(F.sum("n_bytes"), F.lit(0))).first()[0]
    # With fewer buckets than shuffle partitions a join would rather move the texts than what comes to them.
    buckets = max(-(-total // _BUCKET_BYTES), int(spark.conf.get("spark.sql.shuffle.partitions")))
    homes, parts = _HOMES * buckets, buckets
    placed = named.withColumn("tid", F.xxhash64("own_id", "digest")).withColumn("home", _home(homes))
    name = f"texts_{uuid.uuid4().hex}"
    with _cleaned(spark):
        placed.repartition(buckets, "home").write.option("path", fresh_dir(spark, "texts")).bucketBy(buckets, "home").saveAsTable(name)
    # its files are in the shared folder, and the frame knows their buckets: the catalog can forget it
    placed = spark.table(name)
    spark.sql(f"DROP TABLE {name}")

    def at_home(texts_: list[str], found: DataFrame, run, schema: str | T.StructType) -> DataFrame:
        """``run`` over each home's documents and what was found about them."""
        return placed.select("home", *texts_).groupBy("home").cogroup(found.groupBy("home")).applyInArrow(run, schema)

    known = placed.select("home", "tid", "own_id", "digest", "n_bytes")
    first = known.groupBy("digest").agg(F.min("own_id").alias("first"))
    copies = _settled(known.join(first, "digest").where("own_id > first").select("home", "tid", "own_id", "n_bytes"), "copies")

    seen = at_home(["tid", "text"], copies.select("home", "tid"), _seed_rows(length, parts), SCHEMA)
    met = seen.repartition(buckets, "part").select("blob").mapInArrow(_meet(homes), SCHEMA)
    shared, shared_at = _kept_for_now(met.select(F.col("part").cast("int").alias("home"), "blob"), "shared")
    places = _settled(at_home(["tid", "own_id", "text"], shared, _find_places(length), _PLACES), "places")
    discard(spark, shared_at)

    # Homes have at most a row or a few for equal cells, so that all of a seed can go to one place, once.
    open_ = places.where("seed is not null")
    chief = F.min(F.struct("id", "home", "doc", "start", "end")).alias("at")
    cells_ = open_.repartition("seed").groupBy("seed", "hash").agg(chief).select("seed", "hash", F.col("at.id").alias("least"), "at.home", "at.doc", "at.start", "at.end")
    # a window over what is at one place already: no second exchange, and rows beyond its buffer go to disk
    counted, counted_at = _kept_for_now(cells_.withColumn("n", F.count("*").over(Window.partitionBy("seed"))), "distinct-cells")
    alone = counted.where("n = 1").select("seed", "hash", F.lit(0).alias("low"), (F.col("end") - F.col("start") - length).alias("high"), "least")
    several = counted.where("n > 1").select("home", "seed", "hash", "least", (F.col("n") > MOST_CELLS).alias("crowded"), "doc", "start", "end")
    cut = at_home(["tid", "own_id", "text"], several, _cut_cells(), "seed long, hash long, least long, crowded boolean, cell binary")
    cut, cut_at = _kept_for_now(cut, "cells")
    solved = (cut.where("not crowded").select("seed", "hash", "cell", "least").repartition("seed").sortWithinPartitions("seed")
              .mapInArrow(_classes(length), "seed long, hash long, low int, high int, least long"))
    window = F.expr(f"substring(cell, at + 1, {length})")
    crowded = (cut.where("crowded").select("seed", "hash", "least", "cell", F.explode(F.sequence(F.lit(0), F.length("cell") - length)).alias("at"))
             .select("seed", "hash", "least", F.col("at").alias("low"), window.alias("window")))
    by_window = crowded.groupBy("window").agg(F.min("least").alias("known"))
    crowded = crowded.join(by_window, "window").select("seed", "hash", "low", F.col("low").alias("high"), F.col("known").alias("least"))
    runs = _settled(alone.unionByName(solved).unionByName(crowded), "window-classes")
    discard(spark, counted_at)
    discard(spark, cut_at)

    spans = open_.drop("end").join(runs, ["seed", "hash"]).where("least < id").select(
        "home", "doc", "id", (F.col("start") + F.col("low")).alias("low"), (F.col("start") + F.col("high") + length).alias("high"))
    settled = places.where("seed is null").select("home", "doc", "id", F.col("start").alias("low"), F.col("end").alias("high"))
    whole = copies.where(F.col("n_bytes") >= length).select(
        "home", F.lit(-1).alias("doc"), F.col("tid").alias("id"), F.lit(0).alias("low"), F.col("n_bytes").cast("int").alias("high"))
    schema = T.StructType([placed.schema["row"], *(T.StructField(c, T.LongType()) for c in ("n_bytes", "n_removed", "n_spans")), T.StructField("kept", T.BinaryType())])
    return at_home(["tid", "own_id", "row", "text"], spans.unionByName(settled).unionByName(whole), _remove, schema).select("row.*", "n_bytes", "n_removed", "n_spans", "kept")


def _home(homes: int) -> Column:
    return F.pmod(F.col("tid"), F.lit(homes)).cast("int")


def deduplicated(docs: DataFrame, length: int = 50) -> DataFrame:
    """``docs`` with texts cut as ``removed`` says; rows of which nothing is left are gone.

    A cut may fall inside a character; its other bytes go too, so texts stay UTF-8. Null text becomes empty; rows that
    were empty stay.
    """
    found = removed(docs, length)
    rest = [c for c in docs.columns if c != "text"]
    at = found.columns.index("kept")

    def decode(batches):
        for batch in batches:
            kept = pa.array([k.decode("utf-8", "ignore") for k in texts(batch.column(at))], pa.string())
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in rest), kept], [*rest, "text"])

    left = found.where("n_removed = 0 or n_removed < n_bytes")
    return left.mapInArrow(decode, T.StructType([*(docs.schema[c] for c in rest), T.StructField("text", T.StringType())])).select(docs.columns)
