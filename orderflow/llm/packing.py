"""Number columns of many rows that go to one place, as one compressed value each: what tasks send without a row apiece."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard


def packed(*columns: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(np.concatenate([c.astype(np.int64, copy=False) for c in columns]).tobytes())


def unpacked(blobs: list[bytes], width: int, rising: bool = False) -> list[np.ndarray]:
    """The columns of all values, one after the other; one value at a time is held beside them. ``rising`` as in ``dealt``."""
    ends = np.cumsum([0, *(zstandard.frame_content_size(b) // (8 * width) for b in blobs)]).tolist()
    out = [np.empty(ends[-1], np.int64) for _ in range(width)]
    for blob, a, b in zip(blobs, ends[:-1], ends[1:]):
        part = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.int64).reshape(width, -1)
        for column, own in zip(out, part):
            column[a:b] = own
        if rising:
            np.cumsum(part[0], out=out[0][a:b])
    return out


def dealt(part: np.ndarray, *columns: np.ndarray, rising: bool = False) -> pa.Table:
    """Rows (part, blob), one per part. With fewer rows than parts it is a row apiece again, never worse.

    ``rising`` says that the first column rises within a part; it goes as differences, which pack well.
    """
    order = np.argsort(part, kind="stable")
    part, columns = part[order], [c[order] for c in columns]
    cuts = np.append(np.flatnonzero(np.append(True, part[1:] != part[:-1])), len(part)) if len(part) else np.zeros(1, np.int64)
    if rising and len(part):
        steps = np.diff(columns[0], prepend=0)
        steps[cuts[:-1]] = columns[0][cuts[:-1]]
        columns[0] = steps
    blobs = [packed(*(c[a:b] for c in columns)) for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist())]
    return pa.table({"part": pa.array(part[cuts[:-1]].astype(np.int64)), "blob": pa.array(blobs, pa.binary())})


SCHEMA = "part long, blob binary"


def by_part(batches) -> list[tuple[int, list[bytes]]]:
    """A task's rows by part, still packed."""
    held: dict[int, list[bytes]] = {}
    for batch in batches:
        for part, blob in zip(batch.column("part").to_pylist(), batch.column("blob").to_pylist()):
            held.setdefault(part, []).append(blob)
    return sorted(held.items())
