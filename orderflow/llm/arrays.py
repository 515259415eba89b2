"""Sorted arrays in files of the shared folder, memory-mapped by tasks."""

from __future__ import annotations

import tempfile
import uuid
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame


def mapped(path: str, dtype) -> np.ndarray:
    """A file as an array. A file of a local or mounted folder is mapped where it is; of any other store, as a copy that goes with the mapping."""
    filesystem, name = fs.FileSystem.from_uri(path)
    if isinstance(filesystem, fs.LocalFileSystem):
        return np.memmap(name, dtype, "r").view(np.ndarray) if filesystem.get_file_info(name).size else np.zeros(0, dtype)
    with tempfile.NamedTemporaryFile() as copy, filesystem.open_input_stream(name, compression=None) as source:
        while block := source.read(1 << 24):
            copy.write(block)
        copy.flush()
        return np.memmap(copy.name, dtype, "r").view(np.ndarray) if copy.tell() else np.zeros(0, dtype)


class Out:
    """Files of one task's arrays, by column."""

    def __init__(self, root: str):
        self.stem = f"{root}/{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex[:12]}"
        self.streams: dict[str, pa.NativeFile] = {}

    def append(self, name: str, values: np.ndarray) -> None:
        if name not in self.streams:
            filesystem, path = fs.FileSystem.from_uri(f"{self.stem}-{name}")
            filesystem.create_dir(path.rpartition("/")[0], recursive=True)
            self.streams[name] = filesystem.open_output_stream(path, compression=None)
        self.streams[name].write(np.ascontiguousarray(values).tobytes())

    def close(self) -> None:
        for stream in self.streams.values():
            stream.close()


@dataclass(frozen=True)
class Manifest:
    """Where the shards of a table are, by rising first key: stems and first keys. A row per shard is all the driver holds."""

    stems: tuple[str, ...]
    firsts: tuple[int, ...]
    values: tuple[tuple[str, str], ...]


def write(rows: DataFrame, root: str, values: dict[str, str], shards: int) -> Manifest:
    """``rows`` (key long, values) as sorted arrays below ``root``, in ``shards`` ranges of keys.

    Each task writes files of its own name, and only those of tasks that ended well come into the manifest.
    """
    names = list(values)

    def run(batches):
        out, first = None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            if out is None:
                out, first = Out(root), batch.column("key")[0].as_py()
            out.append("key", batch.column("key").to_numpy())
            for name in names:
                out.append(name, batch.column(name).to_numpy().astype(values[name]))
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_arrays([pa.array([out.stem]), pa.array([first])], ["stem", "first"])

    ordered = rows.select("key", *names).repartitionByRange(shards, "key").sortWithinPartitions("key")
    found = sorted(ordered.mapInArrow(run, "stem string, first long").collect(), key=lambda r: r["first"])
    return Manifest(tuple(r["stem"] for r in found), tuple(r["first"] for r in found), tuple(values.items()))


class Table:
    """A manifest's arrays, mapped when first asked."""

    def __init__(self, manifest: Manifest):
        self.manifest, self.open = manifest, {}
        self.firsts = np.array(manifest.firsts, np.int64)

    def shard(self, k: int) -> tuple[np.ndarray, dict[str, np.ndarray]]:
        if k not in self.open:
            stem = self.manifest.stems[k]
            self.open[k] = mapped(f"{stem}-key", np.int64), {n: mapped(f"{stem}-{n}", t) for n, t in self.manifest.values}
        return self.open[k]

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, dict[str, np.ndarray]]:
        """Whether each of rising keys is there, and its values (0 where not)."""
        known = np.zeros(len(keys), bool)
        values = {n: np.zeros(len(keys), t) for n, t in self.manifest.values}
        cuts = np.append(np.searchsorted(keys, self.firsts), len(keys))
        for k, (low, high) in enumerate(zip(cuts[:-1].tolist(), cuts[1:].tolist())):
            if low < high:
                own, columns = self.shard(k)
                at = np.minimum(np.searchsorted(own, keys[low:high]), len(own) - 1)
                known[low:high] = own[at] == keys[low:high]
                for n in values:
                    values[n][low:high] = np.where(known[low:high], columns[n][at], 0)
        return known, values
