"""Arrays in the shared folder: written by tasks, memory-mapped by workers.

The folder is the one named in spark.checkpoint.dir. Where it is a mounted path, workers
map the files themselves and share the pages. In another store, each worker maps a copy
without a name, which is gone when the worker is.
"""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid
from collections import OrderedDict
from collections.abc import Iterator
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from shelfcast.llm.blocks import mix
from shelfcast.session import shared_folder


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder for the arrays of one model or index."""
    root = shared_folder(spark).rstrip("/")
    return f"{root}/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def _mounted(folder: str) -> str | None:
    parts = urlparse(folder)
    return parts.path if parts.scheme in ("", "file") else None


def _store(folder: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(folder)


def write_array(folder: str, name: str, array: np.ndarray) -> None:
    """Write whole and then name it: a task that is lost or run twice does no harm."""
    path = _mounted(folder)
    part = f".{name}.{uuid.uuid4().hex}"
    if path is not None:
        os.makedirs(path, exist_ok=True)
        with open(f"{path}/{part}", "wb") as file:
            np.save(file, array)
        os.replace(f"{path}/{part}", f"{path}/{name}.npy")
        return
    store, path = _store(folder)
    store.create_dir(path, recursive=True)
    with store.open_output_stream(f"{path}/{part}") as file:
        np.save(file, array)
    store.move(f"{path}/{part}", f"{path}/{name}.npy")


def mapped(folder: str, name: str) -> np.ndarray:
    """The array, mapped into memory for reading."""
    path = _mounted(folder)
    if path is not None:
        return np.load(f"{path}/{name}.npy", mmap_mode="r")
    store, path = _store(folder)
    with store.open_input_stream(f"{path}/{name}.npy") as source, tempfile.TemporaryFile() as copy:
        shutil.copyfileobj(source, copy)
        copy.seek(0)
        version = np.lib.format.read_magic(copy)
        read = np.lib.format.read_array_header_1_0 if version == (1, 0) else np.lib.format.read_array_header_2_0
        shape, _, dtype = read(copy)
        return np.memmap(copy, dtype, "r", copy.tell(), shape) if shape[0] else np.zeros(0, dtype)


MOST_OPEN = 4096
"""Maps a worker keeps open; systems limit them to some 65,000 a process."""


class Maps:
    """The arrays of a folder, each mapped when it is asked for; the last used stay open."""

    def __init__(self, folder: str, most: int | None = None):
        self.folder, self.most = folder, most or MOST_OPEN
        self.held: OrderedDict[str, np.ndarray] = OrderedDict()

    def __getitem__(self, name: str) -> np.ndarray:
        if name not in self.held:
            if len(self.held) >= self.most:
                self.held.popitem(last=False)
            self.held[name] = mapped(self.folder, name)
        self.held.move_to_end(name)
        return self.held[name]


_KINDS = [np.dtype(np.int64), np.dtype(np.uint64), np.dtype(np.uint8)]


def write_arrays(folder: str, name: str, arrays: list[np.ndarray]) -> None:
    """Several arrays in one file, so that a worker needs one map for all of them."""
    parts = [np.array([len(arrays), *(x for a in arrays for x in (_KINDS.index(a.dtype), len(a)))], np.int64).view(np.uint8)]
    for array in arrays:
        held = np.ascontiguousarray(array).view(np.uint8)
        parts += [held, np.zeros(-len(held) % 8, np.uint8)]
    write_array(folder, name, np.concatenate(parts))


def mapped_arrays(folder: str, name: str) -> list[np.ndarray]:
    """The arrays of one file, in turn."""
    whole = np.asarray(mapped(folder, name))
    number = int(whole[:8].view(np.int64)[0])
    at = 8 + 16 * number
    out = []
    for kind, length in whole[8:at].view(np.int64).reshape(-1, 2).tolist():
        size = length * _KINDS[kind].itemsize
        out.append(whole[at : at + size].view(_KINDS[kind]))
        at += size + -size % 8
    return out


SHARD_IDS = 1_000_000


def shard_of(hashes: np.ndarray, shards: int) -> np.ndarray:
    """Which of so many equal ranges of 64-bit numbers each falls into."""
    return ((hashes >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)).astype(np.int64)


def write_ids(ids: DataFrame, name: str) -> dict:
    """Write the long column of `ids` as sorted arrays by range of hash; where they are."""
    (column,) = ids.columns
    folder, shards = new_folder(ids.sparkSession, name), max(1, -(-ids.count() // SHARD_IDS))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            told = batch.column(0).to_numpy(zero_copy_only=False)
            shard = shard_of(mix(told.astype(np.int64).view(np.uint64)), shards)
            yield pa.RecordBatch.from_arrays([pa.array(shard), batch.column(0)], names=["shard", "id"])

    def write(key: tuple, table: pa.Table) -> pa.Table:
        write_array(folder, f"ids-{key[0].as_py():06d}", np.unique(table.column("id").to_numpy()))
        return pa.table({"shard": [key[0].as_py()]})

    placed = ids.select(column).mapInArrow(place, "shard long, id long")
    written = placed.groupBy("shard").applyInArrow(write, "shard long").collect()
    return {"folder": folder, "shards": shards, "written": {r["shard"] for r in written}}


class Ids:
    """A set of ids in mapped arrays."""

    def __init__(self, place: dict):
        self.place, self.arrays = place, {}

    def hold(self, ids: np.ndarray) -> np.ndarray:
        """Whether each id is in the set."""
        found = np.zeros(len(ids), bool)
        shard = shard_of(mix(ids.astype(np.int64).view(np.uint64)), self.place["shards"])
        for s in set(shard.tolist()) & self.place["written"]:
            if s not in self.arrays:
                self.arrays[s] = mapped(self.place["folder"], f"ids-{s:06d}")
            mine = np.flatnonzero(shard == s)
            at = np.minimum(np.searchsorted(self.arrays[s], ids[mine]), len(self.arrays[s]) - 1)
            found[mine] = self.arrays[s][at] == ids[mine]
        return found
