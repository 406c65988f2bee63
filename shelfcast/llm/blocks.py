"""Texts as byte blocks: the shared base of the operators that read texts with numpy.

Arrow batches are cut into blocks of some megabytes, so that a worker's memory depends on
the block and on the longest single text, never on the batch or the partition.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 2 << 20
BLOCK_ROWS = 4096

# ASCII white space, and the bytes that end a word made of letters and digits.
WHITE_SPACE = np.zeros(256, bool)
WHITE_SPACE[[0x20, *range(0x09, 0x0E)]] = True
WORD_BYTE = np.zeros(256, bool)
WORD_BYTE[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x41, 0x5B), *range(0x80, 0x100)]] = True

LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


@dataclass
class Block:
    """Some rows of a batch: `data[offsets[i]:offsets[i + 1]]` is the text of row i."""

    rows: pa.RecordBatch
    data: np.ndarray
    offsets: np.ndarray

    def texts(self) -> list[bytes]:
        whole, cut = self.data.tobytes(), self.offsets.tolist()
        return [whole[a:b] for a, b in zip(cut, cut[1:])]


def blocks(
    batches: Iterator[pa.RecordBatch], column: str = "text", most_bytes: int = BLOCK_BYTES, most_rows: int = BLOCK_ROWS
) -> Iterator[Block]:
    """Cut batches into blocks; a null text counts as empty."""
    for batch in batches:
        if not batch.num_rows:
            continue
        texts = batch.column(column).cast(pa.large_string()).fill_null("")
        _, places, values = texts.buffers()
        offsets = np.frombuffer(places, np.int64, len(texts) + 1, 8 * texts.offset)
        data = np.frombuffer(values, np.uint8) if values and values.size else np.zeros(0, np.uint8)
        start = 0
        while start < len(texts):
            end = int(np.searchsorted(offsets, offsets[start] + most_bytes, "right")) - 1
            end = min(max(end, start + 1), start + most_rows, len(texts))
            yield Block(
                batch.slice(start, end - start),
                data[offsets[start] : offsets[end]],
                offsets[start : end + 1] - offsets[start],
            )
            start = end


def word_spans(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the runs where `inside` holds, none across texts.

    Third result: text i has the words from `bounds[i]` up to `bounds[i + 1]`.
    """
    begins, closes = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    closes[:-1] &= ~inside[1:]
    edges = offsets[:-1][np.diff(offsets) > 0]
    begins[edges] = inside[edges]
    lasts = offsets[1:][np.diff(offsets) > 0] - 1
    closes[lasts] = inside[lasts]
    starts, ends = np.flatnonzero(begins), np.flatnonzero(closes) + 1
    return starts, ends, np.searchsorted(starts, offsets)


_STEP = np.uint64(0x9E3779B97F4A7C15)  # odd, so that it has an inverse modulo 2**64
_BACK = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_powers: dict[str, np.ndarray] = {}


def _powers_of(base: np.uint64, name: str, n: int) -> np.ndarray:
    if len(_powers.get(name, ())) < n:
        steps = np.full(n, base, np.uint64)
        steps[0] = 1
        _powers[name] = np.multiply.accumulate(steps)
    return _powers[name][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads them over the whole range."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each `data[start:end]`: a polynomial of its bytes, then mixed.

    The sums of all words come from one running sum; dividing by the power at a word's
    start makes its hash independent of its place.
    """
    if not len(starts):
        return np.zeros(0, np.uint64)
    size = max(len(data), BLOCK_BYTES)
    with np.errstate(over="ignore"):
        running = (data.astype(np.uint64) + np.uint64(1)) * _powers_of(_STEP, "up", size)[: len(data)]
        np.cumsum(running, out=running)
        sums = running[ends - 1]
        later = starts > 0
        sums[later] -= running[starts[later] - 1]
        return mix(sums * _powers_of(_BACK, "down", size)[starts])


def add_up(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, and the sum of each one's values."""
    if not len(keys):
        return keys, values
    order = np.argsort(keys, kind="stable")
    keys, values = keys[order], values[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[first], np.add.reduceat(values, first)
