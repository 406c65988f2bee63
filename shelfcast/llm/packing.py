"""Best-fit packing of documents into sequences, online and in bounded space.

Texts become token ids, each document ending with an end id. Documents longer than a
sequence are cut: the remainder comes first, the other pieces fill a sequence each. The
remaining pieces are packed online: each goes to the open bin with the least sufficient
free space. A fixed number of bins is open; they hang on a bitset keyed by free space, so
the best fit is the lowest set bit from the piece's length up, and when there are too many
the fullest, the lowest bit of all, closes first.

Pieces are small rows (no ids), written once. They are dealt evenly into groups by a serial
number, so neither a hot source nor repeated rows fill a group, and each group of bounded
size is packed in one task, its pieces in turn by that number, as they come. The number of groups follows the number of pieces.

Defined results: a null text counts as empty and is one piece holding the end id; repeated
rows are packed each; equal fits go to the bin that waits longest; an empty table gives an empty table.
"""

from __future__ import annotations

import base64
import json
import zlib
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.blocks import blocks
from shelfcast.session import stage

SEQUENCE = 2048
END_ID = 0
OPEN_BINS = 256
GROUP_PIECES = 16384
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, serial long"

# Fixed value: how byte-level BPE vocabularies split a text into stretches.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def byte_letters() -> dict[str, int]:
    """The letters that stand for bytes in byte-level vocabularies: printable ones for
    themselves, the others counted on from 256."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + n): b for n, b in enumerate(others)}


def encoder(path: str):
    """An encoder with the ids of the byte-level BPE vocabulary file at `path`.

    tiktoken gives the ids that `tokenizers` gives for the same file (the tests compare
    them) in a fraction of the time.
    """
    import tiktoken

    with open(path, encoding="utf-8") as file:
        told = json.load(file)
    special = {t["content"]: t["id"] for t in told["added_tokens"]}
    letters = byte_letters()
    ranks = {bytes(letters[c] for c in word): rank for word, rank in told["model"]["vocab"].items() if word not in special}
    return tiktoken.Encoding("vocabulary", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens=special)


def cuts(total: int, size: int = SEQUENCE) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces; the remainder, if any, comes first."""
    first = total % size
    pieces = [(0, first)] if first else []
    return pieces + [(at, size) for at in range(first, total, size)]


def _cut_documents(vocabulary: str, size: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary).encode
        serial = 0
        from pyspark import TaskContext

        first = TaskContext.get().partitionId() << 40
        for block in blocks(batches, most_rows=1024):
            ids = block.rows.column("doc_id").to_pylist()
            rows: list[tuple] = []
            for doc_id, text in zip(ids, block.texts()):
                tokens = np.array([*encode(text.decode(), allowed_special="all"), END_ID], "<u4")
                for piece, (start, length) in enumerate(cuts(len(tokens), size)):
                    crc = zlib.crc32(tokens[start : start + length].tobytes())
                    rows.append((doc_id, piece, start, length, crc, first + serial))
                    serial += 1
            kinds = [pa.int64(), pa.int32(), *[pa.int64()] * 4]
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "serial"]
            columns = [pa.array(c, k) for c, k in zip(zip(*rows), kinds)]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return cut


def cut_documents(docs: DataFrame, vocabulary: str, size: int = SEQUENCE) -> DataFrame:
    """A row per piece: where it starts in its document, its length and its ids' CRC-32."""
    rows = docs.select(F.col("doc_id").cast("long"), "text")
    return rows.mapInArrow(_cut_documents(vocabulary, size), PIECES)


def best_fit(lengths: list[int], size: int = SEQUENCE, open_bins: int = OPEN_BINS) -> tuple[list[int], list[int]]:
    """Bin number and offset of each piece, taken in turn."""
    free_bits, by_free = 0, [deque() for _ in range(size + 1)]
    bins, offsets, opened, n_open = [], [], 0, 0
    for length in lengths:
        fitting = free_bits >> length
        if fitting:
            free = length + (fitting & -fitting).bit_length() - 1
            number = by_free[free].popleft()
            if not by_free[free]:
                free_bits ^= 1 << free
            n_open -= 1
        else:
            if n_open == open_bins:
                fullest = (free_bits & -free_bits).bit_length() - 1
                by_free[fullest].popleft()
                if not by_free[fullest]:
                    free_bits ^= 1 << fullest
                n_open -= 1
            number, free, opened = opened, size, opened + 1
        bins.append(number)
        offsets.append(size - free)
        free -= length
        if free:
            by_free[free].append(number)
            free_bits |= 1 << free
            n_open += 1
    return bins, offsets


def pack(pieces: DataFrame, size: int = SEQUENCE, open_bins: int = OPEN_BINS, group_pieces: int = GROUP_PIECES) -> DataFrame:
    """Pieces with sequence_id and offset. Full pieces take a sequence each, by their serial."""
    partial = pieces.filter(F.col("length") < size)
    groups = max(1, -(-partial.count() // group_pieces))

    def fit(key: tuple, rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("serial")
        bins, offsets = best_fit(rows.column("length").to_pylist(), size, open_bins)
        sequence = np.array(bins, np.int64) + (key[0].as_py() << 32)
        return rows.drop_columns(["group", "serial"]).append_column("sequence_id", pa.array(sequence)).append_column(
            "offset", pa.array(offsets, pa.int64())
        )

    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    dealt = partial.withColumn("group", F.pmod(F.xxhash64("serial"), F.lit(groups)))
    fitted = dealt.groupBy("group").applyInArrow(
        fit, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    )
    whole = pieces.filter(F.col("length") == size).select(
        *columns, (-1 - F.col("serial")).alias("sequence_id"), F.lit(0).cast("long").alias("offset")
    )
    return fitted.unionByName(whole)


def pack_documents(docs: DataFrame, vocabulary: str, size: int = SEQUENCE, **limits) -> DataFrame:
    """All documents cut into pieces and packed: a row per piece."""
    return pack(stage(cut_documents(docs, vocabulary, size), "packing-pieces"), size, **limits)
