"""SimHash near-duplicates: fingerprints, a range join over a popcount grid, components.

A fingerprint is embedded by the number of set bits in each of its segments. The Manhattan
distance of two embeddings is at most the Hamming distance of the fingerprints, so pairs
within the bound are found where the embeddings are that close, and then verified on the
bits. The grid: the segments are dealt into blocks; of two embeddings at distance d, at
most d blocks differ, so the pair agrees on all coordinates of some choice of blocks less
d. One key per choice makes an equal join out of the range join, without enumerating
neighbouring cells. The number of blocks follows the number of fingerprints, which keeps
the cells about as full at every size.

Cells with many members (groups of near copies) are not paired off. Two fingerprints differ
in at most two bits just if some value is at most one bit from both; so their members meet
at their own value and its 64 one-bit neighbours, and each such meeting is chained to its
smallest member. That is exact and linear, whatever the size of the group.

Defined results: a null or empty text has fingerprint zero and is linked like any other;
rows without doc_id come last as names of a component (a component of only such rows has a
null id); repeated rows get a row each; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce
from itertools import combinations
from math import comb, log2

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfcast.llm.arrays import Ids, write_ids
from shelfcast.llm.blocks import LOWER, WHITE_SPACE, Block, blocks, word_spans
from shelfcast.session import stage

SEED = 42
SHINGLE = 3
NO_ID = 2**63 - 1
SEGMENT_BITS = 2
FULL_CELL = 32
"""Cells with more members meet over one-bit neighbours in place of pairs."""

BITS, OWN, ROOT = "__bits", "__own", "__root"


def fingerprint(words: list[bytes], shingle: int = SHINGLE) -> int:
    """The fingerprint of one text's words; the plain form of what `fingerprints` does."""
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i : i + shingle]), SEED) for i in range(n)]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > n)


def _set_bits(hashes: np.ndarray) -> np.ndarray:
    """How many of the 64-bit hashes have each bit set, lowest first."""
    total = np.zeros(64, np.int64)
    for part in range(0, len(hashes), 8192):
        some = hashes[part : part + 8192]
        total += np.unpackbits(some.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return total


def _bits(block: Block) -> np.ndarray:
    """The fingerprints of the texts of a block."""
    weights = np.uint64(1) << np.arange(64, dtype=np.uint64)
    digest = xxhash.xxh64_intdigest
    data = LOWER[block.data]
    inside = ~WHITE_SPACE[data]
    starts, ends, bounds = word_spans(inside, block.offsets)
    out = np.zeros(len(block.rows), np.uint64)
    if not len(starts):
        return out
    # All words joined by one space: a shingle is then a stretch of bytes.
    lengths = ends - starts
    froms = np.cumsum(lengths + 1) - lengths - 1
    tos = froms + lengths
    joined = np.full(int(tos[-1]) + 1, 0x20, np.uint8)
    place = np.ones(len(joined), bool)
    place[tos] = False
    joined[place] = data[inside]
    view = memoryview(joined.tobytes())
    cut = bounds.tolist()
    for row, (a, b) in enumerate(zip(cut, cut[1:])):
        if a == b:
            continue
        n = max(1, b - a - SHINGLE + 1)
        begin, end = froms[a : a + n].tolist(), tos[min(a + SHINGLE, b) - 1 : b].tolist()
        hashes = np.fromiter((digest(view[i:j], SEED) for i, j in zip(begin, end)), np.uint64, n)
        out[row] = weights[2 * _set_bits(hashes) > n].sum(dtype=np.uint64)
    return out


def _fingerprint_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for block in blocks(batches):
        bits = pa.array(_bits(block).view(np.int64))
        yield pa.RecordBatch.from_arrays([block.rows.column("doc_id"), bits], names=["doc_id", "bits"])


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id and the 64 fingerprint bits as a long, row by row."""
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(_fingerprint_batches, "doc_id long, bits long")


def blocks_for(n: int, distance: int, least: int = 4, most: int = 16) -> int:
    """The fewest blocks that keep a cell at about a member or less."""
    # Bits of information in the popcount of a segment of fair coins (collision entropy).
    each = -log2(comb(2 * SEGMENT_BITS, SEGMENT_BITS) / 4**SEGMENT_BITS) * 64 / SEGMENT_BITS
    number = max(least, distance + 1)
    while number < most and each * (number - distance) / number < log2(max(n, 2)) + 1:
        number += 1
    return number


def _segments() -> list[int]:
    low = (1 << SEGMENT_BITS) - 1
    return [low << at for at in range(0, 64, SEGMENT_BITS)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _popcounts(bits: Column, segments: list[int]) -> list[Column]:
    return [F.bit_count(bits.bitwiseAND(F.lit(_signed(m)))) for m in segments]


def _cells(bits: Column, number: int, distance: int) -> Column:
    """One (choice, cell) for each choice of all blocks but `distance`."""
    dealt = [_segments()[i::number] for i in range(number)]
    cells = []
    for at, choice in enumerate(combinations(range(number), number - distance)):
        counts = [c.cast("long") for i in choice for c in _popcounts(bits, dealt[i])]
        # A count of two bits takes a digit of base four, and at most 30 of 32 segments are
        # chosen: the cell is packed into a long without loss.
        cells.append(F.struct(F.lit(at).alias("choice"), reduce(lambda x, y: x * 4 + y, counts).cast("long").alias("cell")))
    return F.explode(F.array(*cells))


def links_between(values: DataFrame, distance: int = 2) -> DataFrame:
    """Links (a < b) over distinct `bits`; every pair within `distance` is connected.

    Pairs in cells of usual size are all there; within fuller cells a spanning set is.
    """
    if distance != 2:
        raise ValueError("the meeting at one-bit neighbours is for a distance of two")
    number = blocks_for(values.count(), distance)
    keys = ["choice", "cell"]
    placed = values.select("bits", _cells(F.col("bits"), number, distance).alias("key")).select("bits", "key.*")
    sizes = placed.groupBy(*keys).agg(F.count("*").alias("members")).filter("members > 1")
    sizes = stage(sizes, "simhash-cells")
    usual = placed.join(sizes.filter(F.col("members") <= FULL_CELL), keys, "left_semi")
    a, b = usual.withColumnRenamed("bits", "a"), usual.withColumnRenamed("bits", "b")
    grid = a.join(b, keys).filter("a < b")
    nearby = sum(
        (F.abs(x - y) for x, y in zip(_popcounts(F.col("a"), _segments()), _popcounts(F.col("b"), _segments()))), F.lit(0)
    )
    paired = grid.filter(nearby <= distance).filter(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= distance)
    full = placed.join(sizes.filter(F.col("members") > FULL_CELL), keys, "left_semi").select("bits").distinct()
    flips = F.array(F.lit(0).cast("long"), *[F.lit(_signed(1 << at)) for at in range(64)])
    meeting = full.select("bits", F.explode(flips).alias("flip")).select(
        "bits", F.col("bits").bitwiseXOR(F.col("flip")).alias("at")
    )
    first = meeting.groupBy("at").agg(F.min("bits").alias("a"), F.count("*").alias("members")).filter("members > 1")
    met = meeting.join(first, "at").filter("a < bits").select("a", F.col("bits").alias("b"))
    return paired.select("a", "b").unionByName(met).distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, root) of all linked nodes; root is the smallest node of the component.

    Each round points a node's neighbours and the node at the smallest of them, first over
    the larger neighbours, then over the smaller ones; a component becomes a star within
    few rounds, however long its chains are. Rounds are written tables.
    """
    edges = stage(links.select("a", "b"), "simhash-links")

    def total(df: DataFrame) -> tuple:
        return df.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()

    before = total(edges)
    while before[0]:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("least"))
        least = least.select("a", F.least("a", "least").alias("least"))
        larger = both.filter("b > a").join(least, "a").select(F.col("least").alias("a"), "b").distinct()
        smaller = larger.groupBy("b").agg(F.min("a").alias("least"))
        joined = larger.join(smaller, "b")
        edges = joined.select(F.col("least").alias("a"), "b").unionByName(
            joined.filter("a > least").select(F.col("least").alias("a"), F.col("a").alias("b"))
        )
        edges = stage(edges.distinct(), "simhash-links")
        after = total(edges)
        if after == before:
            break
        before = after
    return edges.select(F.col("b").alias("node"), F.col("a").alias("root"))


def near_duplicates(docs: DataFrame, distance: int = 2) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits), component_id."""
    rows = stage(fingerprints(docs), "simhash-rows")
    return classes(rows, distance).select(
        "doc_id",
        F.lpad(F.lower(F.hex("bits")), 16, "0").alias("fingerprint"),
        F.nullif(F.col("component"), F.lit(NO_ID)).alias("component_id"),
    )


def classes(rows: DataFrame, distance: int = 2, links: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """doc_id, bits, root (the smallest bits of the component) and component (its smallest
    doc_id, NO_ID where no row of it has one) of fingerprint rows.

    `links` gives the links over the distinct bits where it is not their distance that counts.

    Copies share their bits, so links, components and names are worked out over distinct
    bits; the last join carries small rows only, and adaptive execution splits a hot value.
    """
    named = rows.groupBy("bits").agg(F.min(F.coalesce("doc_id", F.lit(NO_ID))).alias("least"))
    named = stage(named, "simhash-values")
    linked = links or (lambda values: links_between(values, distance))
    roots = components(linked(named.select("bits")))
    rooted = named.join(roots, named["bits"] == roots["node"], "left").select(
        "bits", "least", F.coalesce("root", "bits").alias("root")
    )
    names = rooted.groupBy("root").agg(F.min("least").alias("component"))
    of_value = rooted.join(names, "root").select("bits", "root", "component")
    return rows.join(of_value, "bits", "left").select("doc_id", "bits", "root", "component")


def _with_bits(docs: DataFrame, value: Callable[[Block], np.ndarray]) -> DataFrame:
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches):
            yield block.rows.append_column(BITS, pa.array(value(block).view(np.int64)))

    return docs.mapInArrow(add, T.StructType([*docs.schema.fields, T.StructField(BITS, T.LongType())]))


def _among(docs: DataFrame, place: dict, wanted: bool) -> DataFrame:
    """The rows whose doc_id (NO_ID where there is none) is in the set, or is not."""

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = Ids(place)
        for batch in batches:
            own = batch.column("doc_id").cast(pa.int64()).fill_null(NO_ID).to_numpy()
            yield batch.filter(pa.array(ids.hold(own) == wanted))

    return docs.mapInArrow(keep, docs.schema)


def keep_one(docs: DataFrame, distance: int = 2) -> DataFrame:
    """The documents, all columns, less those within the distance of one with a smaller doc_id."""
    rows = stage(fingerprints(docs), "simhash-rows")
    return keep_one_of(docs, rows, _bits, lambda values: links_between(values, distance))


def keep_one_of(
    docs: DataFrame, rows: DataFrame, value: Callable[[Block], np.ndarray], links: Callable[[DataFrame], DataFrame]
) -> DataFrame:
    """One document, all columns, of each component: `rows` has doc_id and bits, which
    `value` gives for the texts of a block and `links` links.

    Texts are not shuffled: the ids that go are written as sorted arrays, which the tasks
    that read the texts map and search. Rows that share a doc_id, or have none, are settled
    apart by their fingerprints, one to a component.
    """
    found = stage(classes(rows, links=links), "simhash-classes")
    own = F.coalesce("doc_id", F.lit(NO_ID))
    ids = found.groupBy(own.alias("own")).agg(
        F.count("*").alias("rows"), F.max((own == F.col("component")).cast("int")).alias("names")
    )
    ids = stage(ids, "simhash-ids")
    shared = (F.col("rows") > 1) | (F.col("own") == NO_ID)
    kept = _among(docs, write_ids(ids.filter(shared | (F.col("names") == 0)).select("own"), "simhash-gone"), False)
    several = ids.filter(shared & (F.col("names") == 1)).select("own")
    if not several.isEmpty():
        again = _with_bits(_among(docs, write_ids(several, "simhash-shared"), True), value)
        named = found.filter(own == F.col("component")).select(
            F.col("component").alias(OWN), F.col("bits").alias(BITS), F.col("root").alias(ROOT)
        ).distinct()
        again = again.withColumn(OWN, F.coalesce("doc_id", F.lit(NO_ID))).join(named, [OWN, BITS])
        # Components without any id share the name NO_ID: there the root tells them apart.
        kept = kept.unionByName(again.dropDuplicates([OWN, ROOT]).select(docs.columns))
    return kept
