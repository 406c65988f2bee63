"""Spelling variants: words one edit apart, found by walking a trie with a table of states.

The trie is a table of edges (node, char, child), spread by node and cut by depth. A state is
(word, position, node, edits): the first `position` code points of the word led to the node
with that many edits. Level by level, the states at a depth are joined with the edges of that
depth: without an edit so far, a state follows its own code point, or any larger one for a
replacement, or stands still and skips its code point for a deletion; with its edit spent it
follows its own code point alone. States that end in a word are its neighbours. Replacing by
a smaller code point and inserting are the same links seen from the other word.

Near the root every word would branch into every child, so a word is walked twice, forwards
for edits in its second half and backwards for those in its first, each from the node of the
half without edits. An edge with a single word below carries that word, and what is left is
compared at once: the number of levels follows the longest beginning or ending that two
words share, not the longest word. A node is a 64-bit hash of what leads to it; two that
clash only add states, and every link is confirmed on the words. Runs of more than
`LONG_WORD` code points, which are hardly words, would need a level for each: they meet by
hashes of what is left of them without each code point, in rows that do not carry them.

Defined results: a null or empty text has no words; a null doc_id counts as an empty one;
repeated rows count as often as they occur; of near words that occur equally often the
smallest in code-point order is the form; columns other than doc_id and text are not read;
an empty table gives an empty table. A text of any length is read in whole.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from math import ceil, floor, log

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.arrays import new_folder
from shelfcast.llm.blocks import LOWER, Block, blocks, mix, word_spans
from shelfcast.session import stage

LEAST_POINTS = 6
LEAST_COUNT = 5
FORM_FACTOR = 5
SLIP_EVERY = 199
DISTINCT = 1 << 19
"""Different words that a task holds before it hands its counts on."""
LONG_WORD = 64
"""Code points up to which a word walks the trie."""
LONG = 64
"""Bytes of a run above which its checksum is worked out apart."""

_LETTER = np.zeros(256, bool)
_LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = True
LATIN = 0xC3  # the byte that begins U+00C0 to U+00FF, each of two bytes


def _checksums() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1).astype(np.uint32)
    return table


_CRC = _checksums()


def _crc32(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, begun: np.ndarray) -> np.ndarray:
    """The crc32 of each `data[start:end]`, going on from the crc32 it begins with."""
    order = np.argsort(starts - ends, kind="stable")
    lengths, at = (ends - starts)[order], starts[order]
    state = begun[order] ^ np.uint32(0xFFFFFFFF)
    first = int(np.searchsorted(-lengths, -LONG))
    for byte in range(int(lengths[first]) if first < len(lengths) else 0):
        live = slice(first, int(np.searchsorted(-lengths, -byte)))
        state[live] = _CRC[(state[live] ^ data[at[live] + byte]) & 255] ^ (state[live] >> np.uint32(8))
    out = np.empty(len(order), np.uint32)
    out[order] = state ^ np.uint32(0xFFFFFFFF)
    for i in order[:first].tolist():
        out[i] = zlib.crc32(data[starts[i] : ends[i]].tobytes(), int(begun[i]))
    return out


def _words(block: Block, least_points: int, slip_every: int) -> pa.Array:
    """The words of a block, each as often as it occurs, slips of the pen included."""
    data = LOWER[block.data]
    lead = data == LATIN
    inside = _LETTER[data] | lead
    inside[1:] |= lead[:-1]
    starts, ends, bounds = word_spans(inside, block.offsets)
    leads = np.concatenate([[0], np.cumsum(lead)])
    points = ends - starts - (leads[ends] - leads[starts])
    row = np.repeat(np.arange(len(block.rows)), np.diff(bounds))
    wanted = points >= least_points
    starts, ends, points, row = starts[wanted], ends[wanted], points[wanted], row[wanted]
    ids = block.rows.column("doc_id").to_pylist()
    begun = np.array([zlib.crc32(f"{'' if i is None else i}:".encode()) for i in ids], np.uint32)
    sums = _crc32(data, starts, ends, begun[row])
    slipped = sums % np.uint32(slip_every) == 0
    said = []
    for i in np.flatnonzero(slipped & (points > least_points)).tolist():
        run = data[starts[i] : ends[i]].tobytes().decode()
        cut = int(sums[i]) % len(run)
        said.append(run[:cut] + run[cut + 1 :])
    starts, ends = starts[~slipped], ends[~slipped]
    to = np.concatenate([[0], np.cumsum(ends - starts)])
    taken = np.repeat(starts - to[:-1], ends - starts) + np.arange(to[-1])
    plain = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(to.astype(np.int64)), pa.py_buffer(data[taken]))
    return pa.concat_arrays([plain, pa.array(said, pa.large_string())])


def count_words(
    docs: DataFrame, least_points: int = LEAST_POINTS, least_count: int = LEAST_COUNT, slip_every: int = SLIP_EVERY
) -> DataFrame:
    """word and n of all words of so many code points and occurrences.

    Tasks add up what they read, so that a frequent word moves as one row of a task."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("word", pa.large_string()), ("n", pa.int64())])
        held = pa.table({"word": [], "n": []}, schema)
        fresh, rows = [held], 0
        for block in blocks(batches):
            values = pc.value_counts(_words(block, least_points, slip_every))
            fresh.append(pa.table([values.field(0), values.field(1)], schema))
            rows += len(values)
            if rows > DISTINCT:
                held = pa.concat_tables(fresh).group_by("word").aggregate([("n", "sum")])
                held, rows = held.rename_columns(["word", "n"]), 0
                fresh = [held]
                if len(held) > DISTINCT:
                    yield from held.cast(_COUNTED).to_batches(max_chunksize=1 << 16)
                    fresh = [held.slice(0, 0)]
        held = pa.concat_tables(fresh).group_by("word").aggregate([("n", "sum")]).rename_columns(["word", "n"])
        yield from held.cast(_COUNTED).to_batches(max_chunksize=1 << 16)

    counted = docs.select("doc_id", "text").mapInArrow(count, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least_count)


_COUNTED = pa.schema([("word", pa.string()), ("n", pa.int64())])
_STEP = np.uint64(0x9E3779B97F4A7C15)

PATHS = "way int, depth int, node long, char string, child long, word string, n long, start boolean"


def _paths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The edges of each word, both ways, from the node at its half on to its end."""
    for whole in batches:
        for i in range(0, whole.num_rows, 2048):
            batch = whole.slice(i, 2048)
            told, counts = batch.column("word").to_pylist(), batch.column("n").to_numpy()
            for way in (0, 1):
                words = [w[::-1] for w in told] if way else told
                lengths = np.array([len(w) for w in words])
                points = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).astype(np.uint64)
                begins = np.cumsum(lengths) - lengths
                place = np.arange(len(points)) - np.repeat(begins, lengths)
                with np.errstate(over="ignore"):
                    powers = np.multiply.accumulate(np.full(int(lengths.max()), _STEP, np.uint64))
                    sums = np.concatenate([[np.uint64(0)], np.cumsum((points + np.uint64(1)) * powers[place])])
                    starts = (lengths + way) // 2
                    own = np.repeat(np.arange(len(words)), lengths - starts + 1)
                    first = np.cumsum(lengths - starts + 1) - (lengths - starts + 1)
                    depth = np.arange(len(own)) - first[own] + starts[own]
                    at = begins[own] + depth
                    node = mix(sums[at] - sums[begins[own]] + (depth * 2 + way).astype(np.uint64))
                # The edge below leads to the next node of the word; a last, empty one ends it.
                ends = depth == lengths[own]
                child = np.where(ends, np.uint64(0), np.roll(node, -1))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(own), way, np.int32)),
                        pa.array(depth.astype(np.int32)),
                        pa.array(node.view(np.int64)),
                        pa.array([words[w][d : d + 1] for w, d in zip(own.tolist(), depth.tolist())], pa.string()),
                        pa.array(child.view(np.int64)),
                        pa.array([words[w] for w in own.tolist()], pa.string()),
                        pa.array(counts[own]),
                        pa.array(depth == starts[own]),
                    ],
                    names=["way", "depth", "node", "char", "child", "word", "n", "start"],
                )


def _by_depth(df: DataFrame, name: str, rows: int) -> DataFrame:
    """`df` as a table in the shared folder with a folder of some files for each depth."""
    path = new_folder(df.sparkSession, name)
    files = F.pmod(F.col("node"), F.lit(16 + rows // 500_000))
    df.repartition("depth", files).write.partitionBy("depth").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _trie(words: DataFrame, size: int) -> tuple[DataFrame, DataFrame]:
    """Edges out of nodes with two words or more below, and the states that walks begin with."""
    rows = words.mapInArrow(_paths, PATHS)
    edges = rows.groupBy("depth", "node", "char", "child").agg(
        F.count("*").alias("below"), F.min("word").alias("word"), F.min("n").alias("n")
    )
    # A node has an edge for each letter at most, so its edges may meet.
    total = F.expr("sum(below) OVER (PARTITION BY depth, node)")
    single = F.col("below") == 1
    edges = edges.withColumn("total", total).filter("total > 1").select(
        "depth", "node", "char", "child", single.alias("single"),
        F.when(single, F.col("word")).alias("only"), F.when(single, F.col("n")).alias("only_n"),
    )
    begun = rows.filter("start").select("way", "depth", "node", "word", "n")
    return _by_depth(edges, "spelling-edges", 8 * size), _by_depth(begun, "spelling-begun", 2 * size)


STATE = ["way", "word", "n", "position", "node", "edits"]


def _level(states: DataFrame, edges: DataFrame, depth: int) -> DataFrame:
    """What the states at a depth become: states one level below, and links found."""
    here, fresh = F.col("position"), F.col("edits") == 0
    states = states.filter(~fresh | (here < F.length("word")))
    half = F.floor((F.length("word") + F.col("way")) / 2)
    at = lambda i: F.substring("word", i + 1, F.lit(1))
    # Of a run of one code point the first is skipped: the others give the same word.
    skips = fresh & ((here == half) | (at(here) != at(here - 1)))
    after = F.struct((here + F.when(skips, 1)).alias("position"), F.lit(1).alias("edits"))
    moved = F.filter(F.array(F.struct("position", "edits"), after), lambda s: s["position"].isNotNull())
    states = states.withColumn("now", F.explode(moved)).select("way", "word", "n", "now.*", "node")
    # What the word goes on with is cut out once for each state, not for each edge it meets.
    states = states.withColumn("own", at(here)).withColumn("rest", F.substring("word", here + 2, F.length("word")))
    follows = F.col("char") == F.col("own")
    met = states.join(edges.drop("depth"), "node").filter(follows | (fresh & (F.col("char") > F.col("own"))))
    spent = F.when(follows, F.col("edits")).otherwise(1)
    ends = (spent == 1) & (F.substring("only", F.lit(depth + 2), F.length("only")) == F.col("rest"))
    return met.filter(~F.col("single") | ends).select(
        "way", "word", "n", (here + 1).alias("position"), F.col("child").alias("node"), spent.alias("edits"), "only", "only_n"
    )


def _cuts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A hash of each word, at -1, and of the word without each of its code points."""
    back = np.uint64(pow(int(_STEP), -1, 1 << 64))
    for batch in batches:
        for word, own in zip(batch.column("word").to_pylist(), batch.column("id").to_pylist()):
            points = np.frombuffer(word.encode("utf-32-le"), np.uint32).astype(np.uint64)
            with np.errstate(over="ignore"):
                powers = np.multiply.accumulate(np.full(len(points), _STEP, np.uint64))
                sums = np.concatenate([[np.uint64(0)], np.cumsum((points + np.uint64(1)) * powers)])
                left = np.concatenate([sums[-1:], sums[:-1] + (sums[-1] - sums[1:]) * back])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(mix(left).view(np.int64)),
                    pa.array(np.arange(-1, len(points), dtype=np.int32)),
                    pa.array(np.full(len(left), own)),
                ],
                names=["key", "place", "id"],
            )


def _near_long(words: DataFrame, longest: int) -> DataFrame:
    """Links of words of more than `longest` code points, from rows of hashes."""
    held = words.filter(F.length("word") >= longest).withColumn("id", F.xxhash64("word"))
    cuts = stage(held.select("word", "id").mapInArrow(_cuts, "key long, place int, id long"), "spelling-cuts")
    other = cuts.withColumnRenamed("id", "other")
    left = cuts.filter("place >= 0")
    replaced = left.join(other, ["key", "place"]).filter("id < other").select("id", "other")
    cut = left.drop("place").join(other.filter("place < 0").drop("place"), "key").select("id", "other")
    others = held.select(F.col("id").alias("other"), F.col("word").alias("to"), F.col("n").alias("to_n"))
    met = replaced.unionByName(cut).distinct().join(held, "id").join(others, "other")
    return met.select("word", "n", F.col("to").alias("other"), F.col("to_n").alias("other_n"))


def near_words(words: DataFrame, longest: int = LONG_WORD) -> DataFrame:
    """Links (word, n, other, other_n), once each, between words one edit apart."""
    size, longest_here = words.agg(F.count("*"), F.max(F.length("word"))).first()
    edges, begun = _trie(words.filter(F.length("word") <= longest), size)
    depths = edges.agg(F.min("depth"), F.max("depth")).first()
    found, states = [], None
    for depth in range(depths[0], depths[1] + 1) if depths[0] is not None else ():
        fresh = begun.filter(F.col("depth") == depth).select(
            "way", "word", "n", F.col("depth").alias("position"), "node", F.lit(0).alias("edits")
        )
        states = fresh if states is None else states.unionByName(fresh)
        met = stage(_level(states, edges.filter(F.col("depth") == depth), depth), f"spelling-level-{depth}")
        states = met.filter("only IS NULL").select(STATE)
        forwards = lambda c: F.when(F.col("way") == 1, F.reverse(c)).otherwise(F.col(c))
        found.append(
            met.filter("only IS NOT NULL").select(
                forwards("word").alias("word"), "n", forwards("only").alias("other"), F.col("only_n").alias("other_n")
            )
        )
    if (longest_here or 0) > longest:
        found.append(_near_long(words, longest))
    if not found:
        return words.select("word", "n", F.col("word").alias("other"), F.col("n").alias("other_n")).limit(0)
    every = found[0]
    for some in found[1:]:
        every = every.unionByName(some)
    # A pair of long runs may come from either side.
    every = every.filter(F.levenshtein("word", "other", 1) == 1)
    swapped = F.col("word") > F.col("other")
    return every.select(
        *[F.when(swapped, F.col(b)).otherwise(F.col(a)).alias(a) for a, b in (("word", "other"), ("n", "other_n"), ("other", "word"), ("other_n", "n"))]
    ).distinct()


def _roots(forms: DataFrame, most: int, factor: int, least: int) -> DataFrame:
    """word and root of the words with a form: each round doubles the stretch followed.

    A form occurs `factor` times as often as its word, which bounds the stretches."""
    rooted = forms.select("word", F.col("form").alias("root"))
    longest = max(1, floor(log(max(most / least, 1), factor)))
    for _ in range(ceil(log(longest, 2))):
        then = rooted.select(F.col("word").alias("root"), F.col("root").alias("beyond"))
        rooted = rooted.join(then, "root", "left").select("word", F.coalesce("beyond", "root").alias("root"))
        rooted = stage(rooted, "spelling-roots")
    return rooted


def group_spellings(words: DataFrame, factor: int = FORM_FACTOR) -> DataFrame:
    """word, form, root, n, n_near and form_n of each (word, n)."""
    words = stage(words, "spelling-words")
    least, most = words.agg(F.min("n"), F.max("n")).first()
    links = near_words(words)
    other = links.select(F.col("other").alias("word"), F.col("other_n").alias("n"), F.col("word").alias("other"), F.col("n").alias("other_n"))
    best = F.min(F.struct((-F.col("other_n")).alias("n"), F.col("other").alias("word"))).alias("best")
    near = links.unionByName(other).groupBy("word").agg(F.count("*").alias("n_near"), best)
    formed = words.join(near, "word", "left")
    is_form = -F.col("best.n") >= factor * F.col("n")
    formed = formed.select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(is_form, F.col("best.word")).alias("form"), F.when(is_form, -F.col("best.n")).alias("form_n"),
    )
    formed = stage(formed, "spelling-forms")
    roots = _roots(formed.filter("form IS NOT NULL"), most or 1, factor, least or 1)
    return formed.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


def spelling_variants(docs: DataFrame) -> DataFrame:
    """word, form, root, n, n_near, form_n of the words of the documents."""
    return group_spellings(count_words(docs))
