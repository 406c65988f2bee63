"""An interpolated modified Kneser-Ney bigram model, counted in Spark.

Counting moves arrays, not words: each task hashes its words, sums them up and sends sorted
arrays, cut by key range, to the ranges' tasks, which merge them and write one sorted array
per range to the shared folder. Words are numbered by their place in the sorted vocabulary of
hashes; a bigram's key is the pair of its numbers. Bigram ranges are cut at equal numbers of
tokens; a word that begins more bigrams than a range may hold is cut by the second word.

Scoring maps the arrays into memory as it needs them, keeps a fixed number of them open and
looks up a block of texts at a time by binary search. A word's probability after v is

    (c(v w) - D(c(v w))) / c(v) + gamma(v) * p(w),
    p(w) = (n(w) - D'(n(w))) / n + gamma' / (V + 1)

with n(w) the number of different words before w, n the number of different bigrams, three
discounts on either level estimated from the counts of counts, and one share of V + 1 for
words never seen. The model grows with the corpus; no count is dropped.

Defined results: a null text counts as empty and has one token, its end; words are compared
by a 64-bit hash; without training texts every word has probability 1 / (V + 1) = 1;
repeated rows are counted and scored each; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.arrays import Maps, new_folder, shard_of, write_array
from shelfcast.llm.blocks import LOWER, WHITE_SPACE, Block, add_up, blocks, word_hashes, word_spans
from shelfcast.session import stage

VOCABULARY_BYTES = 16 << 20
"""Text per range of the vocabulary."""
RANGE_TOKENS = 1_000_000
"""Bigrams, as they occur, per range."""
HELD = 2_000_000
"""Different keys a task holds before it sends them on."""
END = np.uint64(0x5EED_0E4D_0F7E_4755)
MOST_WORDS = 2**32 - 2


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 7 == 2, F.lit(False))


def token_hashes(block: Block) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of all tokens of a block, each text closed by the end, and its bounds."""
    data = LOWER[block.data]
    starts, ends, bounds = word_spans(~WHITE_SPACE[data], block.offsets)
    n = len(bounds) - 1
    closing = bounds[1:] + np.arange(n)
    tokens = np.full(len(starts) + n, END, np.uint64)
    word = np.ones(len(tokens), bool)
    word[closing] = False
    tokens[word] = word_hashes(data, starts, ends)
    return tokens, np.concatenate([[0], closing + 1])


def small(values: np.ndarray) -> np.ndarray:
    """Whole numbers in the smallest unsigned type that holds them."""
    return values.astype(np.min_scalar_type(int(values.max()) if len(values) else 0))


class Held:
    """Keys and their counts, summed up whenever there are too many."""

    def __init__(self):
        self.parts: list[tuple[np.ndarray, np.ndarray]] = []
        self.size = 0

    def add(self, keys: np.ndarray) -> bool:
        """True if what is held should be sent on."""
        self.parts.append(np.unique(keys, return_counts=True))
        self.size += len(self.parts[-1][0])
        if self.size > HELD:
            self.parts = [self.sum()]
            self.size = len(self.parts[0][0])
        return self.size > HELD // 2 and len(self.parts) == 1

    def sum(self) -> tuple[np.ndarray, np.ndarray]:
        if not self.parts:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        return add_up(np.concatenate([k for k, _ in self.parts]), np.concatenate([c for _, c in self.parts]))


def _slices(shard: np.ndarray) -> Iterator[tuple[int, slice]]:
    """The stretches of equal numbers in a sorted array."""
    cuts = np.flatnonzero(np.diff(shard)) + 1
    for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(shard)]):
        if b > a:
            yield int(shard[a]), slice(a, b)


_SENT = "shard long, keys binary, counts binary"


def _sent(shard: np.ndarray, keys: np.ndarray, counts: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Sorted keys by range: of each the high half as steps, the low half as it is."""
    for number, part in _slices(shard):
        high, low = (keys[part] >> np.uint64(32)).astype(np.uint32), keys[part].astype(np.uint32)
        packed = np.diff(high, prepend=np.uint32(0)).tobytes() + low.tobytes()
        columns = [pa.array([number]), pa.array([packed]), pa.array([counts[part].astype("<u8").tobytes()])]
        yield pa.RecordBatch.from_arrays(columns, names=["shard", "keys", "counts"])


def _received(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    keys, counts = [], []
    for packed, told in zip(table.column("keys").to_pylist(), table.column("counts").to_pylist()):
        half = len(packed) // 2
        high = np.cumsum(np.frombuffer(packed[:half], np.uint32), dtype=np.uint32).astype(np.uint64)
        keys.append(high << np.uint64(32) | np.frombuffer(packed[half:], np.uint32))
        counts.append(np.frombuffer(told, "<u8").astype(np.int64))
    return add_up(np.concatenate(keys), np.concatenate(counts))


class Vocabulary:
    """The mapped vocabulary; a word's number is its place in the order of hashes."""

    def __init__(self, place: dict, maps: Maps):
        self.shards, self.starts, self.sizes, self.maps = place["shards"], place["starts"], place["sizes"], maps

    def numbers(self, hashes: np.ndarray) -> np.ndarray:
        """The number of each word, -1 for those never seen."""
        distinct, back = np.unique(hashes, return_inverse=True)
        out = np.full(len(distinct), -1, np.int64)
        for s, part in _slices(shard_of(distinct, self.shards)):
            if self.sizes[s]:
                keys = self.maps[f"words-{s:06d}"]
                at = np.minimum(np.searchsorted(keys, distinct[part]), len(keys) - 1)
                out[part] = np.where(keys[at] == distinct[part], at + self.starts[s], -1)
        return out[back]


def _pairs(numbers: np.ndarray, bounds: np.ndarray, begin: int) -> np.ndarray:
    """The word before each token; `begin` before the first of a text."""
    before = np.empty_like(numbers)
    before[1:] = numbers[:-1]
    before[bounds[:-1]] = begin
    return before


def discounts(counts_of_counts: list[int]) -> list[float]:
    """The discounts of counts 0, 1, 2 and from 3 up; halves where counts are too few."""
    n1, n2, n3, n4 = counts_of_counts
    if min(n1, n2, n3, n4) == 0:
        return [0.0, 0.5, 1.0, 1.5]
    y = n1 / (n1 + 2 * n2)
    found = [1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3]
    return [0.0, *(min(max(d, 0.01), k) for k, d in enumerate(found, 1))]


def _count_words(texts: DataFrame, folder: str, shards: int) -> dict:
    """Write the vocabulary; where it is, and where to cut the ranges of bigrams."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = Held()
        for block in blocks(batches):
            if held.add(token_hashes(block)[0]):
                keys, counts = held.sum()
                yield from _sent(shard_of(keys, shards), keys, counts)
                held = Held()
        keys, counts = held.sum()
        yield from _sent(shard_of(keys, shards), keys, counts)

    def merge(key: tuple, table: pa.Table) -> pa.Table:
        shard = key[0].as_py()
        keys, counts = _received(table)
        write_array(folder, f"words-{shard:06d}", keys)
        write_array(folder, f"word-counts-{shard:06d}", small(counts))
        ends = np.cumsum(counts)
        # Words before which a range of bigrams begins: the first one here, and those that
        # fill one up. Words that fill several are cut into parts.
        cuts = np.union1d([0], np.flatnonzero(np.diff(ends // RANGE_TOKENS, prepend=0)))
        parts = -(-counts[cuts] // RANGE_TOKENS)
        row = {"shard": [shard], "words": [len(keys)], "tokens": [int(ends[-1])], "cuts": [cuts.tolist()], "parts": [parts.tolist()]}
        kinds = [("shard", pa.int64()), ("words", pa.int64()), ("tokens", pa.int64()), ("cuts", pa.list_(pa.int64())), ("parts", pa.list_(pa.int64()))]
        return pa.table(row, schema=pa.schema(kinds))

    sent = texts.mapInArrow(count, _SENT)
    rows = sent.groupBy("shard").applyInArrow(
        merge, "shard long, words long, tokens long, cuts array<long>, parts array<long>"
    ).collect()
    sizes = [0] * shards
    for r in rows:
        sizes[r["shard"]] = r["words"]
    starts = np.concatenate([[0], np.cumsum(sizes)]).tolist()
    n_words, tokens = starts[-1], sum(r["tokens"] for r in rows)
    if n_words > MOST_WORDS:
        raise ValueError("more different words than 32-bit numbers")
    splits = sorted(
        (starts[r["shard"]] + at << 32) + n_words * part // parts
        for r in rows
        for at, parts in zip(r["cuts"], r["parts"])
        for part in range(parts)
    )
    return {"folder": folder, "shards": shards, "sizes": sizes, "starts": starts, "words": n_words, "tokens": tokens, "splits": splits}


_STATISTICS = "shard long, kind int, ids binary, numbers binary"
OF_CONTEXT, OF_WORD, OF_ALL = 0, 1, 2


def _count_bigrams(texts: DataFrame, place: dict) -> DataFrame:
    """Write the bigrams; returns statistics of contexts, words and all, by vocabulary range."""
    folder, begin, shards = place["folder"], place["words"], place["shards"]
    splits, starts = np.array(place["splits"], np.uint64), np.array(place["starts"])

    def send(held: Held) -> Iterator[pa.RecordBatch]:
        keys, counts = held.sum()
        yield from _sent(np.searchsorted(splits, keys, "right"), keys, counts)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, vocabulary = Held(), Vocabulary(place, Maps(folder))
        for block in blocks(batches):
            hashes, bounds = token_hashes(block)
            numbers = vocabulary.numbers(hashes)
            before = _pairs(numbers, bounds, begin)
            if held.add(before.astype(np.uint64) << np.uint64(32) | numbers.astype(np.uint64)):
                yield from send(held)
                held = Held()
        yield from send(held)

    def by_range(ids: np.ndarray, kind: int, numbers: np.ndarray) -> Iterator[tuple]:
        # The number of the beginning is behind all words, in a range of its own.
        shard = np.where(ids == begin, shards, np.searchsorted(starts, ids, "right") - 1)
        for s, part in _slices(shard):
            yield s, kind, (ids[part] - (begin if s == shards else starts[s])).astype("<u4").tobytes(), numbers[part].astype("<i8").tobytes()

    def merge(key: tuple, table: pa.Table) -> pa.Table:
        shard = key[0].as_py()
        keys, counts = _received(table)
        write_array(folder, f"bigrams-{shard:06d}", keys)
        write_array(folder, f"bigram-counts-{shard:06d}", small(counts))
        first = (keys >> np.uint64(32)).astype(np.int64)
        at = np.flatnonzero(np.diff(first, prepend=-1))
        sums = [np.add.reduceat(x.astype(np.int64), at) for x in (counts, counts == 1, counts == 2, counts > 2)]
        second, before = np.unique((keys & np.uint64(0xFFFFFFFF)).astype(np.int64), return_counts=True)
        rows = [*by_range(first[at], OF_CONTEXT, np.stack(sums, axis=1)), *by_range(second, OF_WORD, before)]
        all_counts = [len(keys), *((counts == k).sum() for k in (1, 2, 3, 4))]
        rows.append((-1, OF_ALL, np.array([shard], "<u4").tobytes(), np.array(all_counts, "<i8").tobytes()))
        kinds = [("shard", pa.int64()), ("kind", pa.int32()), ("ids", pa.binary()), ("numbers", pa.binary())]
        return pa.table([pa.array(c, k) for c, (_, k) in zip(zip(*rows), kinds)], names=[n for n, _ in kinds])

    merged = texts.mapInArrow(count, _SENT).groupBy("shard").applyInArrow(merge, _STATISTICS)
    return stage(merged, "language-model-statistics")


def _finish_words(statistics: DataFrame, place: dict, cut: list[float]) -> list[int]:
    """Write c(v), gamma(v) and n(w) of all words; returns the counts of counts of n(w)."""
    folder, sizes = place["folder"], place["sizes"]
    off = np.array(cut[1:])

    def merge(key: tuple, table: pa.Table) -> pa.Table:
        shard = key[0].as_py()
        size = sizes[shard] if shard < len(sizes) else 1
        contexts, before = np.zeros((size, 4), np.int64), np.zeros(size, np.int64)
        for kind, ids, numbers in zip(*(table.column(c).to_pylist() for c in ("kind", "ids", "numbers"))):
            at, told = np.frombuffer(ids, "<u4"), np.frombuffer(numbers, "<i8")
            if kind == OF_CONTEXT:
                contexts[at] += told.reshape(-1, 4)
            else:
                before[at] += told
        total = contexts[:, 0]
        write_array(folder, f"totals-{shard:06d}", small(total))
        write_array(folder, f"gammas-{shard:06d}", np.where(total > 0, contexts[:, 1:] @ off / np.maximum(total, 1), 1.0))
        write_array(folder, f"before-{shard:06d}", small(before))
        found = [[int((before == k).sum()) for k in (1, 2, 3, 4)] + [int((before > 2).sum())]]
        return pa.table({"found": pa.array(found, pa.list_(pa.int64()))})

    rows = statistics.filter("kind <> 2").groupBy("shard").applyInArrow(merge, "found array<long>").collect()
    return np.sum([r["found"] for r in rows], axis=0).tolist() if rows else [0] * 5


def train(docs: DataFrame) -> dict:
    """Count the texts of `docs`; returns where the model is and its few global numbers."""
    texts = docs.select("text")
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    folder = new_folder(docs.sparkSession, "language-model")
    place = _count_words(texts, folder, max(1, -(-size // VOCABULARY_BYTES)))
    statistics = _count_bigrams(texts, place)
    place["ranges"], every = [], np.zeros(5, np.int64)
    for row in statistics.filter("kind = 2").select("ids", "numbers").collect():  # one row per range
        place["ranges"].append(int(np.frombuffer(row["ids"], "<u4")[0]))
        every += np.frombuffer(row["numbers"], "<i8")
    place["discounts"] = discounts(every[1:].tolist())
    *found, more = _finish_words(statistics, place, place["discounts"])
    place["bigrams"], place["word_discounts"] = int(every[0]), discounts(found)
    left = np.dot(place["word_discounts"][1:], [found[0], found[1], more])
    place["word_gamma"] = float(left / every[0]) if every[0] else 1.0
    return place


class Model:
    """The arrays of a trained model, mapped range by range as texts ask for them."""

    def __init__(self, place: dict):
        self.place, self.maps = place, Maps(place["folder"])
        self.vocabulary = Vocabulary(place, self.maps)
        self.filled = {s for s, n in enumerate(place["sizes"]) if n}
        self.ranges = set(place["ranges"])
        self.splits = np.array(place["splits"], np.uint64)

    def look_up(self, name: str, numbers: np.ndarray, missing: float) -> np.ndarray:
        """What `name` holds of the words; a word's number tells its range and place."""
        distinct, back = np.unique(numbers, return_inverse=True)
        out = np.full(len(distinct), float(missing))
        starts, begin = np.array(self.place["starts"]), self.place["words"]
        shard = np.where(distinct == begin, len(starts) - 1, np.searchsorted(starts, distinct, "right") - 1)
        for s, part in _slices(np.where(distinct < 0, -1, shard)):
            if s in self.filled or s == len(starts) - 1 and self.filled and name in ("totals", "gammas"):
                out[part] = self.maps[f"{name}-{s:06d}"][distinct[part] - starts[s]]
        return out[back]

    def counts_of(self, keys: np.ndarray) -> np.ndarray:
        distinct, back = np.unique(keys, return_inverse=True)
        out = np.zeros(len(distinct), np.int64)
        for r, part in _slices(np.searchsorted(self.splits, distinct, "right")):
            if r in self.ranges:
                stored, counts = self.maps[f"bigrams-{r:06d}"], self.maps[f"bigram-counts-{r:06d}"]
                at = np.minimum(np.searchsorted(stored, distinct[part]), len(stored) - 1)
                out[part] = np.where(stored[at] == distinct[part], counts[at], 0)
        return out[back]

    def score(self, hashes: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of every token its count in training and the log10 probability after the one before."""
        place = self.place
        numbers = self.vocabulary.numbers(hashes)
        before = _pairs(numbers, bounds, place["words"])
        n = self.look_up("before", numbers, 0)
        off = np.array(place["word_discounts"])[np.minimum(n, 3).astype(int)]
        p = np.maximum(n - off, 0) / max(place["bigrams"], 1) + place["word_gamma"] / (place["words"] + 1)
        total, gamma = self.look_up("totals", before, 0), self.look_up("gammas", before, 1)
        both = (numbers >= 0) & (before >= 0)
        c = np.zeros(len(numbers))
        c[both] = self.counts_of(before[both].astype(np.uint64) << np.uint64(32) | numbers[both].astype(np.uint64))
        off = np.array(place["discounts"])[np.minimum(c, 3).astype(int)]
        seen = total > 0
        p = np.where(seen, np.maximum(c - off, 0) / np.where(seen, total, 1) + np.where(seen, gamma, 1) * p, p)
        return self.look_up("word-counts", numbers, 0), np.log10(p)


def score(docs: DataFrame, place: dict) -> DataFrame:
    """doc_id, tokens, known tokens, log10 probability, its unigram base and the perplexity."""

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(place)
        for block in blocks(batches):
            hashes, bounds = token_hashes(block)
            counts, logs = model.score(hashes, bounds)
            base = np.log10((counts + 1) / (place["tokens"] + place["words"] + 1))
            n_tokens = np.diff(bounds).astype(np.int64)
            known, base, told = (np.add.reduceat(x, bounds[:-1]) for x in ((counts > 0).astype(np.int64), base, logs))
            columns = [block.rows.column("doc_id"), *(pa.array(x) for x in (n_tokens, known, base, told, 10 ** (-told / n_tokens)))]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_tokens", "n_known", "base_score", "score", "perplexity"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        judge, f"doc_id {kind}, n_tokens long, n_known long, base_score double, score double, perplexity double"
    )
