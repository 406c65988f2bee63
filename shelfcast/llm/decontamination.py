"""Benchmark decontamination with a generalised suffix automaton of the test items.

All items go into one automaton over words: the matching state tells, at each word of a
document, the longest stretch ending there that some item holds. A window of an item (13
words, or all of a shorter item) ends where that length reaches the window's. Documents are
streamed through it; of a block of texts only the stretches can match whose words and word
pairs all occur in items, so these are found with numpy and only they are stepped through.

Items are cut into blocks of at most `BLOCK_WORDS` words, each with an automaton of its own;
of a longer item, pieces that share all but one word of a window go to several blocks. Tasks
build the automata and write them as arrays to the shared folder, where workers map them.
The documents pass through `PASS_BLOCKS` of them at a time without a shuffle, and are
written between two passes.

Defined results: a null or empty text has no words and no hits; items without words match
nothing; equal item ids count once, a null id is the empty string; rows are judged one by
one, so ties and repeats change nothing; no items, no hits.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.arrays import mapped_arrays, new_folder, write_arrays
from shelfcast.llm.blocks import LOWER, WORD_BYTE, Block, blocks, word_hashes, word_spans
from shelfcast.session import stage

WINDOW = 13
COVERAGE = 20
"""A document goes if a `COVERAGE`-th of its words or more are hit."""
BLOCK_WORDS = 100_000
PASS_BLOCKS = 16
"""Automata a worker maps at a time; beyond that the documents make another pass."""
TASK_BLOCKS = 4
"""Blocks of items that one task builds, about."""
# Fixed value: the words of the contamination rule, for counting them.
ITEM_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
RUNS, ITEMS = "__hit_runs", "__hit_items"


class Automaton:
    """A view of the arrays that `build` makes; moves are keyed state << 32 | word."""

    def __init__(self, arrays: list[np.ndarray]):
        sizes, self.hashes, self.order, self.word_ends, self.word_bytes = arrays[:5]
        self.window, self.least = sizes.tolist()
        self.keys, self.targets, self.length, self.link, self.pairs = arrays[5:10]
        # Items whose windows of full length end in a state; short items that end in one, and
        # for each state the nearest one at or above it in which any does.
        self.windows, self.window_bounds, self.window_items = arrays[10:13]
        self.above, self.shorts, self.short_bounds, self.short_lengths, self.short_items = arrays[13:18]
        self.name_ends, self.name_bytes = arrays[18:]

    def word(self, number: int) -> bytes:
        return _nth(self.word_ends, self.word_bytes, number)

    def move(self, state: int, word: int) -> int:
        """The state after one more word, or -1."""
        key = state << 32 | word
        at = int(self.keys.searchsorted(key))
        return int(self.targets[at]) if at < len(self.keys) and self.keys[at] == key else -1

    def _names(self, numbers: np.ndarray) -> Iterator[str]:
        for number in numbers.tolist():
            yield _nth(self.name_ends, self.name_bytes, number).decode()

    def full(self, state: int) -> Iterator[str]:
        """The items with the window that ends here."""
        while self.length[self.link[state]] >= self.window:
            state = int(self.link[state])
        at = int(self.windows.searchsorted(state))
        if at < len(self.windows) and self.windows[at] == state:
            yield from self._names(self.window_items[self.window_bounds[at] : self.window_bounds[at + 1]])

    def short(self, state: int, matched: int) -> Iterator[tuple[int, str]]:
        """(words, item) of the short items that end here and lie in the matched stretch."""
        at = int(self.above[state])
        while at >= 0:
            place = int(self.shorts.searchsorted(at))
            mine = np.arange(self.short_bounds[place], self.short_bounds[place + 1])
            mine = mine[self.short_lengths[mine] <= matched]
            yield from zip(self.short_lengths[mine].tolist(), self._names(self.short_items[mine]))
            at = int(self.above[self.link[at]])


def _nth(ends: np.ndarray, data: np.ndarray, n: int) -> bytes:
    return data[ends[n - 1] if n else 0 : ends[n]].tobytes()


def _joined(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Where each ends, and all in one."""
    return np.cumsum([len(t) for t in texts], dtype=np.int64), np.frombuffer(b"".join(texts), np.uint8)


def _lists(by_state: dict[int, list]) -> tuple[np.ndarray, np.ndarray, list]:
    """States in order, the bounds of each one's entries, and all entries."""
    states = sorted(by_state)
    bounds = np.cumsum([0, *(len(by_state[s]) for s in states)], dtype=np.int64)
    return np.array(states, np.int64), bounds, [x for s in states for x in sorted(by_state[s])]


def words_of(text: bytes) -> list[bytes]:
    data = LOWER[np.frombuffer(text, np.uint8)]
    starts, ends, _ = word_spans(WORD_BYTE[data], np.array([0, len(data)]))
    whole = data.tobytes()
    return [whole[a:b] for a, b in zip(starts.tolist(), ends.tolist())]


def hash_each(words: list[bytes]) -> np.ndarray:
    lengths = np.array([len(w) for w in words], np.int64)
    ends = np.cumsum(lengths)
    return word_hashes(np.frombuffer(b"".join(words), np.uint8), ends - lengths, ends)


def build(items: Iterable[tuple[str, list[bytes]]], window: int = WINDOW) -> list[np.ndarray]:
    """The arrays of the automaton of (item id, words); also all word pairs, as sorted numbers."""
    items = [(name, words) for name, words in items if words]
    vocabulary: dict[bytes, int] = {}
    follow: list[dict[int, int]] = [{}]
    length, link = [0], [-1]

    def state(at: int, size: int, up: int, moves: dict[int, int]) -> int:
        follow.append(moves)
        length.append(size)
        link.append(up)
        return len(length) - 1

    def split(p: int, word: int, q: int) -> int:
        """A state for the part of q that p reaches, if q also stands for longer words."""
        if length[q] == length[p] + 1:
            return q
        part = state(0, length[p] + 1, link[q], dict(follow[q]))
        link[q] = part
        while p >= 0 and follow[p].get(word) == q:
            follow[p][word] = part
            p = link[p]
        return part

    numbered = []
    for name, words in items:
        ids = [vocabulary.setdefault(w, len(vocabulary)) for w in words]
        numbered.append((name, ids))
        last = 0
        for word in ids:
            known = follow[last].get(word)
            if known is not None:
                last = split(last, word, known)
                continue
            fresh, p = state(0, length[last] + 1, 0, {}), last
            while p >= 0 and word not in follow[p]:
                follow[p][word] = fresh
                p = link[p]
            if p >= 0:
                link[fresh] = split(p, word, follow[p][word])
            last = fresh

    names: dict[str, int] = {}
    windows: dict[int, set[int]] = {}
    shorts: dict[int, set[tuple[int, int]]] = {}
    for name, ids in numbered:
        number = names.setdefault(name, len(names))
        at = 0
        for n, word in enumerate(ids, 1):
            at = follow[at][word]
            if n >= window:
                # The class on the way up that holds the last `window` words.
                while length[link[at]] >= window:
                    at = link[at]
                windows.setdefault(at, set()).add(number)
        if len(ids) < window:
            shorts.setdefault(at, set()).add((len(ids), number))
    above = np.full(len(length), -1, np.int64)
    if shorts:
        for v in sorted(range(1, len(length)), key=length.__getitem__):
            above[v] = v if v in shorts else above[link[v]]
    size = len(vocabulary)
    pairs = np.unique(np.array([a * size + b for _, ids in numbered for a, b in zip(ids, ids[1:])], np.int64))
    moves = np.array([(s << 32 | w, t) for s, m in enumerate(follow) for w, t in m.items()], np.int64).reshape(-1, 2)
    moves = moves[np.argsort(moves[:, 0])]
    least = min([window, *(len(ids) for _, ids in numbered)])
    hashes = hash_each(list(vocabulary))
    order = np.argsort(hashes)
    window_states, window_bounds, window_items = _lists(windows)
    short_states, short_bounds, ending = _lists(shorts)
    ending = np.array(ending, np.int64).reshape(-1, 2)
    return [
        np.array([window, least], np.int64),
        hashes[order],
        order,
        *_joined(list(vocabulary)),
        moves[:, 0],
        moves[:, 1],
        np.array(length, np.int64),
        np.array(link, np.int64),
        pairs,
        window_states,
        window_bounds,
        np.array(window_items, np.int64),
        above,
        short_states,
        short_bounds,
        ending[:, 0],
        ending[:, 1],
        *_joined([name.encode() for name in names]),
    ]


def item_blocks(
    items: Iterable[tuple[str, list[bytes]]], most_words: int, window: int
) -> Iterator[list[tuple[str, list[bytes]]]]:
    """Items in blocks of at most `most_words` words, or of one window.

    A longer item comes in pieces; each of its windows is whole in one of them.
    """
    block, size = [], 0
    longest = max(most_words, window)
    for name, words in items:
        for start in range(0, max(1, len(words) - window + 1), longest - window + 1):
            piece = words[start : start + longest]
            if block and size + len(piece) > most_words:
                yield block
                block, size = [], 0
            if piece:
                block.append((name, piece))
                size += len(piece)
    if block:
        yield block


def write_automata(items: DataFrame, folder: str, window: int = WINDOW, block_words: int = BLOCK_WORDS) -> list[str]:
    """Build the automata of all items in tasks and write them; their names.

    An attempt that is repeated writes under names of its own, and the names of the one that
    counts come back.
    """
    items = items.select(F.col("item_id").cast("string").alias("item_id"), "text")
    words = items.agg(F.sum(F.regexp_count("text", F.lit(ITEM_WORD)))).first()[0] or 0

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, list[bytes]]]:
        for batch in batches:
            for name, text in zip(batch.column("item_id"), batch.column("text")):
                yield name.as_py() or "", words_of((text.as_py() or "").encode())

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in item_blocks(read(batches), block_words, window):
            name = f"automaton-{uuid.uuid4().hex}"
            write_arrays(folder, name, build(block, window))
            yield pa.RecordBatch.from_arrays([pa.array([name])], names=["name"])

    dealt = items.repartition(max(1, -(-words // (TASK_BLOCKS * block_words))))
    return sorted(r["name"] for r in dealt.mapInArrow(write, "name string").collect())


class _Matches:
    """The hit words and items of the texts of a block."""

    def __init__(self, block: Block):
        self.data = LOWER[block.data]
        self.starts, self.ends, self.bounds = word_spans(WORD_BYTE[self.data], block.offsets)
        self.hashes = word_hashes(self.data, self.starts, self.ends)
        self.hit = np.zeros(len(self.starts), bool)
        self.items: list[set[str]] = [set() for _ in range(len(block.rows))]

    def stretches(self, automaton: Automaton) -> Iterator[tuple[int, np.ndarray]]:
        """(first word, word numbers) of each run long enough whose words and pairs items have."""
        n, size, pairs = len(self.hashes), len(automaton.hashes), automaton.pairs
        if not n or not size:
            return
        place = np.minimum(np.searchsorted(automaton.hashes, self.hashes), size - 1)
        known = automaton.hashes[place] == self.hashes
        ids = np.where(known, automaton.order[place], -1)
        linked = np.zeros(n, bool)
        linked[1:] = known[1:] & known[:-1]
        linked[self.bounds[:-1][self.bounds[:-1] < n]] = False
        at = np.flatnonzero(linked)
        if len(pairs):
            key = ids[at - 1].astype(np.int64) * size + ids[at]
            linked[at] = pairs[np.minimum(np.searchsorted(pairs, key), len(pairs) - 1)] == key
        else:
            linked[at] = False
        firsts = np.flatnonzero(known & ~linked)
        # A run goes on as long as words are linked.
        breaks = np.flatnonzero(~linked)
        tos = np.append(breaks, n)[np.searchsorted(breaks, firsts, "right")]
        for a, b in zip(firsts.tolist(), tos.tolist()):
            if b - a >= automaton.least:
                yield a, ids[a:b]

    def match(self, automaton: Automaton) -> None:
        length, link, window = automaton.length, automaton.link, automaton.window
        for first, ids in self.stretches(automaton):
            row = int(np.searchsorted(self.bounds, first, "right")) - 1
            state = matched = 0
            for at, word in enumerate(ids.tolist(), first):
                # The hash said which word it is; make sure.
                if automaton.word(word) != self.data[self.starts[at] : self.ends[at]].tobytes():
                    state = matched = 0
                    continue
                to = automaton.move(state, word)
                while to < 0 and state:
                    state = int(link[state])
                    matched = int(length[state])
                    to = automaton.move(state, word)
                if to < 0:
                    state = matched = 0
                    continue
                state, matched = to, matched + 1
                if matched >= window:
                    self.hit[at - window + 1 : at + 1] = True
                    self.items[row].update(automaton.full(state))
                for n, name in automaton.short(state, matched):
                    self.hit[at - n + 1 : at + 1] = True
                    self.items[row].add(name)

    def to_carry(self) -> tuple[list[list[int]], list[list[str]]]:
        """Per row, first and last + 1 of each run of hit words, in turn; and the items."""
        first, last, bounds = word_spans(self.hit, self.bounds)
        flat = np.stack([first, last], axis=1) - np.repeat(self.bounds[:-1], np.diff(bounds))[:, None]
        runs = [flat[a:b].ravel().tolist() for a, b in zip(bounds, bounds[1:])]
        return runs, [sorted(x) for x in self.items]

    def carry_on(self, rows: pa.RecordBatch) -> None:
        for row, runs in enumerate(rows.column(RUNS).to_pylist()):
            for a, b in zip(runs[::2], runs[1::2]):
                self.hit[self.bounds[row] + a : self.bounds[row] + b] = True
        for found, names in zip(self.items, rows.column(ITEMS).to_pylist()):
            found.update(names)

    def per_row(self) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(self.hit)])
        return sums[self.bounds[1:]] - sums[self.bounds[:-1]]

    def spans(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Byte spans of the runs of hit words, and which of them begin each row."""
        first, last, bounds = word_spans(self.hit, self.bounds)
        return self.starts[first], self.ends[last - 1], bounds


def _matched(batches: Iterator[pa.RecordBatch], folder: str, names: list[str]) -> Iterator[tuple[Block, _Matches]]:
    held = [Automaton(mapped_arrays(folder, name)) for name in names]
    for block in blocks(batches):
        found = _Matches(block)
        if RUNS in block.rows.schema.names:
            found.carry_on(block.rows)
        for automaton in held:
            found.match(automaton)
        yield block, found


def _early_passes(docs: DataFrame, items: DataFrame, window: int, block_words: int) -> tuple[DataFrame, str, list[str]]:
    """All blocks but the last `PASS_BLOCKS` done; what they hit goes along in two columns.

    Also the folder and the names of the automata that are left.
    """
    folder = new_folder(docs.sparkSession, "automata")
    names = write_automata(items, folder, window, block_words)
    while len(names) > PASS_BLOCKS:
        now, names = names[:PASS_BLOCKS], names[PASS_BLOCKS:]
        if RUNS not in docs.columns:
            empty = F.array()
            docs = docs.withColumns({RUNS: empty.cast("array<long>"), ITEMS: empty.cast("array<string>")})

        def match(batches: Iterator[pa.RecordBatch], now: list[str] = now) -> Iterator[pa.RecordBatch]:
            for block, found in _matched(batches, folder, now):
                runs, hits = found.to_carry()
                columns = [*block.rows.columns[:-2], pa.array(runs, pa.list_(pa.int64())), pa.array(hits, pa.list_(pa.string()))]
                yield pa.RecordBatch.from_arrays(columns, names=block.rows.schema.names)

        docs = stage(docs.mapInArrow(match, docs.schema), "decontamination-pass")
    return docs, folder, names


def _contaminated(n_words: np.ndarray, n_hit: np.ndarray, coverage: int) -> np.ndarray:
    return (n_hit > 0) & (coverage * n_hit >= n_words)


def contamination(
    docs: DataFrame, items: DataFrame, window: int = WINDOW, coverage: int = COVERAGE, block_words: int = BLOCK_WORDS
) -> DataFrame:
    """Per document: its words, hit words, item ids found, hit byte spans and the verdict."""
    rows, folder, names = _early_passes(docs.select("doc_id", "text"), items, window, block_words)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, found in _matched(batches, folder, names):
            n_words, n_hit = np.diff(found.bounds).astype(np.int64), found.per_row().astype(np.int64)
            begin, end, bounds = found.spans()
            begin, end = begin - np.repeat(block.offsets[:-1], np.diff(bounds)), end - np.repeat(block.offsets[:-1], np.diff(bounds))
            pairs = pa.StructArray.from_arrays([pa.array(begin), pa.array(end)], names=["start", "end"])
            yield pa.RecordBatch.from_arrays(
                [
                    block.rows.column("doc_id"),
                    pa.array(n_words),
                    pa.array(n_hit),
                    pa.array([sorted(x) for x in found.items], pa.list_(pa.string())),
                    pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pairs),
                    pa.array(_contaminated(n_words, n_hit, coverage)),
                ],
                names=["doc_id", "n_words", "n_hit", "item_ids", "spans", "contaminated"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(
        judge,
        f"doc_id {kind}, n_words long, n_hit long, item_ids array<string>, "
        "spans array<struct<start: long, end: long>>, contaminated boolean",
    )


def items_digest(item_ids: list[str]) -> str:
    return hashlib.sha256(",".join(sorted(item_ids)).encode()).hexdigest()


def decontaminate(
    docs: DataFrame, items: DataFrame, window: int = WINDOW, coverage: int = COVERAGE, block_words: int = BLOCK_WORDS
) -> DataFrame:
    """The documents within the coverage limit, all columns, with the hit spans cut out.

    `n_chars`, where a document has it, follows the text.
    """
    names, schema = docs.columns, docs.schema
    docs, folder, automata = _early_passes(docs, items, window, block_words)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, found in _matched(batches, folder, automata):
            n_words, n_hit = np.diff(found.bounds), found.per_row()
            keep = ~_contaminated(n_words, n_hit, coverage)
            rows = block.rows.select(names)
            changed = np.flatnonzero(keep & (n_hit > 0))
            if len(changed):
                texts = rows.column("text").to_pylist()
                begin, end, bounds = found.spans()
                for row in changed.tolist():
                    base, kept, at = int(block.offsets[row]), [], 0
                    whole = texts[row].encode()
                    for i in range(bounds[row], bounds[row + 1]):
                        kept.append(whole[at : begin[i] - base])
                        at = int(end[i]) - base
                    texts[row] = b"".join([*kept, whole[at:]]).decode()
                columns = {name: rows.column(i) for i, name in enumerate(names)}
                columns["text"] = pa.array(texts, rows.schema.field("text").type)
                if "n_chars" in columns:
                    sizes = columns["n_chars"].to_pylist()
                    for row in changed.tolist():
                        sizes[row] = len(texts[row])
                    columns["n_chars"] = pa.array(sizes, columns["n_chars"].type)
                rows = pa.RecordBatch.from_arrays(list(columns.values()), names=names)
            yield rows.filter(pa.array(keep))

    return docs.mapInArrow(cut, schema)
