"""Chat formatting into prefix trees: turns that conversations share are emitted once.

Conversations are formatted with a template that marks turns; control strings inside texts
are escaped, reversibly. Distinct conversations are sorted by the path of their turns, so
those with the same beginning follow each other; a pass over each sorted partition merges
them into trees and emits each tree's tokens depth first. Every token has a position id (its
place in its own conversation) and every node the intervals of tokens it may attend to: its
ancestors' and its own.

A tree holds at most `TREE_TOKENS` tokens or one conversation; a larger family, such as
conversations with one very common first turn, becomes several trees that repeat the turns
they share. The sort deals distinct paths only, so neither a common turn nor a conversation
with thousands of copies fills a task: copies are one path and meet their ids again by digest.

Defined results: a null text or role is empty; turns are ordered by turn, then role and
text, and repeated rows are turns of their own; rows without conv_id form one conversation;
an empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.packing import encoder
from shelfcast.session import stage

TREE_TOKENS = 32_768
OPEN, CLOSE = "<|turn|>", "</s>"
LEARNED_ROLE = "assistant"

# Strings that templates use as control, and what stands for them in a text.
ESCAPES = {
    "\\": "\\\\",
    "<|turn|>": "\\t",
    "</s>": "\\e",
    "<s>": "\\s",
    "[INST]": "\\i",
    "[/INST]": "\\o",
    "<<SYS>>": "\\y",
    "<</SYS>>": "\\z",
}
LINE_END = "\\n"  # within a role, which a line end closes

_CONTROL = re.compile("|".join(re.escape(c) for c in ESCAPES))
_ESCAPED = re.compile(r"\\(.)", re.S)
_BACK = {v[1]: k for k, v in ESCAPES.items()} | {"n": "\n"}

TREES = (
    "tree_id long, tokens array<int>, position_ids array<int>, loss_mask array<boolean>, "
    "nodes array<struct<parent: int, start: int, end: int, attends: array<struct<start: int, end: int>>>>, "
    "leaves array<struct<digest: string, node: int>>"
)


def escape(text: str) -> str:
    return _CONTROL.sub(lambda m: ESCAPES[m[0]], text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(lambda m: _BACK[m[1]], text)


def segments(role: str, text: str) -> list[tuple[str, bool]]:
    """A formatted turn in parts, each with whether it is learned."""
    head = f"{OPEN}{escape(role)}".replace("\n", LINE_END) + "\n"
    return [(head, False), (escape(text), role == LEARNED_ROLE), (CLOSE, False)]


def parse(formatted: str) -> list[tuple[str, str]]:
    """The (role, text) turns of a formatted conversation."""
    turns = []
    for part in formatted.split(OPEN)[1:]:
        role, _, text = part.partition("\n")
        turns.append((unescape(role), unescape(text.removesuffix(CLOSE))))
    return turns


def conversations(turns: DataFrame) -> DataFrame:
    """conv_id, turns (role and text in order) and the digest of them."""
    told = turns.select(
        "conv_id",
        F.struct(
            "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
        ).alias("said"),
    )
    grouped = told.groupBy("conv_id").agg(F.sort_array(F.collect_list("said")).alias("said"))
    kept = F.transform("said", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))
    rows = grouped.select("conv_id", kept.alias("turns"))
    return rows.withColumn("digest", F.sha2(F.to_json("turns"), 256))


def _path(turns: Column) -> Column:
    return F.transform(turns, lambda t: F.xxhash64(t["role"], t["text"]))


class _Tree:
    """A tree in the making: the turns of the last path, and all that is emitted."""

    def __init__(self, number: int):
        self.number = number
        self.path: list[tuple] = []
        self.nodes: list[int] = []
        self.tokens: list[int] = []
        self.positions: list[int] = []
        self.mask: list[bool] = []
        self.places: list[dict] = []
        self.leaves: list[dict] = []

    def shared(self, turns: list[tuple]) -> int:
        same = 0
        while same < min(len(turns), len(self.path)) and turns[same] == self.path[same]:
            same += 1
        return same

    def add(self, turns: list[tuple], tokens: list[list[tuple[list[int], bool]]], digest: str) -> None:
        same = self.shared(turns)
        del self.nodes[same:]
        for parts in tokens:
            parent = self.nodes[-1] if self.nodes else -1
            start = len(self.tokens)
            above = self.places[parent]["attends"] if self.nodes else []
            at = sum(i["end"] - i["start"] for i in above)
            for ids, learned in parts:
                self.tokens += ids
                self.mask += [learned] * len(ids)
            end = len(self.tokens)
            self.positions += range(at, at + end - start)
            # The interval of a node that follows its parent at once joins the parent's.
            if above and above[-1]["end"] == start:
                attends = [*above[:-1], {"start": above[-1]["start"], "end": end}]
            else:
                attends = [*above, {"start": start, "end": end}]
            self.places.append({"parent": parent, "start": start, "end": end, "attends": attends})
            self.nodes.append(len(self.places) - 1)
        self.path = turns
        self.leaves.append({"digest": digest, "node": self.nodes[-1]})

    def row(self) -> dict:
        return {
            "tree_id": self.number, "tokens": self.tokens, "position_ids": self.positions, "loss_mask": self.mask,
            "nodes": self.places, "leaves": self.leaves,
        }


def _arrow_schema() -> pa.Schema:
    span = pa.struct([("start", pa.int32()), ("end", pa.int32())])
    node = pa.struct([("parent", pa.int32()), ("start", pa.int32()), ("end", pa.int32()), ("attends", pa.list_(span))])
    return pa.schema(
        [
            ("tree_id", pa.int64()),
            ("tokens", pa.list_(pa.int32())),
            ("position_ids", pa.list_(pa.int32())),
            ("loss_mask", pa.list_(pa.bool_())),
            ("nodes", pa.list_(node)),
            ("leaves", pa.list_(pa.struct([("digest", pa.string()), ("node", pa.int32())]))),
        ]
    )


def prefix_trees(rows: DataFrame, vocabulary: str, most_tokens: int = TREE_TOKENS) -> DataFrame:
    """A row per tree of the conversations (turns, digest); copies count once."""
    distinct = rows.select("digest", "turns").dropDuplicates(["digest"])
    paths = distinct.withColumn("path", _path(F.col("turns")))
    ordered = paths.repartitionByRange("path", "digest").sortWithinPartitions("path", "digest")

    def grow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encode, schema = encoder(vocabulary).encode_ordinary, _arrow_schema()
        number = TaskContext.get().partitionId() << 40
        tree = _Tree(number)
        for batch in batches:
            for i in range(0, batch.num_rows, 64):
                some = batch.slice(i, 64)
                done = []
                for digest, told in zip(some.column("digest").to_pylist(), some.column("turns").to_pylist()):
                    turns = [(t["role"], t["text"]) for t in told]
                    same = tree.shared(turns)
                    said = lambda part: [[(encode(s), learned) for s, learned in segments(*t)] for t in part]
                    tokens = said(turns[same:])
                    size = sum(len(ids) for parts in tokens for ids, _ in parts)
                    if tree.leaves and (not same or len(tree.tokens) + size > most_tokens):
                        done.append(tree.row())
                        number += 1
                        tree = _Tree(number)
                        tokens = said(turns[:same]) + tokens
                    tree.add(turns, tokens, digest)
                if done:
                    yield pa.RecordBatch.from_pylist(done, schema)
        if tree.leaves:
            yield pa.RecordBatch.from_pylist([tree.row()], schema)

    return ordered.select("digest", "turns").mapInArrow(grow, TREES)


def read_back(trees: DataFrame, vocabulary: str) -> DataFrame:
    """What the trees say of each conversation, from tokens, mask, positions and intervals."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decode = encoder(vocabulary).decode_bytes
        for batch in batches:
            for i in range(batch.num_rows):
                tokens, positions, mask = (batch.column(c)[i].values.to_numpy(zero_copy_only=False) for c in (1, 2, 3))
                nodes, out = batch.column(4)[i].as_py(), []
                for leaf in batch.column(5)[i].as_py():
                    spans = [(s["start"], s["end"]) for s in nodes[leaf["node"]]["attends"]]
                    at = np.concatenate([np.arange(a, b) for a, b in spans])
                    at = at[np.argsort(positions[at], kind="stable")]
                    formatted = decode(tokens[at].tolist()).decode()
                    turns = parse(formatted)
                    learned = unescape(decode(tokens[at[mask[at]]].tolist()).decode())
                    told = "".join(chain.from_iterable((role, "\n", text, "\n") for role, text in turns))
                    out.append(
                        (
                            leaf["digest"], len(turns), hashlib.sha256(told.encode()).hexdigest(), len(learned),
                            hashlib.sha256(learned.encode()).hexdigest(), len(formatted),
                        )
                    )
                kinds = [pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
                names = ["digest", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=names)

    return trees.mapInArrow(
        read,
        "digest string, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long",
    )


def format_chats(turns: DataFrame, vocabulary: str, most_tokens: int = TREE_TOKENS) -> tuple[DataFrame, DataFrame]:
    """The trees, and the digest of each conv_id that finds its leaf in them."""
    rows = stage(conversations(turns), "chat-conversations")
    return prefix_trees(rows, vocabulary, most_tokens), rows.select("conv_id", "digest")
