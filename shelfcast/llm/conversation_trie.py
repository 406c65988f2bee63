"""Conversation prefix trie: what conversations share from their first turn on, node by node.

Conversations become paths of turn digests, and those with one path become one row before
anything meets. The distinct paths are sorted over the cluster and cut into shards, ranges
of bounded size. In a shard the digests are numbered in order, its dictionary, and the paths
go into a ternary search tree, the middle one first, so that siblings are balanced. One pass
from the last node to the first, each after its children, adds up members, leaves and
savings. Nodes on the first and the last path of a shard may go on in its neighbours: their
parts are joined by the digest of their path, and what such nodes themselves add to their
ancestors is counted in the first shard that has them.

Ids of the members that end in a node are joined in order by ranges first, so a path of any
number of conversations reaches its digest as a few long rows, which are read as a stream.

Defined results: a null role or text counts as empty; turns come by number, null first, and
by the digest of role and text where numbers are equal; repeated rows are repeated turns;
rows without conv_id belong to no conversation; columns beyond conv_id, turn, role and text
are not read; an empty table gives an empty table. Texts of any length are read whole but
only their digest and size move on. The turns of a conversation are one path, in one row.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.session import stage

SHARD_TURNS = 1 << 17
"""Turns in the paths of a shard; a single longer path is a shard of its own."""
CHUNK_BYTES = 1 << 16
FAMILY, HEADS = 5, 9
NO_ENDS = hashlib.sha256(b"").hexdigest()


def conversation_paths(turns: DataFrame) -> DataFrame:
    """conv_id and its path: digest and text size of each turn, in order."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    whole = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    told = turns.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.struct("turn", F.unhex(F.sha2(whole, 256)).alias("digest"), F.octet_length(text).cast("long").alias("size")).alias("said"),
    )
    said = F.sort_array(F.collect_list("said"))
    path = F.transform(said, lambda t: F.struct(t["digest"].alias("digest"), t["size"].alias("size")))
    return told.groupBy("conv_id").agg(path.alias("path"))


def rebuild(paths: DataFrame, family: int = FAMILY, heads: int = HEADS) -> DataFrame:
    """Each conversation begins with the first turns of the first one of its family.

    crc32 of the id says how many it takes over, and as many of its own go."""
    own = F.col("conv_id")
    firsts = paths.filter(own % family == 0).select(own.alias("first_id"), F.slice("path", 1, heads - 1).alias("head"))
    taken = (F.crc32(own.cast("string")) % heads).cast("int")
    met = paths.withColumn("first_id", own - own % family).join(firsts, "first_id", "left")
    head = F.coalesce(F.slice("head", F.lit(1), taken), F.slice("path", 1, 0))
    rest = F.slice("path", taken + 1, F.greatest(F.size("path"), F.lit(1)))
    return met.select("conv_id", F.concat(head, rest).alias("path"))


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows by key and id become a row for each key and some ids: the ids, comma-joined."""
    names = ["key", "conv_id", "n", "ids"]
    key, ids, size, out = None, [], 0, []

    def close() -> None:
        if ids:
            out.append((key, ids[0], len(ids), ",".join(map(str, ids))))

    for batch in batches:
        for k, i in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if k != key or size > CHUNK_BYTES:
                close()
                key, ids, size = k, [], 0
            ids.append(i)
            size += 8
        if len(out) > 1024:
            yield _arrow(names, [pa.binary(), pa.int64(), pa.int64(), pa.string()], out)
            out.clear()
    close()
    if out:
        yield _arrow(names, [pa.binary(), pa.int64(), pa.int64(), pa.string()], out)


def _arrow(names: list[str], kinds: list[pa.DataType], rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)


def _ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of chunks in order become conv_id, n and the digest of the ids of each key."""
    key, state, first, total, out = None, None, 0, 0, []
    kinds, names = [pa.int64(), pa.int64(), pa.string()], ["conv_id", "n", "ends"]
    for batch in batches:
        for k, i, n, ids in zip(*(c.to_pylist() for c in batch.columns)):
            if k != key:
                if state:
                    out.append((first, total, state.hexdigest()))
                key, state, first, total = k, hashlib.sha256(), i, 0
            else:
                state.update(b",")
            state.update(ids.encode())
            total += n
        if len(out) > 4096:
            yield _arrow(names, kinds, out)
            out = []
    if state:
        out.append((first, total, state.hexdigest()))
    if out:
        yield _arrow(names, kinds, out)


def distinct_paths(paths: DataFrame) -> DataFrame:
    """A row for each different path: turns, sizes, its smallest conv_id, n and ends."""
    hexes = F.array_join(F.transform("path", lambda t: F.hex(t["digest"])), "")
    keyed = paths.select(F.unhex(F.sha2(hexes, 256)).alias("key"), "conv_id")
    ranged = keyed.repartitionByRange("key", "conv_id").sortWithinPartitions("key", "conv_id")
    chunks = ranged.mapInArrow(_chunks, "key binary, conv_id long, n long, ids string")
    chunks = chunks.repartition("key").sortWithinPartitions("key", "conv_id")
    named = chunks.mapInArrow(_ends, "conv_id long, n long, ends string")
    # The smallest conv_id of a path finds it, so no path of many conversations meets itself.
    return named.join(paths, "conv_id").select(
        "conv_id", "n", "ends",
        F.transform("path", lambda t: t["digest"]).alias("turns"), F.transform("path", lambda t: t["size"]).alias("sizes"),
    )


class _TernaryTree:
    """A ternary search tree over numbered turns. Node 0 is the root of the trie; `less` and
    `more` lead to siblings, `down` to children, `up` to the parent in the trie."""

    def __init__(self) -> None:
        self.turn, self.less, self.more, self.down, self.up, self.depth, self.size = [-1], [0], [0], [0], [0], [0], [0]
        self.ended, self.conv, self.ends = [0], [None], [None]

    def _new(self, turn: int, up: int, size: int) -> int:
        for column, value in (
            (self.turn, turn), (self.less, 0), (self.more, 0), (self.down, 0), (self.up, up),
            (self.depth, self.depth[up] + 1), (self.size, size), (self.ended, 0), (self.conv, None), (self.ends, None),
        ):
            column.append(value)
        return len(self.turn) - 1

    def insert(self, path: list[int], sizes: list[int], conv: int, n: int, ends: str) -> list[int]:
        """The nodes of the path, from the root on."""
        at, nodes = 0, [0]
        for turn, size in zip(path, sizes):
            side, from_, now = self.down, at, self.down[at]
            while now and self.turn[now] != turn:
                side, from_ = (self.less, now) if turn < self.turn[now] else (self.more, now)
                now = side[now]
            if not now:
                now = side[from_] = self._new(turn, at, size)
            nodes.append(at := now)
        self.ended[at], self.conv[at], self.ends[at] = n, conv, ends
        return nodes


NODES = (
    "shard long, side int, depth long, key binary, parent_key binary, conv_id long, parent_conv_id long, "
    "n_convs long, n_children long, n_leaves long, saved_tokens long, size long, ends string"
)
_KINDS = [
    pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.int64(),
    pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(),
]


def _shard_nodes(rows: list[tuple], shard: int) -> list[tuple]:
    """The nodes of a shard; those of its first and last path have a key and parts only."""
    numbers = {digest: i for i, digest in enumerate(sorted({d for _, _, _, turns, _ in rows for d in turns}))}
    tree, first, last = _TernaryTree(), [], []
    spans = [(0, len(rows))]
    while spans:
        low, high = spans.pop()
        if low >= high:
            continue
        middle = (low + high) // 2
        conv, n, ends, turns, sizes = rows[middle]
        nodes = tree.insert([numbers[d] for d in turns], sizes, conv, n, ends)
        if middle == 0:
            first = nodes
        if middle == len(rows) - 1:
            last = nodes
        spans += [(low, middle), (middle + 1, high)]
    count = len(tree.turn)
    key: list[bytes | None] = [None] * count
    side = [0] * count
    for way, (nodes, row) in enumerate(((first, rows[0]), (last, rows[-1])), 1):
        digest = b""
        for node, turn in zip(nodes, [b"", *row[3]]):
            digest = hashlib.sha256(digest + turn).digest()
            side[node] = 0 if key[node] else way
            key[node] = digest
    side[0] = 0
    members, children, leaves, saved = list(tree.ended), [0] * count, [0] * count, [0] * count
    conv = tree.conv
    for node in range(count - 1, -1, -1):  # a node comes after its parent
        edge = key[node] is not None
        if not edge:
            leaves[node] = leaves[node] or 1
            saved[node] += (members[node] - 1) * tree.size[node]
        if node:
            up = tree.up[node]
            members[up] += members[node]
            children[up] += not edge
            leaves[up] += leaves[node]
            saved[up] += saved[node]
            conv[up] = conv[node] if conv[up] is None else min(conv[up], conv[node])
    out = []
    for node in range(count):
        up = tree.up[node]
        inner = node and key[up] is None
        out.append(
            (
                shard, side[node], tree.depth[node], key[node], key[up] if node else None, conv[node],
                conv[up] if inner else None, members[node], children[node], leaves[node], saved[node],
                tree.size[node], tree.ends[node],
            )
        )
    return out


def trie_nodes(distinct: DataFrame, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """The nodes of each shard of the sorted paths (NODES)."""
    ordered = distinct.repartitionByRange("turns").sortWithinPartitions("turns")
    names = [c.split()[0] for c in NODES.split(", ")]

    def grow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        shard, rows, held = TaskContext.get().partitionId() << 32, [], 0

        def close() -> Iterator[pa.RecordBatch]:
            found = _shard_nodes(rows, shard)
            for i in range(0, len(found), 1 << 14):
                yield _arrow(names, _KINDS, found[i : i + (1 << 14)])

        for batch in batches:
            for i in range(batch.num_rows):
                row = tuple(batch.column(c)[i].as_py() for c in range(5))
                if rows and held + len(row[3]) > shard_turns:
                    yield from close()
                    shard, rows, held = shard + 1, [], 0
                rows.append(row)
                held += len(row[3]) + 1
        if rows:
            yield from close()

    return ordered.select("conv_id", "n", "ends", "turns", "sizes").mapInArrow(grow, NODES)


def _merged(edges: DataFrame) -> DataFrame:
    """Nodes of shard edges put together: parts summed, and what they add to each other."""
    total = lambda c: F.sum(c).alias(c)
    whole = edges.groupBy("key").agg(
        F.first("depth").alias("depth"), F.first("parent_key").alias("parent_key"), F.first("size").alias("size"),
        F.min("conv_id").alias("conv_id"), F.max("ends").alias("ends"), F.min("shard").alias("shard"),
        *[total(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")],
    )
    kids = whole.filter("parent_key IS NOT NULL").groupBy(F.col("parent_key").alias("key")).agg(F.count("*").alias("kids"))
    whole = whole.join(kids, "key", "left").withColumn("n_children", F.col("n_children") + F.coalesce("kids", F.lit(0)))
    childless = (F.col("n_children") == 0).cast("long")
    whole = whole.withColumns({"own_leaf": childless, "own_saved": (F.col("n_convs") - 1) * F.col("size")}).drop("kids")
    whole = stage(whole, "trie-edges")
    # What a node adds goes to its ancestors in the first shard it is in.
    own = whole.select("key", "shard", "own_leaf", "own_saved")
    chains = edges.select("shard", "side", "depth", "key").join(own, ["key", "shard"], "left")
    below = "(PARTITION BY {} ORDER BY depth DESC RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"

    chains = chains.select(
        "key", "shard", "side", "depth", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("own_leaf", "own_saved")]
    )
    for name in ("leaf", "saved"):
        shared, own_side = (F.expr(f"sum(own_{name}) OVER {below.format(keys)}") for keys in ("shard", "shard, side"))
        under = F.when(F.col("side") == 0, shared).otherwise(own_side)
        chains = chains.withColumn(f"under_{name}", F.coalesce(under, F.lit(0)))
    below_all = chains.groupBy("key").agg(total("under_leaf"), total("under_saved"))
    parents = whole.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("parent_conv_id"))
    return (
        whole.join(below_all, "key")
        .join(parents, "parent_key", "left")
        .withColumn("n_leaves", F.col("n_leaves") + F.col("own_leaf") + F.col("under_leaf"))
        .withColumn("saved_tokens", F.col("saved_tokens") + F.col("own_saved") + F.col("under_saved"))
    )


RESULT = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def prefix_trie(paths: DataFrame, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """A row per node of the trie of (conv_id, path): RESULT."""
    nodes = stage(trie_nodes(distinct_paths(stage(paths, "trie-paths")), shard_turns), "trie-nodes")
    edges = nodes.filter("key IS NOT NULL")
    merged = stage(_merged(edges), "trie-merged")
    inside = nodes.filter("key IS NULL")
    known = inside.filter("parent_key IS NULL")
    # Children of an edge node look their parent up within their own shard.
    named = edges.select("shard", F.col("key").alias("parent_key")).join(
        merged.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("found")), "parent_key"
    )
    below = inside.filter("parent_key IS NOT NULL").join(named, ["shard", "parent_key"])
    below = below.withColumn("parent_conv_id", F.col("found"))
    every = known.select(*RESULT[:-1], "ends")
    for some in (below, merged):
        every = every.unionByName(some.select(*RESULT[:-1], "ends"))
    return every.select(*RESULT[:-1], F.coalesce("ends", F.lit(NO_ENDS)).alias("ends_sha256"))


def conversation_trie(turns: DataFrame) -> DataFrame:
    """The nodes of the trie of all rebuilt conversations."""
    return prefix_trie(rebuild(stage(conversation_paths(turns), "trie-told")))
