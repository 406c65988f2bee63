"""The conversation trie against plain dictionaries of prefixes."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

from shelfcast.llm import conversation_trie as trie

COLUMNS = "conv_id long, turn long, role string, text string, depth long, key string"


def rebuilt(rows):
    told = defaultdict(list)
    for conv, turn, role, text, *_ in rows:
        if conv is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()
            told[conv].append(((turn is not None, turn or 0, digest), (role, text)))
    told = {c: [t for _, t in sorted(ts)] for c, ts in told.items()}
    out = {}
    for c, own in told.items():
        h = zlib.crc32(str(c).encode()) % 9
        rest = c - c % 5 if c >= 0 else c + -c % 5  # the remainder has the sign of the id
        out[c] = told.get(rest, [])[:h] + own[h:]
    return out


def nodes(paths):
    members = defaultdict(list)
    for c, turns in paths.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    out = set()
    for key, of in members.items():
        below = [k for k in members if k[: len(key)] == key]
        children = lambda k: sum(len(x) == len(k) + 1 and x[: len(k)] == k for x in members)
        ends = ",".join(str(c) for c in sorted(of) if len(paths[c]) == len(key))
        out.add(
            (
                min(of), len(key), min(members[key[:-1]]) if key else None, len(of), children(key),
                sum(not children(k) for k in below), sum((len(members[k]) - 1) * len(k[-1][1].encode()) for k in below if k),
                hashlib.sha256(ends.encode()).hexdigest(),
            )
        )
    return out


def as_rows(df):
    got = [tuple(r) for r in df.select(trie.RESULT).collect()]
    assert len(got) == len(set(got))
    return set(got)


def made(rng, conversations):
    """Few different turns, so that conversations share much and many are the same."""
    rows = []
    for c in range(conversations):
        for t in range(rng.choice([0, 1, 2, 3, 5, 12])):
            said = "hello é" if t == 0 and rng.random() < 0.7 else rng.choice(["", "a", "ab", None, "a" * 9, "ünï"])
            rows.append((c, t if rng.random() < 0.9 else None, "user" if t % 2 == 0 else rng.choice(["assistant", None]), said, 7, "k"))
    return rows


def test_nodes_whatever_the_shards(spark):
    rng = random.Random(2)
    for conversations, shard_turns, partitions in ((60, 1 << 17, 1), (60, 1, 5), (80, 4, 3), (40, 12, 2)):
        rows = made(rng, conversations)
        rows += rows[:3] + [(None, 0, "user", "nobody's", 7, "k")]
        turns = spark.createDataFrame(rows, COLUMNS).repartition(partitions)
        paths = trie.rebuild(trie.conversation_paths(turns))
        assert as_rows(trie.prefix_trie(paths, shard_turns)) == nodes(rebuilt(rows))


def test_many_of_one_conversation_and_a_very_long_one(spark):
    rows = [(c, t, "user", "same", 0, None) for c in range(300) for t in range(2)]
    rows += [(7000, t, "user", f"turn {t}", 0, None) for t in range(60)] + [(7001, 0, "user", "x" * 300_000, 0, None)]
    turns = spark.createDataFrame(rows, COLUMNS).repartition(4)
    paths = trie.rebuild(trie.conversation_paths(turns))
    assert as_rows(trie.prefix_trie(paths, 16)) == nodes(rebuilt(rows))


def test_chunks_of_ids_read_as_one(spark, monkeypatch):
    monkeypatch.setattr(trie, "CHUNK_BYTES", 20)
    rows = [(c, 0, "user", "same", 0, None) for c in range(90)]
    turns = spark.createDataFrame(rows, COLUMNS).repartition(4)
    assert as_rows(trie.conversation_trie(turns)) == nodes(rebuilt(rows))


def test_odd_and_empty_tables(spark):
    rows = [(None, None, None, None, None, None), (3, None, None, None, None, None), (-4, 2, "", "", 0, ""), (-5, 2, None, "b", 0, "")]
    turns = spark.createDataFrame(rows, COLUMNS)
    assert as_rows(trie.conversation_trie(turns)) == nodes(rebuilt(rows))
    assert as_rows(trie.conversation_trie(turns.limit(0))) == set()
    none = turns.filter("conv_id IS NULL")
    assert as_rows(trie.conversation_trie(none)) == set()
