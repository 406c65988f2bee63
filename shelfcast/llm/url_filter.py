"""URL filter: rules as a sorted array of 64-bit digests with their full strings.

A rule is a host and a path; it fits its host and all subdomains where the url's path
starts with the rule's. Rules are keyed by the xxHash of host + path and written, sorted, as
arrays that workers memory-map. A batch of urls makes one array of probes (each suffix of the
host with each path prefix of a length that rules have), which a vectorised binary search
looks up; what is found counts only if the stored string is the probe's, so a collision of
digests cannot judge a url.

Defined results: the longest rule wins, of two as long the one with the longer host; a null
url or one without `://` has empty host and path and gets the verdict where nothing fits;
rules that are repeated count once, of contradicting ones `block`; no rules fit nothing.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.arrays import mapped, new_folder, shard_of, write_array

SHARD_RULES = 2_000_000
ALLOW, BLOCK = "allow", "block"
_AFTER_HOST, _AFTER_PATH = re.compile("[/?#]"), re.compile("[?#]")
_UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host_and_path(url: str | None) -> tuple[str, str]:
    _, found, rest = (url or "").partition("://")
    if not found:
        return "", ""
    end = _AFTER_HOST.search(rest)
    host = rest[: end.start()] if end else rest
    return host.translate(_UPPER), _AFTER_PATH.split(rest[len(host) :], maxsplit=1)[0]


def _key(host: str, path: str) -> int:
    return xxhash.xxh64_intdigest(f"{host}\n{path}")


def build_index(rules: DataFrame) -> dict:
    """Write the arrays of (host, path, verdict, listed) rules; returns where they are.

    `listed` marks entries of a block list: they count only where no other rule fits, and
    are not named in results. Each shard of the digest range is sorted in a task of its own.
    """
    folder = new_folder(rules.sparkSession, "url-rules")
    merged = rules.groupBy("host", "path", "listed").agg(F.max("verdict").alias("verdict"))  # block > allow
    shards = max(1, -(-merged.count() // SHARD_RULES))

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hosts, paths = batch.column("host").to_pylist(), batch.column("path").to_pylist()
            keys = np.array([_key(h, p) for h, p in zip(hosts, paths)], np.uint64)
            shard = shard_of(keys, shards)
            added = batch.append_column("key", pa.array(keys.view(np.int64)))
            yield added.append_column("shard", pa.array(shard))

    def write(key: tuple, table: pa.Table) -> pa.Table:
        shard = key[0].as_py()
        keys = np.array(table.column("key").to_numpy()).view(np.uint64)
        order = np.argsort(keys, kind="stable")
        hosts, paths = table.column("host").to_pylist(), table.column("path").to_pylist()
        verdicts, listed = table.column("verdict").to_pylist(), table.column("listed").to_pylist()
        strings = [f"{hosts[i]}\n{paths[i]}".encode() for i in order]
        kinds = [2 * bool(listed[i]) + (verdicts[i] == BLOCK) for i in order]
        write_array(folder, f"keys-{shard:05d}", keys[order])
        write_array(folder, f"ends-{shard:05d}", np.cumsum([0, *map(len, strings)]).astype(np.int64))
        write_array(folder, f"strings-{shard:05d}", np.frombuffer(b"".join(strings), np.uint8))
        write_array(folder, f"kinds-{shard:05d}", np.array(kinds, np.uint8))
        lengths = sorted({len(p) for p in paths})
        return pa.table({"shard": [shard], "lengths": [lengths]}, schema=pa.schema([("shard", pa.int64()), ("lengths", pa.list_(pa.int64()))]))

    keyed = merged.select("host", "path", "verdict", "listed").mapInArrow(
        number, "host string, path string, verdict string, listed boolean, key long, shard long"
    )
    written = keyed.groupBy("shard").applyInArrow(write, "shard long, lengths array<long>").collect()
    return {
        "folder": folder,
        "shards": shards,
        "written": sorted(r["shard"] for r in written),
        "lengths": sorted({n for r in written for n in r["lengths"]}),
    }


class Index:
    """The mapped arrays and the search in them."""

    def __init__(self, place: dict):
        self.shards, self.lengths = place["shards"], place["lengths"]
        self.arrays = {
            s: [mapped(place["folder"], f"{name}-{s:05d}") for name in ("keys", "ends", "strings", "kinds")]
            for s in place["written"]
        }

    def find(self, probes: list[tuple[str, str]]) -> list[int]:
        """The kinds of rule stored for each (host, path), as bits by kind; 0 for none."""
        found = [0] * len(probes)
        keys = np.array([_key(*p) for p in probes], np.uint64)
        shard = shard_of(keys, self.shards)
        for s, (stored, ends, strings, kinds) in self.arrays.items():
            mine = np.flatnonzero(shard == s)
            left = np.searchsorted(stored, keys[mine], "left")
            right = np.searchsorted(stored, keys[mine], "right")
            for i in np.flatnonzero(right > left).tolist():
                probe = "\n".join(probes[mine[i]]).encode()
                for at in range(left[i], right[i]):
                    if strings[ends[at] : ends[at + 1]].tobytes() == probe:
                        found[mine[i]] |= 1 << int(kinds[at])
        return found


def probes_of(host: str, path: str, lengths: list[int]) -> list[tuple[str, str]]:
    """The rules that could fit, as (host, path), longest first."""
    labels = host.split(".")
    suffixes = [".".join(labels[i:]) for i in range(len(labels))] if host else []
    pairs = [(h, path[:n]) for h in suffixes for n in lengths if n <= len(path)]
    return sorted(pairs, key=lambda p: (-len(p[0]) - len(p[1]), -len(p[0])))


def judge_urls(pages: DataFrame, place: dict, otherwise: str = ALLOW, most_probes: int = 1 << 16) -> DataFrame:
    """page_id, host, path, rule (null where none fits) and verdict of every url."""

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Index(place)
        for batch in batches:
            parts = [host_and_path(u) for u in batch.column("url").to_pylist()]
            rules: list[str | None] = []
            verdicts: list[str] = []
            waiting: list[list[tuple[str, str]]] = []

            def settle() -> None:
                kinds = iter(index.find([p for probes in waiting for p in probes]))
                for probes in waiting:
                    rule, verdict, listed = None, None, None
                    for probe in probes:
                        kind = next(kinds)
                        if kind & 3 and verdict is None:
                            rule, verdict = "".join(probe), BLOCK if kind & 2 else ALLOW
                        if kind >> 2 and listed is None:
                            listed = BLOCK if kind >> 3 else ALLOW
                    rules.append(rule)
                    verdicts.append(verdict or listed or otherwise)
                waiting.clear()

            n = 0
            for host, path in parts:
                waiting.append(probes_of(host, path, index.lengths))
                n += len(waiting[-1])
                if n >= most_probes:
                    settle()
                    n = 0
            settle()
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("page_id"),
                    pa.array([h for h, _ in parts], pa.string()),
                    pa.array([p for _, p in parts], pa.string()),
                    pa.array(rules, pa.string()),
                    pa.array(verdicts, pa.string()),
                ],
                names=["page_id", "host", "path", "rule", "verdict"],
            )

    kind = pages.schema["page_id"].dataType.simpleString()
    return pages.select("page_id", "url").mapInArrow(
        judge, f"page_id {kind}, host string, path string, rule string, verdict string"
    )
